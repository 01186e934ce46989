import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from edge_data import corpus, edge_rows, frame
from kestrel.llm import token_orc as t
from kestrel.storage import scratch_path

FILE = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_equal_the_library_on_whole_texts():
    texts = [r[1] or "" for r in edge_rows()] + corpus(40, 7) + ["ends in space ", " starts", "a, b. c.\nD e,f", "naïve Ärger, Ça.", "x\n\ny", "it's we'll", "a .b ,c", "1,2. 3."]
    lib = Tokenizer.from_file(FILE)
    enc = t.PieceEncoder(FILE, limit=50)
    got = enc.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [lib.encode(x, add_special_tokens=False).ids for x in texts]


def test_round_trip_spans(spark):
    lib = Tokenizer.from_file(FILE)
    rows = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in edge_rows()), key=lambda r: r[:2])
    ids = [lib.encode(x, add_special_tokens=False).ids + [0] for *_, x in rows]
    got = t.round_trip(frame(spark), FILE).collect()
    want = sorted(((r[0], r[1], len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for r, i in zip(rows, ids)))
    assert sorted((g.doc_id is not None, g.doc_id or 0, g.n_tokens, g.ids_crc32) for g in got) == want
    # starts are gapless and follow doc_id order
    by_start = sorted(got, key=lambda g: g.start)
    assert [g.start for g in by_start] == np.concatenate([[0], np.cumsum([g.n_tokens for g in by_start])[:-1]]).tolist()
    order = [(g.doc_id is not None, g.doc_id or 0) for g in by_start]
    assert order == sorted(order)


def test_filter_reads_only_the_wanted_documents(spark):
    path = scratch_path(spark, "orc")
    t.write_token_orc(frame(spark), path, FILE)
    df = t.read_token_orc(spark, path, [3, 5])
    assert "In(doc_id, [3,5])" in df._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in df.collect()) == [3, 5]


def test_empty_table(spark):
    assert t.round_trip(frame(spark, []), FILE).count() == 0
