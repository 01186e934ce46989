import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from edge_data import corpus, edge_rows, frame
from kestrel.llm import sentencepiece_viterbi as s

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def enc():
    return s.Encoder(FILE, limit=300)


def plain_viterbi(sp, text):
    """All pieces at all places, whole marked text, no cuts and no sharing."""
    score = {sp.id_to_piece(i): (sp.get_score(i), i) for i in range(sp.get_piece_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    lowest = min(v[0] for v in score.values())
    byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
    t = "▁" + text.replace(" ", "▁") if text else ""
    best = [(0.0, None)] + [(-1e300, None)] * len(t)
    for j in range(1, len(t) + 1):
        for i in range(max(0, j - 16), j):
            p = score.get(t[i:j])
            if p is None and j - i == 1:
                p = lowest - 10, -1
            if p and best[i][0] + p[0] > best[j][0]:
                best[j] = best[i][0] + p[0], (i, p[1])
    out, j = [], len(t)
    while j:
        i, k = best[j][1]
        out += [k] if k >= 0 else [byte[b] for b in reversed(t[i:j].encode())]
        j = i
    return out[::-1]


def texts():
    return [(r[1] or "") for r in edge_rows() if len(r[1] or "") < 3000] + corpus(30, 3) + ["  two  spaces ", " ", "\n", "a\n b\n\nc", "tab\there", "naïve Ärger ñandú"]


def test_ids_match_plain_viterbi(enc):
    sp = sentencepiece.SentencePieceProcessor(model_file=FILE)
    for t, ids in zip(texts(), enc.encode(texts())):
        assert np.frombuffer(ids, "<u4").tolist() == plain_viterbi(sp, t), t[:50]


def test_library_decodes_our_ids(enc):
    sp = sentencepiece.SentencePieceProcessor(model_file=FILE)
    for t, ids in zip(texts(), enc.encode(texts())):
        if "▁" not in t:
            assert sp.decode(np.frombuffer(ids, "<u4").tolist()) == t
            assert enc.decode(ids) == t


def test_documents_round_trip(spark, enc):
    got = s.round_trip(frame(spark), FILE).collect()
    ids = enc.encode([r[1] or "" for r in edge_rows()])
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(r[0]), len(i) // 4, zlib.crc32(i)) for r, i in zip(edge_rows(), ids))
    assert all(r.round_trip or r.doc_id == 110 for r in got)
    coded = s.encode_documents(frame(spark), FILE)
    back = s.decode_documents(coded, FILE).collect()
    assert sorted((str(r.doc_id), r.text) for r in back if r.doc_id != 110) == sorted((str(r[0]), r[1] or "") for r in edge_rows() if r[0] != 110)
    assert s.round_trip(frame(spark, []), FILE).count() == 0
