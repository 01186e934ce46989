import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from edge_data import SCHEMA, edge_rows, frame
from kestrel.llm import vector_packing as v

FILE = public_tokenizers.path("byte_bpe_50k.json")


def plain_packing(pieces, limits):
    """The dot-product heuristic without cuts, by lists."""
    pool = list(pieces)
    n = len(pool)
    mean = [sum(p.length for p in pool) / n / limits.tokens, 1 / limits.segments, sum(p.loss for p in pool) / n / limits.loss]
    out = []
    while pool:
        left, sequence = [limits.tokens, limits.segments, limits.loss], []
        while True:
            fits = [p for p in pool if p.length <= left[0] and left[1] and p.loss <= left[2]]
            if not fits:
                break
            share = [a / b for a, b in zip(left, (limits.tokens, limits.segments, limits.loss))]
            dot = lambda p: round(mean[0] * p.length / limits.tokens * share[0] + mean[1] / limits.segments * share[1]
                                  + mean[2] * p.loss / limits.loss * share[2], 12)
            p = max(fits, key=lambda p: (dot(p), p.length, -p.row))
            pool.remove(p)
            sequence.append(p)
            left = [left[0] - p.length, left[1] - 1, left[2] - p.loss]
        out.append(sequence)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_choices_follow_the_dot_product(seed):
    r = random.Random(seed)
    limits = v.Limits(tokens=100, segments=(3, 5, 50)[seed % 3], loss=99)
    pieces = [v.Piece(i, 0, n := r.randint(1, 60), r.randint(0, n)) for i in range(80)]
    done, last = v.pack_block(pieces, limits, cut=False)
    got = [*done, last] if last else done
    # equal demands are interchangeable: compare them
    assert [[(p.length, p.loss) for p in s] for s in got] == [[(p.length, p.loss) for p in s] for s in plain_packing(pieces, limits)]


@pytest.mark.parametrize("cut", [True, False])
@pytest.mark.parametrize("seed", range(4))
def test_limits_hold_and_pieces_tile(seed, cut):
    r = random.Random(seed)
    limits = v.Limits(tokens=64, segments=4, loss=63 if seed % 2 else 70)
    pieces = [v.Piece(i, 0, n := r.choice((1, 2, 3, 30, 64, 65, 128, 200, 500)), r.randint(0, n)) for i in range(200)]
    done, last = v.pack_block(pieces, limits, cut)
    assert len(last) <= limits.segments
    for s in [*done, last]:
        assert sum(p.length for p in s) <= 64 and len(s) <= 4 and sum(p.loss for p in s) <= limits.loss
    for p in pieces:
        at = 0
        for q in sorted(q for s in [*done, last] for q in s if q.row == p.row):
            assert q.start == at
            at += q.length
        assert at == p.length


def test_loss_of_a_piece():
    p = v.Piece(0, 0, 10, 4)
    assert p.loss == 6 and v.Piece(0, 0, 10, 0).loss == 9 and v.Piece(0, 0, 10, 10).loss == 0
    a, b = p.split(3)
    assert (a.length, a.loss, b.start, b.length, b.loss) == (3, 0, 3, 7, 6)
    assert v.Piece(0, 5, 5, 4).loss == 4


def check(pieces, rows, limits, front=lambda r: ""):
    lib = Tokenizer.from_file(FILE)
    want = {}
    for r in rows:
        ids = lib.encode(front(r), add_special_tokens=False).ids + lib.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want.setdefault(r[0], []).append(np.array(ids, dtype="<u4"))
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_doc.setdefault(p.doc_id, []).append(p)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s in by_sequence.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limits.tokens and len(s) <= limits.segments and sum(p.n_loss for p in s) <= limits.loss
    assert set(by_doc) == set(want)
    for key, docs in want.items():
        assert sum(p.length for p in by_doc[key]) == sum(map(len, docs))
        for p in by_doc[key]:
            assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for x in docs)
        if len(docs) == 1:
            at = 0
            for p in sorted(by_doc[key], key=lambda p: p.start):
                assert p.start == at
                at += p.length
    return sum(limits.tokens - sum(p.length for p in s) for s in by_sequence.values())


def test_edge_cases(spark):
    check(v.pack(frame(spark), FILE).collect(), edge_rows(), v.Limits())
    assert v.pack(frame(spark, []), FILE).count() == 0


def test_small_blocks_and_prompts(spark):
    docs = frame(spark).coalesce(2)
    limits = v.Limits(tokens=512, segments=16, loss=511)
    rows = v.packed(docs, FILE, limits, prompt="source", block_tokens=3000)
    got = rows.withColumn("sequence_id", rows.part * 1_000_000 + rows.sequence).collect()
    ids = {s: i for i, s in enumerate(sorted({p.sequence_id for p in got}))}
    pieces = [type("P", (), p.asDict() | {"sequence_id": ids[p.sequence_id]}) for p in got]
    check(pieces, edge_rows(), limits, front=lambda r: r[3] or "")


def test_little_padding(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = v.padding(v.pack(rows, FILE)).first()
    assert got.padding < 0.005 * got.tokens


def test_repeated_rows_are_packed_each(spark):
    rows = [edge_rows()[0]] * 50
    pieces = v.pack(spark.createDataFrame(rows, SCHEMA), FILE).collect()
    n = pieces[0].doc_tokens
    assert sum(p.length for p in pieces) == 50 * n
