import hashlib
import math

import numpy as np
import pytest

from kestrel.llm import vector_codes as v

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, _key int, _n long, place long"


def _nearest(q, entries):
    d = [sum((a - b) ** 2 for a, b in zip(q, e)) for e in entries]
    return d.index(min(d)), min(d)


def brute(rows, parts=16, k=64, rounds=2):
    """The rule, one row at a time in Python integers."""
    kept = [(i, y, [math.floor(256 * x) for x in e]) for i, e, y in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    w = len(kept[0][2]) // parts
    cut = [[x[p * w:(p + 1) * w] for p in range(parts)] for _, _, x in kept]
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0], kept[r][2]))[:k]
    books = [[cut[r][p] for r in first] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            got = [_nearest(c[p], books[p])[0] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, g in zip(cut, got) if g == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    for (i, y, _), c in zip(kept, cut):
        near = [_nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{a:02x}" for a, _ in near), sum(d for _, d in near), y))
    total = {}
    for _, _, e, y in out:
        total[y] = total.get(y, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, c, e, total[y], sha, y) for i, c, e, y in out], sha


def frame(spark, rows):
    return spark.createDataFrame([(i, e, y, "c", 1, 2, 3, 4) for i, e, y in rows], SCHEMA)


def same(a, b):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in a), key=key) == sorted(b, key=key)


def f32(rows):
    return [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], y) for i, e, y in rows]


@pytest.mark.parametrize("spread", [1, 3, 40, 2000])
def test_orchard_equals_a_full_scan_with_ties(spread):
    r = np.random.default_rng(spread)
    entries = r.integers(-spread, spread + 1, (64, 4))
    q = r.integers(-spread, spread + 1, (3000, 4))
    book = v.Orchard(entries)
    index, d = book.nearest(q)
    full = ((q[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert index.tolist() == full.argmin(axis=1).tolist() and d.tolist() == full.min(axis=1).tolist()
    if spread == 2000:
        assert book.compared < 0.6 * full.size


def test_whole_operator_against_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(int(i), (r.normal(size=32) / 4).tolist(), int(r.integers(0, 4))) for i in r.permutation(300)]
    rows += [(1000, rows[0][1], None), (1001, rows[0][1], None), (1001, rows[0][1], None), (7, rows[1][1], 2), (None, rows[2][1], 9)]
    rows = f32(rows)
    same(v.compress(frame(spark, rows)).collect(), brute(rows)[0])


def test_dropped_rows_few_rows_and_empty_table(spark):
    ok = [0.1, -0.1] * 16
    rows = f32([(1, None, 1), (2, [*ok[:-1], None], 1), (3, [*ok[:-1], float("nan")], 1), (4, [*ok[:-1], float("inf")], 1),
                (5, ok, 1), (6, [-x for x in ok], None), (8, [0.0] * 32, None), (9, [-0.001] * 32, 1)])
    same(v.compress(frame(spark, rows)).collect(), brute(rows)[0])
    got = v.compress(frame(spark, []))
    assert got.count() == 0 and got.columns[:5] == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_codes_decode_to_their_entries(spark):
    r = np.random.default_rng(6)
    rows = f32([(i, r.normal(size=32).tolist(), 0) for i in range(200)])
    kept = v.usable(frame(spark, rows))
    books = v.train(kept)
    by_id = {i: np.floor(256 * np.array(e)).astype(int) for i, e, _ in rows}
    for x in v.encode(kept, books).collect():
        assert ((by_id[x.vec_id] - v.decode(x.code, books)) ** 2).sum() == x.error


@pytest.mark.parametrize("bad", [[(1, [0.0] * 32, 1), (2, [0.0] * 48, 1)], [(1, [0.0] * 20, 1)], [(1, [0.0] * 31 + [1e9], 1)]])
def test_vectors_that_cannot_be_cut_or_compared_are_an_error(spark, bad):
    with pytest.raises(Exception, match="length|equal parts|2\\^19"):
        v.compress(frame(spark, bad)).collect()


def test_many_labels_meet_by_shuffle(spark):
    rows = spark.range(6000).selectExpr("id AS vec_id", "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 3000 END AS label", "id AS error")
    got = {r.vec_id: r.t for r in v.with_total(rows, "label", "error", "t").collect()}
    want = {}
    for i in range(6000):
        want[None if i % 3 == 0 else i % 3000] = want.get(None if i % 3 == 0 else i % 3000, 0) + i
    assert got == {i: want[None if i % 3 == 0 else i % 3000] for i in range(6000)}
