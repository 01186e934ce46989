import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from edge_data import edge_rows, frame
from kestrel.llm import feistel as f


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**63))
def test_permutation_is_a_bijection_with_inverse(n, key):
    p = f.Permutation(n, key)
    x = np.arange(n)
    y = p.forward(x)
    assert sorted(y.tolist()) == x.tolist()
    assert p.inverse(y).tolist() == x.tolist()


def test_place_and_row_at_agree():
    for row in (0, 1, 999, 123_456):
        shard, slot = f.place(row, 123_457, 24)
        assert f.row_at(shard, slot, 123_457, 24) == row


def test_shards_of_edge_cases(spark):
    got = f.shard_documents(frame(spark), 5).collect()
    n = len(edge_rows())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(r[0]), len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in edge_rows())
    assert sorted(r.row for r in got) == list(range(n))
    assert all((r.shard, r.slot) == f.place(r.row, n, 5) for r in got)
    for s in range(5):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) in (n // 5, n // 5 + 1)
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.row)]
    assert order == sorted(order)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    again = f.shard_documents(frame(spark).repartition(7), 5).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_fewer_rows_than_shards_and_empty(spark):
    one = f.shard_documents(frame(spark, edge_rows()[:1]), 24).collect()
    assert len(one) == 1 and one[0].slot == 0
    assert f.shard_documents(frame(spark, []), 24).count() == 0
