"""Connected components of an edge table, by Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.storage import materialize, release


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest
    node of its component.

    Alternating large-star and small-star steps on the edge table: each node
    links its larger (then its smaller) neighbours to the smallest node of its
    neighbourhood, until nothing changes. The minimum of a neighbourhood is
    an aggregation with partial sums and a join, so a node with very many
    neighbours is never collected. Every step is written to the shared
    folder.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    nodes = e
    before = None
    while True:
        large = materialize(_star(e.union(e.select("b", "a")), larger=True), "large-star")
        e2 = materialize(_star(large, larger=False), "small-star")
        now = e2.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        release(large)
        if e is not nodes:
            release(e)
        e = e2
        if now == before:
            break
        before = now
    # now a star: every other node of a component hangs on its smallest
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select("b", "b").distinct()).toDF("node", "root")


def _star(e: DataFrame, larger: bool) -> DataFrame:
    """Large-star (``larger``; both directions of each edge given) or
    small-star (each edge once, a > b)."""
    least = materialize(e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    j = e.join(least, "a")
    if larger:
        out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def join_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of their group (``groups``: one row per
    ``key``, written, with ``_n`` rows in each). Groups with a thousandth of
    all rows, at most 1,000 of them, are broadcast; the others meet by
    shuffle, no large group among them."""
    total = groups.agg(F.sum("_n")).first()[0] or 0
    large = F.col("_n") * 1000 >= total
    hot, cold = groups.where(large).drop("_n"), groups.where(~large).drop("_n")
    out = rows.join(F.broadcast(hot), key)
    if cold.isEmpty():
        return out
    return out.unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))
