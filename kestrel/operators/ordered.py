"""Running sums in a global order, without a window over a whole group.

A window ``partitionBy(model).orderBy(score)`` puts every distinct score of a
model in one task. ``ordered_cumsum`` range-buckets the order column (bucket
edges from one approximate-quantile job, mapped with ``Bucketizer``'s binary
search), prefix-sums bucket totals (at most ``n_buckets`` rows per group) and
adds in-bucket running sums from a window over ``(group, bucket)`` only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.storage import broadcast_if_small, materialize

DEFAULT_BUCKETS = 1024
_IN_PARTITION = (1 << 33) - 1  # low bits of monotonically_increasing_id: the row's index in its partition


def bucket_edges(df: DataFrame, col: str, n_buckets: int = DEFAULT_BUCKETS, rel_err: float = 1e-4) -> list[float]:
    """Strictly increasing split points (n_buckets - 1 quantiles, deduplicated)."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = df.select(F.col(col).cast("double").alias(col)).where(F.col(col).isNotNull()) \
        .approxQuantile(col, probs, rel_err)
    return sorted(set(float(q) for q in qs))


def ordered_cumsum(df: DataFrame, part: Sequence[str], order_col: str, sum_cols: Sequence[str],
                   descending: bool = True, n_buckets: int = DEFAULT_BUCKETS,
                   prefix: str = "cum_") -> DataFrame:
    """Add inclusive running sums ``{prefix}{c}`` of ``sum_cols`` per ``part``
    in ``order_col`` order (rows must be distinct on part + order_col), plus
    ``{prefix}rows``, the 1-based position."""
    part = list(part)
    sums = list(sum_cols) + ["_one"]
    d = df.withColumn("_one", F.lit(1).cast("bigint"))
    edges = bucket_edges(d, order_col, n_buckets)
    splits = [float("-inf")] + edges + [float("inf")]
    d = d.withColumn("_ord", F.col(order_col).cast("double"))
    d = Bucketizer(splits=splits, inputCol="_ord", outputCol="_bkt", handleInvalid="keep").transform(d)
    bkt_order = F.col("_bkt").desc() if descending else F.col("_bkt").asc()
    val_order = F.col("_ord").desc() if descending else F.col("_ord").asc()

    totals = d.groupBy(*part, "_bkt").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    w_off = Window.partitionBy(*part).orderBy(bkt_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, "_bkt", *[
        F.coalesce(F.sum(f"_t_{c}").over(w_off), F.lit(0)).alias(f"_o_{c}") for c in sums])

    w_in = Window.partitionBy(*part, "_bkt").orderBy(val_order).rowsBetween(Window.unboundedPreceding, 0)
    inner = d.select("*", *[F.sum(c).over(w_in).alias(f"_i_{c}") for c in sums])
    out = inner.join(offsets, [*part, "_bkt"])
    names = {c: (f"{prefix}rows" if c == "_one" else f"{prefix}{c}") for c in sums}
    return out.select(*df.columns, *[(F.col(f"_o_{c}") + F.col(f"_i_{c}")).alias(names[c]) for c in sums])


def global_row_number(df: DataFrame, *order: str, out: str = "row") -> DataFrame:
    """``df`` with ``out`` = 0-based global position in ``order``: one range
    shuffle, then per-partition counts; no task sees more than its range. The
    scan position is the last sort key, so equal rows can be dealt over several
    partitions."""
    s = (df.withColumn("_tie", F.monotonically_increasing_id())
         .repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
         .withColumn("_part", F.spark_partition_id())
         .withColumn("_index", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))))
    s = materialize(s, "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (s.join(broadcast_if_small(offsets, 1_000_000), "_part")
            .withColumn(out, F.col("_offset") + F.col("_index")).drop("_part", "_index", "_offset"))
