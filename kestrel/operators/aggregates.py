"""Grouped aggregates of the analysis notebooks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.quantiles import MAX_BROADCAST_GROUPS, exact_quantiles
from kestrel.storage import broadcast_if_small, materialize


# A1
def target_rate_by_category(df: DataFrame, cat: str, target: str, top: int | None = None) -> DataFrame:
    """Mean target per category, highest first (ties by category); null category dropped."""
    out = (df.where(F.col(cat).isNotNull())
           .groupBy(cat)
           .agg(F.avg(F.col(target).cast("double")).alias("target_rate"),
                F.count(F.lit(1)).alias("n_rows"))
           .orderBy(F.desc("target_rate"), F.asc(cat)))
    return out.limit(top) if top else out


# A3
def counts_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count per key combination (null keys kept as a group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


# A4
def box_summary(df: DataFrame, value: str, by: Sequence[str], k: float = 1.5) -> DataFrame:
    """Box-plot data per group: quartiles, whiskers (last values inside
    q1 - k*iqr / q3 + k*iqr) and the count of points outside them."""
    by = list(by)
    q = exact_quantiles(df, [value], [0.25, 0.5, 0.75], by=by)
    qw = q.groupBy(*by).agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    qw = qw.withColumn("_lo", F.col("q1") - k * iqr).withColumn("_hi", F.col("q3") + k * iqr)
    x = F.col(value).cast("double")
    # one row per group on the right side, sent to the tasks that read the rows
    # (a shuffle by few group keys fills few tasks); null group keys are dropped,
    # as in a pandas groupby
    qw = broadcast_if_small(materialize(qw, "box-quartiles"), MAX_BROADCAST_GROUPS)
    j = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull()).join(qw, by, "inner")
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    return j.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
