"""Profiling and data-quality operators (one scan + aggregates each).

Every function returns a small DataFrame; wide per-column statistics are
computed in one aggregation pass and unpivoted, never one job per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.quantiles import exact_quantiles


def _unpivot_row(row: DataFrame, names: Sequence[str], value_name: str,
                 name_col: str = "column_name") -> DataFrame:
    """Turn a one-row table with one column per name into ``(name, value)`` rows."""
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias(name_col), F.col(f"`{n}`").alias(value_name)) for n in names
    ])))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# P1
def shape(df: DataFrame) -> DataFrame:
    """``n_rows`` (bigint) and ``n_cols`` (int) as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


# P3
def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, most first (ties by column name)."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return _unpivot_row(row, cols, "n_null").orderBy(F.desc("n_null"), "column_name")


# P4
def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in cols])
    return _unpivot_row(row, cols, "null_rate")


# P5 / P6
def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical group (nulls compare equal)."""
    subset = list(subset or df.columns)
    groups = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


# P7
def duplicate_rows(df: DataFrame, subset: Sequence[str], key: str, keep: str | bool = False) -> DataFrame:
    """Members of duplicate groups on ``subset``.

    ``keep=False``: every member; ``keep='first'``: all but the member with
    the smallest ``key``. Aggregate-then-join (no window over a group), so a
    hot group is split across tasks by the skew-join handling.
    """
    subset = list(subset)
    stats = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_dup_n"), F.min(key).alias("_dup_first"))
    stats = stats.where(F.col("_dup_n") > 1).select(
        *[F.col(c).alias(f"_dup_k{i}") for i, c in enumerate(subset)], "_dup_first")
    cond = [F.col(c).eqNullSafe(F.col(f"_dup_k{i}")) for i, c in enumerate(subset)]
    j = df.join(stats, cond, "inner")
    if keep == "first":
        j = j.where(F.col(key) != F.col("_dup_first"))
    elif keep is not False:
        raise ValueError("keep must be False or 'first'")
    return j.select(*df.columns)


# P8
def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per numeric column."""
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    row = df.agg(*aggs)
    basic = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__count").alias("count"),
                 F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                 F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
        for c in cols])))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("column_name").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("p75"))
    return basic.join(qw, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, unique, top (most frequent, smallest on ties), freq per text column."""
    cols = list(cols)
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in cols
    ]))).where(F.col("v").isNotNull())
    vc = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("_n"))
    # most frequent, then smallest: the least (-count, value)
    best = vc.groupBy("column_name").agg(F.sum("_n").alias("count"), F.count(F.lit(1)).alias("unique"),
                                         F.min(F.struct((-F.col("_n")).alias("n"), "v")).alias("_top"))
    return best.select("column_name", "count", "unique", F.col("_top.v").alias("top"), (-F.col("_top.n")).alias("freq"))


# P10 / P11
def value_counts(df: DataFrame, col: str, dropna: bool = True, normalize: bool = False,
                 top: int | None = None) -> DataFrame:
    """Frequency per value, most frequent first (ties by value)."""
    src = df.select(F.col(col).alias("value"))
    if dropna:
        src = src.where(F.col("value").isNotNull())
    vc = src.groupBy("value").agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = src.agg(F.count(F.lit(1)).alias("_total"))
        vc = vc.crossJoin(F.broadcast(total)).withColumn(
            "share", F.col("count") / F.col("_total")).drop("_total")
    vc = vc.orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return vc.limit(top) if top else vc


# P12
def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, dropna: bool = True,
                    approx: bool = False) -> DataFrame:
    """Distinct values per column; ``dropna=False`` counts null as a value."""
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`")
        d = F.approx_count_distinct(x) if approx else F.count_distinct(x)
        if not dropna:
            d = d + F.max(x.isNull()).cast("bigint")
        aggs.append(d.cast("bigint").alias(c))
    return _unpivot_row(df.agg(*aggs), cols, "n_distinct")


# P13
def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows violating each rule (a null comparison is not a violation)."""
    names = list(rules)
    row = df.agg(*[F.count_if(rules[n]).alias(n) for n in names])
    return _unpivot_row(row, names, "n_rows", name_col="rule")


# P14
def mismatch_count(df: DataFrame, a: Column | str, b: Column | str) -> DataFrame:
    """Rows where ``a != b``; a null on either side counts (NaN != NaN)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return df.agg(F.count_if(F.coalesce(a != b, F.lit(True))).alias("n_mismatch"))


# P15
def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r for every pair (i < j) in one aggregation."""
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    row = df.agg(*[F.corr(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"r{i}_{j}")
                   for i, j in pairs])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"),
                 F.lit(i).alias("pos_a"), F.lit(j).alias("pos_b"), F.col(f"r{i}_{j}").alias("r"))
        for i, j in pairs])))


# P16
def high_correlation_columns(df: DataFrame, cols: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Columns with |r| > threshold against an earlier column (reported, not dropped)."""
    pairs = correlation_pairs(df, cols)
    return (pairs.where(F.abs("r") > threshold)
            .groupBy(F.col("col_b").alias("column_name"))
            .agg(F.max(F.abs("r")).alias("max_abs_r")))


# P17
def kpi_check(metrics: DataFrame, thresholds: DataFrame, key: str = "metric") -> DataFrame:
    """Join a long metric table ``(..., metric, value)`` with ``(metric, minimum)``."""
    return (metrics.join(F.broadcast(thresholds), key)
            .withColumn("meets_kpi", F.col("value") >= F.col("minimum")))


# P18
def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Per column: q1, q3, lower = q1 - k*iqr, upper = q3 + k*iqr."""
    q = exact_quantiles(df, cols, [0.25, 0.75])
    w = q.groupBy("column_name").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return w.select("column_name", "q1", "q3", (F.col("q1") - k * iqr).alias("lower"),
                    (F.col("q3") + k * iqr).alias("upper"))


def iqr_outlier_counts(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Values outside [q1 - k*iqr, q3 + k*iqr] per column."""
    cols = list(cols)
    b = iqr_bounds(df, cols, k)
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in cols])))
    # bounds: one row per column, bounded by the column list
    j = long.join(F.broadcast(b), "column_name")
    out = j.groupBy("column_name", "q1", "q3", "lower", "upper").agg(
        F.count_if((F.col("x") < F.col("lower")) | (F.col("x") > F.col("upper"))).alias("n_outliers"))
    return out
