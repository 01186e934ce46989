"""Feature construction and binning.

Row-level features are native expressions; binning statistics (quartile
edges, min/max) are one aggregation joined back as a one-row table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.scalar import ratio_plus_one
from kestrel.operators.quantiles import exact_quantiles

# Right-closed age bins (-1,2], (2,5], (5,10], (10,30] and their
# labels; quartile labels of the odometer; bins of the explorer views.
AGE_EDGES = (-1, 2, 5, 10, 30)
AGE_LABELS = ("nuevo", "semi_nuevo", "usado", "antiguo")
ODO_LABELS = ("bajo", "medio_bajo", "medio_alto", "alto")
CUT_BINS = 10
HIST_BINS = 30
CUT_LOWER_PAD = 0.001


def _has(df: DataFrame, *cols: str) -> bool:
    return set(cols) <= set(df.columns)


# F1, F2, F3, F10, F11
def add_ratio_features(df: DataFrame, with_auction_ratio: bool = True, with_cost_x_warranty: bool = True) -> DataFrame:
    """Guarded like the reference: a feature is added only if its inputs exist."""
    new = {}
    if _has(df, "VehOdo", "VehicleAge"):
        new["odo_per_year"] = ratio_plus_one("VehOdo", "VehicleAge")
        new["age_x_odo"] = F.col("VehicleAge").cast("double") * F.col("VehOdo").cast("double")
    if _has(df, "WarrantyCost", "VehBCost"):
        new["warranty_cost_ratio"] = ratio_plus_one("WarrantyCost", "VehBCost")
        if with_cost_x_warranty:
            new["cost_x_warranty"] = F.col("VehBCost").cast("double") * F.col("WarrantyCost").cast("double")
    if with_auction_ratio and _has(df, "VehBCost", "MMRAcquisitionAuctionAveragePrice"):
        new["cost_vs_acq_auction_avg_ratio"] = ratio_plus_one("VehBCost", "MMRAcquisitionAuctionAveragePrice")
    return df.withColumns(new)


# F4-F7
def add_date_parts(df: DataFrame, date_col: str = "PurchDate", prefix: str = "purchase") -> DataFrame:
    """year, month, day, weekday (Monday = 0); text dates are parsed with coercion."""
    if date_col not in df.columns:
        return df
    d = F.col(date_col)
    if isinstance(df.schema[date_col].dataType, T.StringType):
        d = F.try_to_timestamp(d)
    return df.withColumns({f"{prefix}_year": F.year(d), f"{prefix}_month": F.month(d),
                           f"{prefix}_day": F.dayofmonth(d), f"{prefix}_dow": F.weekday(d)})


# F8
def right_closed_bins(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """pd.cut with fixed edges: (e0,e1] -> labels[0], ...; outside -> NULL."""
    out = None
    for i, lab in enumerate(labels):
        cond = (x > edges[i]) & (x <= edges[i + 1])
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def add_age_group(df: DataFrame, age_col: str = "VehicleAge", out: str = "vehicle_age_group") -> DataFrame:
    if age_col not in df.columns:
        return df
    return df.withColumn(out, right_closed_bins(F.col(age_col), AGE_EDGES, AGE_LABELS))


# F9
def quartile_edges(df: DataFrame, col: str) -> DataFrame:
    """One-row table ``edges``: distinct sorted quantiles at 0, .25, .5, .75, 1."""
    q = exact_quantiles(df, [col], [0.0, 0.25, 0.5, 0.75, 1.0])
    return q.agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("_edges"))


def quantile_bin(x: Column, edges: Column, labels: Sequence[str]) -> Column:
    """pd.qcut semantics: right-closed, lowest edge included; equal edges
    merged; when merging leaves fewer bins than labels, bins are numbered."""
    idx = F.greatest(F.size(F.filter(edges, lambda e: e < x)) - 1, F.lit(0))
    n_bins = F.size(edges) - 1
    named = F.element_at(F.array(*[F.lit(s) for s in labels]), (idx + 1).cast("int"))
    lab = F.when(n_bins == len(labels), named).otherwise(idx.cast("string"))
    return F.when(x.isNotNull() & (n_bins >= 1), lab)


def add_quartile_group(df: DataFrame, col: str = "VehOdo", out: str = "odometer_group",
                       edges: DataFrame | None = None) -> DataFrame:
    edges = edges if edges is not None else quartile_edges(df, col)
    j = df.join(F.broadcast(edges), F.lit(True), "left")  # one row
    return j.withColumn(out, quantile_bin(F.col(col).cast("double"), F.col("_edges"), ODO_LABELS)).drop("_edges")


# F12-F14
def nonnegative_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns (of those present and numeric) whose values are all >= 0 and
    not NULL: one aggregation, one boolean per column."""
    cols = [c for c in cols if c in df.columns and isinstance(df.schema[c].dataType, T.NumericType)]
    if not cols:
        return []
    row = df.agg(*[F.every(F.coalesce(F.col(c) >= 0, F.lit(False))).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def add_log1p(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_log1p": F.log1p(F.col(c).cast("double")) for c in cols})


# F16, A2
def equal_width_bins(df: DataFrame, col: str, n: int = CUT_BINS, target: str | None = None) -> DataFrame:
    """pd.cut(x, n): right-closed equal-width bins over [min, max], lower edge
    padded by 0.1% of the range. Every bin is returned, empty ones with 0
    rows (and NULL target rate). With min = max there is one bin."""
    x = F.col(col).cast("double")
    src = df.select(x.alias("_x"), *([F.col(target).cast("double").alias("_t")] if target else []))
    src = src.where(F.col("_x").isNotNull())
    mm = src.agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    w = (F.col("_mx") - F.col("_mn")) / n
    j = src.join(F.broadcast(mm), F.lit(True), "inner")  # one row
    bin_id = F.when(F.col("_mx") > F.col("_mn"),
                    F.least(F.lit(n - 1), F.greatest(F.lit(0), F.ceil((F.col("_x") - F.col("_mn")) / w) - 1))
                    ).otherwise(F.lit(0)).cast("int")
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if target:
        aggs.append(F.avg("_t").alias("target_rate"))
    counts = j.groupBy(bin_id.alias("bin_id")).agg(*aggs)
    # the n bins: a fixed-size skeleton (n is a parameter, not data)
    bins = df.sparkSession.range(n).select(F.col("id").cast("int").alias("bin_id")).crossJoin(F.broadcast(mm))
    bins = bins.where((F.col("_mx") > F.col("_mn")) | (F.col("bin_id") == 0))
    lower = F.when(F.col("bin_id") == 0, F.col("_mn") - CUT_LOWER_PAD * (F.col("_mx") - F.col("_mn"))) \
        .otherwise(F.col("_mn") + F.col("bin_id") * w)
    upper = F.when(F.col("bin_id") == n - 1, F.col("_mx")).otherwise(F.col("_mn") + (F.col("bin_id") + 1) * w)
    out = bins.join(counts, "bin_id", "left").select(
        "bin_id", lower.alias("lower"), upper.alias("upper"),
        F.coalesce(F.col("n_rows"), F.lit(0)).alias("n_rows"),
        *([F.col("target_rate")] if target else []))
    return out


# F17
def histogram(df: DataFrame, col: str, n: int = HIST_BINS, hue: str | None = None) -> DataFrame:
    """plt.hist(x, n): left-closed equal bins, the last closed on both sides.
    Without ``hue`` every bin is returned (empty ones with 0)."""
    x = F.col(col).cast("double")
    src = df.select(x.alias("_x"), *([F.col(hue)] if hue else [])).where(F.col("_x").isNotNull())
    mm = src.agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    w = (F.col("_mx") - F.col("_mn")) / n
    j = src.join(F.broadcast(mm), F.lit(True), "inner")
    bin_id = F.when(F.col("_mx") > F.col("_mn"),
                    F.least(F.lit(n - 1), F.floor((F.col("_x") - F.col("_mn")) / w))).otherwise(F.lit(0)).cast("int")
    keys = [bin_id.alias("bin_id")] + ([F.col(hue)] if hue else [])
    counts = j.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    if hue:
        return counts
    bins = df.sparkSession.range(n).select(F.col("id").cast("int").alias("bin_id"))
    return bins.join(counts, "bin_id", "left").select(
        "bin_id", F.coalesce(F.col("n_rows"), F.lit(0)).alias("n_rows"))
