"""Categorical encoders and scalers as fit -> small table, transform -> join
(E1-E6). Fitted tables hold one row per category (or per column); the
transform is a left join the planner may broadcast when the table is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.category_stage import CategoryIndexer
from kestrel.operators.ordered import global_row_number
from kestrel.operators.quantiles import exact_quantiles
from kestrel.storage import broadcast_if_small, materialize

# Smoothing of the target encoder (min_samples_leaf, smoothing).
TE_MIN_SAMPLES_LEAF = 20
TE_SMOOTHING = 10.0
#: dummy columns become columns of the table; beyond this many the call fails and E5's sparse vectors are the way
MAX_DUMMY_CATEGORIES = 1000
MAX_BROADCAST_ROWS = 100_000


# E1 / E2
def fit_ordinal(df: DataFrame, col: str, order: Sequence[str] | None = None) -> DataFrame:
    """``(value, code)``: codes 0..k-1 in sorted order (or the given order).
    The categories are numbered by range partitions, not in one task."""
    if order is not None:
        rows = [(v, i) for i, v in enumerate(order)]
        return df.sparkSession.createDataFrame(rows, f"value string, code int")
    d = df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    return global_row_number(d, "value", out="code").select("value", F.col("code").cast("int").alias("code"))


def transform_ordinal(df: DataFrame, col: str, codes: DataFrame, out: str | None = None) -> DataFrame:
    out = out or f"{col}_code"
    m = broadcast_if_small(codes.select(F.col("value").alias("_v"), F.col("code").alias(out)), MAX_BROADCAST_ROWS)
    return df.join(m, F.col(col).cast("string") == F.col("_v"), "left").drop("_v")


# E3
def dummy_categories(df: DataFrame, col: str, max_categories: int = MAX_DUMMY_CATEGORIES) -> list[str]:
    """Sorted distinct categories; fails instead of truncating above the cap."""
    vals = (df.select(F.col(col).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
            .orderBy("v").limit(max_categories + 1).collect())
    if len(vals) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories; use one-hot vectors")
    return [r["v"] for r in vals]


def dummies(df: DataFrame, cols: Sequence[str], drop_first: bool = True,
            categories: dict[str, list[str]] | None = None) -> DataFrame:
    """pd.get_dummies(drop_first): one 0/1 int column per category but the
    first; NULL gives all zeros; the source column is replaced."""
    categories = dict(categories or {})
    out = df
    for c in cols:
        cats = categories.get(c) or dummy_categories(df, c)
        keep = cats[1:] if drop_first else cats
        out = out.withColumns({f"{c}_{v}": (F.coalesce(F.col(c).cast("string") == v, F.lit(False))).cast("int")
                               for v in keep}).drop(c)
    return out


# E4
def fit_target_encoder(train: DataFrame, cols: Sequence[str], target: str,
                       min_samples_leaf: int = TE_MIN_SAMPLES_LEAF, smoothing: float = TE_SMOOTHING,
                       single_row_to_prior: bool = True) -> DataFrame:
    """``(column_name, value, encoding, prior)`` from the training rows only:
    lambda(n) = 1 / (1 + exp(-(n - k) / f)); encoding = lambda * mean +
    (1 - lambda) * prior; one-row categories take the prior."""
    y = F.col(target).cast("double")
    prior = train.agg(F.avg(y).alias("prior"))
    long = train.select(y.alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])))
    stats = long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("_y").alias("_mean"))
    stats = stats.crossJoin(F.broadcast(prior))  # one row
    lam = 1.0 / (1.0 + F.exp(-(F.col("_n") - min_samples_leaf) / smoothing))
    enc = F.col("prior") * (1 - lam) + F.col("_mean") * lam
    if single_row_to_prior:
        enc = F.when(F.col("_n") == 1, F.col("prior")).otherwise(enc)
    return stats.select("column_name", "value", enc.alias("encoding"), "prior")


def transform_target_encoder(df: DataFrame, cols: Sequence[str], fitted: DataFrame,
                             suffix: str = "") -> DataFrame:
    """Replace each column by its encoding; unseen and NULL take the prior."""
    fitted = materialize(fitted, "encodings")  # read once per column, not fitted again
    prior = fitted.agg(F.first("prior").alias("_prior"))
    out = df.join(F.broadcast(prior), F.lit(True), "left")  # one row
    for c in cols:
        m = fitted.where(F.col("column_name") == c).select(F.col("value").alias(f"_v_{c}"),
                                                          F.col("encoding").alias(f"_e_{c}"))
        m = broadcast_if_small(m, MAX_BROADCAST_ROWS)
        out = out.join(m, F.col(c).cast("string") == F.col(f"_v_{c}"), "left")
        out = out.withColumn(c + suffix, F.coalesce(F.col(f"_e_{c}"), F.col("_prior"))).drop(f"_v_{c}", f"_e_{c}")
    return out.drop("_prior")


# E5
def fit_one_hot(train: DataFrame, col: str):
    """(dictionary stage, encoder): sorted categories, unseen and NULL get an
    index past the last, whose vector is all zeros."""
    idx = CategoryIndexer(inputCols=[col], outputCols=[f"{col}_idx"]).fit(train)
    ohe = OneHotEncoder(inputCols=[f"{col}_idx"], outputCols=[f"{col}_vec"], dropLast=True,
                        handleInvalid="keep").fit(idx.transform(train))
    return idx, ohe


def one_hot_slot(df: DataFrame, col: str, idx, ohe) -> DataFrame:
    """Active position of the one-hot vector, NULL when all zeros."""
    # the active position is the index itself; the index past the last has none
    i = F.col(f"{col}_idx")
    v = ohe.transform(idx.transform(df))
    return v.withColumn(f"{col}_slot", F.when(i < idx.getOrDefault("sizes")[0], i.cast("int"))).drop(f"{col}_idx", f"{col}_vec")


# E6
def fit_robust_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, center, scale)``: median and q3 - q1 (0 -> 1)."""
    q = exact_quantiles(train, cols, [0.25, 0.5, 0.75])
    s = q.groupBy("column_name").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("_q1"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("center"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("_q3"))
    iqr = F.col("_q3") - F.col("_q1")
    return s.select("column_name", "center", F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def transform_robust_scaler(df: DataFrame, cols: Sequence[str], fitted: DataFrame) -> DataFrame:
    cols = list(cols)
    wide = fitted.groupBy().pivot("column_name", cols).agg(F.first(F.struct("center", "scale")))
    j = df.join(F.broadcast(wide.select(*[F.col(c).alias(f"_s_{c}") for c in cols])), F.lit(True), "left")
    return j.select(*[
        ((F.col(c).cast("double") - F.col(f"_s_{c}.center")) / F.col(f"_s_{c}.scale")).alias(c)
        if c in cols else F.col(c) for c in df.columns])
