"""Stratified split, folds and class balancing.

Randomness is reproducible and engine-independent: rows are ordered by
``md5(key || '-' || seed)``. The exact per-class rank of every row is
computed without a window over a whole class: the first four hex digits of
the hash pick one of 65,536 buckets (uniform, so a huge class is spread
evenly), bucket counts are prefix-summed per class (<= 65,536 rows per
class), and rows are numbered inside their (class, bucket) only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
HASH_BUCKET_HEX = 4


def hash_key(key: str, seed: int = SEED) -> Column:
    """md5 of the key and the seed; a NULL key hashes as the empty text."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"-{seed}")))


def _null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` in which NULL equals NULL; the columns come from
    the left side."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    on = [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in cols]
    return left.join(renamed, on, how).drop(*[f"_r_{c}" for c in cols])


def draw(text: Column, n: Column) -> Column:
    """1 + a hash of ``text`` (60 bits) modulo ``n``."""
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint") % n) + 1


def stratified_rank(df: DataFrame, strata: Sequence[str], key: str, seed: int = SEED,
                    out: str = "_rank", bucket_hex: int = HASH_BUCKET_HEX) -> DataFrame:
    """Add ``out`` = 1-based position of the row inside its stratum in
    (md5, key) order, and ``_n_stratum`` = stratum size. NULL strata and NULL
    keys are strata and keys of their own: no row is lost. A stratum is cut
    into 16^bucket_hex hash buckets: 4 suits strata of up to some 10^10 rows,
    take 5 or 6 beyond (the result is the same)."""
    strata = list(strata)
    d = df.withColumn("_h", hash_key(key, seed)).withColumn(
        "_hb", F.conv(F.substring("_h", 1, bucket_hex), 16, 10).cast("int"))
    counts = d.groupBy(*strata, "_hb").agg(F.count(F.lit(1)).alias("_cnt"))
    w_off = Window.partitionBy(*strata).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*strata)
    offsets = counts.select(*strata, "_hb", F.coalesce(F.sum("_cnt").over(w_off), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(w_all).alias("_n_stratum"))
    w_in = Window.partitionBy(*strata, "_hb").orderBy("_h", key)
    numbered = d.withColumn("_rn", F.row_number().over(w_in))
    j = _null_safe(numbered, offsets, [*strata, "_hb"])
    return j.withColumn(out, F.col("_off") + F.col("_rn")).drop("_h", "_hb", "_rn", "_off")


# B1
def stratified_split(df: DataFrame, target: str, key: str, test_size: float = 0.2,
                     seed: int = SEED, out: str = "split") -> DataFrame:
    """``split`` = 'test' for the first round(test_size * n_c) rows of each class."""
    r = stratified_rank(df, [target], key, seed)
    k = F.round(F.col("_n_stratum") * test_size)
    return r.withColumn(out, F.when(F.col("_rank") <= k, F.lit("test")).otherwise(F.lit("train"))) \
        .drop("_rank", "_n_stratum")


# B2
def stratified_folds(df: DataFrame, target: str, key: str, k: int = 5, seed: int = SEED,
                     out: str = "fold") -> DataFrame:
    """``fold`` in 1..k, dealt round-robin inside each class in hash order."""
    r = stratified_rank(df, [target], key, seed)
    return r.withColumn(out, (((F.col("_rank") - 1) % k) + 1).cast("int")).drop("_rank", "_n_stratum")


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's shared ``spark.checkpoint.dir``
    for a table that several branches read (their pruned projections differ,
    so the planner would otherwise recompute it per branch)."""
    return df.checkpoint(eager=True)


def _class_sizes(ranked: DataFrame, target: str) -> DataFrame:
    return ranked.groupBy(target).agg(F.max("_n_stratum").alias("_n_c"))


# B3
def random_oversample(df: DataFrame, target: str, key: str, seed: int = SEED) -> DataFrame:
    """Keep every row; add copies of minority rows, drawn with replacement,
    until every class has the size of the largest. Copy ``i`` of class c is
    the row of rank 1 + hash(i, c) mod n_c. The draw numbers come from the
    majority rows beyond n_c (exactly n_max - n_c of them), so no counts go
    through the driver. Adds ``is_copy`` (0 original, 1 drawn)."""
    r = materialize(stratified_rank(df, [target], key, seed))
    sizes = _class_sizes(r, target)
    n_max = sizes.agg(F.max("_n_c").alias("_n_max"), F.max_by(target, "_n_c").alias("_maj"))
    # class sizes: one row per class (bounded by the number of classes)
    need = sizes.crossJoin(F.broadcast(n_max)).where(F.col("_n_c") < F.col("_n_max"))
    majority = r.join(F.broadcast(n_max), F.col(target).eqNullSafe(F.col("_maj")))
    draws = majority.join(F.broadcast(need.select(F.col(target).alias("_cls"), "_n_c")),
                          F.col("_rank") > F.col("_n_c")) \
        .select(F.col("_cls"), (F.col("_rank") - F.col("_n_c") - 1).alias("_i"), "_n_c")
    pick = draw(F.concat(F.col("_i").cast("string"), F.lit("-"),
                         F.coalesce(F.col("_cls").cast("string"), F.lit("")), F.lit(f"-{seed}")), F.col("_n_c"))
    draws = draws.select(F.col("_cls").alias(target), pick.alias("_rank"))
    # the draws join the numbered rows of their class on the rank: an
    # equi-join with no hot key (draws are uniform over ranks)
    copies = _null_safe(draws, r, [target, "_rank"]).select(*df.columns).withColumn("is_copy", F.lit(1))
    return r.select(*df.columns).withColumn("is_copy", F.lit(0)).unionByName(copies)


# B4
def random_undersample(df: DataFrame, target: str, key: str, seed: int = SEED) -> DataFrame:
    """Keep the first n_min rows (hash order) of every class."""
    r = materialize(stratified_rank(df, [target], key, seed))
    n_min = _class_sizes(r, target).agg(F.min("_n_c").alias("_n_min"))
    return r.crossJoin(F.broadcast(n_min)).where(F.col("_rank") <= F.col("_n_min")).select(*df.columns)


# B7
def class_weights(df: DataFrame, target: str, out: str = "class_weight") -> DataFrame:
    """weight = n / (n_classes * n_c), the 'balanced' rule."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("_n_c"))
    tot = counts.agg(F.sum("_n_c").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = counts.crossJoin(tot).select(target, (F.col("_n") / (F.col("_k") * F.col("_n_c"))).alias(out))
    # one row per class
    return _null_safe(df, F.broadcast(w), [target], "left")


# A7
def balance_summary(parts: Mapping[str, DataFrame], target: str, method: str) -> DataFrame:
    """One row per named part: n_rows, minority_ratio (mean target), method."""
    out = None
    for name, d in parts.items():
        row = d.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(target).cast("double")).alias("minority_ratio")) \
            .select(F.lit(name).alias("split"), "n_rows", "minority_ratio", F.lit(method).alias("method"))
        out = row if out is None else out.unionByName(row)
    return out
