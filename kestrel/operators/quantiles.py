"""Exact order statistics without funnelling a column into one task.

``percentile`` in Spark keeps a value->count map per group and merges it in a
single task, which does not survive a 100 TB column. ``exact_quantiles``
instead

1. sketches every (group, column) with ``percentile_approx`` (bounded
   memory, relative rank error ``1/accuracy``),
2. takes, for every wanted probability q, a bracket [lo, hi] from the sketch
   at q -/+ 3/accuracy (groups of n >= 4 * accuracy rows), at q -/+ 0.05
   (groups of 200 rows or more) or the whole range (smaller groups), so
   that the wanted ranks lie inside it with several rows of slack beyond the
   sketch's rank error,
3. in one shuffle counts the rows below each bracket and the distinct values
   inside it, and
4. ranks only the bracket values exactly (a window over at most about
   ``6 * n / accuracy`` distinct values per large group, whatever the data
   skew; ``accuracy`` trades sketch memory for bracket width).

Interpolation is the linear rule of pandas/NumPy (``v0 + (v1 - v0) * frac``
at position ``q * (n - 1)``), the oracle SQL uses the same expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.storage import broadcast_if_small, materialize

DEFAULT_ACCURACY = 100000
#: groups up to which the brackets go to every task
MAX_BROADCAST_GROUPS = 100_000


def melt(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
         name_col: str = "column_name", value_col: str = "x",
         dropna: bool = True) -> DataFrame:
    """Long form ``by..., column_name, x`` of numeric columns (cast to double)."""
    cols = list(cols)
    pairs = F.array(*[
        F.struct(F.lit(c).alias(name_col), F.col(c).cast("double").alias(value_col))
        for c in cols
    ])
    long = df.select(*by, F.inline(pairs))
    if dropna:
        long = long.where(F.col(value_col).isNotNull())
    return long


def quantiles_long(long: DataFrame, keys: Sequence[str], value_col: str,
                   probs: Sequence[float], accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Exact quantiles of ``value_col`` per ``keys`` from a long table.

    Returns ``keys..., q, value, n`` with one row per key and probability
    (keys whose values are all null are absent).
    """
    keys = list(keys)
    probs = [float(q) for q in probs]
    m = len(probs)
    eps = 1.0 / accuracy
    # rank slack per size tier (the sketch's rank error is <= eps * n):
    # n >= big: q -/+ 3 eps (>= 6 rows of slack); small <= n < big: q -/+ 0.05
    # (>= 7 rows); n < small: the whole range (at most `small` rows)
    big, small = 4.0 / eps, 200.0
    m1, m2 = 3.0 * eps, 0.05
    cand = []
    for q in probs:
        cand += [q - m1, q + m1, q - m2, q + m2]
    approx_probs = [min(max(p, 0.0), 1.0) for p in cand]

    x = F.col(value_col)
    bounds = long.groupBy(*keys).agg(
        F.count(x).alias("_n"),
        F.percentile_approx(x, approx_probs, accuracy).alias("_b"),
    )
    neg_inf, pos_inf = F.lit(float("-inf")), F.lit(float("inf"))
    n = F.col("_n")

    def pick(idx: int, lower: bool):
        p = cand[idx]
        edge = (p <= 0) if lower else (p >= 1)
        return (neg_inf if lower else pos_inf) if edge else F.col("_b")[idx]

    lo, hi = [], []
    for i in range(m):
        lo.append(F.when(n >= big, pick(4 * i, True)).when(n >= small, pick(4 * i + 2, True)).otherwise(neg_inf))
        hi.append(F.when(n >= big, pick(4 * i + 1, False)).when(n >= small, pick(4 * i + 3, False))
                  .otherwise(pos_inf))
    bounds = bounds.select(*keys, "_n",
                           *[lo[i].alias(f"_lo{i}") for i in range(m)],
                           *[hi[i].alias(f"_hi{i}") for i in range(m)])
    # null-safe on the group keys: a NULL group is a group, as in groupBy
    renamed = bounds.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                            *[c for c in bounds.columns if c not in keys])
    if not [k for k in keys if k != "column_name"]:
        # one row per column name: size bounded by the column list
        renamed = F.broadcast(renamed)
    else:
        # one row per group: shuffled by few group keys, the rows would meet in few tasks
        renamed = broadcast_if_small(materialize(renamed, "quantile-bounds"), MAX_BROADCAST_GROUPS)
    j = long.join(renamed, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]) \
        .drop(*[f"_key{i}" for i in range(len(keys))])
    in_band = F.lit(False)
    for i in range(m):
        in_band = in_band | ((x >= F.col(f"_lo{i}")) & (x <= F.col(f"_hi{i}")))
    below = [(x < F.col(f"_lo{i}")).alias(f"_below{i}") for i in range(m)]
    # one shuffle: rows outside every bracket collapse to <= m+1 rows per key
    g = j.groupBy(*keys, "_n", *[f"_lo{i}" for i in range(m)], *[f"_hi{i}" for i in range(m)],
                  F.when(in_band, x).alias("_xb"), *below).agg(F.count(F.lit(1)).alias("_cnt"))

    per_q = g.select(
        *keys, "_n", "_xb", "_cnt",
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("_qi"), F.lit(probs[i]).alias("q"),
                     F.col(f"_below{i}").alias("_is_below"),
                     ((F.col("_xb") >= F.col(f"_lo{i}")) & (F.col("_xb") <= F.col(f"_hi{i}"))).alias("_is_band"))
            for i in range(m)
        ])),
    ).where(F.col("_is_below") | F.coalesce(F.col("_is_band"), F.lit(False)))

    order_key = F.when(F.col("_is_below"), F.lit(float("-inf"))).otherwise(F.col("_xb"))
    w = (Window.partitionBy(*keys, "_qi").orderBy(order_key, F.col("_is_below").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = per_q.withColumn("_end", F.sum("_cnt").over(w)).where(~F.col("_is_below"))
    start = F.col("_end") - F.col("_cnt")
    pos = F.col("q") * (F.col("_n") - 1)
    k0 = F.floor(pos)
    k1 = F.ceil(pos)
    hit0 = (start <= k0) & (k0 < F.col("_end"))
    hit1 = (start <= k1) & (k1 < F.col("_end"))
    picked = ranked.groupBy(*keys, "_qi", "q", "_n").agg(
        F.max(F.when(hit0, F.col("_xb"))).alias("_v0"),
        F.max(F.when(hit1, F.col("_xb"))).alias("_v1"),
    )
    frac = pos - k0
    value = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * frac
    # a sketch beyond its error bound would leave a rank outside its bracket: fail rather than return NULL
    value = F.coalesce(value, F.raise_error(F.lit("a quantile's rank lies outside its bracket; raise accuracy")).cast("double"))
    return picked.select(*keys, "q", value.alias("value"), F.col("_n").alias("n"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """``by..., column_name, q, value, n`` for every column in ``cols``."""
    long = melt(df, cols, by)
    return quantiles_long(long, [*by, "column_name"], "x", probs, accuracy)
