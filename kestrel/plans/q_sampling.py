"""Split, folds and class-balancing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import sampling as sp
from kestrel.plans.registry import register
from kestrel.plans.views import with_views
from kestrel.sources import proxies

RANKED = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY IsBadBuy
                               ORDER BY md5(CAST(row_id AS VARCHAR) || '-42'), row_id) AS rk,
         count(*) OVER (PARTITION BY IsBadBuy) AS n_c
  FROM auction)"""

SPLIT = RANKED + """,
split_a AS (SELECT * EXCLUDE (rk, n_c),
                   CASE WHEN rk <= round(n_c * 0.2) THEN 'test' ELSE 'train' END AS split FROM ranked)"""

FOLDS = RANKED + """,
fold_a AS (SELECT * EXCLUDE (rk, n_c), CAST((rk - 1) % 5 + 1 AS INTEGER) AS fold FROM ranked)"""


def _oversample_sql(src: str) -> str:
    """Oracle of random_oversample over a view ``src`` with row_id, IsBadBuy."""
    return f"""r AS (SELECT row_id, IsBadBuy,
                row_number() OVER (PARTITION BY IsBadBuy ORDER BY md5(CAST(row_id AS VARCHAR) || '-42'), row_id) AS rk,
                count(*) OVER (PARTITION BY IsBadBuy) AS n_c FROM {src}),
sizes AS (SELECT IsBadBuy, max(n_c) AS n_c FROM r GROUP BY IsBadBuy),
mx AS (SELECT max(n_c) AS n_max, arg_max(IsBadBuy, n_c) AS maj FROM sizes),
need AS (SELECT s.IsBadBuy AS cls, s.n_c FROM sizes s, mx WHERE s.n_c < mx.n_max),
draws AS (SELECT need.cls, r.rk - need.n_c - 1 AS i, need.n_c FROM r, mx, need
          WHERE r.IsBadBuy = mx.maj AND r.rk > need.n_c),
picks AS (SELECT cls AS IsBadBuy,
                 (('0x' || substr(md5(CAST(i AS VARCHAR) || '-' || CAST(cls AS VARCHAR) || '-42'), 1, 15))::BIGINT
                  % n_c) + 1 AS rk FROM draws),
balanced AS (SELECT row_id, IsBadBuy, 0 AS is_copy FROM {src}
             UNION ALL
             SELECT r.row_id, r.IsBadBuy, 1 AS is_copy FROM picks p JOIN r ON p.IsBadBuy = r.IsBadBuy AND p.rk = r.rk)"""


@register("b1_stratified_split", with_views("SELECT row_id, IsBadBuy, split FROM split_a", "auction", extra=(SPLIT,)))
def b1_stratified_split(spark, sf):
    a = proxies.auction(spark, sf, ["row_id", "IsBadBuy"])
    return sp.stratified_split(a, "IsBadBuy", "row_id", 0.2)


@register("b2_stratified_folds", with_views("SELECT row_id, IsBadBuy, fold FROM fold_a", "auction", extra=(FOLDS,)))
def b2_stratified_folds(spark, sf):
    a = proxies.auction(spark, sf, ["row_id", "IsBadBuy"])
    return sp.stratified_folds(a, "IsBadBuy", "row_id", 5)


@register("b3_random_oversample", with_views(
    "SELECT row_id, IsBadBuy, CAST(is_copy AS INTEGER) AS is_copy FROM balanced", "auction",
    extra=(_oversample_sql("auction"),)))
def b3_random_oversample(spark, sf):
    a = proxies.auction(spark, sf, ["row_id", "IsBadBuy"])
    return sp.random_oversample(a, "IsBadBuy", "row_id")


@register("b4_random_undersample", with_views(
    "SELECT row_id, IsBadBuy FROM ranked WHERE rk <= (SELECT min(n_c) FROM ranked)", "auction", extra=(RANKED,)))
def b4_random_undersample(spark, sf):
    a = proxies.auction(spark, sf, ["row_id", "IsBadBuy"])
    return sp.random_undersample(a, "IsBadBuy", "row_id")


@register("b7_class_weights", with_views("""
SELECT a.row_id, a.IsBadBuy, round(t.n / (t.k * c.n_c), 6) AS class_weight
FROM auction a JOIN (SELECT IsBadBuy, count(*) AS n_c FROM auction GROUP BY IsBadBuy) c ON a.IsBadBuy = c.IsBadBuy
CROSS JOIN (SELECT count(*)::DOUBLE AS n, count(DISTINCT IsBadBuy) AS k FROM auction) t""", "auction"))
def b7_class_weights(spark, sf):
    a = proxies.auction(spark, sf, ["row_id", "IsBadBuy"])
    out = sp.class_weights(a, "IsBadBuy")
    return out.select("row_id", "IsBadBuy", F.round("class_weight", 6).alias("class_weight"))


@register("a7_balance_summary", with_views("""
SELECT 'train' AS split, count(*) AS n_rows, round(avg(CAST(IsBadBuy AS DOUBLE)), 6) AS minority_ratio,
       'RandomOverSampler' AS method FROM split_a WHERE split = 'train'
UNION ALL
SELECT 'test', count(*), round(avg(CAST(IsBadBuy AS DOUBLE)), 6), 'RandomOverSampler' FROM split_a WHERE split = 'test'
UNION ALL
SELECT 'train_balanced', count(*), round(avg(CAST(IsBadBuy AS DOUBLE)), 6), 'RandomOverSampler' FROM balanced""",
    "auction", extra=(SPLIT, "train_a AS (SELECT * FROM split_a WHERE split = 'train')",
                      _oversample_sql("train_a"))))
def a7_balance_summary(spark, sf):
    a = sp.stratified_split(proxies.auction(spark, sf, ["row_id", "IsBadBuy"]), "IsBadBuy", "row_id", 0.2)
    train = a.where(F.col("split") == "train").drop("split")
    test = a.where(F.col("split") == "test").drop("split")
    bal = sp.random_oversample(train, "IsBadBuy", "row_id")
    out = sp.balance_summary({"train": train, "test": test, "train_balanced": bal}, "IsBadBuy", "RandomOverSampler")
    return out.withColumn("minority_ratio", F.round("minority_ratio", 6))
