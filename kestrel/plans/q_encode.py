"""Encoder and scaler queries (E1-E6, E9); fitted on the training split only."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import encode as en
from kestrel.operators import sampling as sp
from kestrel.plans import sqlgen as sg
from kestrel.plans.q_profile import NUMERIC
from kestrel.plans.q_sampling import SPLIT
from kestrel.plans.registry import register
from kestrel.plans.views import with_views
from kestrel.sources import proxies

SIZES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
AUCTIONS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _split_auction(spark, sf):
    return sp.stratified_split(proxies.auction(spark, sf), "IsBadBuy", "row_id", 0.2)


@register("e1_label_codes", with_views("""
SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT Make AS value FROM auction WHERE Make IS NOT NULL) d""", "auction"))
def e1_label_codes(spark, sf):
    return en.fit_ordinal(proxies.auction(spark, sf), "Make")


@register("e2_ordinal_size", with_views("""
SELECT a.row_id, c.code AS Size_code FROM auction a LEFT JOIN (
  SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT Size AS value FROM auction WHERE Size IS NOT NULL) d) c ON a.Size = c.value""", "auction"))
def e2_ordinal_size(spark, sf):
    a = proxies.auction(spark, sf)
    codes = en.fit_ordinal(a, "Size")
    return en.transform_ordinal(a, "Size", codes).select("row_id", "Size_code")


def _dummy_sql(col: str, cats: list[str]) -> str:
    return ", ".join(f"CAST(coalesce({col} = '{v}', false) AS INTEGER) AS {sg.q(col + '_' + v)}" for v in cats[1:])


@register("e3_dummies_drop_first", with_views(
    f"SELECT row_id, {_dummy_sql('Auction', AUCTIONS)}, {_dummy_sql('Size', SIZES)} FROM auction", "auction"))
def e3_dummies_drop_first(spark, sf):
    a = proxies.auction(spark, sf).select("row_id", "Auction", "Size")
    return en.dummies(a, ["Auction", "Size"], drop_first=True)


_TE_COLS = ["Make", "Model"]


def _te_sql() -> str:
    parts = []
    for c in _TE_COLS:
        parts.append(f"""te_{c} AS (
  SELECT value, CASE WHEN n = 1 THEN prior
                     ELSE prior * (1 - 1.0 / (1.0 + exp(-(n - 20) / 10.0)))
                          + m * (1.0 / (1.0 + exp(-(n - 20) / 10.0))) END AS enc
  FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n, avg(CAST(IsBadBuy AS DOUBLE)) AS m
        FROM split_a WHERE split = 'train' AND {c} IS NOT NULL GROUP BY 1) s,
       (SELECT avg(CAST(IsBadBuy AS DOUBLE)) AS prior FROM split_a WHERE split = 'train') p)""")
    return ",\n".join(parts)


@register("e4_target_encoding", with_views(f"""
SELECT a.row_id, a.split,
       round(coalesce(t1.enc, (SELECT avg(CAST(IsBadBuy AS DOUBLE)) FROM split_a WHERE split = 'train')), 6) AS Make,
       round(coalesce(t2.enc, (SELECT avg(CAST(IsBadBuy AS DOUBLE)) FROM split_a WHERE split = 'train')), 6) AS Model
FROM split_a a LEFT JOIN te_Make t1 ON a.Make = t1.value LEFT JOIN te_Model t2 ON a.Model = t2.value""",
    "auction", extra=(SPLIT, _te_sql())))
def e4_target_encoding(spark, sf):
    a = _split_auction(spark, sf)
    fitted = en.fit_target_encoder(a.where(F.col("split") == "train"), _TE_COLS, "IsBadBuy")
    out = en.transform_target_encoder(a, _TE_COLS, fitted)
    return out.select("row_id", "split", *[F.round(c, 6).alias(c) for c in _TE_COLS])


@register("e5_one_hot_slots", with_views("""
SELECT a.row_id, c.slot AS Model_slot FROM split_a a LEFT JOIN (
  SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS slot
  FROM (SELECT DISTINCT Model AS value FROM split_a WHERE split = 'train' AND Model IS NOT NULL) d
) c ON a.Model = c.value""", "auction", extra=(SPLIT,)))
def e5_one_hot_slots(spark, sf):
    a = _split_auction(spark, sf)
    idx, ohe = en.fit_one_hot(a.where(F.col("split") == "train"), "Model")
    return en.one_hot_slot(a, "Model", idx, ohe).select("row_id", "Model_slot")


_RS = f"""rs AS (SELECT column_name, max(CASE WHEN q = 0.5 THEN value END) AS center,
       CASE WHEN max(CASE WHEN q = 0.75 THEN value END) - max(CASE WHEN q = 0.25 THEN value END) = 0 THEN 1.0
            ELSE max(CASE WHEN q = 0.75 THEN value END) - max(CASE WHEN q = 0.25 THEN value END) END AS scale
FROM {sg.quantiles("(SELECT * FROM split_a WHERE split = 'train') t", NUMERIC, [0.25, 0.5, 0.75])} qq
GROUP BY column_name)"""


@register("e6_robust_scale", with_views(
    "SELECT row_id, " + ", ".join(
        f"round((CAST({c} AS DOUBLE) - (SELECT center FROM rs WHERE column_name = '{c}')) "
        f"/ (SELECT scale FROM rs WHERE column_name = '{c}'), 6) AS {c}" for c in NUMERIC) + " FROM split_a",
    "auction", extra=(SPLIT, _RS)))
def e6_robust_scale(spark, sf):
    a = _split_auction(spark, sf)
    fitted = en.fit_robust_scaler(a.where(F.col("split") == "train"), NUMERIC)
    out = en.transform_robust_scaler(a.select("row_id", *NUMERIC), NUMERIC, fitted)
    return out.select("row_id", *[F.round(c, 6).alias(c) for c in NUMERIC])
