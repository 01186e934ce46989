"""Profiling queries (P*, A1, A3, A4) on the auction and line-item proxies."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import aggregates as agg
from kestrel.operators import profile as pr
from kestrel.plans import sqlgen as sg
from kestrel.plans.registry import register
from kestrel.plans.views import with_views
from kestrel.sources import proxies

AUCTION_COLS = ["row_id", "IsBadBuy", "PurchDate", "Auction", "Make", "Model", "Size",
                "VehicleAge", "VehYear", "VehOdo", "VehBCost",
                "MMRAcquisitionAuctionAveragePrice", "WarrantyCost"]
NUMERIC = ["VehicleAge", "VehYear", "VehOdo", "VehBCost", "MMRAcquisitionAuctionAveragePrice",
           "WarrantyCost"]
TEXT = ["Auction", "Make", "Model", "Size"]
DUP_KEYS = ["Make", "Model", "VehYear", "VehOdo"]
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- A1 (flagship)
@register("a1_target_rate_by_make", with_views("""
SELECT Make, round(avg(CAST(IsBadBuy AS DOUBLE)), 6) AS target_rate, count(*) AS n_rows
FROM auction WHERE Make IS NOT NULL GROUP BY Make
ORDER BY target_rate DESC, Make LIMIT 10""", "auction"))
def a1_target_rate_by_make(spark, sf):
    out = agg.target_rate_by_category(proxies.auction(spark, sf, ["Make", "IsBadBuy"]), "Make", "IsBadBuy", top=10)
    return out.select("Make", r6("target_rate").alias("target_rate"), "n_rows")


@register("a1_target_rate_by_model_all", with_views("""
SELECT Model, round(avg(CAST(IsBadBuy AS DOUBLE)), 6) AS target_rate, count(*) AS n_rows
FROM auction WHERE Model IS NOT NULL GROUP BY Model""", "auction"))
def a1_target_rate_by_model_all(spark, sf):
    out = agg.target_rate_by_category(proxies.auction(spark, sf), "Model", "IsBadBuy")
    return out.select("Model", r6("target_rate").alias("target_rate"), "n_rows")


# ---------------------------------------------------------------- P1
@register("p1_shape", with_views(
    f"SELECT count(*) AS n_rows, CAST({len(AUCTION_COLS)} AS INTEGER) AS n_cols FROM auction", "auction"))
def p1_shape(spark, sf):
    return pr.shape(proxies.auction(spark, sf))


# ---------------------------------------------------------------- P3 / P4
_null_row = "SELECT " + ", ".join(f"count(*) FILTER (WHERE {sg.q(c)} IS NULL) AS {sg.q(c)}"
                                  for c in AUCTION_COLS) + " FROM auction"


@register("p3_null_counts", with_views(sg.unpivot_body(AUCTION_COLS, "n_null"), "auction",
                                       extra=(f"r AS ({_null_row})",)))
def p3_null_counts(spark, sf):
    return pr.null_counts(proxies.auction(spark, sf))


_rate_row = "SELECT " + ", ".join(f"round(avg(CAST({sg.q(c)} IS NULL AS DOUBLE)), 6) AS {sg.q(c)}"
                                  for c in AUCTION_COLS) + " FROM auction"


@register("p4_null_rates", with_views(sg.unpivot_body(AUCTION_COLS, "null_rate"), "auction",
                                      extra=(f"r AS ({_rate_row})",)))
def p4_null_rates(spark, sf):
    out = pr.null_rates(proxies.auction(spark, sf))
    return out.select("column_name", r6("null_rate").alias("null_rate"))


# ---------------------------------------------------------------- P5 / P6
@register("p5_duplicate_rows_count", f"""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY {", ".join(LINE_COLS)}) g""")
def p5_duplicate_rows_count(spark, sf):
    return pr.duplicate_count(proxies.lines(spark, sf))


@register("p6_duplicate_key_count", with_views(f"""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS c FROM auction GROUP BY {", ".join(DUP_KEYS)}) g""", "auction"))
def p6_duplicate_key_count(spark, sf):
    return pr.duplicate_count(proxies.auction(spark, sf), DUP_KEYS)


@register("p6_duplicate_line_key_count", """
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber) g""")
def p6_duplicate_line_key_count(spark, sf):
    return pr.duplicate_count(proxies.lines(spark, sf), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- P7
_P7_KEYS = ["Make", "Model", "VehicleAge"]
_p7_join = " AND ".join(f"a.{k} IS NOT DISTINCT FROM d.{k}" for k in _P7_KEYS)


@register("p7_duplicate_members", with_views(f"""
SELECT a.* FROM auction a JOIN (
  SELECT {", ".join(_P7_KEYS)}, min(row_id) AS f FROM auction GROUP BY {", ".join(_P7_KEYS)}
  HAVING count(*) > 1) d ON {_p7_join}""", "auction"))
def p7_duplicate_members(spark, sf):
    return pr.duplicate_rows(proxies.auction(spark, sf), _P7_KEYS, "row_id", keep=False)


@register("p7_duplicate_beyond_first", with_views(f"""
SELECT a.* FROM auction a JOIN (
  SELECT {", ".join(_P7_KEYS)}, min(row_id) AS f FROM auction GROUP BY {", ".join(_P7_KEYS)}
  HAVING count(*) > 1) d ON {_p7_join} AND a.row_id <> d.f""", "auction"))
def p7_duplicate_beyond_first(spark, sf):
    return pr.duplicate_rows(proxies.auction(spark, sf), _P7_KEYS, "row_id", keep="first")


# ---------------------------------------------------------------- P8
_desc_basic = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({sg.q(c)}) AS count, round(avg(CAST({sg.q(c)} AS DOUBLE)), 6) AS mean, "
    f"round(stddev_samp(CAST({sg.q(c)} AS DOUBLE)), 6) AS std, min(CAST({sg.q(c)} AS DOUBLE)) AS min, "
    f"max(CAST({sg.q(c)} AS DOUBLE)) AS max FROM auction" for c in NUMERIC)


@register("p8_describe_numeric", with_views(f"""
SELECT b.column_name, b.count, b.mean, b.std, b.min,
       max(CASE WHEN qq.q = 0.25 THEN qq.value END) AS p25,
       max(CASE WHEN qq.q = 0.5 THEN qq.value END) AS p50,
       max(CASE WHEN qq.q = 0.75 THEN qq.value END) AS p75, b.max
FROM ({_desc_basic}) b LEFT JOIN {sg.quantiles("auction", NUMERIC, [0.25, 0.5, 0.75])} qq
  ON b.column_name = qq.column_name
GROUP BY b.column_name, b.count, b.mean, b.std, b.min, b.max""", "auction"))
def p8_describe_numeric(spark, sf):
    out = pr.describe_numeric(proxies.auction(spark, sf), NUMERIC)
    return out.withColumn("mean", r6("mean")).withColumn("std", r6("std"))


_text_long = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({sg.q(c)} AS VARCHAR) AS v FROM auction WHERE {sg.q(c)} IS NOT NULL"
    for c in TEXT)


@register("p8_describe_text", with_views(f"""
SELECT column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS unique,
       arg_min(v, (-n, v)) AS top, max(n) AS freq
FROM (SELECT column_name, v, count(*) AS n FROM ({_text_long}) t GROUP BY column_name, v) g
GROUP BY column_name""", "auction"))
def p8_describe_text(spark, sf):
    out = pr.describe_text(proxies.auction(spark, sf), TEXT)
    return out.withColumn("count", F.col("count").cast("bigint"))


# ---------------------------------------------------------------- P10 / P11
@register("p10_value_counts_make_top10", with_views("""
SELECT Make AS value, count(*) AS count FROM auction WHERE Make IS NOT NULL
GROUP BY Make ORDER BY count DESC, value LIMIT 10""", "auction"))
def p10_value_counts_make_top10(spark, sf):
    return pr.value_counts(proxies.auction(spark, sf, ["Make"]), "Make", top=10)


@register("p10_value_counts_with_null", with_views("""
SELECT Model AS value, count(*) AS count FROM auction GROUP BY Model""", "auction"))
def p10_value_counts_with_null(spark, sf):
    return pr.value_counts(proxies.auction(spark, sf), "Model", dropna=False)


@register("p11_value_shares", with_views("""
SELECT Auction AS value, count(*) AS count,
       count(*) / (SELECT count(*) FROM auction WHERE Auction IS NOT NULL)::DOUBLE AS share
FROM auction WHERE Auction IS NOT NULL GROUP BY Auction""", "auction"))
def p11_value_shares(spark, sf):
    return pr.value_counts(proxies.auction(spark, sf, ["Auction"]), "Auction", normalize=True)


# ---------------------------------------------------------------- P12
_dc_row = "SELECT " + ", ".join(f"count(DISTINCT {sg.q(c)}) AS {sg.q(c)}" for c in AUCTION_COLS) + " FROM auction"
_dcn_row = "SELECT " + ", ".join(
    f"count(DISTINCT {sg.q(c)}) + CAST(bool_or({sg.q(c)} IS NULL) AS BIGINT) AS {sg.q(c)}"
    for c in AUCTION_COLS) + " FROM auction"


@register("p12_distinct_counts", with_views(sg.unpivot_body(AUCTION_COLS, "n_distinct"), "auction",
                                            extra=(f"r AS ({_dc_row})",)))
def p12_distinct_counts(spark, sf):
    return pr.distinct_counts(proxies.auction(spark, sf))


@register("p12_distinct_counts_with_null", with_views(sg.unpivot_body(AUCTION_COLS, "n_distinct"), "auction",
                                                      extra=(f"r AS ({_dcn_row})",)))
def p12_distinct_counts_with_null(spark, sf):
    return pr.distinct_counts(proxies.auction(spark, sf), dropna=False)


# ---------------------------------------------------------------- P13 / P14
RULES_SQL = {
    "odometer_not_positive": "VehOdo <= 0",
    "cost_not_positive": "VehBCost <= 0",
    "year_out_of_range": "VehYear < 1980 OR VehYear > 2026",
    "age_over_ten": "VehicleAge > 10",
}


def _rules():
    return {
        "odometer_not_positive": F.col("VehOdo") <= 0,
        "cost_not_positive": F.col("VehBCost") <= 0,
        "year_out_of_range": (F.col("VehYear") < 1980) | (F.col("VehYear") > 2026),
        "age_over_ten": F.col("VehicleAge") > 10,
    }


_rule_row = "SELECT " + ", ".join(f"count(*) FILTER (WHERE {v}) AS {k}" for k, v in RULES_SQL.items()) + " FROM auction"


@register("p13_rule_violations", with_views(sg.unpivot_body(list(RULES_SQL), "n_rows", name_col="rule"),
                                            "auction", extra=(f"r AS ({_rule_row})",)))
def p13_rule_violations(spark, sf):
    return pr.rule_violations(proxies.auction(spark, sf), _rules())


@register("p14_age_mismatch", with_views("""
SELECT count(*) FILTER (WHERE coalesce(year(PurchDate) - VehYear <> VehicleAge, true)) AS n_mismatch
FROM auction""", "auction"))
def p14_age_mismatch(spark, sf):
    return pr.mismatch_count(proxies.auction(spark, sf), F.year("PurchDate") - F.col("VehYear"), "VehicleAge")


# ---------------------------------------------------------------- P15 / P16
_pairs = [(i, j) for i in range(len(NUMERIC)) for j in range(i + 1, len(NUMERIC))]
_corr_sql = "\nUNION ALL\n".join(
    f"SELECT '{NUMERIC[i]}' AS col_a, '{NUMERIC[j]}' AS col_b, {i} AS pos_a, {j} AS pos_b, "
    f"round(corr(CAST({sg.q(NUMERIC[i])} AS DOUBLE), CAST({sg.q(NUMERIC[j])} AS DOUBLE)), 6) AS r FROM auction"
    for i, j in _pairs)


@register("p15_correlation_pairs", with_views(
    f"SELECT col_a, col_b, CAST(pos_a AS INTEGER) AS pos_a, CAST(pos_b AS INTEGER) AS pos_b, r FROM ({_corr_sql}) c",
    "auction"))
def p15_correlation_pairs(spark, sf):
    out = pr.correlation_pairs(proxies.auction(spark, sf), NUMERIC)
    return out.withColumn("r", r6("r"))


# cost, a near copy of it (cost plus the vehicle's age) and the odometer total
_P16_COLS = ["VehBCost", "CostAge", "VehOdo"]
_p16_sql = "\nUNION ALL\n".join(
    f"SELECT '{b}' AS column_name, abs(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) AS r FROM p16"
    for i, a in enumerate(_P16_COLS) for b in _P16_COLS[i + 1:])


@register("p16_high_correlation", with_views(
    f"SELECT column_name, round(max(r), 6) AS max_abs_r FROM ({_p16_sql}) c WHERE r > 0.95 GROUP BY column_name", "auction",
    extra=("p16 AS (SELECT VehBCost, VehBCost + VehicleAge AS CostAge, VehOdo FROM auction)",)))
def p16_high_correlation(spark, sf):
    a = proxies.auction(spark, sf).withColumn("CostAge", F.col("VehBCost") + F.col("VehicleAge"))
    return pr.high_correlation_columns(a, _P16_COLS, 0.95).select("column_name", r6("max_abs_r").alias("max_abs_r"))


# ---------------------------------------------------------------- P18
_BQ = f"""bq AS (SELECT column_name, max(CASE WHEN q = 0.25 THEN value END) AS q1,
                  max(CASE WHEN q = 0.75 THEN value END) AS q3
           FROM {sg.quantiles("auction", NUMERIC, [0.25, 0.75])} qq GROUP BY column_name)"""


@register("p18_iqr_outliers", with_views(f"""
SELECT b.column_name, round(b.q1, 6) AS q1, round(b.q3, 6) AS q3,
       round(b.q1 - 1.5 * (b.q3 - b.q1), 6) AS lower, round(b.q3 + 1.5 * (b.q3 - b.q1), 6) AS upper,
       count(*) FILTER (WHERE l.x < b.q1 - 1.5 * (b.q3 - b.q1) OR l.x > b.q3 + 1.5 * (b.q3 - b.q1)) AS n_outliers
FROM ({sg.long_union("auction", NUMERIC, dropna=False)}) l JOIN bq b ON l.column_name = b.column_name
GROUP BY b.column_name, b.q1, b.q3""", "auction", extra=(_BQ,)))
def p18_iqr_outliers(spark, sf):
    out = pr.iqr_outlier_counts(proxies.auction(spark, sf), NUMERIC)
    return out.select("column_name", *[r6(c).alias(c) for c in ["q1", "q3", "lower", "upper"]], "n_outliers")


# ---------------------------------------------------------------- A3 / A4
@register("a3_counts_by_year_target", with_views("""
SELECT VehYear, IsBadBuy, count(*) AS n_rows FROM auction GROUP BY VehYear, IsBadBuy""", "auction"))
def a3_counts_by_year_target(spark, sf):
    return agg.counts_by(proxies.auction(spark, sf, ["VehYear", "IsBadBuy"]), ["VehYear", "IsBadBuy"])


@register("a4_box_by_class", with_views(f"""
SELECT b.IsBadBuy, b.q1, b.median, b.q3,
       min(CASE WHEN a.VehBCost BETWEEN b.lo AND b.hi THEN a.VehBCost END) AS whisker_low,
       max(CASE WHEN a.VehBCost BETWEEN b.lo AND b.hi THEN a.VehBCost END) AS whisker_high,
       count(*) FILTER (WHERE NOT (a.VehBCost BETWEEN b.lo AND b.hi)) AS n_outliers
FROM auction a JOIN (
  SELECT IsBadBuy, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT IsBadBuy, max(CASE WHEN q = 0.25 THEN value END) AS q1, max(CASE WHEN q = 0.5 THEN value END) AS median,
           max(CASE WHEN q = 0.75 THEN value END) AS q3
    FROM {sg.quantiles("auction", ["VehBCost"], [0.25, 0.5, 0.75], by=["IsBadBuy"])} qq GROUP BY IsBadBuy) s
) b ON a.IsBadBuy = b.IsBadBuy
WHERE a.VehBCost IS NOT NULL
GROUP BY b.IsBadBuy, b.q1, b.median, b.q3""", "auction"))
def a4_box_by_class(spark, sf):
    return agg.box_summary(proxies.auction(spark, sf, ["VehBCost", "IsBadBuy"]), "VehBCost", ["IsBadBuy"])


@register("a1_toxic_rate_by_source", with_views("""
SELECT source, round(avg(CAST(toxic AS DOUBLE)), 6) AS target_rate, count(*) AS n_rows
FROM docs WHERE source IS NOT NULL GROUP BY source""", "docs"))
def a1_toxic_rate_by_source(spark, sf):
    out = agg.target_rate_by_category(proxies.docs(spark, sf), "source", "toxic")
    return out.select("source", r6("target_rate").alias("target_rate"), "n_rows")
