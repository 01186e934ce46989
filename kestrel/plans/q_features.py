"""Feature-engineering and binning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import features as fe
from kestrel.operators.stages import FeatureBuilder
from kestrel.plans import sqlgen as sg
from kestrel.plans.registry import register
from kestrel.plans.views import with_views
from kestrel.sources import proxies

LOG_COLS = ["VehOdo", "VehBCost", "WarrantyCost"]


def r6(c):
    return F.round(c, 6)


def _guard_sql(c: str) -> str:
    return f"(SELECT bool_and(coalesce({c} >= 0, false)) FROM auction)"


@register("f15_feature_builder", with_views(f"""
SELECT row_id,
       CAST(year(PurchDate) AS INTEGER) AS purchase_year, CAST(month(PurchDate) AS INTEGER) AS purchase_month,
       CAST(day(PurchDate) AS INTEGER) AS purchase_day, CAST(isodow(PurchDate) - 1 AS INTEGER) AS purchase_dow,
       round(VehOdo / (VehicleAge + 1.0), 6) AS odo_per_year,
       round(WarrantyCost / (VehBCost + 1.0), 6) AS warranty_cost_ratio,
       VehicleAge * VehOdo AS age_x_odo,
       CASE WHEN VehicleAge > -1 AND VehicleAge <= 2 THEN 'nuevo'
            WHEN VehicleAge > 2 AND VehicleAge <= 5 THEN 'semi_nuevo'
            WHEN VehicleAge > 5 AND VehicleAge <= 10 THEN 'usado'
            WHEN VehicleAge > 10 AND VehicleAge <= 30 THEN 'antiguo' END AS vehicle_age_group,
       {", ".join(f"CASE WHEN {_guard_sql(c)} THEN round(ln(1 + {c}), 6) END AS {c}_log1p" for c in LOG_COLS)}
FROM auction""", "auction"))
def f15_feature_builder(spark, sf):
    a = proxies.auction(spark, sf)
    model = FeatureBuilder().fit(a)
    out = model.transform(a)
    logs = [r6(F.col(f"{c}_log1p")).alias(f"{c}_log1p") if f"{c}_log1p" in out.columns
            else F.lit(None).cast("double").alias(f"{c}_log1p") for c in LOG_COLS]
    return out.select("row_id", "purchase_year", "purchase_month", "purchase_day", "purchase_dow",
                      r6("odo_per_year").alias("odo_per_year"),
                      r6("warranty_cost_ratio").alias("warranty_cost_ratio"),
                      "age_x_odo", "vehicle_age_group", *logs)


@register("f3_f11_extra_features", with_views("""
SELECT row_id, round(VehBCost / (MMRAcquisitionAuctionAveragePrice + 1.0), 6) AS cost_vs_acq_auction_avg_ratio,
       VehBCost * WarrantyCost AS cost_x_warranty
FROM auction""", "auction"))
def f3_f11_extra_features(spark, sf):
    out = fe.add_ratio_features(proxies.auction(spark, sf))
    return out.select("row_id", r6("cost_vs_acq_auction_avg_ratio").alias("cost_vs_acq_auction_avg_ratio"),
                      "cost_x_warranty")


@register("f8_age_group_counts", with_views("""
SELECT CASE WHEN VehicleAge > -1 AND VehicleAge <= 2 THEN 'nuevo'
            WHEN VehicleAge > 2 AND VehicleAge <= 5 THEN 'semi_nuevo'
            WHEN VehicleAge > 5 AND VehicleAge <= 10 THEN 'usado'
            WHEN VehicleAge > 10 AND VehicleAge <= 30 THEN 'antiguo' END AS vehicle_age_group,
       count(*) AS n_rows
FROM auction GROUP BY 1""", "auction"))
def f8_age_group_counts(spark, sf):
    out = fe.add_age_group(proxies.auction(spark, sf))
    return out.groupBy("vehicle_age_group").agg(F.count(F.lit(1)).alias("n_rows"))


_EDGES = f"""edges AS (SELECT list_sort(list_distinct(list(value))) AS e
FROM {sg.quantiles("auction", ["VehOdo"], [0.0, 0.25, 0.5, 0.75, 1.0])} qq)"""


@register("f9_odometer_group", with_views("""
SELECT row_id,
  CASE WHEN VehOdo IS NOT NULL AND len(e) >= 2 THEN
    CASE WHEN len(e) - 1 = 4 THEN
      ['bajo', 'medio_bajo', 'medio_alto', 'alto'][greatest(len(list_filter(e, lambda v: v < VehOdo)) - 1, 0) + 1]
    ELSE CAST(greatest(len(list_filter(e, lambda v: v < VehOdo)) - 1, 0) AS VARCHAR) END
  END AS odometer_group
FROM auction, edges""", "auction", extra=(_EDGES,)))
def f9_odometer_group(spark, sf):
    return fe.add_quartile_group(proxies.auction(spark, sf)).select("row_id", "odometer_group")


@register("f12_log1p_guard", with_views(
    "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, {_guard_sql(c)} AS all_nonnegative" for c in LOG_COLS),
    "auction"))
def f12_log1p_guard(spark, sf):
    good = fe.nonnegative_columns(proxies.auction(spark, sf), LOG_COLS)
    return spark.createDataFrame([(c, c in good) for c in LOG_COLS], "column_name string, all_nonnegative boolean")


def _cut_sql(src: str, col: str, n: int, target: str | None = None) -> str:
    tgt_sel = f", CAST({target} AS DOUBLE) AS t" if target else ""
    tgt_out = ", avg(b.t) AS target_rate" if target else ""
    return f"""
, src AS (SELECT CAST({col} AS DOUBLE) AS x{tgt_sel} FROM {src} WHERE {col} IS NOT NULL)
, mm AS (SELECT min(x) AS mn, max(x) AS mx FROM src)
, b AS (SELECT CAST(CASE WHEN mx > mn THEN least({n - 1}, greatest(0, CAST(ceil((x - mn) / ((mx - mn) / {n})) AS BIGINT) - 1))
                    ELSE 0 END AS INTEGER) AS bin_id{", t" if target else ""} FROM src, mm)
, c AS (SELECT bin_id, count(*) AS n_rows{tgt_out.replace("b.t", "t")} FROM b GROUP BY bin_id)
SELECT r.bin_id,
       round(CASE WHEN r.bin_id = 0 THEN mn - 0.001 * (mx - mn) ELSE mn + r.bin_id * ((mx - mn) / {n}) END, 6) AS lower,
       round(CASE WHEN r.bin_id = {n - 1} THEN mx ELSE mn + (r.bin_id + 1) * ((mx - mn) / {n}) END, 6) AS upper,
       coalesce(c.n_rows, 0) AS n_rows{", round(c.target_rate, 6) AS target_rate" if target else ""}
FROM (SELECT CAST(range AS INTEGER) AS bin_id FROM range({n})) r CROSS JOIN mm
LEFT JOIN c ON r.bin_id = c.bin_id
WHERE mx > mn OR r.bin_id = 0""".lstrip()


@register("f16_equal_width_bins", with_views(_cut_sql("auction", "VehBCost", 10), "auction"))
def f16_equal_width_bins(spark, sf):
    out = fe.equal_width_bins(proxies.auction(spark, sf), "VehBCost", 10)
    return out.select("bin_id", r6("lower").alias("lower"), r6("upper").alias("upper"), "n_rows")


@register("a2_target_rate_by_bin", with_views(_cut_sql("auction", "VehOdo", 10, target="IsBadBuy"), "auction"))
def a2_target_rate_by_bin(spark, sf):
    out = fe.equal_width_bins(proxies.auction(spark, sf), "VehOdo", 10, target="IsBadBuy")
    return out.select("bin_id", r6("lower").alias("lower"), r6("upper").alias("upper"), "n_rows",
                      r6("target_rate").alias("target_rate"))


@register("f17_histogram", with_views("""
, src AS (SELECT value AS x FROM ev WHERE value IS NOT NULL)
, mm AS (SELECT min(x) AS mn, max(x) AS mx FROM src)
, c AS (SELECT CAST(CASE WHEN mx > mn THEN least(29, CAST(floor((x - mn) / ((mx - mn) / 30)) AS BIGINT)) ELSE 0 END
                AS INTEGER) AS bin_id, count(*) AS n_rows FROM src, mm GROUP BY 1)
SELECT r.bin_id, coalesce(c.n_rows, 0) AS n_rows
FROM (SELECT CAST(range AS INTEGER) AS bin_id FROM range(30)) r LEFT JOIN c ON r.bin_id = c.bin_id""".lstrip(), "ev"))
def f17_histogram(spark, sf):
    return fe.histogram(proxies.events(spark, sf), "value", 30)


@register("f17_histogram_by_class", with_views("""
, src AS (SELECT value AS x, is_error FROM ev WHERE value IS NOT NULL)
, mm AS (SELECT min(x) AS mn, max(x) AS mx FROM src)
SELECT CAST(CASE WHEN mx > mn THEN least(29, CAST(floor((x - mn) / ((mx - mn) / 30)) AS BIGINT)) ELSE 0 END
            AS INTEGER) AS bin_id, is_error, count(*) AS n_rows
FROM src, mm GROUP BY 1, 2""".lstrip(), "ev"))
def f17_histogram_by_class(spark, sf):
    return fe.histogram(proxies.events(spark, sf), "value", 30, hue="is_error")
