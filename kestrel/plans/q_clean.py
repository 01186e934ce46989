"""Projection, filter, cast, imputation and scalar-function queries (C*, I*, X*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import scalar as X
from kestrel.operators import clean as cl
from kestrel.operators import profile as pr
from kestrel.plans import sqlgen as sg
from kestrel.plans.q_profile import AUCTION_COLS, NUMERIC
from kestrel.plans.registry import register
from kestrel.plans.views import with_views
from kestrel.sources import proxies
from kestrel.sources.tables import load

_MED_CTE = f"""med AS (SELECT column_name, value FROM {sg.quantiles("auction", NUMERIC, [0.5])} qq)"""


def _med(c: str) -> str:
    return f"(SELECT value FROM med WHERE column_name = '{c}')"


def _replace_numeric(expr_for) -> str:
    return ", ".join(expr_for(c) if c in NUMERIC else c for c in AUCTION_COLS)


# ---------------------------------------------------------------- C1 / C2 / C3 / C4
@register("c1_strip_column_names", with_views("SELECT row_id, Make, VehBCost FROM auction", "auction"))
def c1_strip_column_names(spark, sf):
    a = proxies.auction(spark, sf).select("row_id", "Make", "VehBCost")
    padded = a.toDF(" row_id", "Make  ", " VehBCost ")
    return cl.strip_column_names(padded)


_sparse_sql = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, avg(CAST({sg.q(c)} IS NULL AS DOUBLE)) AS null_rate FROM auction"
    for c in AUCTION_COLS)


@register("c2_sparse_columns", with_views(
    f"SELECT column_name FROM ({_sparse_sql}) s WHERE null_rate > 0.01", "auction"))
def c2_sparse_columns(spark, sf):
    # the decision table of the drop: one row per sparse column
    names = cl.sparse_columns(proxies.auction(spark, sf), 0.01)
    return spark.createDataFrame([(n,) for n in names], "column_name string")


@register("c2_drop_columns", with_views(
    "SELECT row_id, IsBadBuy, PurchDate, Auction, Make, VehBCost FROM auction", "auction"))
def c2_drop_columns(spark, sf):
    a = proxies.auction(spark, sf)
    return cl.drop_columns(a, ["Model", "Size", "VehicleAge", "VehYear", "VehOdo",
                               "MMRAcquisitionAuctionAveragePrice", "WarrantyCost", "NotThere"])


_const_sql = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {sg.q(c)}) + CAST(bool_or({sg.q(c)} IS NULL) AS BIGINT) AS nu "
    f"FROM (SELECT *, 'USD' AS Currency FROM auction) a" for c in [*AUCTION_COLS, "Currency"])


@register("c3_constant_columns", with_views(
    f"SELECT column_name FROM ({_const_sql}) s WHERE nu <= 1", "auction"))
def c3_constant_columns(spark, sf):
    a = proxies.auction(spark, sf).withColumn("Currency", F.lit("USD"))
    # the decision table of the drop: one row per constant column
    names = cl.constant_columns(a)
    return spark.createDataFrame([(n,) for n in names], "column_name string")


@register("c4_select_existing", with_views("SELECT Make, VehBCost, row_id FROM auction", "auction"))
def c4_select_existing(spark, sf):
    return cl.select_existing(proxies.auction(spark, sf), ["Make", "NoSuchColumn", "VehBCost", "row_id"])


# ---------------------------------------------------------------- C5 / C6 / C7 / C8 / C9
@register("c5_range_filters", with_views(
    "SELECT * FROM auction WHERE VehBCost > 100000 AND VehOdo > 100", "auction"))
def c5_range_filters(spark, sf):
    a = proxies.auction(spark, sf)
    return cl.filter_greater(cl.filter_greater(a, "VehBCost", 100000), "VehOdo", 100)


@register("c6_band_filter", with_views("""
SELECT row_id, VehBCost - MMRAcquisitionAuctionAveragePrice AS Sobrecosto FROM auction
WHERE VehBCost - MMRAcquisitionAuctionAveragePrice > -5000
  AND VehBCost - MMRAcquisitionAuctionAveragePrice < 80000""", "auction"))
def c6_band_filter(spark, sf):
    a = cl.with_overprice(proxies.auction(spark, sf), "VehBCost", "MMRAcquisitionAuctionAveragePrice")
    return cl.filter_open_band(a, "Sobrecosto", -5000, 80000).select("row_id", "Sobrecosto")


@register("c7_target_filter", with_views("SELECT * FROM auction WHERE IsBadBuy = 1", "auction"))
def c7_target_filter(spark, sf):
    return cl.filter_target(proxies.auction(spark, sf), "IsBadBuy", 1)


@register("c8_coerce_target", """
SELECT o_orderkey, CAST(TRY_CAST(t AS DOUBLE) AS INTEGER) AS target FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown'
                          ELSE split_part(o_orderpriority, '-', 1) END AS target_text
  FROM orders) s(o_orderkey, t)
WHERE TRY_CAST(t AS DOUBLE) IS NOT NULL""")
def c8_coerce_target(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("unknown"))
        .otherwise(F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(1))).alias("target"))
    return cl.coerce_target(o, "target")


@register("c9_cast_columns", with_views("""
SELECT row_id, CAST(VehYear AS VARCHAR) AS VehYear, TRY_CAST(VehicleAge AS DOUBLE) AS VehicleAge,
       CAST(IsBadBuy AS INTEGER) AS IsBadBuy FROM auction""", "auction"))
def c9_cast_columns(spark, sf):
    a = proxies.auction(spark, sf).select("row_id", "VehYear", "VehicleAge", "IsBadBuy")
    return cl.cast_columns(a, numeric=["VehicleAge"], category=["VehYear"], flags=["IsBadBuy"])


# ---------------------------------------------------------------- C11 / C12 / C13
@register("c11_features_head", with_views(
    "SELECT * EXCLUDE (IsBadBuy) FROM auction ORDER BY row_id LIMIT 5", "auction"))
def c11_features_head(spark, sf):
    x, _ = cl.split_xy(proxies.auction(spark, sf), "IsBadBuy")
    return cl.head(x, 5, ["row_id"])


@register("c12_text_cleanup", with_views(f"""
SELECT row_id, coalesce(Model, 'Missing') AS Model, coalesce(Size, 'Missing') AS Size,
       coalesce(VehOdo, {_med("VehOdo")}) AS VehOdo,
       coalesce(WarrantyCost, {_med("WarrantyCost")}) AS WarrantyCost
FROM auction""", "auction", extra=(_MED_CTE,)))
def c12_text_cleanup(spark, sf):
    a = proxies.auction(spark, sf).select("row_id", "Model", "Size", "VehOdo", "WarrantyCost")
    return cl.basic_text_cleanup(a, ["VehOdo", "WarrantyCost"], ["Model", "Size"])


@register("c13_constant_columns_added", with_views(
    "SELECT CAST(3 AS INTEGER) AS sprint, 'modeling_baseline' AS stage, row_id, Make AS make_name FROM auction",
    "auction"))
def c13_constant_columns_added(spark, sf):
    a = proxies.auction(spark, sf).select("row_id", "Make").withColumnRenamed("Make", "make_name")
    return cl.with_constants(a, {"sprint": 3, "stage": "modeling_baseline"}, first=True)


# ---------------------------------------------------------------- I1 / I2 / I3
@register("i1_fill_constant", with_views("""
SELECT row_id, coalesce(Model, 'Unknown') AS Model, coalesce(Size, 'Missing') AS Size,
       coalesce(VehOdo, 0.0) AS VehOdo FROM auction""", "auction"))
def i1_fill_constant(spark, sf):
    a = proxies.auction(spark, sf).select("row_id", "Model", "Size", "VehOdo")
    return cl.fill_constant(a, {"Model": "Unknown", "Size": "Missing", "VehOdo": 0.0})


_ZERO_COLS = ["l_discount", "l_tax"]


@register("i2_repair_zeros", f"""
WITH pos AS (SELECT column_name, value FROM {sg.quantiles(
    "(SELECT CASE WHEN l_discount > 0 THEN l_discount END AS l_discount, "
    "CASE WHEN l_tax > 0 THEN l_tax END AS l_tax FROM lineitem) z", _ZERO_COLS, [0.5])} qq)
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount = 0 THEN (SELECT value FROM pos WHERE column_name = 'l_discount')
            ELSE l_discount END AS l_discount,
       CASE WHEN l_tax = 0 THEN (SELECT value FROM pos WHERE column_name = 'l_tax')
            ELSE l_tax + 0.0 END AS l_tax
FROM lineitem""")
def i2_repair_zeros(spark, sf):
    li = proxies.lines(spark, sf).select("l_orderkey", "l_linenumber", *_ZERO_COLS)
    return cl.repair_zeros(li, _ZERO_COLS)


@register("i3_fill_median", with_views(
    "SELECT " + _replace_numeric(lambda c: f"coalesce(CAST({c} AS DOUBLE), {_med(c)}) AS {c}") + " FROM auction",
    "auction", extra=(_MED_CTE,)))
def i3_fill_median(spark, sf):
    return cl.fill_median(proxies.auction(spark, sf), NUMERIC)


# ---------------------------------------------------------------- I4
@register("i4_group_median_fill", with_views(f"""
, base AS (SELECT row_id, VehYear, CASE WHEN WarrantyCost > 1 THEN WarrantyCost END AS x FROM auction)
, gm AS (SELECT VehYear, value FROM {sg.quantiles(
    "(SELECT VehYear, x FROM base WHERE VehYear IS NOT NULL) b", ["x"], [0.5], by=["VehYear"])} qq)
, filled AS (SELECT b.row_id, b.VehYear, coalesce(b.x, gm.value) AS x FROM base b LEFT JOIN gm ON b.VehYear = gm.VehYear)
, gall AS (SELECT value FROM {sg.quantiles("filled", ["x"], [0.5])} qq)
SELECT row_id, VehYear, coalesce(x, (SELECT value FROM gall)) AS WarrantyCost FROM filled""".lstrip(),
    "auction"))
def i4_group_median_fill(spark, sf):
    a = proxies.auction(spark, sf).select("row_id", "VehYear", "WarrantyCost")
    return cl.fill_group_median(a, "WarrantyCost", "VehYear", low_to_null=1.0)


# ---------------------------------------------------------------- I5
_MODE_COLS = ["Model", "Size", "VehicleAge"]


def _mode_sql(c: str, numeric: bool) -> str:
    v = f"CAST({c} AS DOUBLE)" if numeric else c
    return (f"SELECT '{c}' AS column_name, CAST(arg_min(v, (-n, v)) AS VARCHAR) AS mode FROM "
            f"(SELECT {v} AS v, count(*) AS n FROM auction WHERE {c} IS NOT NULL GROUP BY 1) g")


_MODE_SQL = "\nUNION ALL\n".join(_mode_sql(c, c == "VehicleAge") for c in _MODE_COLS)


@register("i5_mode_values", with_views(_MODE_SQL, "auction"))
def i5_mode_values(spark, sf):
    return cl.mode_stats(proxies.auction(spark, sf), _MODE_COLS)


@register("i5_fill_mode", with_views(f"""
, m AS ({_MODE_SQL})
SELECT row_id,
       coalesce(Model, (SELECT mode FROM m WHERE column_name = 'Model')) AS Model,
       coalesce(Size, (SELECT mode FROM m WHERE column_name = 'Size')) AS Size,
       coalesce(VehicleAge, CAST(CAST((SELECT mode FROM m WHERE column_name = 'VehicleAge') AS DOUBLE) AS INTEGER))
         AS VehicleAge
FROM auction""".lstrip(), "auction"))
def i5_fill_mode(spark, sf):
    a = proxies.auction(spark, sf).select("row_id", *_MODE_COLS)
    return cl.fill_mode(a, _MODE_COLS)


# ---------------------------------------------------------------- I7 / I8 / I9
@register("i7_i8_derived_checks", with_views("""
SELECT row_id, VehBCost - MMRAcquisitionAuctionAveragePrice AS Sobrecosto,
       CAST(year(PurchDate) - VehYear AS INTEGER) AS edad_calculada FROM auction""", "auction"))
def i7_i8_derived_checks(spark, sf):
    a = proxies.auction(spark, sf)
    a = cl.with_overprice(a, "VehBCost", "MMRAcquisitionAuctionAveragePrice")
    a = cl.recompute_age(a, "PurchDate", "VehYear")
    return a.select("row_id", "Sobrecosto", "edad_calculada")


_IQR_CTE = f"""iq AS (SELECT column_name, max(CASE WHEN q = 0.25 THEN value END) AS q1,
       max(CASE WHEN q = 0.75 THEN value END) AS q3
FROM {sg.quantiles("auction", NUMERIC, [0.25, 0.75])} qq GROUP BY column_name)"""


def _clip(c: str) -> str:
    q1 = f"(SELECT q1 FROM iq WHERE column_name = '{c}')"
    q3 = f"(SELECT q3 FROM iq WHERE column_name = '{c}')"
    x = f"CAST({c} AS DOUBLE)"
    return (f"CASE WHEN {x} IS NOT NULL THEN greatest(least({x}, {q3} + 1.5 * ({q3} - {q1})), "
            f"{q1} - 1.5 * ({q3} - {q1})) END AS {c}")


@register("i9_winsorize_iqr", with_views(
    "SELECT " + _replace_numeric(_clip) + " FROM auction", "auction", extra=(_IQR_CTE,)))
def i9_winsorize_iqr(spark, sf):
    return cl.winsorize_iqr(proxies.auction(spark, sf), NUMERIC)


# ---------------------------------------------------------------- X functions
@register("x_text_functions", with_views("""
SELECT row_id, upper(Make) AS make_upper, trim('  ' || Auction || ' ') AS auction_trim,
       CASE Auction WHEN 'AUTOMOBILE' THEN 'auto' WHEN 'BUILDING' THEN 'build' ELSE 'other' END AS auction_group,
       CASE WHEN Size IN ('nan', 'None', '', 'NULL', 'NA') THEN NULL ELSE Size END AS size_clean,
       CAST(VehYear AS VARCHAR) AS veh_year_text,
       printf('%.3f', VehBCost / 3.0) AS cost_third,
       concat_ws(' | ', Make, Model, Size) AS label
FROM auction""", "auction"))
def x_text_functions(spark, sf):
    a = proxies.auction(spark, sf)
    return a.select(
        "row_id",
        X.upper("Make").alias("make_upper"),
        X.trim(F.concat(F.lit("  "), F.col("Auction"), F.lit(" "))).alias("auction_trim"),
        X.map_values("Auction", {"AUTOMOBILE": "auto", "BUILDING": "build"}, "other").alias("auction_group"),
        X.nullify_tokens("Size").alias("size_clean"),
        X.to_text("VehYear").alias("veh_year_text"),
        X.fmt3(F.col("VehBCost") / 3.0).alias("cost_third"),
        X.join_parts(F.col("Make"), F.col("Model"), F.col("Size")).alias("label"),
    )


@register("x_date_functions", with_views("""
SELECT event_id,
       CAST(year(ts) AS INTEGER) AS ts_year, CAST(month(ts) AS INTEGER) AS ts_month,
       CAST(day(ts) AS INTEGER) AS ts_day, CAST(isodow(ts) - 1 AS INTEGER) AS ts_dow,
       strftime(to_timestamp(epoch(date_trunc('second', ts))::BIGINT) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS ts_from_epoch,
       CAST(year(TRY_CAST(CASE WHEN is_error = 1 THEN 'not a date'
                          ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP)) AS INTEGER) AS parsed_year
FROM ev""", "ev"))
def x_date_functions(spark, sf):
    e = proxies.events(spark, sf)
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    text = F.when(F.col("is_error") == 1, F.lit("not a date")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select(
        "event_id", *X.date_parts("ts", "ts"),
        F.date_format(X.epoch_seconds_to_ts(epoch), "yyyy-MM-dd HH:mm:ss").alias("ts_from_epoch"),
        F.year(X.text_to_ts(text)).alias("parsed_year"),
    )


@register("x_numeric_functions", with_views("""
SELECT row_id,
       round(VehOdo / (VehicleAge + 1.0), 6) AS odo_per_year,
       VehicleAge * VehOdo AS age_x_odo,
       VehBCost - MMRAcquisitionAuctionAveragePrice AS overprice,
       abs(VehBCost - MMRAcquisitionAuctionAveragePrice) AS overprice_abs,
       round(ln(1 + VehBCost), 6) AS cost_log1p,
       round(VehBCost / 3.0, 2) AS cost_third_2,
       CASE WHEN IsBadBuy = 1 THEN 'bad' ELSE 'good' END AS label,
       CASE WHEN WarrantyCost / VehBCost >= 0.10 THEN 'posible overfitting'
            WHEN WarrantyCost / VehBCost <= 0.03 THEN 'sin brecha fuerte'
            WHEN WarrantyCost / VehBCost IS NOT NULL THEN 'brecha moderada' END AS diagnosis
FROM auction""", "auction"))
def x_numeric_functions(spark, sf):
    a = proxies.auction(spark, sf)
    ratio = F.col("WarrantyCost") / F.col("VehBCost")
    return a.select(
        "row_id",
        F.round(X.ratio_plus_one("VehOdo", "VehicleAge"), 6).alias("odo_per_year"),
        X.product("VehicleAge", "VehOdo").alias("age_x_odo"),
        X.difference("VehBCost", "MMRAcquisitionAuctionAveragePrice").alias("overprice"),
        F.abs(X.difference("VehBCost", "MMRAcquisitionAuctionAveragePrice")).alias("overprice_abs"),
        F.round(X.log1p("VehBCost"), 6).alias("cost_log1p"),
        X.round_to(F.col("VehBCost") / 3.0, 2).alias("cost_third_2"),
        X.choose(F.col("IsBadBuy") == 1, F.lit("bad"), F.lit("good")).alias("label"),
        X.gap_diagnosis(ratio).alias("diagnosis"),
    )


@register("x_ordered_list_text", with_views("""
SELECT '[' || string_agg(CAST(IsBadBuy AS VARCHAR), ', ' ORDER BY row_id) || ']' AS sample_targets
FROM (SELECT row_id, IsBadBuy FROM auction ORDER BY row_id LIMIT 5) s""", "auction"))
def x_ordered_list_text(spark, sf):
    first5 = cl.head(proxies.auction(spark, sf).select("row_id", "IsBadBuy"), 5, ["row_id"])
    return first5.agg(X.ordered_list_text("row_id", "IsBadBuy").alias("sample_targets"))
