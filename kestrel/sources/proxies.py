"""Proxy views over the driver's tables.

The reference works on a table of used-car auction purchases that is not
available; every operator takes column names as parameters, and the
registered queries run them on these proxies built from the TPC-H-like
tables. Money is summed in integer cents so that every engine gives the same
digits, and averages are rounded half-up in integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.tables import load

# Fixed values of the proxy definitions.
URGENT_PRIORITY = "1-URGENT"
AGE_MODULUS = 12
SEED = 42


def _cents(c) -> F.Column:
    return F.round(F.col(c) * 100).cast("bigint")


LINE_DERIVED = {"Model", "Size", "VehicleAge", "VehYear", "VehOdo", "MMRAcquisitionAuctionAveragePrice",
                "WarrantyCost"}


def auction(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """One row per order, shaped like the auction purchase table.

    row_id, IsBadBuy, PurchDate, Auction, Make, Model, Size, VehicleAge,
    VehYear, VehOdo, VehBCost, MMRAcquisitionAuctionAveragePrice,
    WarrantyCost. Orders without lines get nulls (left join), which gives the
    profiling and imputation operators real missing values.

    ``cols`` (optional) names the columns a query needs: when none of them
    comes from the line items, the line-item aggregation and the part join
    are not built at all (the planner cannot drop a left join it cannot
    prove row-preserving).
    """
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        _cents("l_extendedprice").alias("ext_c"), _cents("l_tax").alias("tax_c"))

    # partial aggregation map-side; output is hash-partitioned on l_orderkey,
    # which the join with orders reuses
    per_order = lines.groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("min_partkey"),
        F.sum("ext_c").alias("sum_c"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("ext_c") * F.col("tax_c")).alias("sum_w4"),
    )
    # nation is a fixed 25-row dimension: broadcast is bounded
    base = (orders
            .join(customer, orders.o_custkey == customer.c_custkey)
            .join(F.broadcast(nation), F.col("c_nationkey") == nation.n_nationkey))
    need_lines = cols is None or bool(LINE_DERIVED & set(cols))
    if need_lines:
        base = (base.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
                .join(part, F.col("min_partkey") == part.p_partkey, "left"))
    age = (F.col("p_size") % AGE_MODULUS).cast("int")
    out = {
        "row_id": F.col("o_orderkey"),
        "IsBadBuy": (F.col("o_orderpriority") == URGENT_PRIORITY).cast("int"),
        "PurchDate": F.col("o_orderdate"),
        "Auction": F.col("c_mktsegment"),
        "Make": F.col("n_name"),
    }
    if need_lines:
        out.update({
            "Model": F.col("p_brand"),
            "Size": F.col("p_type"),
            "VehicleAge": age,
            "VehYear": (F.year("o_orderdate") - age).cast("int"),
            "VehOdo": F.col("sum_c") / 100.0,
        })
    out["VehBCost"] = F.col("o_totalprice")
    if need_lines:
        out.update({
            "MMRAcquisitionAuctionAveragePrice": F.expr("(2 * sum_c + n_lines) div (2 * n_lines)") / 100.0,
            "WarrantyCost": F.expr("(sum_w4 + 50) div 100") / 100.0,
        })
    order = ["row_id", "IsBadBuy", "PurchDate", "Auction", "Make", "Model", "Size", "VehicleAge", "VehYear",
             "VehOdo", "VehBCost", "MMRAcquisitionAuctionAveragePrice", "WarrantyCost"]
    keep = [c for c in order if c in out and (cols is None or c in cols)]
    return base.select(*[out[c].alias(c) for c in keep])


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a second, larger fact table (whole rows can repeat)."""
    return load(spark, sf_dir, "lineitem")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a binary target ``is_error``."""
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "user_id", "event_type", "value",
                     (F.col("event_type") == "error").cast("int").alias("is_error"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: labels join documents, target ``toxic``."""
    lab = load(spark, sf_dir, "labels")
    doc = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return lab.join(doc, "doc_id")


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with a binary target ``is_zero`` (label = 0)."""
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", "embedding", "label",
                    (F.col("label") == 0).cast("int").alias("is_zero"))
