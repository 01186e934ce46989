"""Parquet sources of the driver's tables (S1 for parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one table; column pruning and filters reach the reader."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
    return spark.read.parquet(table_path(sf_dir, name))


def load_all(spark: SparkSession, sf_dir: str, register: bool = False) -> dict[str, DataFrame]:
    frames = {t: load(spark, sf_dir, t) for t in TABLES}
    if register:
        for t, df in frames.items():
            df.createOrReplaceTempView(t)
    return frames
