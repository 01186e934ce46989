"""Shared scratch tables and size-checked broadcasts.

Intermediate results go to the folder in ``spark.checkpoint.dir`` (shared by
driver and executors), as Parquet or as a reliable ``checkpoint()``; nothing
is written to a machine-local folder on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/kestrel/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return a scan of it:
    cuts the lineage, survives lost executors, keeps column pruning."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kestrel_path = path
    return out


def release(*dfs: DataFrame) -> None:
    """Delete the scratch tables behind ``materialize``d frames."""
    for df in dfs:
        path = getattr(df, "_kestrel_path", None)
        if path:
            spark = df.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has at most
    ``max_rows`` rows; a larger table is joined by shuffle (with adaptive
    skew splitting). Call it on a materialised or cheap frame."""
    return F.broadcast(df) if df.count() <= max_rows else df
