"""Session helpers.

``get_session`` is for tests, tools and ``bench.py``; library code never
creates a session and never overrides settings a cluster has already made.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings applied only when the cluster/session has not set them already.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # whole texts go to Python tasks: a batch of 10,000 of them is tens of MB in several copies
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


# checkpoint folder already registered, by application
_registered: dict[str, str] = {}
_shipped: set[str] = set()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kestrel") -> SparkSession:
    """Local session for tests and benchmarks (UI off, UTC, AQE on)."""
    master = master or os.environ.get("KESTREL_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a local master (tests, bench) gets a scratch folder of its
    own; any other master without the setting is an error, since a
    machine-local folder is not visible to other executors.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if _registered.get(spark.sparkContext.applicationId) != current:
            spark.sparkContext.setCheckpointDir(current)
            _registered[spark.sparkContext.applicationId] = current
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    _registered[spark.sparkContext.applicationId] = local
    return local


def apply_defaults(spark: SparkSession) -> None:
    """Set the analysis defaults on an existing session where unset, and make
    sure checkpoints go to the session's ``spark.checkpoint.dir``."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, so
    that Python tasks import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="kestrel-code-")), "kestrel.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
