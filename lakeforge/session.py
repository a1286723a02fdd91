"""Session helpers.

Library code never changes session configuration; it only reads it. The
builders here are for our own entry points (tests, bench, pipeline CLI).
"""

from __future__ import annotations

import os
import hashlib

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lakeforge") -> SparkSession:
    """A session tuned for the lakehouse jobs.

    AQE is on so that shuffle partitions coalesce at small scale and skewed
    join partitions are split at large scale; the session time zone is UTC
    so ingest-date partitions are UTC dates.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder
        .master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LAKEFORGE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared storage folder for tables, topic logs and stream checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` when the session names one,
    else the catalog warehouse folder (both are shared storage on a cluster).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/") + "/lakeforge"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable; only sets a folder when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = shared_root(spark) + "/rdd-checkpoints"
    sc.setCheckpointDir(path)
    return path


def scoped_path(spark: SparkSession, kind: str, *parts: str) -> str:
    """Deterministic folder under the shared root, keyed by ``parts``.

    Re-running the same query on the same input lands in the same folder,
    so overwrite sinks and checkpointed streams stay idempotent.
    """
    tag = hashlib.sha1("|".join(parts).encode()).hexdigest()[:12]
    return f"{shared_root(spark)}/{kind}/{tag}"
