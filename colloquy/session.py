"""Spark session helpers.

The library never creates its own session inside an operator; callers pass one
in.  ``get_session`` is for scripts and tests only.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app_name: str = "colloquy",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the plans are tuned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # long texts: keep Arrow batches small so one batch of segment pairs
        # stays well inside a Python worker's memory
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .config("spark.driver.memory", os.environ.get("COLLOQUY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; ``fallback`` is applied
    only when it is unset (tests).  Never a machine-local folder on a cluster.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    target = current or fallback
    if not target:
        return None
    try:
        if not current:
            spark.conf.set("spark.checkpoint.dir", target)
        spark.sparkContext.setCheckpointDir(target)
    except Exception:  # noqa: BLE001 - a session without a SparkContext (Spark Connect)
        return None
    return target


def work_parallelism(spark: SparkSession, factor: int = 2) -> int:
    """Partition count for compute-heavy (not byte-heavy) stages.

    AQE coalesces shuffles by bytes; quadratic text kernels need partitions by
    work.  Use the larger of the configured shuffle partitions and
    ``factor`` x the cluster's default parallelism.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(shuffle, factor * default_parallelism(spark, shuffle))


def default_parallelism(spark: SparkSession, fallback: int) -> int:
    """The cluster's core count, or ``fallback`` where the session has no
    SparkContext to ask (Spark Connect)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return fallback


def materialize(df):
    """Cut lineage after an expensive stage (the scoring kernels) that several
    consumers read: a reliable ``checkpoint()`` into the shared folder named by
    ``spark.checkpoint.dir``.  Without that setting the DataFrame is returned
    as is and recomputed per consumer (never a local checkpoint)."""
    if checkpoint_dir(df.sparkSession) is None:
        return df
    return df.checkpoint(eager=True)
