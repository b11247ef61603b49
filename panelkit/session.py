"""Spark session defaults and lineage cutting.

On a cluster the session comes from the platform; ``get_spark`` only fills in
settings that are not set yet, so a cluster's own values always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "panelkit",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with panelkit's defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Only a local session without
    that setting (tests) gets a private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    master = sc.master or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster run needs a shared folder")
    path = tempfile.mkdtemp(prefix="panelkit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    return a scan of it.

    Survives executor loss (the files live in the shared folder, unlike a
    local checkpoint) and keeps long chains from re-running their lineage on
    every action. Compared with ``DataFrame.checkpoint()`` it costs one job
    instead of two (an eager reliable checkpoint computes the plan once to
    count and again to write), and later reads are columnar scans with
    column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/panelkit-cut-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
