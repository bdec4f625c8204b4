"""Session helpers: UTC session zone, checkpoint folder, local builder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_ROOT: str | None = None


def get_spark(master: str | None = None, app: str = "logsift",
              shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Builder used by tests, bench and scripts (never by library code)."""
    master = master or os.environ.get("LOGSIFT_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("LOGSIFT_DRIVER_MEM", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in conf.items():
        b = b.config(k.replace("_", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> None:
    """Pin the session zone to UTC: naive timestamps mean UTC (contract)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session without the
    setting (tests, bench) gets a fresh temporary folder of its own; on a
    cluster a missing setting is an error, never a machine-local folder.
    """
    global _LOCAL_CHECKPOINT_ROOT
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    if _LOCAL_CHECKPOINT_ROOT is None:
        _LOCAL_CHECKPOINT_ROOT = tempfile.mkdtemp(prefix="logsift-ckpt-")
    sc.setCheckpointDir(_LOCAL_CHECKPOINT_ROOT)
    return sc.getCheckpointDir() or _LOCAL_CHECKPOINT_ROOT


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
