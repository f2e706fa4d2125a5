"""Session construction and session-scoped settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults applied only when the caller (cluster config, spark-submit) has not
# set a value. AQE re-plans joins and splits skewed shuffle partitions at run
# time; the skew join split is what keeps a hot employee code from pinning one
# task in the interval joins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "effdated",
                shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Return the active session, or build one (tests / local runs).

    On a cluster the session already exists and its settings win; we only fill
    in the keys above that are still unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None and master is None:
        spark = active
    else:
        b = SparkSession.builder.appName(app_name)
        if master:
            b = b.master(master)
            if master.startswith("local") and "spark__driver__memory" not in conf:
                b = b.config("spark.driver.memory", "8g")  # local mode: the driver is the executor
        for k, v in _DEFAULTS.items():
            b = b.config(k, v)
        if shuffle_partitions:
            b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        for k, v in conf.items():
            b = b.config(k.replace("__", "."), v)
        spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset and the
    master is local (tests). On a cluster the folder must be shared, so unset raises."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="effdated-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path
