"""Spark session helpers.

The library never creates a session inside an operator: every public
function takes DataFrames (or a session) from the caller.  ``get_spark`` is
for tests, ``bench.py`` and scripts; on a cluster the caller's session (with
its own ``spark.checkpoint.dir``) is used unchanged.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings chosen for the engine's operators (all public Spark confs).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "repflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults."""
    master = master or os.environ.get("REPFLOW_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("REPFLOW_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local session without one gets a fresh scratch folder; any
    other master raises, since its executors could not see such a folder.
    """
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="repflow-ckpt-", dir="/tmp")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the session's shared checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
