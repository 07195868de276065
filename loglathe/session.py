"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # the JVM does not compile larger methods; beyond it Spark generates several small ones instead of one
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # recording the Python call site of every expression costs more than building the plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks. On a cluster use the session it provides."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("loglathe")
    base = {
        **SESSION_DEFAULTS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in {**base, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach, under the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a folder of this machine.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    if not base:
        if not (spark.conf.get("spark.master", "") or "").startswith("local"):
            raise RuntimeError(f"Set {CHECKPOINT_SETTING} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")
