"""Session construction for local runs and tests, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = 8, app: str = "arrears", **conf) -> SparkSession:
    """A local session for tests and benchmarks (a cluster brings its own)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_LOCAL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a session with a
    ``local`` master, as in tests, gets a folder of its own where that is unset;
    elsewhere executors could not read each other's files in it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="arrears-ckpt-", dir=os.environ.get("ARREARS_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
