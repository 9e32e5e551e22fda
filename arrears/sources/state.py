"""The high-watermark of lateness per contract as a log-structured table.

Every batch adds its own values (``delta/batch=<id>``), a read merges what is
there, and compaction folds it into one base.  The merge is a maximum, so it does
not matter in which order batches arrive, whether one is replayed (it replaces
its own delta) or whether a value is read twice: a reader beside a compaction, or
one after a compaction that stopped half way, sees the same maxima.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.config import CONTRACT

KEYS = ("company_code", CONTRACT)


def append_watermarks(df: DataFrame, path: str, batch_id: int | str, keys: Sequence[str] = KEYS) -> None:
    """Add a batch's ``dpd_max`` by key; the same batch again replaces what it wrote."""
    least = df.where(F.col("dpd_max").isNotNull()).groupBy(*keys).agg(F.max("dpd_max").cast("int").alias("dpd_max"))
    least.write.mode("overwrite").parquet(f"{path.rstrip('/')}/delta/batch={batch_id}")


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The committed bases and deltas of the table, a folder each."""
    jvm = spark.sparkContext._jvm
    out = []
    for kind in ("base", "delta"):
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{kind}")
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            for s in fs.listStatus(p):
                if s.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
                    out.append(s.getPath().toString())
    return sorted(out)


def read_watermarks(spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> DataFrame | None:
    """(keys, dpd_max): the maxima over all batches; None where there is no batch yet."""
    folders = _folders(spark, path)
    if not folders:
        return None
    return spark.read.parquet(*folders).groupBy(*keys).agg(F.max("dpd_max").alias("dpd_max"))


def compact_watermarks(spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> None:
    """Fold everything into one new base, then delete what was folded.

    Stopped before the deletes are done, some values are there twice, which no reader can tell.  A batch that
    arrives or is replayed meanwhile is kept: of a folder that was replaced while it was folded the new files stay.
    """
    folders = _folders(spark, path)
    if not folders:
        return
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = spark.read.parquet(*folders)
    seen = files.inputFiles()
    files.groupBy(*keys).agg(F.max("dpd_max").alias("dpd_max")).write.parquet(f"{path.rstrip('/')}/base/{uuid.uuid4().hex}")
    for f in seen:
        p = jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(conf).delete(p, False)
