"""Places 1..N of rows, in the order of their files or of given columns, without a sort or a window in one task.

Rows are counted per file (or per task of the sort); these counts, a row for
each file or task, are summed up in order, and a row's place is what comes
before its file or task plus its place there.  Only the counts are ordered
in one task: they are no more than what the driver lists to plan the scan.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.operators.salted import meet
from arrears.session import scratch_path


def _written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: read again, they stay in the parts that they were numbered in."""
    path = scratch_path(df.sparkSession, "positions", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _placed(rows: DataFrame, part: list[str], name: str) -> DataFrame:
    """``name`` = rows in earlier parts + place in the part (``__at``, consecutive from any number)."""
    sizes = rows.groupBy(*part).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*part, (F.coalesce(before, F.lit(0)) - F.col("__first") + 1).alias("__start"))
    out = meet(rows, starts, part, by=["__at"])
    return out.withColumn(name, F.col("__start") + F.col("__at")).drop(*part, "__at", "__start")


def file_positions(df: DataFrame, name: str = "position") -> DataFrame:
    """Rows as read from files with their place 1..N: files by path, rows as they stand in them.

    ``df`` is a scan without filters.  Parquet tells each row's place in its file, so nothing is
    written and reruns agree; rows of other formats are written once with
    the place that their task gives them within their stretch of the file.  A
    table that does not come from files has no such order (AnalysisException).
    """
    file = F.col("_metadata.file_path").alias("__file")
    try:
        rows = df.select("*", file, F.col("_metadata.row_index").alias("__at"))
    except AnalysisException:
        block = F.col("_metadata.file_block_start").alias("__block")
        rows = _written(df.select("*", file, block, F.monotonically_increasing_id().alias("__at")))
        return _placed(rows, ["__file", "__block"], name)
    return _placed(rows, ["__file"], name)


def in_order(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Rows with their place 1..N in the given order; rows that tie in it share no place, in any order.

    The sort is by ranges over all tasks and written once: its files, by name, hold the rows in order.
    """
    at = F.monotonically_increasing_id()
    rows = _written(df.orderBy(*order).withColumn("__at", at).withColumn("__part", F.shiftright("__at", 33)))
    return _placed(rows, ["__part"], name)
