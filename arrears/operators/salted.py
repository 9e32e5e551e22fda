"""Joins of a large table with a small one on a key that may hold most of the large one's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that each key of the large table is dealt to.
SALT = 32


def meet(df: DataFrame, small: DataFrame, on: str | Sequence[str], by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join with a small table: the rows of ``df`` are dealt to ``SALT`` parts by the columns ``by``, and each part gets all of the other."""
    on = [on] if isinstance(on, str) else list(on)
    salt = F.pmod(F.xxhash64(*by), F.lit(SALT)).cast("int")
    spread = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return df.withColumn("__salt", salt).join(spread, [*on, "__salt"], how).drop("__salt")
