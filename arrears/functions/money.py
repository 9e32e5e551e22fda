"""Money columns: exact decimals, null, NaN and bad text as zero, HALF_UP cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.schemas import MONEY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c, dtype: T.DataType | None = None) -> Column:
    """``decimal(18,4)``; nulls, NaN and what is not a number are null."""
    c = _col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c)
    elif isinstance(dtype, T.StringType):
        c = F.trim(c)
    return c.try_cast(MONEY)


def money_or_zero(c, dtype: T.DataType | None = None) -> Column:
    """As :func:`money`, with 0 for null."""
    return F.coalesce(money(c, dtype), F.lit(0).cast(MONEY))


def not_a_number(c, dtype: T.DataType | None = None) -> Column:
    """Whether a value is there that :func:`money` cannot read."""
    c = _col(c)
    return c.isNotNull() & money(c, dtype).isNull()


def round_half_up_cents(c) -> Column:
    """HALF_UP to cents, on the shortest decimal text of a double.

    Spark's ``round`` on doubles rounds the decimal representation HALF_UP
    (``round(1.005D, 2) = 1.01``), the same as quantising ``Decimal(str(x))``.
    """
    return F.round(_col(c), 2)
