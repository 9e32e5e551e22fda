"""Sanitising raw schedules and payment tapes (any source, any column types)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.config import REFERENCE, SCHEDULE_BUCKETS, Cutoff
from arrears.functions.money import money, money_or_zero, not_a_number
from arrears.schemas import MONEY

#: Text dates read where no format is given: ISO, or month first.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy")


def tolerant_date(df: DataFrame, name: str, date_format: str | None = None) -> Column:
    """Parse a date column of any type; what cannot be read becomes null.

    Text is ISO or month first; a ``date_format`` is the column's only format
    instead (``dd/MM/yyyy`` for a day-first tape), so no column mixes two readings.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    if isinstance(dtype, T.StringType):
        s = F.trim(c)
        if date_format is not None:
            return F.try_to_timestamp(s, F.lit(date_format)).cast("date")
        iso = F.when(s.rlike(r"^\d{4}-"), F.try_to_timestamp(s))
        return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in DATE_FORMATS], iso).cast("date")
    return c.try_cast("date")


def reference_text(df: DataFrame, name: str) -> Column:
    """Instalment references as text; integral floats lose their ``.0``, NaN is null."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c)
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        integral = c == F.floor(c)
        return F.when(integral, c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def date_column(df: DataFrame, candidates: Sequence[str]) -> str:
    """First present column among ``candidates`` (e.g. installment_date, date)."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of the date columns {list(candidates)} is present; columns: {df.columns}")


def require_columns(df: DataFrame, required: Sequence[str], what: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns {missing}; available: {df.columns}")


def _numbered(df: DataFrame) -> DataFrame:
    """Adds ``id``: place of the instalment among those of its contract, by day, then reference and gross.

    The day comes first, so only instalments of one contract and day are ordered
    together, never a whole contract.
    """
    day = F.coalesce(F.datediff(F.col("installment_date"), F.lit("1600-01-01").cast("date")), F.lit(0)).cast("long")
    keys = [c for c in ("company_code", "borrower_contract_id") if c in df.columns]
    order = Window.partitionBy(*keys, "installment_date").orderBy(F.length(REFERENCE), REFERENCE, "gross_amount")
    return df.withColumn("id", day * F.lit(1 << 32) + F.row_number().over(order))


def sanitize_schedule(df: DataFrame, bucket_fallback: bool = True, observation=None, date_format: str | None = None,
                      position: str | None = None) -> DataFrame:
    """Uniform schedule: ``installment_date`` date, text refs, ids, decimal buckets.

    * ``date`` or ``installment_date`` is parsed tolerantly into
      ``installment_date`` (``date_format``: the column's format, if it is neither ISO nor month first);
    * components that are missing, null or not numbers become 0; a gross that
      is not a number becomes null;
    * a missing id column is filled with the instalment's place in its contract
      (a function of the contract's rows alone, so retries give the same ids); single null ids with a hash of the
      row, so rows that differ have ids that differ; with ``position`` (a column that is dropped then, see
      :func:`arrears.operators.position.file_positions`) both are filled with the row's position instead;
    * with ``bucket_fallback``, rows whose components sum to 0 but whose
      gross is positive get ``principal_amount = gross_amount``.

    With an ``Observation``, the rows so filled (``filled_rows``) and the amounts
    that were not numbers (``bad_amounts``) are counted while the data flows.
    """
    require_columns(df, ["borrower_contract_id", "gross_amount"], "schedule")
    dcol = date_column(df, ["installment_date", "date"])
    out = df.withColumn("installment_date", tolerant_date(df, dcol, date_format))
    if dcol != "installment_date":
        out = out.drop(dcol)
    out = out.withColumn("borrower_contract_id", F.col("borrower_contract_id").cast("string"))
    if REFERENCE in df.columns:
        out = out.withColumn(REFERENCE, reference_text(df, REFERENCE))
    else:
        out = out.withColumn(REFERENCE, F.lit(None).cast("string"))
    amounts = [c for c in ("gross_amount", *SCHEDULE_BUCKETS) if c in df.columns]
    if observation is not None:
        bad = sum((not_a_number(c, df.schema[c].dataType).cast("long") for c in amounts), F.lit(0))
        out = out.withColumn("__bad", bad)
    buckets = {
        b: (money_or_zero(b, df.schema[b].dataType) if b in df.columns else F.lit(0).cast(MONEY))
        for b in SCHEDULE_BUCKETS
    }
    out = out.withColumns(buckets).withColumn("gross_amount", money("gross_amount", df.schema["gross_amount"].dataType))
    if position is not None:
        given = F.col("id").try_cast("long") if "id" in df.columns else F.lit(None)
        out = out.withColumn("id", F.coalesce(given, F.col(position).cast("long"))).drop(position)
    elif "id" in df.columns:
        whole = F.xxhash64("borrower_contract_id", "installment_date", REFERENCE, "gross_amount", *SCHEDULE_BUCKETS)
        out = out.withColumn("id", F.coalesce(F.col("id").try_cast("long"), whole))
    else:
        out = _numbered(out)
    if observation is not None:
        filled = F.count_if(needs_fallback() & F.lit(bucket_fallback)).alias("filled_rows")
        out = out.observe(observation, filled, F.coalesce(F.sum("__bad"), F.lit(0)).alias("bad_amounts")).drop("__bad")
    if bucket_fallback:
        out = out.withColumn("principal_amount", fallback_principal())
    return out


def needs_fallback() -> Column:
    total = sum((F.col(b) for b in SCHEDULE_BUCKETS[1:]), F.col(SCHEDULE_BUCKETS[0]))
    return (total == 0) & (F.coalesce(F.col("gross_amount"), F.lit(0)) > 0)


def fallback_principal() -> Column:
    """Principal := gross on rows without any component breakdown."""
    return F.when(needs_fallback(), F.col("gross_amount")).otherwise(F.col("principal_amount")).cast(MONEY)


def sanitize_payments(df: DataFrame, date_format: str | None = None) -> DataFrame:
    """Uniform payment tape: ``payment_date`` date, text refs, decimal amounts.

    A reference column without any value is filled from the first spare column (see :func:`rescue_reference`).
    """
    require_columns(df, ["borrower_contract_id", "payment_date", "total_payment"], "payment tape")
    if REFERENCE in df.columns:
        df = rescue_reference(df)
    out = df.withColumn("payment_date", tolerant_date(df, "payment_date", date_format))
    out = out.withColumn("borrower_contract_id", F.col("borrower_contract_id").cast("string"))
    if REFERENCE in df.columns:
        out = out.withColumn(REFERENCE, reference_text(df, REFERENCE))
    else:
        out = out.withColumn(REFERENCE, F.lit(None).cast("string"))
    return out.withColumn("total_payment", money("total_payment", df.schema["total_payment"].dataType))


#: Names of columns without a header in spreadsheets and CSV files.
_SPARE = re.compile(r"Unnamed:.*|_c\d+")


def rescue_reference(df: DataFrame) -> DataFrame:
    """When the reference column is entirely null, use the first spare column with a value.

    Spare columns are those named like header-less spreadsheet/CSV columns;
    without any nothing is read.  Otherwise one aggregate over these columns decides.
    """
    spare = [c for c in df.columns if _SPARE.fullmatch(c)]
    if not spare:
        return df
    probe = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(spare)]
    if REFERENCE in df.columns:
        probe.append(F.count(F.col(REFERENCE)).alias("ref"))
    counts = df.agg(*probe).first()
    if REFERENCE in df.columns and counts["ref"] > 0:
        return df
    for i, c in enumerate(spare):
        if counts[f"c{i}"] > 0:
            return df.withColumn(REFERENCE, F.col(f"`{c}`"))
    return df


def usable_instalment() -> Column:
    """A due date and a positive gross, written as plain comparisons (a Parquet
    scan can take it, and its negation, as pushed filters)."""
    g = F.col("gross_amount")
    return F.col("installment_date").isNotNull() & g.isNotNull() & (g > 0)


def valid_instalments(df: DataFrame) -> DataFrame:
    """Rows the allocation modes use: a due date and a positive gross."""
    return df.where(usable_instalment())


def valid_payments(df: DataFrame, cfg: Cutoff) -> DataFrame:
    """Payments the modes use: dated and positive (non-zero with reversals)."""
    amount = F.col("total_payment")
    cond = F.col("payment_date").isNotNull() & amount.isNotNull() & (
        (amount != 0) if cfg.allow_reversals else (amount > 0)
    )
    if cfg.payments_as_of is not None:
        cond = cond & (F.col("payment_date") <= F.lit(cfg.payments_as_of))
    return df.where(cond)


def component_mismatch() -> Column:
    """Components that do not add up to gross (the cascade caps what it applies
    at their sum but compares with gross, so such rows can never be paid)."""
    total = sum((F.col(b) for b in SCHEDULE_BUCKETS[1:]), F.col(SCHEDULE_BUCKETS[0]))
    return F.coalesce(total != F.col("gross_amount"), F.lit(False))
