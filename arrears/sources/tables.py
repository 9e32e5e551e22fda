"""Scans of the schedule and payment tape (any DataFrame source: parquet, CSV, JDBC)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.config import SCHEDULE_BUCKETS
from arrears.operators.salted import meet
from arrears.schemas import MONEY

SCHEDULE_COLUMNS = ["id", "company_code", "borrower_contract_id", "borrower_installment_reference",
                    "installment_date", "gross_amount", *SCHEDULE_BUCKETS]


def read_schedule(schedule: DataFrame, company_code: str | None = None) -> DataFrame:
    """One company's instalments: the schedule columns, null components as 0.

    ``date`` is accepted for ``installment_date``.  The company filter and
    the projection reach the scan (parquet pushdown / JDBC WHERE).
    """
    df = schedule
    if "installment_date" not in df.columns and "date" in df.columns:
        df = df.withColumnRenamed("date", "installment_date")
    if company_code is not None:
        df = df.where(F.col("company_code") == F.lit(str(company_code)))
    return df.select(
        *[c for c in SCHEDULE_COLUMNS[:6]],
        *[F.coalesce(F.col(b), F.lit(0)).cast(MONEY).alias(b) for b in SCHEDULE_BUCKETS],
    )


def read_payments(payments: DataFrame, company_id: int | None = None) -> DataFrame:
    """Dated positive payments with the last payment date of their company.

    The maximum of one company is one row, joined back by broadcast.  For all
    companies it is a row for each, reduced map-side; a company may hold most
    payments, so they meet it dealt to parts, not on the company alone.
    Payments without a company have no last date.
    """
    df = payments.where(F.col("payment_date").isNotNull() & (F.col("total_payment") > 0))
    cols = ["company_id", "borrower_contract_id", "borrower_installment_reference", "payment_date", "total_payment"]
    if company_id is not None:
        df = df.where(F.col("company_id") == F.lit(int(company_id)))
    df = df.select(*cols)
    last = df.groupBy("company_id").agg(F.max("payment_date").alias("last_payment_date"))
    if company_id is None:
        return meet(df, last, "company_id", by=cols, how="left")
    return df.join(F.broadcast(last), "company_id", "left")  # one row: a single company was selected


def with_company_code(payments: DataFrame, company_map: DataFrame) -> DataFrame:
    """Give payments the schedule's company column (``company_code``) through the map.

    Needed for portfolio-wide runs, where contract ids repeat across
    companies and the contract key becomes (company_code, contract).  The
    planner knows the size of the map's files and broadcasts it where it is
    small enough.
    """
    return payments.join(company_map.select("company_id", "company_code"), "company_id", "left")
