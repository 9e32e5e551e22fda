"""One run of detail and summary: read, sanitise, allocate, classify, export."""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.config import CONTRACT, Cutoff
from arrears.operators.classify import attach_cases, case_labels, classify_contracts
from arrears.operators.clean import sanitize_payments, sanitize_schedule
from arrears.operators.reports import detail, summary
from arrears.schemas import PAYMENTS
from arrears.sources.loan_tape import export_two_part, read_loan_tape

log = logging.getLogger(__name__)

MODES = {"cascade": ("cascade",), "join": ("join",), "both": ("cascade", "join")}


class EmptySchedule(ValueError):
    """The schedule of a run has no rows."""


def read_source(spark: SparkSession, source: str | Mapping[str, str]) -> DataFrame:
    """A table from a path (parquet or CSV, by extension) or from reader options such as those of JDBC.

    Options: ``{"format": "jdbc", "url": …, "dbtable": …}``; ``path`` may be among them.
    """
    if isinstance(source, str):
        return read_loan_tape(spark, source)
    options = dict(source)
    return spark.read.format(options.pop("format")).options(**options).load()


def run_tables(schedule: DataFrame, payments: DataFrame, as_of: _dt.date | None = None, mode: str = "both", cases: bool = False,
               **cutoff) -> tuple[DataFrame, DataFrame]:
    """(detail, summary) of raw tables.

    The cut-off is yesterday unless given; ``cutoff`` takes the other fields of :class:`Cutoff`.
    An empty schedule is an error; without payments everything due is unpaid.
    """
    s, p, cfg = _prepared(schedule, payments, as_of, mode, **cutoff)
    labels = classify_contracts(s, p, cfg.as_of, cfg.contract_keys) if cases else None
    sums = summary(detail(s, p, cfg, MODES[mode], with_contract_max=False), MODES[mode], keys=cfg.contract_keys)
    return _detail(s, p, cfg, mode, labels), attach_cases(sums, labels, keys=cfg.contract_keys) if cases else sums


def _prepared(schedule: DataFrame, payments: DataFrame, as_of: _dt.date | None, mode: str, **cutoff) -> tuple[DataFrame, DataFrame, Cutoff]:
    """Sanitised tables and the cut-off of a run."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {sorted(MODES)}")
    cfg = Cutoff(as_of=as_of or _dt.date.today() - _dt.timedelta(days=1), **cutoff)
    if schedule.isEmpty():
        raise EmptySchedule("the schedule has no rows; check its source and the company")
    if payments.isEmpty():
        log.warning("no payments: everything due is unpaid")
        payments = schedule.sparkSession.createDataFrame([], PAYMENTS)
        for k in cfg.contract_keys:
            if k not in payments.columns:
                payments = payments.withColumn(k, F.lit(None).cast("string"))
    return sanitize_schedule(schedule), sanitize_payments(payments), cfg


def _detail(s: DataFrame, p: DataFrame, cfg: Cutoff, mode: str, labels: DataFrame | None) -> DataFrame:
    return detail(s, p, cfg, MODES[mode], per_contract=None if labels is None else case_labels(labels, keys=cfg.contract_keys))


def run_detail_summary(spark: SparkSession, schedule: str | Mapping[str, str], payments: str | Mapping[str, str], output: str,
                       company_code: str | None = None, company_id: int | None = None, as_of: _dt.date | None = None,
                       mode: str = "both", cases: bool = False, fmt: str = "parquet", **cutoff) -> None:
    """Read both tables (of one company, where given), run, and write ``detail`` and ``summary`` below ``output``.

    The summary is written in order of its first mode's worst lateness.  With Parquet it is reduced from the detail as
    written, so the allocation runs once.
    """
    s, p = read_source(spark, schedule), read_source(spark, payments)
    if company_code is not None:
        s = s.where(F.col("company_code") == F.lit(company_code))
    if company_id is not None:
        p = p.where(F.col("company_id") == F.lit(company_id))
    keys = list(cutoff.get("contract_keys", (CONTRACT,)))
    worst: Sequence = [F.col(f"{MODES.get(mode, ('',))[0]}_dpd_max").desc_nulls_last(), *[F.col(k) for k in keys]]
    if fmt != "parquet":  # text has no types to read back
        d, sums = run_tables(s, p, as_of, mode, cases, **cutoff)
        export_two_part(d, sums.orderBy(*worst), output, fmt)
        return
    s, p, cfg = _prepared(s, p, as_of, mode, **cutoff)
    labels = classify_contracts(s, p, cfg.as_of, cfg.contract_keys) if cases else None

    def reduced(written: DataFrame) -> DataFrame:
        sums = summary(written, MODES[mode], keys=keys)
        if cases:
            sums = sums.join(written.groupBy(*keys).agg(F.max("case").alias("case")), keys, "left")
        return sums.orderBy(*worst)

    export_two_part(_detail(s, p, cfg, mode, labels), reduced, output, fmt)
