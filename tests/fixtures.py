"""Small hand-made inputs: the golden five-contract seed and helpers."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from arrears.schemas import PAYMENTS, SCHEDULE

D = Decimal
CUT = dt.date(2026, 5, 4)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def instalment(i, contract, ref, due, gross="1000", buckets=("0", "800", "150", "30", "20"), company="42"):
    g, p, it, t, f = (D(x) if x is not None else None for x in buckets)
    return (i, company, contract, ref, d(due) if due else None, D(gross) if gross is not None else None, g, p, it, t, f)


def payment(i, contract, ref, when, amount, company=42):
    return (i, company, contract, ref, d(when) if when else None, D(amount) if amount is not None else None)


SEED_SCHEDULE = [
    instalment(1, "C001", "C001-1", "2026-02-01"),
    instalment(2, "C001", "C001-2", "2026-03-01"),
    instalment(3, "C001", "C001-3", "2026-04-01"),
    instalment(4, "C002", "C002-1", "2026-02-01"),
    instalment(5, "C002", "C002-2", "2026-03-01"),
    instalment(6, "C002", "C002-3", "2026-04-01"),
    instalment(7, "C003", "C003-1", "2026-02-01"),
    instalment(8, "C004", "C004-1", "2026-04-01"),
    instalment(9, "C005", "C005-1", "2026-03-01"),
    instalment(10, "C005", "C005-2", "2026-04-01"),
]
SEED_PAYMENTS = [
    payment(1, "C001", "C001-1", "2026-02-01", "1000"),
    payment(2, "C001", "C001-2", "2026-03-01", "1000"),
    payment(3, "C001", "C001-3", "2026-04-01", "1000"),
    payment(4, "C002", "C002-1", "2026-02-01", "1000"),
    payment(5, "C002", "C002-3", "2026-04-01", "1000"),
    payment(6, "C003", "C003-1", "2026-02-01", "500"),
    payment(7, "C005", "C005-1", "2026-03-01", "1500"),
]


def frames(spark, schedule_rows, payment_rows):
    return spark.createDataFrame(schedule_rows, SCHEDULE), spark.createDataFrame(payment_rows, PAYMENTS)
