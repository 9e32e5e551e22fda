"""Date expressions: days late and instalment due dates."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrears.config import PERIOD_STEP_DAYS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_late(due, as_of: _dt.date, grace: int) -> Column:
    """``max(as_of - due - grace, 0)`` in calendar days (null due stays null)."""
    days = F.datediff(F.lit(as_of), _col(due)) - F.lit(int(grace))
    return F.greatest(days, F.lit(0)).cast("int")


def due_date(first, periodicity, step) -> Column:
    """Due date of instalment ``step`` (0-based) from the first due date.

    Monthly schedules add calendar months to the *first* date and clamp to
    the month end (31 Jan + 1 → 28/29 Feb, 31 Jan + 2 → 31 Mar); the other
    periodicities add a fixed number of days per step.
    """
    first, periodicity, step = _col(first), _col(periodicity), _col(step)
    expr = F.add_months(first, step)
    for name, days in PERIOD_STEP_DAYS.items():
        expr = F.when(periodicity == F.lit(name), F.date_add(first, step * F.lit(days))).otherwise(expr)
    return expr
