"""Column expressions (all JVM-side built-ins)."""

from arrears.functions.dates import days_late, due_date
from arrears.functions.money import money, money_or_zero, not_a_number, round_half_up_cents
from arrears.functions.periodicity import normalize_periodicity, period_rate

__all__ = [
    "days_late",
    "due_date",
    "money",
    "money_or_zero",
    "not_a_number",
    "round_half_up_cents",
    "normalize_periodicity",
    "period_rate",
]
