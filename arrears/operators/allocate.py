"""Allocation of payments to instalments: by reference (join) or FIFO (cascade).

Both modes return the valid instalments (due date present, gross > 0) with
``dpd_current`` and ``amount_in_arrears`` added, following the raw mode
rules: an unpaid instalment carries its outstanding amount even before it is
late; reports apply their own rule on top (see ``detail`` and ``products``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.config import REFERENCE, SCHEDULE_BUCKETS, Cutoff
from arrears.functions.dates import days_late
from arrears.operators.clean import valid_instalments, valid_payments
from arrears.operators.ordered import before_in_key, from_units, known, running_before, units
from arrears.schemas import MONEY


def owed_units() -> Column:
    """What an instalment can absorb, the sum of its positive components, in money units (exact, 64-bit)."""
    parts = [F.greatest(units(F.col(b)), F.lit(0)) for b in SCHEDULE_BUCKETS]
    return sum(parts[1:], parts[0])


def _paid(applied: Column, cfg: Cutoff, any_counts: bool) -> Column:
    if any_counts:
        return applied > 0
    return applied >= F.col("gross_amount") * F.lit(cfg.exact_share)


def outcome(df: DataFrame, amount: str, cfg: Cutoff, others: Mapping[str, Cutoff], any_counts: bool = False) -> DataFrame:
    """Lateness and arrears from the amount applied; ``others`` adds the lateness under other cut-offs."""
    applied = F.col(amount)
    paid = _paid(applied, cfg, any_counts and cfg.any_payment_counts)

    def late(c: Cutoff) -> Column:
        done = _paid(applied, c, any_counts and c.any_payment_counts)
        return F.when(done, F.lit(0)).otherwise(days_late("installment_date", c.as_of, c.grace)).cast("int")

    left = F.greatest(F.col("gross_amount") - applied, F.lit(0))
    return df.withColumns(
        {
            "dpd_current": late(cfg),
            "amount_in_arrears": F.when(paid, F.lit(0)).otherwise(left).cast(MONEY),
            **{name: late(c) for name, c in others.items()},
        }
    )


def payment_pools(payments: DataFrame, cfg: Cutoff) -> DataFrame:
    """Σ usable payments per contract, in money units (map-side combined aggregate)."""
    keys = list(cfg.contract_keys)
    return valid_payments(payments, cfg).groupBy(*keys).agg(F.sum(units(F.col("total_payment"))).alias("__pool"))


def cascade(schedule: DataFrame, payments: DataFrame, cfg: Cutoff, others: Mapping[str, Cutoff] | None = None) -> DataFrame:
    """FIFO: each contract's whole payment pool drains instalments in (date, id) order.

    Closed form of the sequential drain: with ``owed`` the positive
    components and ``before`` the owed total of earlier instalments,
    ``applied = clamp(pool - before, 0, owed)``.  Draining the components in
    their fixed order inside one instalment only splits ``applied`` among
    them, so the instalment total is all the outcome needs.

    What is applied does not depend on the cut-off: ``others`` (column name →
    cut-off) adds the lateness under other days or paid shares from the same allocation.
    """
    inst = valid_instalments(schedule).withColumn("__owed", owed_units())
    rows = running_before(
        inst, cfg.contract_keys, "installment_date", "id", {"__before": F.col("__owed")}, per_key=payment_pools(payments, cfg)
    )
    return _drained(rows, cfg, others)


def cascade_in_contract(inst: DataFrame, payments: DataFrame, cfg: Cutoff, usable: Column) -> DataFrame:
    """:func:`cascade` of instalments that are dealt by contract already: they are not shuffled again.

    Rows that are not usable owe nothing here; what they get as outcome means nothing.
    """
    keys = list(cfg.contract_keys)
    rows = inst.withColumn("__owed", F.when(usable, owed_units()).otherwise(F.lit(0))).join(payment_pools(payments, cfg), keys, "left")
    return _drained(before_in_key(rows, keys, "installment_date", "id", {"__before": F.col("__owed")}), cfg)


def _drained(rows: DataFrame, cfg: Cutoff, others: Mapping[str, Cutoff] | None = None) -> DataFrame:
    """The outcome of instalments with what is owed (``__owed``), owed before them and the pool."""
    pool = F.coalesce(F.col("__pool"), F.lit(0))
    applied = F.greatest(F.lit(0), F.least(F.col("__owed"), pool - F.col("__before")))
    rows = rows.withColumn("applied_amount", from_units(applied))
    return outcome(rows, "applied_amount", cfg, others or {}, any_counts=True).drop("__owed", "__before", "__pool")


def applied_column(component: str) -> str:
    """``principal_amount`` → ``applied_principal``."""
    return f"applied_{component.removesuffix('_amount')}"


def cascade_components(schedule: DataFrame, payments: DataFrame, cfg: Cutoff) -> DataFrame:
    """:func:`cascade` with what each component got (``applied_guarantee`` … ``applied_fee``).

    An instalment's components stand one after the other on the contract's line
    of money, in drain order from where the instalment begins; a component gets
    the part of its stretch that the pool covers.  The parts add up to
    ``applied_amount``; components of 0 or less get nothing.
    """
    rows = cascade(schedule, payments, cfg)
    covered = units(F.col("applied_amount"))
    start, parts = F.lit(0), {}
    for b in SCHEDULE_BUCKETS:
        owed = F.greatest(units(F.col(b)), F.lit(0))
        parts[applied_column(b)] = from_units(F.greatest(F.lit(0), F.least(owed, covered - start)))
        start = start + owed
    return rows.withColumns(parts)


def paid_by_reference(payments: DataFrame, cfg: Cutoff) -> DataFrame:
    """Σ usable payments per (contract, reference); null and blank references are ignored."""
    keys = list(cfg.contract_keys)
    ref = F.col(REFERENCE)
    usable = valid_payments(payments, cfg).where(ref.isNotNull() & (F.trim(ref) != ""))
    return usable.groupBy(*keys, REFERENCE).agg(F.sum("total_payment").cast(MONEY).alias("paid_amount"))


def paid_in_contract(inst: DataFrame, payments: DataFrame, cfg: Cutoff) -> DataFrame:
    """Instalments with ``paid_amount``, what was paid on their reference (0 without payments), dealt by contract.

    Instalments and payments of a contract meet in one task, in one shuffle of both, and stay there.
    """
    keys = list(cfg.contract_keys)
    ref = F.col(REFERENCE)
    usable = valid_payments(payments, cfg).where(ref.isNotNull() & (F.trim(ref) != "") & known(keys))
    usable = usable.select(*keys, REFERENCE, F.col("total_payment").alias("__v_paid"), F.lit(0).alias("__instalment"))
    both = inst.withColumn("__instalment", F.lit(1)).unionByName(usable, allowMissingColumns=True).repartition(*keys)
    payments_first = Window.partitionBy(*keys, REFERENCE).orderBy("__instalment")
    paid = F.coalesce(F.sum("__v_paid").over(payments_first).cast(MONEY), F.lit(0)).cast(MONEY)
    return both.withColumn("paid_amount", paid).where(F.col("__instalment") == 1).drop("__instalment", "__v_paid")


def join_mode(schedule: DataFrame, payments: DataFrame, cfg: Cutoff, others: Mapping[str, Cutoff] | None = None) -> DataFrame:
    """Each instalment is paid by the payments carrying its reference.

    Surplus never flows to another instalment; instalments sharing one
    reference each see the full sum.
    """
    keys = list(cfg.contract_keys)
    inst = valid_instalments(schedule)
    rows = inst.join(paid_by_reference(payments, cfg), [*keys, REFERENCE], "left")
    rows = rows.withColumn("paid_amount", F.coalesce(F.col("paid_amount"), F.lit(0)).cast(MONEY))
    return outcome(rows, "paid_amount", cfg, others or {})


def allocate(schedule: DataFrame, payments: DataFrame, cfg: Cutoff, mode: str = "cascade",
             others: Mapping[str, Cutoff] | None = None) -> DataFrame:
    if mode == "cascade":
        return cascade(schedule, payments, cfg, others)
    if mode == "join":
        return join_mode(schedule, payments, cfg, others)
    raise ValueError(f"unknown mode {mode!r}; expected 'cascade' or 'join'")
