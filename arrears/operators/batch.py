"""Many enrichments in one plan: all units of a request batch, whatever their number.

A *unit* is one output: a company, a loan tape, products and parameters.  The
allocation does not depend on a unit's parameters, so it runs once over the
companies asked for; what depends on them (the paid share, the discount rate) is
worked out once for each distinct value of a company and kept per contract in a
small map.  The tapes of all units are one table that meets these facts in one
join and picks its unit's entries; product columns are null where the unit did
not ask for them.  Jobs, stages and shuffles therefore do not grow with the units.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.config import CONTRACT, DAYS_PER_YEAR, Cutoff
from arrears.functions.dates import days_late
from arrears.functions.money import money
from arrears.operators.allocate import allocate
from arrears.operators.salted import meet
from arrears.schemas import MONEY

COMPANY = "company_code"
#: A paid share as an exact number.
SHARE = "decimal(9,6)"

_FACTS = {"share": SHARE, "rate": "double", "late": "int", "arrears": "decimal(18,4)", "pv": "decimal(38,12)", "paid": "decimal(18,4)"}


def _wants(product: str) -> Column:
    return F.array_contains("products", product)


def _rows(df: DataFrame, **cols: Column) -> DataFrame:
    return df.select(COMPANY, F.col(CONTRACT).cast("string").alias(CONTRACT), *[cols.get(n, F.lit(None)).cast(t).alias(n) for n, t in _FACTS.items()])


def contract_facts(units: DataFrame, schedule: DataFrame, payments: DataFrame, as_of: _dt.date, grace: int = 1, mode: str = "cascade") -> DataFrame:
    """A row per (company, contract): ``by_share`` (late, arrears), ``by_rate`` (present value) and ``paid``."""
    companies = units.select(COMPANY).distinct()
    schedule = meet(schedule.where(F.col(COMPANY).isNotNull()), companies, COMPANY, [CONTRACT, "installment_date"])
    payments = meet(payments.where(F.col(COMPANY).isNotNull()), companies, COMPANY, [CONTRACT, "payment_date"])
    share = lambda c: F.col(c).cast(SHARE).alias("share")
    dpd = units.where(_wants("dpd"))
    shares = dpd.select(COMPANY, share("paid_threshold")).union(dpd.select(COMPANY, share("highest_share"))).where("share is not null").distinct()
    rates = units.where(_wants("vpn")).select(COMPANY, F.coalesce("interest_rate", F.lit(0.0)).alias("rate")).distinct()
    cfg = Cutoff(as_of=as_of, grace=grace, contract_keys=(COMPANY, CONTRACT))
    applied = "applied_amount" if mode == "cascade" else "paid_amount"
    done = allocate(schedule, payments, cfg, mode).select(COMPANY, CONTRACT, "id", "installment_date", "gross_amount", F.col(applied).alias("applied"))
    done = meet(done, shares, COMPANY, [CONTRACT, "id"])
    late = F.when(F.col("applied") >= F.col("gross_amount") * F.col("share"), F.lit(0)).otherwise(days_late("installment_date", as_of, grace))
    owing = F.when(late > 0, F.greatest(F.col("gross_amount") - F.col("applied"), F.lit(0)))
    future = meet(schedule.where(F.col("installment_date") > F.lit(as_of)).select(COMPANY, CONTRACT, "id", "installment_date", "gross_amount"), rates, COMPANY, [CONTRACT, "id"])
    gross = F.coalesce(F.col("gross_amount"), F.lit(0)).cast("double")
    years = F.datediff("installment_date", F.lit(as_of)).cast("double") / F.lit(DAYS_PER_YEAR)
    value = F.when(F.col("rate") == 0, gross).otherwise(gross * (F.lit(1.0) / F.pow(F.lit(1.0) + F.col("rate"), years)))
    amount = money("total_payment", payments.schema["total_payment"].dataType)
    parts = [
        _rows(done, share=F.col("share"), late=late, arrears=owing),
        _rows(future, rate=F.col("rate"), pv=value.cast("decimal(38,12)")),  # fixed before summing: the order of rows does not matter
        _rows(payments, paid=F.when(amount > 0, amount)),
    ]
    each = reduce(DataFrame.unionByName, parts).where(F.col(CONTRACT).isNotNull()).groupBy(COMPANY, CONTRACT, "share", "rate").agg(
        F.max("late").alias("late"), F.sum("arrears").alias("arrears"), F.sum("pv").alias("pv"), F.sum("paid").alias("paid"))
    entries = lambda key, value: F.map_from_entries(F.collect_list(F.when(F.col(key).isNotNull(), F.struct(F.col(key), value.alias("v")))))
    return each.groupBy(COMPANY, CONTRACT).agg(
        entries("share", F.struct("late", "arrears")).alias("by_share"), entries("rate", F.col("pv")).alias("by_rate"), F.sum("paid").alias("paid"))


def enrich_units(units: DataFrame, tapes: DataFrame, schedule: DataFrame, payments: DataFrame, as_of: _dt.date, grace: int = 1,
                 mode: str = "cascade", previous: DataFrame | None = None, key: str = CONTRACT) -> DataFrame:
    """The tapes of all units with their product columns, as ``enrich`` gives them one by one.

    ``units``: a row per unit with unit, company_code, products, paid_threshold, interest_rate and highest_share (the paid
    share that also counts for ``dpd_max``; may be null).  ``tapes``: their rows, with unit and the contract under ``key``.
    ``schedule`` and ``payments`` carry company_code.  ``previous``: (unit, ``key``, dpd_max) of earlier runs.
    Columns of products that a unit did not ask for are null; tape rows of no unit are left out.
    """
    asked = units.select("unit", F.col(COMPANY).alias("__company"), F.col("products").alias("__products"), F.col("paid_threshold").cast(SHARE).alias("__share"),
                         F.col("highest_share").cast(SHARE).alias("__highest"), F.coalesce("interest_rate", F.lit(0.0)).alias("__rate"))
    facts = contract_facts(units, schedule, payments, as_of, grace, mode).select(
        F.col(COMPANY).alias("__company"), F.col(CONTRACT).alias("__contract"), F.col("by_share").alias("__shares"), F.col("by_rate").alias("__rates"), F.col("paid").alias("__paid"))
    rows = meet(tapes.where(F.col("unit").isNotNull()), asked, "unit", [key]).withColumn("__contract", F.col(key).cast("string"))
    rows = rows.join(facts, ["__company", "__contract"], "left")
    before = F.lit(0)
    if previous is not None:
        number = F.coalesce(F.col("dpd_max").cast("string").try_cast("double").try_cast("int"), F.lit(0))
        old = previous.groupBy(F.col("unit"), F.col(key).cast("string").alias("__contract")).agg(F.max(number).alias("__before"))
        rows = rows.join(old, ["unit", "__contract"], "left")
        before = F.coalesce(F.col("__before"), F.lit(0))
    at = lambda m, k: F.try_element_at(F.col(m), F.col(k))
    wants = lambda p: F.array_contains("__products", p)
    now = F.coalesce(at("__shares", "__share")["late"], F.lit(0))
    other = F.coalesce(F.when(F.col("__highest").isNotNull(), at("__shares", "__highest")["late"]), F.lit(0))
    cols = {
        "dpd_current": F.when(wants("dpd"), now).cast("int"),
        "dpd_max": F.when(wants("dpd"), F.greatest(now, other, before)).cast("int"),
        "amount_in_arrears": F.when(wants("dpd"), F.coalesce(at("__shares", "__share")["arrears"], F.lit(0))).cast(MONEY),
        "total_amount_paid": F.when(wants("total_amount"), F.coalesce("__paid", F.lit(0))).cast(MONEY),
        "vpn": F.when(wants("vpn"), F.round(F.coalesce(at("__rates", "__rate"), F.lit(0)).cast("double"), 2)),
    }
    return rows.select(*[c for c in tapes.columns if c not in cols], *[c.alias(n) for n, c in cols.items()])


def write_units(enriched: DataFrame, path: str, batch_id: int | str) -> str:
    """All outputs of a batch in one write, a folder for each unit; a replay replaces the batch's own folder.

    Rows are gathered by unit, so that small outputs are one file; a large unit is split over tasks.
    """
    target = f"{path.rstrip('/')}/batch={batch_id}"
    enriched.hint("rebalance", F.col("unit")).write.mode("overwrite").partitionBy("unit").parquet(target)
    return target
