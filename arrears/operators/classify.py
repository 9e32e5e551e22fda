"""Multi-label classification of contracts by payment behaviour (cases 1–18).

Rules are evaluated on the contract's overdue instalments (due on or before
the cut-off, in (date, id) order) with the payments matched by instalment
reference.  Each rule is restated as a per-contract aggregate so that no
step needs all rows of one contract in one task:

* counts of exact / partial / unpaid / overpaid / covered instalments and
  the flags (cents difference, ratios) are ``count_if`` / ``bool_or``;
* "first" and "last" instalment tests are ``min_by`` / ``max_by`` over the
  (date, id) order;
* late / early payment tests compare per-reference date ranges of the
  payments and of the schedule (no payment × instalment fan-out);
* the one rule about the *next* instalment takes it from the two-level order
  (:mod:`arrears.operators.ordered`) that also gives the positions.

Contracts without overdue instalments are unclassified; contracts without
any payment get cases 3 and 17 and nothing else.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.config import CONTRACT, REFERENCE, UNCLASSIFIED
from arrears.operators.ordered import apart, before_in_key, known, large_keys, running_before

# Tolerances and ratio bounds of the case rules.
TOL = 0.001  # equality tolerance between paid and gross
TWICE_TOL = 0.01  # tolerance of the two-payments-in-one-month rule
CENTS_LIMIT = 1.0  # a shortfall below this is a cents difference
MODEST_OVERPAY = (1.001, 1.4)  # case 7 ratio range
ONE_AND_A_HALF = (1.4, 1.6)  # case 9 ratio range
DUPLICATE_RATIO = 1.9  # case 15 lower bound
CASE_ORDER = (1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 15, 16, 18)
NO_PAYMENT_CASES = (3, 17)


def _d(x: float) -> Column:
    return F.lit(str(x)).cast("decimal(10,4)")


def _flags(o: DataFrame) -> DataFrame:
    tp, g = F.col("tp"), F.col("gross_amount")
    f = lambda c: F.coalesce(c, F.lit(False))  # noqa: E731  (null comparisons are False)
    ratio = F.when(g == 0, F.when(tp > 0, F.lit(float("inf"))).when(tp < 0, F.lit(float("-inf")))).otherwise(
        tp.cast("double") / F.when(g != 0, g).cast("double")
    )
    return o.withColumns(
        {
            "ex": f(F.abs(tp - g) < _d(TOL)),
            "pa": f((tp > 0) & (tp + _d(TOL) < g)),
            "un": f(tp == 0),
            "ov": f(tp > g + _d(TOL)),
            "co": f(tp >= g - _d(TOL)),
            "ce": f(((g - tp) > _d(TOL)) & ((g - tp) < _d(CENTS_LIMIT))),
            "ratio": ratio,
            "ratio15": tp.cast("double") / F.when(g == 0, F.lit(1)).otherwise(g).cast("double"),
            "ord": F.struct("installment_date", "id"),
        }
    )


def contract_features(schedule: DataFrame, payments: DataFrame, as_of: _dt.date, keys: Sequence[str] = (CONTRACT,)) -> DataFrame:
    """One row per schedule contract with every count and flag the rules use.

    Payments and schedule are each reduced per (contract, reference); the
    overdue instalments take what was paid on their reference, their position
    and whether the next one is short; all facts are then reduced by one
    ``groupBy`` on the contract.  Instalments and payments of an ordinary contract
    are shuffled by contract only, those of large ones
    (:func:`arrears.operators.ordered.large_keys`) by reference and by day.
    """
    keys = list(keys)
    s, p = schedule.where(known(keys)), payments.where(known(keys))
    large = large_keys(s.select(*keys).unionByName(p.select(*keys)), keys)
    (s, s_large), (p, p_large) = apart(s, keys, large), apart(p, keys, large)
    facts = _facts_together(s, p, as_of, keys)
    if large is not None:
        facts = facts.unionByName(_facts_spread(s_large, p_large, as_of, keys))
    flags = {"cents": "ce", "dup15": "dup15", "r9": "r9", "late": "late", "early": "early", "twice": "twice", "on_cut": "on_cut"}
    out = facts.groupBy(*keys).agg(
        F.bool_or("in_schedule").alias("in_schedule"),
        F.coalesce(F.sum("one"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("n_pay"), F.lit(0)).alias("n_pay"),
        *[F.count_if(F.col(c)).alias(f"n_{c}") for c in ("ex", "pa", "un", "ov", "co")],
        *[F.coalesce(F.bool_or(c), F.lit(False)).alias(name) for name, c in flags.items()],
        F.max("np").alias("max_np"),
        F.max("ratio").alias("ratio_max"),
        *[F.coalesce(f(c, "ord"), F.lit(False)).alias(name) for name, f, c in
          (("last_pa", F.max_by, "pa"), ("last_ex", F.max_by, "ex"), ("first_ex", F.min_by, "ex"), ("first_un", F.min_by, "un"))],
        F.min(F.when(~F.col("ex"), F.col("pos"))).alias("first_not_ex"),
        F.max(F.when(~F.col("un"), F.col("pos"))).alias("last_not_un"),
    )
    return out.where(F.col("in_schedule"))


def _of_payments(as_of: _dt.date) -> dict[str, Column]:
    """What the rules use of the payments on one reference."""
    ym = F.year("payment_date") * 12 + F.month("payment_date")
    return {
        "tp": F.sum("total_payment"),
        "nrows": F.count_if("__payment"),
        "ndated": F.count("payment_date"),
        "ym_min": F.min(ym),
        "ym_max": F.max(ym),
        "pmin": F.min("payment_date"),
        "pmax": F.max("payment_date"),
        "ref_on_cut": F.bool_or(F.col("payment_date") == F.lit(as_of)),
    }


def _of_schedule(as_of: _dt.date) -> dict[str, Column]:
    """What the rules use of the instalments with one reference."""
    due = F.col("installment_date") <= F.lit(as_of)
    first = F.struct("installment_date", "id")
    return {
        "smin": F.min("installment_date"),
        "smax": F.max("installment_date"),
        "first_due": F.min(F.when(due, F.struct(first.alias("ord"), F.col("gross_amount").alias("g")))),
        "in_schedule": F.bool_or("__instalment"),
    }


def _reference_facts(refs: DataFrame, keys: list[str]) -> DataFrame:
    """Late / early: some payment after / before a due date of its reference.
    Twice: two payments in one calendar month summing to the first overdue gross of their reference.
    The null reference never matches an instalment, but counts for the contract's totals."""
    named = F.col(REFERENCE).isNotNull()
    return refs.select(
        *keys,
        "in_schedule",
        F.col("nrows").alias("n_pay"),
        F.col("ref_on_cut").alias("on_cut"),
        (named & (F.col("pmax") > F.col("smin"))).alias("late"),
        (named & (F.col("pmin") < F.col("smax"))).alias("early"),
        (named & (F.col("nrows") == 2) & (F.col("ndated") == 2) & (F.col("ym_min") == F.col("ym_max"))
         & (F.abs(F.col("tp") - F.col("first_due.g")) < _d(TWICE_TOL))).alias("twice"),
    )


def _instalment_facts(o: DataFrame, keys: list[str]) -> DataFrame:
    """Flags of overdue instalments with what was paid on their reference, their position and whether the next one is short."""
    a, b = ONE_AND_A_HALF
    return _flags(o).withColumns({
        "dup15": F.col("ratio15") >= DUPLICATE_RATIO,
        # Case 9: an instalment paid 1.4–1.6× followed by one paid short.
        "r9": (F.col("gross_amount") > 0) & (F.col("ratio") >= a) & (F.col("ratio") <= b) & F.col("next_short"),
        "one": F.lit(1),
    }).select(*keys, "one", "ex", "pa", "un", "ov", "co", "np", "ce", "ratio", "dup15", "r9", "ord", "pos")


def _short() -> Column:
    return F.coalesce(F.col("tp") + _d(TOL) < F.col("gross_amount"), F.lit(False))


def _facts_together(s: DataFrame, p: DataFrame, as_of: _dt.date, keys: list[str]) -> DataFrame:
    """The facts of contracts that fit into one task each: their instalments and payments meet there, by reference and by day."""
    ref = [*keys, REFERENCE]
    rows = s.select(*ref, "installment_date", "id", "gross_amount", F.lit(True).alias("__instalment"), F.lit(False).alias("__payment")).unionByName(
        p.select(*ref, "payment_date", "total_payment", F.lit(True).alias("__payment")), allowMissingColumns=True).repartition(*keys)
    refs = rows.groupBy(*ref).agg(*[c.alias(n) for n, c in (_of_payments(as_of) | _of_schedule(as_of)).items()])
    due = F.col("__payment") | (F.col("installment_date") <= F.lit(as_of))
    payments_first = Window.partitionBy(*ref).orderBy("__instalment")  # null before true
    named = F.when(F.col(REFERENCE).isNotNull(), F.col("total_payment"))
    o = rows.where(due).withColumn("__v_paid", named)
    o = o.withColumns({"tp": F.sum("__v_paid").over(payments_first), "np": F.count("__v_paid").over(payments_first)}).where("__instalment")
    o = o.withColumns({"tp": F.coalesce("tp", F.lit(0)), "np": F.coalesce("np", F.lit(0))})
    o = before_in_key(o, keys, "installment_date", "id", {"pos": F.lit(1)}, {"next_short": _short()})
    return _reference_facts(refs, keys).unionByName(_instalment_facts(o, keys), allowMissingColumns=True)


def _facts_spread(s: DataFrame, p: DataFrame, as_of: _dt.date, keys: list[str]) -> DataFrame:
    """The facts of large contracts: both tables are reduced once per (contract, reference) and joined."""
    ref = [*keys, REFERENCE]
    by_ref = p.withColumn("__payment", F.lit(True)).groupBy(*ref).agg(
        *[c.alias(n) for n, c in _of_payments(as_of).items()], F.count("total_payment").alias("np"))
    by_sched = s.withColumn("__instalment", F.lit(True)).groupBy(*ref).agg(*[c.alias(n) for n, c in _of_schedule(as_of).items()])
    overdue = (
        s.where(F.col("installment_date") <= F.lit(as_of))
        .select(*ref, "installment_date", "id", "gross_amount")
        .join(by_ref.select(*ref, "tp", "np"), ref, "left")
        .withColumns({"tp": F.coalesce("tp", F.lit(0)), "np": F.coalesce("np", F.lit(0))})
    )
    o = running_before(overdue, keys, "installment_date", "id", {"pos": F.lit(1)}, following={"next_short": _short()},
                       sized_by=s.where(F.col("installment_date") <= F.lit(as_of)))
    return _reference_facts(by_sched.join(by_ref, ref, "full"), keys).unionByName(_instalment_facts(o, keys), allowMissingColumns=True)


def case_rules(f: DataFrame) -> dict[int, Column]:
    c = F.col
    n, ne, npa, nu, no, nc = c("n"), c("n_ex"), c("n_pa"), c("n_un"), c("n_ov"), c("n_co")
    late, early, on_cut = c("late"), c("early"), c("on_cut")
    lo, hi = MODEST_OVERPAY
    return {
        1: (ne == n) & ~late & ~early & (no == 0),
        2: (n >= 2) & (npa == 1) & (nu == 0) & (no == 0) & c("last_pa")
        & (ne - c("last_ex").cast("int") == n - 1),
        4: (nc == n) & late & ~early & (F.coalesce(c("max_np"), F.lit(0)) <= 1) & ~c("twice") & ~on_cut,
        5: (n >= 3) & (npa == 1) & (nu == 0) & (no == 0) & ~c("last_pa") & (ne + npa == n) & ~c("cents"),
        6: (ne == n) & early & ~late & (no == 0),
        7: (no == 1) & (npa == 0) & (nu == 0) & F.coalesce((c("ratio_max") >= lo) & (c("ratio_max") <= hi), F.lit(False))
        & ~late & ~early & ~on_cut,
        8: npa >= 2,
        9: c("r9"),
        10: c("twice"),
        11: (ne == 1) & (nu >= 2) & (npa == 0) & c("first_ex"),
        12: on_cut,
        13: c("cents"),
        15: c("dup15"),
        16: (n >= 2) & c("first_un") & (ne - c("first_ex").cast("int") == n - 1) & (npa == 0) & (no == 0),
        18: (ne >= 2) & (nu >= 1) & (npa == 0) & (no == 0) & ~late & (c("first_not_ex") >= 2)
        & (c("last_not_un").isNull() | (c("last_not_un") < c("first_not_ex"))),
    }


def classify_contracts(schedule: DataFrame, payments: DataFrame, as_of: _dt.date, keys: Sequence[str] = (CONTRACT,)) -> DataFrame:
    """Per contract: ``cases`` (array of case numbers) and ``case_label`` ("1, 13" or unclassified)."""
    f = contract_features(schedule, payments, as_of, keys)
    rules = case_rules(f)
    matched = F.array_compact(F.array(*[F.when(rules[k], F.lit(k)) for k in CASE_ORDER]))
    cases = (
        F.when(F.col("n") == 0, F.array().cast("array<int>"))
        .when(F.col("n_pay") == 0, F.array(*[F.lit(k) for k in NO_PAYMENT_CASES]))
        .otherwise(matched)
    )
    out = f.select(*keys, cases.alias("cases"))
    label = F.when(F.size("cases") == 0, F.lit(UNCLASSIFIED)).otherwise(
        F.array_join(F.col("cases").cast("array<string>"), ", ")
    )
    return out.withColumn("case_label", label)


def case_histogram(classified: DataFrame) -> DataFrame:
    """Contracts per case (a contract counts once for each case it matches)."""
    labels = F.when(F.size("cases") == 0, F.array(F.lit(UNCLASSIFIED))).otherwise(F.col("cases").cast("array<string>"))
    return classified.select(F.explode(labels).alias("case_label")).groupBy("case_label").agg(
        F.count(F.lit(1)).alias("contracts")
    )


def attach_cases(df: DataFrame, classified: DataFrame, column: str = "case", keys: Sequence[str] = (CONTRACT,)) -> DataFrame:
    """Add each contract's case label (detail or summary rows; one label row per contract)."""
    return df.join(case_labels(classified, column, keys), list(keys), "left")


def case_labels(classified: DataFrame, column: str = "case", keys: Sequence[str] = (CONTRACT,)) -> DataFrame:
    """A row per contract: its key and its case label."""
    return classified.select(*keys, F.col("case_label").alias(column))
