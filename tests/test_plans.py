"""Plan shape: no Python in the core queries, filters and projections reach the scan,
and no row-level window is partitioned by the contract alone."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
CORE = ["dpd_cascade", "dpd_join", "detail_both", "summary_both", "enrich_loan_tape", "generate_schedule",
        "classify_contracts", "product_vpn", "scan_schedule"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CORE)
def test_no_python_in_core_plans(spark, name):
    """The whole plan: nothing is behind a checkpoint, so no node can hide."""
    plan = _plan(E.queries()[name](spark, SF))
    assert "Scan ExistingRDD" not in plan or "checkpoint" not in plan
    assert "Scan parquet" in plan or "FileScan parquet" in plan, plan
    assert not any(n in plan for n in PYTHON_NODES), plan


def _scans(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan parquet" in line]


def test_scan_pushdown_and_pruning(spark):
    scans = _scans(_plan(E.queries()["scan_payments"](spark, SF)))
    assert scans and all("IsNotNull(l_" in re.search(r"PushedFilters: \[([^\]]*)\]", x).group(1) for x in scans), scans
    scans = _scans(_plan(E.queries()["dpd_cascade"](spark, SF)))
    assert scans
    for x in scans:  # a pruned column set, never the whole line item
        assert "l_quantity" not in re.search(r"ReadSchema: struct<([^>]*)", x).group(1)
    rows = [x for x in scans if "l_discount" in x]  # the scan that feeds the instalments, not the payments
    assert rows and all("IsNotNull(l_shipdate)" in x for x in rows), scans


def _windows(df) -> list[str]:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line.split("Window ", 1)[1] for line in plan.splitlines() if re.search(r"\bWindow \[", line)]


@pytest.mark.parametrize("name", ["dpd_cascade", "detail_both", "classify_contracts"])
def test_windows_are_bounded(spark, name):
    """Rows are ordered within (contract, due date) only; windows by contract alone run on per-day totals."""
    found = _windows(E.queries()[name](spark, SF))
    assert found
    for w in found:
        by = re.findall(r"\], \[([^\]]*)\]", w)[0]
        per_day = "__v_" in w or "__f_" in w  # the totals or first rows of days
        in_day = "installment_date" in by
        assert in_day or per_day, w
        if not in_day:
            assert "id#" not in w.split("], [")[-1], w


def _whole(spark, name) -> str:
    """The plan without broadcasts, so that every exchange shows."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return _plan(E.queries()[name](spark, SF))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name,most", [("classify_contracts", 15), ("enrich_loan_tape", 9), ("detail_both", 16)])
def test_exchanges(spark, name, most):
    plan = _whole(spark, name)
    assert 0 < plan.count("Exchange hashpartitioning") <= most, plan


@pytest.mark.parametrize("name", ["companies_without_schedule", "generation_gate"])
def test_company_key_is_salted(spark, name):
    """Large sides meet the companies of the schedule by company and salt, never by company alone."""
    plan = _whole(spark, name)
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", plan)
    assert joins and all("__salt" in j for j in joins), plan


def test_request_bodies_are_parsed_once(spark):
    df = E.queries()["rejected_requests"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1, plan


def test_terms_are_worked_out_once_per_loan(spark):
    """The rates' powers stand once each in the plan, above the exchange that spreads the loans."""
    from arrears.operators.schedule import generate_schedule
    from arrears.sources.testdata import loan_tape

    plan = generate_schedule(loan_tape(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("power(") <= 2
    assert plan.lower().rindex("power(") < plan.index("RepartitionByExpression")
