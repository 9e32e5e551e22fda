"""The golden five-contract seed (cut-off 2026-05-04, grace 1)."""

from decimal import Decimal

import pytest

from arrears.config import Cutoff
from arrears.operators import allocate as A
from arrears.operators import products as P
from arrears.operators import reports as R
from tests.fixtures import CUT, SEED_PAYMENTS, SEED_SCHEDULE, frames

# ref -> (dpd, arrears) for join / cascade / cascade with partial counts
EXPECTED = {
    "C001-1": ((0, 0), (0, 0), (0, 0)),
    "C001-2": ((0, 0), (0, 0), (0, 0)),
    "C001-3": ((0, 0), (0, 0), (0, 0)),
    "C002-1": ((0, 0), (0, 0), (0, 0)),
    "C002-2": ((63, 1000), (0, 0), (0, 0)),
    "C002-3": ((0, 0), (32, 1000), (32, 1000)),
    "C003-1": ((91, 500), (91, 500), (0, 0)),
    "C004-1": ((32, 1000), (32, 1000), (32, 1000)),
    "C005-1": ((0, 0), (0, 0), (0, 0)),
    "C005-2": ((32, 1000), (32, 500), (0, 0)),
}


def _result(df):
    return {r["borrower_installment_reference"]: (r["dpd_current"], r["amount_in_arrears"]) for r in df.collect()}


@pytest.mark.parametrize("variant", [0, 1, 2])
def test_seed_modes(spark, variant):
    s, p = frames(spark, SEED_SCHEDULE, SEED_PAYMENTS)
    mode = "join" if variant == 0 else "cascade"
    cfg = Cutoff(as_of=CUT, any_payment_counts=(variant == 2))
    got = _result(A.allocate(s, p, cfg, mode))
    for ref, exp in EXPECTED.items():
        dpd, arr = exp[variant]
        assert got[ref] == (dpd, Decimal(arr)), (mode, variant, ref, got[ref])


def test_seed_documented_example(spark):
    """C005: one 1500 payment covers the first 1000 and leaves 500 owed on the second."""
    s, p = frames(spark, SEED_SCHEDULE, SEED_PAYMENTS)
    rows = {r["borrower_installment_reference"]: r for r in A.cascade(s, p, Cutoff(as_of=CUT)).collect()}
    assert rows["C005-1"]["applied_amount"] == Decimal("1000")
    assert rows["C005-2"]["applied_amount"] == Decimal("500")
    assert rows["C005-2"]["amount_in_arrears"] == Decimal("500")


def test_seed_raw_days_without_grace(spark):
    s, p = frames(spark, SEED_SCHEDULE, SEED_PAYMENTS)
    rows = _result(A.join_mode(s, p, Cutoff(as_of=CUT, grace=0)))
    assert rows["C003-1"][0] == 92 and rows["C002-2"][0] == 64 and rows["C004-1"][0] == 33


def test_seed_summary_and_product(spark):
    s, p = frames(spark, SEED_SCHEDULE, SEED_PAYMENTS)
    cfg = Cutoff(as_of=CUT)
    summ = {r["borrower_contract_id"]: r for r in R.summary(R.detail(s, p, cfg)).collect()}
    assert summ["C002"]["cascade_dpd_max"] == 32 and summ["C002"]["join_dpd_max"] == 63
    assert summ["C005"]["cascade_arrears_total"] == Decimal("500")
    assert summ["C001"]["cuotas"] == 3
    loans = spark.createDataFrame([(c,) for c in ["C001", "C002", "C003", "C004", "C005", "C999"]], "contract string")
    out = {r["contract"]: r for r in P.enrich(loans, "contract", ["dpd", "total_amount"], cfg, s, p).collect()}
    assert out["C003"]["dpd_current"] == 91 and out["C003"]["amount_in_arrears"] == Decimal("500")
    assert out["C999"]["dpd_current"] == 0 and out["C999"]["total_amount_paid"] == Decimal("0")
    assert out["C005"]["total_amount_paid"] == Decimal("1500")


def test_threshold_80(spark):
    s, p = frames(spark, SEED_SCHEDULE, SEED_PAYMENTS)
    got = _result(A.join_mode(s, p, Cutoff(as_of=CUT, paid_share=0.5)))
    assert got["C003-1"] == (0, Decimal(0))  # 500 >= 1000 * 0.5


def test_product_in_join_mode(spark):
    s, p = frames(spark, SEED_SCHEDULE, SEED_PAYMENTS)
    loans = spark.createDataFrame([("C002",), ("C005",)], "contract string")
    out = {r["contract"]: r for r in P.enrich(loans, "contract", ["dpd"], Cutoff(as_of=CUT), s, p,
                                              mode="join").collect()}
    assert out["C002"]["dpd_current"] == 63 and out["C002"]["amount_in_arrears"] == Decimal("1000")
    assert out["C005"]["dpd_current"] == 32 and out["C005"]["amount_in_arrears"] == Decimal("1000")


def test_fallback_rows_are_observed(spark):
    from pyspark.sql import Observation

    from arrears.operators.clean import sanitize_schedule
    from tests.fixtures import instalment

    rows = [instalment(1, "A", "A-1", "2026-01-01", buckets=("0", "0", "0", "0", "0")),
            instalment(2, "A", "A-2", "2026-02-01"),
            instalment(3, "A", "A-3", "2026-03-01", buckets=(None, None, None, None, None))]
    from arrears.schemas import SCHEDULE

    obs = Observation("fallback")
    out = sanitize_schedule(spark.createDataFrame(rows, SCHEDULE), observation=obs)
    principals = {r["id"]: r["principal_amount"] for r in out.collect()}
    assert obs.get["filled_rows"] == 2
    assert principals[1] == Decimal("1000") and principals[2] == Decimal("800") and principals[3] == Decimal("1000")
