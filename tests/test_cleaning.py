"""Sanitising: dates, references, amounts, ids, the reference column, and whole runs."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Observation

from arrears.config import Cutoff
from arrears.operators import allocate as A
from arrears.operators.clean import sanitize_payments, sanitize_schedule
from arrears.plans.run import EmptySchedule, run_detail_summary, run_tables
from arrears.session import scratch_path
from tests.fixtures import CUT, SEED_PAYMENTS, SEED_SCHEDULE, frames


def _dates(spark, values, **kw):
    df = spark.createDataFrame([("c", v, 1.0) for v in values], "borrower_contract_id string, payment_date string, total_payment double")
    return [r["payment_date"] for r in sanitize_payments(df, **kw).collect()]


def test_dates_are_month_first_or_of_one_format(spark):
    text = ["03/04/2026", "13/04/2026", "04/13/2026", "2026-04-03", " 2026-04-03 10:00:00", "soon", None]
    assert _dates(spark, text) == [dt.date(2026, 3, 4), None, dt.date(2026, 4, 13), dt.date(2026, 4, 3), dt.date(2026, 4, 3), None, None]
    assert _dates(spark, text, date_format="dd/MM/yyyy") == [dt.date(2026, 4, 3), dt.date(2026, 4, 13), None, None, None, None, None]


def test_nan_references_do_not_match(spark):
    s = sanitize_schedule(spark.createDataFrame([(1, "A", float("nan"), dt.date(2026, 3, 1), 100.0), (2, "A", 7.0, dt.date(2026, 3, 1), 100.0)],
                                                "id long, borrower_contract_id string, borrower_installment_reference double, date date, gross_amount double"))
    p = sanitize_payments(spark.createDataFrame([("A", float("nan"), dt.date(2026, 3, 1), 100.0), ("A", 7.0, dt.date(2026, 3, 1), 100.0)],
                                                "borrower_contract_id string, borrower_installment_reference double, payment_date date, total_payment double"))
    assert {r["id"]: r["dpd_current"] for r in A.join_mode(s, p, Cutoff(as_of=CUT)).collect()} == {1: 63, 2: 0}


def test_amounts_that_are_no_numbers(spark):
    obs = Observation()
    df = spark.createDataFrame([(1, "A", "1,000", "2026-03-01", "x"), (2, "A", " 500.5 ", "2026-03-01", None), (3, "A", "12", "2026-03-01", "12")],
                               "id long, borrower_contract_id string, gross_amount string, date string, principal_amount string")
    got = {r["id"]: (r["gross_amount"], r["principal_amount"]) for r in sanitize_schedule(df, observation=obs).collect()}
    assert got == {1: (None, Decimal(0)), 2: (Decimal("500.5"), Decimal("500.5")), 3: (Decimal(12), Decimal(12))}
    assert obs.get == {"filled_rows": 1, "bad_amounts": 2}


def test_ids_are_places_within_the_contract(spark):
    rows = [("A", "A-2", dt.date(2026, 3, 1), 100.0), ("A", "A-10", dt.date(2026, 3, 1), 100.0), ("A", "A-1", dt.date(2026, 2, 1), 100.0),
            ("A", "A-2", dt.date(2026, 3, 1), 100.0)]
    cols = "borrower_contract_id string, borrower_installment_reference string, date date, gross_amount double"
    a = sanitize_schedule(spark.createDataFrame(rows, cols)).orderBy("id").collect()
    assert [r["borrower_installment_reference"] for r in a] == ["A-1", "A-2", "A-2", "A-10"]
    assert len({r["id"] for r in a}) == 4  # twins too
    b = sanitize_schedule(spark.createDataFrame(rows[::-1], cols).repartition(3)).orderBy("id").collect()
    assert [r["id"] for r in a] == [r["id"] for r in b]


def test_reference_column_is_rescued_only_when_empty(spark):
    cols = "borrower_contract_id string, payment_date string, total_payment string, borrower_installment_reference string, _corrupt_record string, _c7 string"
    p = sanitize_payments(spark.createDataFrame([("A", "2026-03-01", "5", None, "bad", "r1"), ("A", "2026-03-01", "5", None, "bad", None)], cols))
    assert [r["borrower_installment_reference"] for r in p.collect()] == ["r1", None]
    p = sanitize_payments(spark.createDataFrame([("A", "2026-03-01", "5", "own", None, "r1"), ("A", "2026-03-01", "5", None, None, "r2")], cols))
    assert [r["borrower_installment_reference"] for r in p.collect()] == ["own", None]


def test_cents_of_payments_that_are_doubles(spark):
    s, _ = frames(spark, [(1, "42", "A", "A-1", dt.date(2026, 3, 1), Decimal("1.13"), Decimal(0), Decimal("1.13"), Decimal(0), Decimal(0), Decimal(0))], SEED_PAYMENTS)
    p = spark.createDataFrame([("A", dt.date(2026, 3, 1), 1.13)], "borrower_contract_id string, payment_date date, total_payment double")
    row = A.cascade(s, p, Cutoff(as_of=CUT)).first()
    assert (row["applied_amount"], row["dpd_current"]) == (Decimal("1.13"), 0)


def test_run_over_empty_sources(spark):
    s, p = frames(spark, SEED_SCHEDULE, SEED_PAYMENTS)
    with pytest.raises(EmptySchedule):
        run_tables(s.limit(0), p, CUT)
    d, sums = run_tables(s, p.limit(0), CUT, cases=True)
    rows = d.collect()
    assert len(rows) == 10 and all(r["cascade_dpd"] > 0 and r["join_dpd"] > 0 for r in rows)
    assert {r["case"] for r in sums.collect()} == {"3, 17"}


def test_run_from_files(spark):
    base = scratch_path(spark, "t", "run-from-files")
    s, p = frames(spark, SEED_SCHEDULE, SEED_PAYMENTS)
    s.write.mode("overwrite").parquet(f"{base}/s.parquet")
    p.write.mode("overwrite").option("header", True).csv(f"{base}/p.csv")
    run_detail_summary(spark, f"{base}/s.parquet", {"format": "csv", "path": f"{base}/p.csv", "header": "true"}, f"{base}/out",
                       company_code="42", company_id=42, as_of=CUT, mode="cascade")
    got = {r["borrower_contract_id"]: r["cascade_dpd_max"] for r in spark.read.parquet(f"{base}/out/summary").collect()}
    assert got == {"C001": 0, "C002": 32, "C003": 91, "C004": 32, "C005": 32}
    assert spark.read.parquet(f"{base}/out/detail").count() == 10
    d, _ = run_tables(s, p)  # the cut-off is yesterday
    late = (dt.date.today() - dt.timedelta(days=1) - dt.date(2026, 2, 1)).days - 1
    assert {r["borrower_contract_id"]: r["max_cascade_dpd"] for r in d.collect()}["C003"] == max(late, 0)
