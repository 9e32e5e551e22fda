"""Request batches in one plan: equal to one unit after the other, and as many jobs for a thousand outputs as for two."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from arrears.plans.batch import read_output, serve_batch
from arrears.plans.service import PortfolioSources, process_requests
from arrears.session import scratch_path
from arrears.sources.loan_tape import read_loan_tape
from arrears.sources.state import append_watermarks, compact_watermarks, read_watermarks
from tests.fixtures import CUT, SEED_PAYMENTS, SEED_SCHEDULE, frames

NOW = dt.datetime(2026, 5, 5, 6, 0)


def _body(n, tape, out, target=42, products=("dpd",), key="contract", **kw):
    meta = {"products": list(products), **{k: kw.pop(k) for k in ("interest_rate", "paid_threshold") if k in kw}}
    return json.dumps({"origin": "ENR", "target": "SVC", "job_id": f"j{n:04}", "input_file": tape, "output_file": out, "key": key,
                       "target_type": "COMPANY", "target_id": target, "metadata": meta, **kw})


@pytest.fixture(scope="module")
def portfolio(spark):
    sched, pays = frames(spark, SEED_SCHEDULE, SEED_PAYMENTS)
    sched = sched.withColumn("company_code", F.lit("42"))
    pays = pays.withColumn("company_id", F.lit(42))
    base = scratch_path(spark, "batch", uuid.uuid4().hex)
    spark.createDataFrame([("C001", 1), ("C002", 2), ("C003", 3), ("C009", 4)], "contract string, x int").write.parquet(f"{base}/a.parquet")
    spark.createDataFrame([("C004", "n"), ("C005", "m"), ("C002", None)], "loan string, y string").write.parquet(f"{base}/b.parquet")
    spark.createDataFrame([("C002",), ("C005",)], "contract string").coalesce(1).write.option("header", True).csv(f"{base}/c.csv")
    spark.createDataFrame([("L1", "1200", 12, 0.1, "2026-01-15"), ("L2", "many", 12, 0.1, "2026-01-15")],
                          "borrower_contract_id string, original_principal string, num_installments int, interest_rate double, first_installment_date string"
                          ).write.parquet(f"{base}/new.parquet")
    return base, PortfolioSources(sched, pays)


def _bodies(base, out):
    return [
        _body(1, f"{base}/a.parquet", f"{out}/1.parquet", products=("dpd", "total_amount", "vpn"), interest_rate=0.1),
        _body(2, f"{base}/a.parquet", f"{out}/2.parquet", products=("dpd",), paid_threshold=0.5),
        _body(3, f"{base}/b.parquet", f"{out}/3.parquet", products=("total_amount", "dpd"), key="loan"),
        _body(4, f"{base}/a.parquet", f"{out}/4.parquet", products=("dpd",), paid_threshold=1.0),
        _body(5, f"{base}/a.parquet", f"{out}/4.parquet", products=("dpd",), paid_threshold=0.5),
        _body(6, f"{base}/new.parquet", f"{out}/6.parquet", target=7, key="borrower_contract_id", products=("dpd", "vpn"), interest_rate=0.05),
    ]


def _rows(df, *drop):
    df = df.drop(*drop)
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str), sorted(df.columns)


def test_equal_to_one_unit_after_the_other(spark, portfolio):
    base, src = portfolio
    one, all_at_once = f"{base}/one", f"{base}/all"
    args = (CUT, NOW, "SVC")
    done = process_requests(spark, spark.createDataFrame([(b,) for b in _bodies(base, one)], "body string"), src, *args, f"{base}/r1", f"{base}/p1")
    assert not done["failed"]
    serve_batch(spark, spark.createDataFrame([(b,) for b in _bodies(base, all_at_once)], "body string"), src, *args, f"{base}/fused", f"{base}/r2", f"{base}/p2")
    for n in (1, 2, 3, 4, 6):
        # The merged read gives a tape the columns of the others; its own are the same.
        got, want = read_output(spark, f"{base}/fused", f"{all_at_once}/{n}.parquet"), read_loan_tape(spark, f"{one}/{n}.parquet")
        extra = [c for c in got.columns if c not in want.columns]
        assert got.select(*[F.count(c).alias(c) for c in extra]).first() == tuple([0] * len(extra)) if extra else True
        assert _rows(got, *extra) == _rows(want), n
    answers = lambda p: sorted(r["body"] for r in spark.read.parquet(p).collect())
    same = lambda xs, out: [x.replace(out, "OUT") for x in xs]
    assert same(answers(f"{base}/p1/batch=0"), one) == same(answers(f"{base}/p2/batch=0"), all_at_once)


def test_what_cannot_be_served_is_rejected_and_the_rest_served(spark, portfolio):
    base, src = portfolio
    out = f"{base}/bad"
    bodies = [_body(1, f"{base}/none.parquet", f"{out}/1.parquet"), _body(2, f"{base}/a.parquet", f"{out}/2.parquet", key="no_such"),
              _body(3, f"{base}/new.parquet", f"{out}/3.parquet", target=8, key="borrower_contract_id", rate_type="variable"),
              _body(4, f"{base}/c.csv", f"{out}/4.parquet"), "{not json"]
    serve_batch(spark, spark.createDataFrame([(b,) for b in bodies], "body string"), src, CUT, NOW, "SVC", f"{base}/f2", f"{base}/r3", f"{base}/p3")
    reasons = sorted(r["errors"] for r in spark.read.parquet(f"{base}/r3/batch=0").collect())
    assert len(reasons) == 4 and sum("does not exist" in r for r in reasons) == 1 and sum("no column no_such" in r for r in reasons) == 1
    assert sum("variable" in r for r in reasons) == 1 and "malformed JSON" in reasons
    assert [r["contract"] for r in read_output(spark, f"{base}/f2", f"{out}/4.parquet").orderBy("contract").collect()] == ["C002", "C005"]
    with pytest.raises(ValueError):
        read_output(spark, f"{base}/f2", f"{out}/1.parquet")


def test_high_watermark_survives_batches_and_replays(spark, portfolio):
    base, src = portfolio
    bodies = spark.createDataFrame([(_body(1, f"{base}/a.parquet", "w/1.parquet"),)], "body string")
    run = lambda day, n: serve_batch(spark, bodies, src, day, NOW, "SVC", f"{base}/f3", f"{base}/r4", f"{base}/p4", batch_id=n)
    top = lambda n: {r["contract"]: (r["dpd_current"], r["dpd_max"]) for r in read_output(spark, f"{base}/f3", "w/1.parquet", n).collect()}
    run(CUT, 1)
    late = top(1)
    run(CUT - dt.timedelta(days=30), 2)
    assert late["C002"][0] > 0 and top(2)["C002"] == (late["C002"][0] - 30, late["C002"][1])
    run(CUT, 1)
    assert top(1) == late


def test_jobs_do_not_grow_with_outputs(spark, portfolio):
    base, src = portfolio
    sc = spark.sparkContext

    def jobs(n):
        bodies = spark.createDataFrame([(_body(i, f"{base}/a.parquet", f"many/{i}.parquet", paid_threshold=(i % 10 + 1) / 10, products=("dpd", "vpn"), interest_rate=i % 7 / 100),) for i in range(n)], "body string")
        sc.setJobGroup(f"outputs-{n}", "")
        serve_batch(spark, bodies, src, CUT, NOW, "SVC", f"{base}/many{n}", f"{base}/r{n}", f"{base}/p{n}")
        sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(f"outputs-{n}"))

    few, many = jobs(2), jobs(1000)
    assert many <= few + 8
    assert spark.read.parquet(f"{base}/many1000/batch=0").groupBy("unit").count().agg(F.count("*"), F.min("count"), F.max("count")).first() == (1000, 4, 4)


def test_state_table_merges_in_any_order(spark, portfolio):
    base, _ = portfolio
    path = f"{base}/state-{uuid.uuid4().hex}"
    df = lambda rows: spark.createDataFrame(rows, "company_code string, borrower_contract_id string, dpd_max int")
    got = lambda: {r["borrower_contract_id"]: r["dpd_max"] for r in read_watermarks(spark, path).collect()}
    assert read_watermarks(spark, path) is None
    compact_watermarks(spark, path)
    append_watermarks(df([("1", "a", 9), ("1", "b", None)]), path, 3)
    append_watermarks(df([("1", "a", 4), ("1", "a", 5), ("1", "b", 2)]), path, 1)
    assert got() == {"a": 9, "b": 2}
    compact_watermarks(spark, path)
    assert got() == {"a": 9, "b": 2}
    append_watermarks(df([("1", "a", 7), ("1", "c", 1)]), path, 1)  # a replay after the compaction
    append_watermarks(df([("1", "c", 3)]), path, 1)
    compact_watermarks(spark, path)
    compact_watermarks(spark, path)
    assert got() == {"a": 9, "b": 2, "c": 3}
