"""A contract holding a third of all instalments is spread over several tasks."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from arrears.config import Cutoff
from arrears.operators import allocate as A
from arrears.schemas import PAYMENTS, SCHEDULE
from tests.sequential import expected_cascade

CALC = dt.date(2030, 1, 1)


def _portfolio():
    sched, pays = [], []
    i = 0
    start = dt.date(2020, 1, 1)
    for c in range(200):  # 200 ordinary contracts, 10 instalments each
        for k in range(10):
            i += 1
            sched.append((i, "X", f"N{c}", f"N{c}-{k}", start + dt.timedelta(days=30 * k), Decimal("100"),
                          Decimal(0), Decimal("90"), Decimal("10"), Decimal(0), Decimal(0)))
        pays.append((i, 1, f"N{c}", None, start, Decimal(37 * (c % 40))))
    for k in range(1000):  # one hot contract: a third of all rows, three instalments a day
        i += 1
        sched.append((i, "X", "HOT", f"H-{k}", start + dt.timedelta(days=k // 3), Decimal("50"),
                      Decimal(0), Decimal("45"), Decimal("5"), Decimal(0), Decimal(0)))
    pays.append((i + 1, 1, "HOT", None, start, Decimal("24975.50")))
    return sched, pays


def test_hot_contract_is_split_and_exact(spark):
    sched, pays = _portfolio()
    s = spark.createDataFrame(sched, SCHEDULE)
    p = spark.createDataFrame(pays, PAYMENTS)
    # Behave as at scale: partitions are not merged and no side is small
    # enough to broadcast.
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    prev = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = A.cascade(s, p, Cutoff(as_of=CALC)).withColumn("task", F.spark_partition_id())
        rows = out.collect()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hot_tasks = {r["task"] for r in rows if r["borrower_contract_id"] == "HOT"}
    assert len(hot_tasks) > 1, "the hot contract's rows were processed by a single task"
    names = [f.name for f in SCHEDULE.fields]
    srows = [dict(zip(names, r)) for r in sched]
    prows = [dict(zip([f.name for f in PAYMENTS.fields], r)) for r in pays]
    exp = expected_cascade(srows, prows, CALC)
    got = {r["id"]: (r["applied_amount"], r["dpd_current"], r["amount_in_arrears"]) for r in rows}
    assert got == exp


def _shuffles(spark, df) -> int:
    """Hash exchanges of the plan without broadcasts."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    prev = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_only_large_contracts_are_spread(spark):
    from arrears.operators.ordered import large_keys, running_before

    rows = [(c, dt.date(2020, 1, 1) + dt.timedelta(days=i // 3), i) for c, n in (("BIG", 400), ("A", 5), ("B", 99), (None, 500)) for i in range(n)]
    df = spark.createDataFrame(rows, "c string, d date, id long")
    assert [r["c"] for r in large_keys(df, ["c"]).collect()] == ["BIG"]
    assert large_keys(df.where("c <> 'BIG' or c is null"), ["c"]) is None
    pool = spark.createDataFrame([("BIG", 7), ("A", 8)], "c string, pool long")
    out = running_before(df, ["c"], "d", "id", {"before": F.col("id")}, pool, {"next_id": F.col("id")})
    assert out.columns == ["c", "d", "id", "pool", "before", "next_id"]
    want = [(c, i, p, i * (i - 1) // 2, i + 1 if i + 1 < n else None) for c, n, p in (("BIG", 400, 7), ("A", 5, 8), ("B", 99, None)) for i in range(n)]
    key = lambda x: x[:2]
    assert sorted(((r["c"], r["id"], r["pool"], r["before"], r["next_id"]) for r in out.collect()), key=key) == sorted(want, key=key)


def test_rows_of_ordinary_contracts_are_shuffled_once(spark):
    """No table of days is shuffled beside the rows."""
    sched, pays = _portfolio()
    s = spark.createDataFrame([x for x in sched if x[2] != "HOT"], SCHEDULE)
    p = spark.createDataFrame([x for x in pays if x[2] != "HOT"], PAYMENTS)
    assert _shuffles(spark, A.cascade(s, p, Cutoff(as_of=CALC))) <= 2  # the rows, the payments' sums


def _odd_portfolio():
    """Shared, missing and blank references, days and contracts; instalments without amount; payments without reference."""
    day = dt.date(2029, 10, 1)
    sched, pays = [], []
    for c in range(12):
        for k in range(8):
            i = 100 * c + k
            gross = None if k == 5 and c % 3 == 0 else Decimal(100 if k != 6 else 0)
            ref = {0: None, 1: " ", 2: f"{c}-1"}.get(k + c % 3, f"{c}-{k}")
            sched.append((i, "X", None if c == 11 else f"C{c}", ref, None if k == 7 else day + dt.timedelta(days=20 * (k // 2)), gross,
                          Decimal(0), Decimal(90), Decimal(10), Decimal(0), Decimal(0)))
            for n in range(k % 3):
                pays.append((10 * i + n, 1, None if c == 10 and k == 2 else f"C{c}", {3: None, 4: " "}.get(k, f"{c}-{k}"),
                             None if k == 1 and c % 4 == 0 else day, Decimal(40 + 13 * c)))
    pays.append((-1, 1, "nobody", "x", day, Decimal(5)))
    return sched, pays


def test_detail_is_the_same_together_and_spread(spark, monkeypatch):
    from arrears.operators import ordered
    from arrears.operators.reports import detail

    sched, pays = _odd_portfolio()
    s, p = spark.createDataFrame(sched, SCHEDULE), spark.createDataFrame(pays, PAYMENTS)
    for modes in (("cascade", "join"), ("join", "cascade"), ("cascade",), ("join",)):
        for maxima in (True, False):
            monkeypatch.setattr(ordered, "LARGE_ROWS", (10**6, 10**6))
            together = detail(s, p, Cutoff(as_of=CALC), modes, maxima)
            monkeypatch.setattr(ordered, "LARGE_ROWS", (0, 12))  # some contracts
            some = detail(s, p, Cutoff(as_of=CALC), modes, maxima)
            monkeypatch.setattr(ordered, "LARGE_ROWS", (0, 0))  # all of them
            spread = detail(s, p, Cutoff(as_of=CALC), modes, maxima)
            assert together.columns == some.columns == spread.columns
            rows = sorted(map(str, together.collect()))
            assert len(rows) == len(sched)
            assert rows == sorted(map(str, some.collect())) == sorted(map(str, spread.collect()))


def test_detail_shuffles_its_rows_once(spark):
    from arrears.operators.reports import detail

    sched, pays = _odd_portfolio()
    d = detail(spark.createDataFrame(sched, SCHEDULE), spark.createDataFrame(pays, PAYMENTS), Cutoff(as_of=CALC))
    assert _shuffles(spark, d) <= 2  # rows with payments, the payments' sums


def test_cases_are_the_same_together_and_spread(spark, monkeypatch):
    from arrears.operators import ordered
    from arrears.operators.classify import contract_features

    sched, pays = _odd_portfolio()
    s, p = spark.createDataFrame(sched, SCHEDULE), spark.createDataFrame(pays, PAYMENTS)
    found = []
    for rows in ((10**6, 10**6), (0, 12), (0, 0)):  # no contract large, some, all of them
        monkeypatch.setattr(ordered, "LARGE_ROWS", rows)
        found.append(sorted(map(str, contract_features(s, p, dt.date(2029, 12, 1)).collect())))
    assert len(found[0]) == 11
    assert found[0] == found[1] == found[2]


def test_classifier_shuffles_by_contract_only(spark):
    from arrears.operators.classify import classify_contracts

    sched, pays = _odd_portfolio()
    out = classify_contracts(spark.createDataFrame(sched, SCHEDULE), spark.createDataFrame(pays, PAYMENTS), CALC)
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = [x.split("hashpartitioning(")[1].split(", ")[0:2] for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert dealt and all(not any(c in "".join(x) for c in ("reference", "date")) for x in dealt), plan


def test_export_allocates_once(spark, tmp_path, monkeypatch):
    """The summary is reduced from the written detail, and is what run_tables gives."""
    from arrears.plans import run

    sched, pays = _odd_portfolio()
    s, p = spark.createDataFrame(sched, SCHEDULE), spark.createDataFrame(pays, PAYMENTS)
    s.write.parquet(f"{tmp_path}/s.parquet")
    p.write.parquet(f"{tmp_path}/p.parquet")
    want = [x.collect() for x in run.run_tables(s, p, dt.date(2029, 12, 1), cases=True)]
    calls, made = [], run.detail
    monkeypatch.setattr(run, "detail", lambda *a, **k: calls.append(1) or made(*a, **k))
    run.run_detail_summary(spark, f"{tmp_path}/s.parquet", f"{tmp_path}/p.parquet", f"{tmp_path}/out", as_of=dt.date(2029, 12, 1), cases=True)
    assert len(calls) == 1
    for name, rows in zip(("detail", "summary"), want):
        assert sorted(map(str, spark.read.parquet(f"{tmp_path}/out/{name}").collect())) == sorted(map(str, rows))
