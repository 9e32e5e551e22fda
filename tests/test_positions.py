"""Places of rows in file order and in a given order, and the last payment date of every company."""

import datetime as dt
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from arrears.operators.clean import sanitize_schedule
from arrears.operators.position import file_positions, in_order
from arrears.session import scratch_path
from arrears.sources.tables import read_payments
from tests.fixtures import frames, payment


def _folder(spark):
    return scratch_path(spark, "positions-test", uuid.uuid4().hex)


def _files(spark, kind):
    """Three files of 50, 7 and 43 rows, row k of all holding k."""
    path = _folder(spark)
    for part, (lo, hi) in enumerate([(1, 51), (51, 58), (58, 101)]):
        spark.range(lo, hi, 1, 1).selectExpr("id AS k").write.format(kind).option("header", True).save(f"{path}/part={part}")
    return path


@pytest.mark.parametrize("kind", ["parquet", "csv"])
@pytest.mark.parametrize("split", ["64", "128m"])
def test_file_positions(spark, kind, split):
    path = _files(spark, kind)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = spark.read.format(kind).option("header", True).load(path)
        got = file_positions(df)
        assert got.columns == [*df.columns, "position"]
        rows = got.select(F.col("k").cast("long"), "position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 100 and all(k == p for k, p in rows)


def test_a_table_without_files_has_no_file_order(spark):
    with pytest.raises(AnalysisException):
        file_positions(spark.createDataFrame([(1,)], "k long"))


def test_empty_file(spark):
    path = _folder(spark)
    spark.range(0).write.parquet(path)
    assert file_positions(spark.read.parquet(path)).collect() == []


def test_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 1000).alias("a"), F.when(F.col("id") % 7 != 0, F.col("id")).alias("b")).repartition(7)
    got = in_order(df, F.col("a").desc(), F.col("b").asc_nulls_last()).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 5001))
    assert [(-r["a"], r["b"] is None, r["b"] or 0) for r in got] == sorted((-r["a"], r["b"] is None, r["b"] or 0) for r in got)
    assert in_order(df.limit(0), "a").collect() == []
    ties = in_order(spark.createDataFrame([(1,)] * 20, "a int"), "a").collect()
    assert sorted(r["position"] for r in ties) == list(range(1, 21))


def test_missing_ids_are_positions(spark):
    day = dt.date(2026, 3, 1)
    rows = [(None, "A", day, 100.0, 1), (40, "A", day, 100.0, 2), (None, "A", day, 100.0, 3)]
    df = spark.createDataFrame(rows, "id long, borrower_contract_id string, date date, gross_amount double, place long")
    got = sanitize_schedule(df, position="place")
    assert "place" not in got.columns and sorted(r["id"] for r in got.collect()) == [1, 3, 40]
    assert sorted(r["id"] for r in sanitize_schedule(df.drop("id"), position="place").collect()) == [1, 2, 3]


def test_last_payment_date_of_every_company(spark):
    """Company 1 holds most payments; it meets its date dealt to parts."""
    pays = [payment(i, f"C{i}", "r", f"2026-01-{1 + i % 28:02d}", "10", company=1) for i in range(300)]
    pays += [payment(900, "X", "r", "2026-03-05", "5", company=2), payment(901, "X", "r", "2026-04-05", "-5", company=2),
             payment(902, "X", "r", None, "5", company=2), payment(903, "Y", "r", "2026-02-02", "5", company=None)]
    _, p = frames(spark, [], pays)
    out = read_payments(p)
    got = out.groupBy("company_id").agg(F.count("*").alias("n"), F.collect_set("last_payment_date").alias("d")).collect()
    assert {r["company_id"]: (r["n"], r["d"]) for r in got} == {
        1: (300, [dt.date(2026, 1, 28)]), 2: (1, [dt.date(2026, 3, 5)]), None: (1, [])}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and out.columns == read_payments(p, 1).columns
