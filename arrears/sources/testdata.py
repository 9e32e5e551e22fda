"""Deterministic mapping of the driver's TPC-H-like tables to loan tables.

The driver data has no loan schema, so each query builds one from it:

* loan tape   ← ``orders``   (one contract per order);
* schedule    ← ``lineitem`` (one instalment per line item);
* payment tape← ``lineitem`` (about 80% of the lines pay: half, 1.25×,
  50 cents short, twice, a 10% reversal or exactly the gross; the others are
  rows that name no contract, day or amount).

Every column is a pure function of one input row (no windows, no joins), so
the mapping is a narrow projection that scales with the scan.  The same
mapping is written once more as DuckDB SQL (``ORACLE_CTES``) for the
correctness oracle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.schemas import MONEY, PRINCIPAL

CALC_DATE = _dt.date(1998, 6, 30)  # cut-off date of all driver-data queries
PREVIOUS_CALC_DATE = _dt.date(1997, 12, 31)  # cut-off of the "previous run"
INVESTOR_RATE = 0.12  # discount rate for the NPV product queries

# Fixed values of the mapping.
COMPANIES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PERIODICITY_BY_PRIORITY = {"1": " Mensual ", "2": "quincenal", "3": "W", "4": None, "5": "daily"}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _company_code(orderkey) -> F.Column:
    return F.element_at(F.array(*[F.lit(c) for c in COMPANIES]), (orderkey % 5 + 1).cast("int"))


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    gross = F.col("l_extendedprice").cast(MONEY)
    interest = (gross * F.col("l_discount").cast(MONEY)).cast(MONEY)
    tax = (gross * F.col("l_tax").cast(MONEY)).cast(MONEY)
    bare = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") % 2 == 0)
    zero = F.lit(0).cast(MONEY)
    return li.select(
        (
            F.col("l_orderkey") * 10_000_000
            + F.col("l_linenumber") * 1_000_000
            + (F.col("l_suppkey") * 20011 + F.col("l_partkey")) % 1_000_000
        ).alias("id"),
        _company_code(F.col("l_orderkey")).alias("company_code"),
        F.col("l_orderkey").cast("string").alias("borrower_contract_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "borrower_installment_reference"
        ),
        F.col("l_shipdate").cast("date").alias("installment_date"),
        gross.alias("gross_amount"),
        zero.alias("guarantee_amount"),
        F.when(bare, zero).otherwise((gross - interest - tax).cast(MONEY)).alias("principal_amount"),
        F.when(bare, zero).otherwise(interest).alias("interest_amount"),
        F.when(bare, zero).otherwise(tax).alias("tax_amount"),
        zero.alias("fee_amount"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    gross = F.col("l_extendedprice").cast(MONEY)
    kind = F.col("l_suppkey") % 8
    amount = (
        F.when(kind == 0, gross * F.lit(0.5).cast("decimal(2,1)"))
        .when(kind == 1, gross * F.lit(1.25).cast("decimal(3,2)"))
        .when(kind == 2, gross - F.lit(0.5).cast("decimal(3,2)"))
        .when(kind == 3, gross * F.lit(2))
        .when(kind == 4, gross * F.lit(-0.1).cast("decimal(2,1)"))
        .otherwise(gross)
    ).cast(MONEY)
    ref = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    pays = (F.col("l_orderkey") + F.col("l_linenumber") * 3 + F.col("l_suppkey")) % 10 < 8
    return li.select(
        (
            F.col("l_orderkey") * 10_000_000
            + F.col("l_linenumber") * 1_000_000
            + (F.col("l_suppkey") * 20011 + F.col("l_partkey")) % 1_000_000
        ).alias("id"),
        (F.col("l_orderkey") % 5 + 1).cast("int").alias("company_id"),
        F.when(pays, F.col("l_orderkey").cast("string")).alias("borrower_contract_id"),
        F.when(pays & (F.col("l_partkey") % 17 != 0), ref).alias("borrower_installment_reference"),
        F.when(pays & (F.col("l_partkey") % 53 != 0),
               F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_partkey") % 31 - 5).cast("int")))
        .alias("payment_date"),
        F.when(pays, amount).alias("total_payment"),
    )


def loan_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    digit = F.substring("o_orderpriority", 1, 1)
    per = F.lit(None).cast("string")
    for d, name in PERIODICITY_BY_PRIORITY.items():
        if name is not None:
            per = F.when(digit == d, F.lit(name)).otherwise(per)
    return o.select(
        F.col("o_orderkey").cast("string").alias("borrower_contract_id"),
        _company_code(F.col("o_orderkey")).alias("company_code"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("company_id"),
        F.col("o_totalprice").cast(PRINCIPAL).alias("original_principal"),
        (F.col("o_orderkey") % 36 + 1).cast("int").alias("num_installments"),
        F.when(F.col("o_custkey") % 11 == 0, F.lit(0.0))
        .otherwise((F.lit(0.06).cast("decimal(3,2)") * (F.col("o_custkey") % 5 + 1)).cast("double"))
        .alias("interest_rate"),
        F.col("o_orderdate").cast("date").alias("first_installment_date"),
        per.alias("periodicity"),
    )


def company_map(spark: SparkSession) -> DataFrame:
    """company_id ↔ company_code (a five-row dimension)."""
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(COMPANIES)], "company_id int, company_code string")


# The same mapping in DuckDB SQL, as CTEs named schedule, payments, loan_tape.
ORACLE_CTES = """
schedule AS (
  SELECT
    l_orderkey * 10000000 + l_linenumber * 1000000 + (l_suppkey * 20011 + l_partkey) % 1000000 AS id,
    (['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'])[CAST(l_orderkey % 5 + 1 AS INTEGER)] AS company_code,
    CAST(l_orderkey AS VARCHAR) AS borrower_contract_id,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS borrower_installment_reference,
    CAST(l_shipdate AS DATE) AS installment_date,
    CAST(l_extendedprice AS DECIMAL(18,4)) AS gross_amount,
    CAST(0 AS DECIMAL(18,4)) AS guarantee_amount,
    CASE WHEN l_returnflag = 'N' AND l_linenumber % 2 = 0 THEN CAST(0 AS DECIMAL(18,4))
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,4))
                   - CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(18,4)) AS DECIMAL(18,4))
                   - CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_tax AS DECIMAL(18,4)) AS DECIMAL(18,4))
              AS DECIMAL(18,4)) END AS principal_amount,
    CASE WHEN l_returnflag = 'N' AND l_linenumber % 2 = 0 THEN CAST(0 AS DECIMAL(18,4))
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(18,4)) AS DECIMAL(18,4)) END AS interest_amount,
    CASE WHEN l_returnflag = 'N' AND l_linenumber % 2 = 0 THEN CAST(0 AS DECIMAL(18,4))
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_tax AS DECIMAL(18,4)) AS DECIMAL(18,4)) END AS tax_amount,
    CAST(0 AS DECIMAL(18,4)) AS fee_amount
  FROM lineitem
),
payments AS (
  SELECT
    l_orderkey * 10000000 + l_linenumber * 1000000 + (l_suppkey * 20011 + l_partkey) % 1000000 AS id,
    CAST(l_orderkey % 5 + 1 AS INTEGER) AS company_id,
    CASE WHEN (l_orderkey + l_linenumber * 3 + l_suppkey) % 10 < 8 THEN CAST(l_orderkey AS VARCHAR) END AS borrower_contract_id,
    CASE WHEN (l_orderkey + l_linenumber * 3 + l_suppkey) % 10 < 8 AND l_partkey % 17 <> 0
         THEN CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS borrower_installment_reference,
    CASE WHEN (l_orderkey + l_linenumber * 3 + l_suppkey) % 10 < 8 AND l_partkey % 53 <> 0
         THEN CAST(CAST(l_shipdate AS DATE) + CAST(l_partkey % 31 - 5 AS INTEGER) AS DATE) END AS payment_date,
    CAST(CASE WHEN (l_orderkey + l_linenumber * 3 + l_suppkey) % 10 < 8 THEN CASE l_suppkey % 8
           WHEN 0 THEN CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(0.5 AS DECIMAL(2,1))
           WHEN 1 THEN CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(1.25 AS DECIMAL(3,2))
           WHEN 2 THEN CAST(l_extendedprice AS DECIMAL(18,4)) - CAST(0.5 AS DECIMAL(3,2))
           WHEN 3 THEN CAST(l_extendedprice AS DECIMAL(18,4)) * 2
           WHEN 4 THEN CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(-0.1 AS DECIMAL(2,1))
           ELSE CAST(l_extendedprice AS DECIMAL(18,4)) END END AS DECIMAL(18,4)) AS total_payment
  FROM lineitem
),
loan_tape AS (
  SELECT
    CAST(o_orderkey AS VARCHAR) AS borrower_contract_id,
    (['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'])[CAST(o_orderkey % 5 + 1 AS INTEGER)] AS company_code,
    CAST(o_orderkey % 5 + 1 AS INTEGER) AS company_id,
    CAST(o_totalprice AS DECIMAL(18,6)) AS original_principal,
    CAST(o_orderkey % 36 + 1 AS INTEGER) AS num_installments,
    CASE WHEN o_custkey % 11 = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE CAST(CAST(0.06 AS DECIMAL(3,2)) * (o_custkey % 5 + 1) AS DOUBLE) END AS interest_rate,
    CAST(o_orderdate AS DATE) AS first_installment_date,
    CASE substr(o_orderpriority, 1, 1)
      WHEN '1' THEN ' Mensual ' WHEN '2' THEN 'quincenal' WHEN '3' THEN 'W' WHEN '5' THEN 'daily'
      ELSE NULL END AS periodicity
  FROM orders
)"""


# --- request messages derived from the tables ----------------------------------

REQUEST_ORIGIN = "PORTFOLIO_DESK"
SERVICE_NAME = "ARREARS_SERVICE"


def order_requests(spark: SparkSession, sf_dir: str, tapes: str = "/data/loans", outputs: str = "/data/out") -> DataFrame:
    """One request body per order, with the faults the validator must catch.

    Products by order status (F: dpd+total_amount, O: dpd+vpn, else an
    unknown product), rate type by priority digit (5: invalid, 4: omitted,
    3: variable), no discount rate for every fourth customer, a 0.8 paid
    threshold for every seventh order, target ids as text for every third
    customer, and every 101st body cut short.
    """
    o = _read(spark, sf_dir, "orders")
    digit = F.substring("o_orderpriority", 1, 1)
    company = _company_code(F.col("o_orderkey"))
    products = (
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("dpd"), F.lit("total_amount")))
        .when(F.col("o_orderstatus") == "O", F.array(F.lit("dpd"), F.lit("vpn")))
        .otherwise(F.array(F.lit("dpd"), F.lit("npv")))
    )
    rate_type = (
        F.when(digit == "5", F.lit("floating")).when(digit == "4", F.lit(None))
        .when(digit == "3", F.lit("variable")).otherwise(F.lit("fixed"))
    )
    meta = F.struct(
        products.alias("products"),
        F.when(F.col("o_custkey") % 4 == 0, F.lit(None))
        .otherwise((F.lit(0.01).cast("decimal(3,2)") * (F.col("o_custkey") % 20)).cast("double"))
        .alias("interest_rate"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(0.8)).alias("paid_threshold"),
    )
    body = F.to_json(
        F.struct(
            F.lit(REQUEST_ORIGIN).alias("origin"),
            F.lit(SERVICE_NAME).alias("target"),
            F.concat(F.lit("job-"), F.col("o_orderkey").cast("string")).alias("job_id"),
            F.concat(F.lit(f"{tapes}/"), company, F.lit(".parquet")).alias("input_file"),
            F.concat(F.lit(f"{outputs}/"), company, F.lit(".parquet")).alias("output_file"),
            F.lit("borrower_contract_id").alias("key"),
            F.lit("COMPANY").alias("target_type"),
            (F.col("o_orderkey") % 5 + 1).cast("string").alias("target_id"),
            rate_type.alias("rate_type"),
            meta.alias("metadata"),
        )
    )
    body = F.when(F.col("o_custkey") % 3 == 0, body).otherwise(
        F.regexp_replace(body, '"target_id":"([0-9]+)"', '"target_id":$1')
    )
    cut = F.expr("substring(__b, 1, length(__b) - 7)")
    return (
        o.select("o_orderkey", body.alias("__b"))
        .select(F.when(F.col("o_orderkey") % 101 == 0, cut).otherwise(F.col("__b")).alias("body"))
    )


#: Contract ids of the shared-id portfolio repeat across companies.
SHARED_IDS = 999


def shared_id(df: DataFrame) -> DataFrame:
    """The same rows with contract ids that are only unique within a company."""
    return df.withColumn("borrower_contract_id", (F.col("borrower_contract_id").cast("long") % SHARED_IDS).cast("string"))


# The same in SQL: company and id in one text, split again by the oracles.
SHARED_ORACLE_CTES = (
    ORACLE_CTES.replace(
        "CAST(l_orderkey AS VARCHAR) AS borrower_contract_id",
        "(['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'])[CAST(l_orderkey % 5 + 1 AS INTEGER)] || ':' || "
        f"CAST(l_orderkey % {SHARED_IDS} AS VARCHAR) AS borrower_contract_id")
    .replace(
        "THEN CAST(l_orderkey AS VARCHAR) END AS borrower_contract_id",
        "THEN (['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'])[CAST(l_orderkey % 5 + 1 AS INTEGER)] || ':' || "
        f"CAST(l_orderkey % {SHARED_IDS} AS VARCHAR) END AS borrower_contract_id")
    .replace(
        "CAST(o_orderkey AS VARCHAR) AS borrower_contract_id",
        "(['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'])[CAST(o_orderkey % 5 + 1 AS INTEGER)] || ':' || "
        f"CAST(o_orderkey % {SHARED_IDS} AS VARCHAR) AS borrower_contract_id")
)
