"""Schemas of the three input tables, the request messages and the outputs."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
PRINCIPAL = T.DecimalType(18, 6)
WIDE_PRINCIPAL = T.DecimalType(26, 6)
RATE = T.DecimalType(19, 18)

SCHEDULE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("company_code", T.StringType()),
        T.StructField("borrower_contract_id", T.StringType()),
        T.StructField("borrower_installment_reference", T.StringType()),
        T.StructField("installment_date", T.DateType()),
        T.StructField("gross_amount", MONEY),
        T.StructField("guarantee_amount", MONEY),
        T.StructField("principal_amount", MONEY),
        T.StructField("interest_amount", MONEY),
        T.StructField("tax_amount", MONEY),
        T.StructField("fee_amount", MONEY),
    ]
)

# Generated instalments as stored.
SCHEDULE_STORED = T.StructType(
    [*SCHEDULE.fields[:4], T.StructField("installment_number", T.IntegerType()), *SCHEDULE.fields[4:]]
)

PAYMENTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("company_id", T.IntegerType()),
        T.StructField("borrower_contract_id", T.StringType()),
        T.StructField("borrower_installment_reference", T.StringType()),
        T.StructField("payment_date", T.DateType()),
        T.StructField("total_payment", MONEY),
    ]
)

REQUEST_METADATA = T.StructType(
    [
        T.StructField("products", T.ArrayType(T.StringType())),
        T.StructField("interest_rate", T.DoubleType()),
        T.StructField("paid_threshold", T.DoubleType()),
        T.StructField("last_payment_tape_date", T.StringType()),
        T.StructField("last_schedule_payment_date", T.StringType()),
        T.StructField("last_payment_date", T.StringType()),
    ]
)

# ``target_id`` is read as text and converted with try_cast: the protocol
# accepts both 42 and "42".
REQUEST = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("input_file", T.StringType()),
        T.StructField("output_file", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("target_type", T.StringType()),
        T.StructField("target_id", T.StringType()),
        T.StructField("rate_type", T.StringType()),
        T.StructField("metadata", REQUEST_METADATA),
    ]
)
