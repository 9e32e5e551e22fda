"""Registered queries: each reads the driver tables through the loan mapping.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame; names and
column aliases match the SQL oracles in :mod:`arrears.plans.oracle`.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.config import CONTRACT, CURRENT_REPORT_COLUMN, HISTORY_REPORT_COLUMN, SCHEDULE_BUCKETS, Cutoff
from arrears.operators import allocate as A
from arrears.operators import products as P
from arrears.operators import reports as R
from arrears.operators.clean import sanitize_schedule
from arrears.sources import tables, testdata as TD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query | None = None, *, name: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        return f

    return register(fn) if fn is not None else register


def cfg(**kw) -> Cutoff:
    return Cutoff(as_of=TD.CALC_DATE, **kw)


def _sched(spark, sf_dir):
    return sanitize_schedule(TD.schedule(spark, sf_dir))


def _pays(spark, sf_dir):
    return TD.payments(spark, sf_dir)


_ALLOC_COLS = [CONTRACT, "id", "installment_date", "gross_amount"]


def _alloc(spark, sf_dir, mode, amount_col, **kw):
    out = A.allocate(_sched(spark, sf_dir), _pays(spark, sf_dir), cfg(**kw), mode)
    return out.select(*_ALLOC_COLS, amount_col, "dpd_current", "amount_in_arrears")


# --- scans ---------------------------------------------------------------


@query
def scan_schedule(spark, sf_dir):
    return tables.read_schedule(TD.schedule(spark, sf_dir), company_code="BUILDING")


@query
def scan_payments(spark, sf_dir):
    return tables.read_payments(TD.payments(spark, sf_dir), company_id=2)


@query
def scan_payments_all(spark, sf_dir):
    """Payments of all companies, each with the last payment date of its company."""
    return tables.read_payments(TD.payments(spark, sf_dir))


# --- allocation ------------------------------------------------------------


@query
def dpd_cascade(spark, sf_dir):
    return _alloc(spark, sf_dir, "cascade", "applied_amount")


@query
def dpd_cascade_partial(spark, sf_dir):
    return _alloc(spark, sf_dir, "cascade", "applied_amount", any_payment_counts=True)


@query
def dpd_cascade_threshold80(spark, sf_dir):
    return _alloc(spark, sf_dir, "cascade", "applied_amount", paid_share=0.8)


@query
def dpd_cascade_grace5(spark, sf_dir):
    return _alloc(spark, sf_dir, "cascade", "applied_amount", grace=5)


@query
def dpd_join(spark, sf_dir):
    return _alloc(spark, sf_dir, "join", "paid_amount")


@query
def cascade_components(spark, sf_dir):
    """What each component of an instalment got from the contract's payments."""
    out = A.cascade_components(_sched(spark, sf_dir), _pays(spark, sf_dir), cfg())
    return out.select(CONTRACT, "id", "applied_amount", *[A.applied_column(b) for b in SCHEDULE_BUCKETS])


@query
def payments_by_ref(spark, sf_dir):
    return A.paid_by_reference(_pays(spark, sf_dir), cfg())


# --- products --------------------------------------------------------------


def _loans(spark, sf_dir):
    return TD.loan_tape(spark, sf_dir)


@query
def product_dpd(spark, sf_dir):
    return P.enrich(_loans(spark, sf_dir), CONTRACT, ["dpd"], cfg(), _sched(spark, sf_dir), _pays(spark, sf_dir))


@query
def product_total_amount(spark, sf_dir):
    return P.enrich(_loans(spark, sf_dir), CONTRACT, ["total_amount"], cfg(), payments=_pays(spark, sf_dir))


@query
def product_vpn(spark, sf_dir):
    return P.enrich(_loans(spark, sf_dir), CONTRACT, ["vpn"], cfg(), schedule=_sched(spark, sf_dir),
                    interest_rate=TD.INVESTOR_RATE)


@query
def product_vpn_zero_rate(spark, sf_dir):
    return P.enrich(_loans(spark, sf_dir), CONTRACT, ["vpn"], cfg(), schedule=_sched(spark, sf_dir),
                    interest_rate=None)


# --- detail and summary ----------------------------------------------------


@query
def detail_both(spark, sf_dir):
    return R.detail(_sched(spark, sf_dir), _pays(spark, sf_dir), cfg())


@query
def summary_both(spark, sf_dir):
    return R.summary(R.detail(_sched(spark, sf_dir), _pays(spark, sf_dir), cfg(), with_contract_max=False))


# --- cleaning --------------------------------------------------------------


def _raw_date(column: str):
    """ISO or month-first text; some days that do not exist month first, some that are no date."""
    d = F.col(column)
    return (
        F.when(F.col("id") % 97 == 0, F.lit("n/a"))
        .when(F.col("id") % 89 == 0, F.date_format(d, "'13'/dd/yyyy"))
        .when(F.col("id") % 3 == 0, F.date_format(d, "MM/dd/yyyy"))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )


def raw_schedule(spark, sf_dir):
    """The schedule as a spreadsheet would deliver it: text dates (ISO, month first, some bad), numeric
    references (some NaN), float gross, amounts as text (some not numbers), null fees, no guarantee column."""
    s = TD.schedule(spark, sf_dir)
    return s.select(
        "id",
        "company_code",
        "borrower_contract_id",
        _raw_date("installment_date").alias("date"),
        F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise((F.col("id") % 100000).cast("double"))
        .alias("borrower_installment_reference"),
        F.when(F.col("id") % 101 == 0, F.lit(float("nan"))).otherwise(F.col("gross_amount").cast("double")).alias("gross_amount"),
        F.when(F.col("id") % 23 == 0, F.lit("pending")).otherwise(F.concat(F.lit(" "), F.col("principal_amount").cast("string")))
        .alias("principal_amount"),
        "interest_amount",
        "tax_amount",
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("fee_amount")).alias("fee_amount"),
    )


@query(name="sanitize_schedule")
def sanitize_schedule_raw(spark, sf_dir):
    return sanitize_schedule(raw_schedule(spark, sf_dir))


@query
def schedule_position_ids(spark, sf_dir):
    """A schedule file in which a third of the ids are missing: these are the rows' places in the file."""
    from arrears.operators.position import file_positions

    li = file_positions(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"))
    raw = li.select(
        "position",
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").cast("string").alias(CONTRACT),
        F.col("l_shipdate").cast("date").alias("installment_date"),
        F.col("l_extendedprice").alias("gross_amount"),
    )
    return sanitize_schedule(raw, position="position").select("id", CONTRACT, "installment_date", "gross_amount")


@query
def sanitize_payments(spark, sf_dir):
    """A payment tape with all faults: references in a column without a header, text dates and amounts."""
    from arrears.operators.clean import sanitize_payments as sanitize

    p = TD.payments(spark, sf_dir)
    raw = p.select(
        "id", "company_id", "borrower_contract_id",
        _raw_date("payment_date").alias("payment_date"),
        F.when(F.col("id") % 19 == 0, F.lit("??")).otherwise(F.col("total_payment").cast("string")).alias("total_payment"),
        F.lit(None).cast("string").alias("borrower_installment_reference"),
        F.lit("x").alias("_corrupt_record"),
        F.lit(None).cast("string").alias("_c5"),
        F.col("borrower_installment_reference").alias("_c6"),
    )
    return sanitize(raw).drop("_c5", "_c6", "_corrupt_record")


@query
def bucket_fallback(spark, sf_dir):
    from arrears.operators.clean import needs_fallback

    s = TD.schedule(spark, sf_dir)
    return s.groupBy("company_code").agg(
        F.count_if(needs_fallback()).alias("filled_rows"),
        F.sum(F.when(needs_fallback(), F.col("gross_amount"))).cast("decimal(18,4)").alias("filled_gross"),
    )


@query
def rescue_reference(spark, sf_dir):
    from arrears.operators.clean import rescue_reference as rescue

    p = TD.payments(spark, sf_dir)
    raw = p.select(
        "id", "borrower_contract_id", "payment_date", "total_payment",
        F.lit(None).cast("string").alias("borrower_installment_reference"),
        F.col("borrower_installment_reference").alias("_c5"),
    )
    return rescue(raw).drop("_c5")


# --- reports -----------------------------------------------------------------


@query
def freshness_dates(spark, sf_dir):
    return R.freshness(TD.schedule(spark, sf_dir), TD.payments(spark, sf_dir), company_map=TD.company_map(spark))


BEFORE = {"previous_dpd": Cutoff(as_of=TD.PREVIOUS_CALC_DATE)}


def _instalment_dpd_history(spark, sf_dir):
    """Per-instalment dpd_current at the cut-off and dpd_max over the previous and current runs (one allocation)."""
    now = A.cascade(_sched(spark, sf_dir), _pays(spark, sf_dir), cfg(), BEFORE)
    return now.withColumn("dpd_max", F.greatest("dpd_current", "previous_dpd"))


@query
def current_dpd_by_contract(spark, sf_dir):
    return R.ranked_by_contract(A.cascade(_sched(spark, sf_dir), _pays(spark, sf_dir), cfg()), "dpd_current",
                                CURRENT_REPORT_COLUMN)


@query
def max_dpd_by_contract(spark, sf_dir):
    return R.ranked_by_contract(_instalment_dpd_history(spark, sf_dir), "dpd_max", HISTORY_REPORT_COLUMN)


@query
def run_counters(spark, sf_dir):
    return R.run_counters(R.detail(_sched(spark, sf_dir), _pays(spark, sf_dir), cfg(), with_contract_max=False))


# --- enrichment --------------------------------------------------------------

JOB_ID = "job-0001"
UPDATED_AT = datetime.datetime(1998, 7, 1, 6, 0, tzinfo=datetime.timezone.utc)


@query
def dpd_max_history(spark, sf_dir):
    return P.enrich(_loans(spark, sf_dir), CONTRACT, ["dpd"], cfg(), _sched(spark, sf_dir), _pays(spark, sf_dir),
                    also=list(BEFORE.values()))


@query
def enrich_loan_tape(spark, sf_dir):
    out = P.enrich(
        _loans(spark, sf_dir), CONTRACT, ["vpn", "dpd", "total_amount"], cfg(),
        _sched(spark, sf_dir), _pays(spark, sf_dir), interest_rate=TD.INVESTOR_RATE, also=list(BEFORE.values()),
    )
    return P.with_lineage(out, JOB_ID, UPDATED_AT)


def _shared(spark, sf_dir):
    """Loans, schedule and payments of a portfolio whose contract ids repeat across companies."""
    pays = tables.with_company_code(TD.shared_id(_pays(spark, sf_dir)), TD.company_map(spark))
    return TD.shared_id(_loans(spark, sf_dir)), TD.shared_id(_sched(spark, sf_dir)), pays


SHARED_KEYS = ("company_code", CONTRACT)


@query
def portfolio_enrichment(spark, sf_dir):
    """Products of a portfolio-wide run under the composite contract key."""
    loans, s, p = _shared(spark, sf_dir)
    return P.enrich(loans, CONTRACT, ["vpn", "dpd", "total_amount"], cfg(contract_keys=SHARED_KEYS), s, p,
                    interest_rate=TD.INVESTOR_RATE, also=list(BEFORE.values()))


@query
def portfolio_summary_with_cases(spark, sf_dir):
    """Summary and case labels of a portfolio-wide run under the composite contract key."""
    from arrears.operators.classify import attach_cases, classify_contracts as classify

    _, s, p = _shared(spark, sf_dir)
    summ = R.summary(R.detail(s, p, cfg(contract_keys=SHARED_KEYS), with_contract_max=False), keys=SHARED_KEYS)
    return attach_cases(summ, classify(s, p, TD.CALC_DATE, SHARED_KEYS), keys=SHARED_KEYS)


def _branch(df, key: str = CONTRACT):
    """Every order is a branch of its own; some have no line items, so no schedule."""
    return df.withColumn("company_code", F.concat(F.lit("B"), F.col(key).cast("string")))


@query
def companies_without_schedule(spark, sf_dir):
    from arrears.operators.schedule import loans_without_schedule

    return loans_without_schedule(_branch(_loans(spark, sf_dir)), _branch(TD.schedule(spark, sf_dir)))


# --- schedule generation -----------------------------------------------------


@query
def period_rate(spark, sf_dir):
    from arrears.operators.schedule import loan_terms

    t = loan_terms(_loans(spark, sf_dir))
    return t.select(CONTRACT, "periodicity", F.col("period_rate").cast("decimal(19,18)").alias("period_rate"))


@query
def level_payment(spark, sf_dir):
    from arrears.operators.schedule import level_payment as pmt, loan_terms

    t = loan_terms(_loans(spark, sf_dir)).where(F.size("errors") == 0)
    payment = pmt(F.col("principal"), F.col("period_rate"), F.col("num_installments"))
    return t.select(CONTRACT, payment.cast("decimal(18,2)").alias("payment"))


@query
def due_dates(spark, sf_dir):
    from arrears.functions.dates import due_date
    from arrears.operators.schedule import loan_terms

    t = loan_terms(_loans(spark, sf_dir)).where((F.size("errors") == 0) & (F.col("num_installments") >= 1))
    steps = t.select(CONTRACT, "first_installment_date", "periodicity",
                     F.explode(F.sequence(F.lit(1), F.col("num_installments"))).alias("installment_number"))
    return steps.select(CONTRACT, "installment_number",
                        due_date("first_installment_date", "periodicity", F.col("installment_number") - 1)
                        .alias("installment_date"))


def messy_loans(spark, sf_dir):
    """Loan tape with the faults generation must reject (terms, principals, rates, dates) and some
    ten-year daily loans."""
    lt = _loans(spark, sf_dir)
    k = F.col("borrower_contract_id").cast("long")
    long = k % 499 == 7
    return lt.withColumns({
        "num_installments": F.when(long, F.lit(3650)).when(k % 41 == 0, F.lit(-3)).otherwise((k % 36).cast("int")),
        "periodicity": F.when(long, F.lit("diario")).otherwise(F.col("periodicity")),
        "original_principal": F.when(k % 97 == 0, F.lit(None)).when(k % 89 == 0, F.lit("2500000000000"))
        .otherwise(F.col("original_principal").cast("string")),
        "interest_rate": F.when(k % 83 == 0, F.lit(-1.5)).when(k % 79 == 0, F.lit(float("nan"))).otherwise(F.col("interest_rate")),
        "first_installment_date": F.when(k % 73 != 0, F.col("first_installment_date")),
    })


@query
def generate_schedule(spark, sf_dir):
    from arrears.operators.schedule import generate_schedule as gen

    return gen(messy_loans(spark, sf_dir)).drop("id")


@query
def schedule_rejects(spark, sf_dir):
    from arrears.operators.schedule import schedule_rejects as rejects

    return rejects(messy_loans(spark, sf_dir))


# --- classifier --------------------------------------------------------------


@query
def classify_contracts(spark, sf_dir):
    from arrears.operators.classify import classify_contracts as classify

    return classify(_sched(spark, sf_dir), _pays(spark, sf_dir), TD.CALC_DATE).select(CONTRACT, "case_label")


@query
def case_histogram(spark, sf_dir):
    from arrears.operators.classify import case_histogram as hist, classify_contracts as classify

    return hist(classify(_sched(spark, sf_dir), _pays(spark, sf_dir), TD.CALC_DATE))


# --- requests and the stream -------------------------------------------------

_PARSED = ["job_id", "malformed", "origin", "target", "input_file", "output_file", "key", "target_type",
           "target_id", "rate_type", "interest_rate", "paid_threshold"]


def _validated_orders(spark, sf_dir):
    from arrears.streaming.requests import parse_requests as parse, validate_requests as validate

    return validate(parse(TD.order_requests(spark, sf_dir)))


@query
def parse_requests(spark, sf_dir):
    from arrears.streaming.requests import parse_requests as parse

    p = parse(TD.order_requests(spark, sf_dir))
    return p.select(*_PARSED, F.array_join("products", ",").alias("products"))


@query
def validate_requests(spark, sf_dir):
    v = _validated_orders(spark, sf_dir)
    return v.select("job_id", "malformed", F.array_join("errors", "; ").alias("errors"),
                    F.array_join("warnings", "; ").alias("warnings"))


@query
def rejected_requests(spark, sf_dir):
    from arrears.streaming.requests import split_valid

    _, rejected = split_valid(_validated_orders(spark, sf_dir))
    return rejected.select("job_id", F.array_join("errors", "; ").alias("errors"))


@query
def dedup_requests(spark, sf_dir):
    from arrears.streaming.requests import dedup_requests as dedup

    bodies = TD.order_requests(spark, sf_dir)
    resent = bodies.where(F.length("body") % 3 == 0)  # every third body arrives twice
    return dedup(bodies.unionByName(resent)).select("body_hash", "body")


def _scratch(spark, name):
    import uuid

    from arrears.session import scratch_path

    return scratch_path(spark, "queries", f"{name}-{uuid.uuid4().hex[:12]}")


_RESPONSE = ("origin string, target string, job_id string, input_file string, output_file string, key string, target_type string, "
             "target_id int, metadata struct<products:array<string>,interest_rate:double,last_payment_tape_date:date,"
             "last_schedule_payment_date:date,last_payment_date:date>")


@query
def build_responses(spark, sf_dir):
    """Responses to the valid requests, their JSON read back into columns."""
    from arrears.streaming.requests import build_responses as respond, split_valid

    valid, _ = split_valid(_validated_orders(spark, sf_dir))
    fresh = R.freshness(TD.schedule(spark, sf_dir), TD.payments(spark, sf_dir), company_map=TD.company_map(spark))
    out = respond(valid, fresh.drop("company_code"), TD.SERVICE_NAME)
    r = out.select(F.inline(F.array(F.struct(F.from_json("body", _RESPONSE).alias("r"), F.col("attributes").alias("a")))))
    return r.select("r.origin", "r.target", "r.job_id", "r.input_file", "r.output_file", "r.key", "r.target_type", "r.target_id",
                    F.array_join("r.metadata.products", ",").alias("products"), "r.metadata.interest_rate",
                    "r.metadata.last_payment_tape_date", "r.metadata.last_schedule_payment_date", "r.metadata.last_payment_date",
                    F.col("a")["target"].alias("routed_to"))


@query
def response_records(spark, sf_dir):
    """Responses handed on by the publishing stream as key, value and headers, a replayed batch among them."""
    from arrears.streaming.requests import build_responses as respond, split_valid
    from arrears.streaming.service import publish_responses

    base = _scratch(spark, "publish")
    valid, _ = split_valid(_validated_orders(spark, sf_dir))
    fresh = R.freshness(TD.schedule(spark, sf_dir), TD.payments(spark, sf_dir), company_map=TD.company_map(spark))
    fresh.write.parquet(f"{base}/freshness")  # a row for each company, worked out once for both writes
    fresh = spark.read.parquet(f"{base}/freshness")
    answers = respond(valid, fresh.drop("company_code"), TD.SERVICE_NAME)
    for _ in range(2):  # the second time as a replay: new files, the same messages
        answers.write.mode("overwrite").parquet(f"{base}/responses/batch=0")
        publish_responses(spark, f"{base}/responses", f"{base}/checkpoint", "parquet", {"path": f"{base}/queue"}).awaitTermination()
    sent = spark.read.parquet(f"{base}/queue")
    of = lambda name: F.decode(F.filter("headers", lambda h: h["key"] == name)[0]["value"], "UTF-8")
    return sent.select("key", F.get_json_object("value", "$.target_id").cast("int").alias("target_id"), of("origin").alias("origin"),
                       of("target").alias("target"), F.size("headers").alias("n_headers"))


@query
def repeated_requests(spark, sf_dir):
    """Bodies that the stream serves and how often each is left out: all orders' requests, a third of them resent after a restart."""
    from arrears.streaming.requests import mark_repeats, no_idle_batches
    from arrears.streaming.service import REPEAT_WINDOW, request_stream

    base = _scratch(spark, "repeats")
    bodies = TD.order_requests(spark, sf_dir).select("body")
    for rows in (bodies, bodies.where(F.length("body") % 3 == 0)):
        rows.write.mode("append").text(f"{base}/requests")
        marked = mark_repeats(request_stream(spark, f"{base}/requests"), REPEAT_WINDOW)
        out = marked.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
        with no_idle_batches(spark):
            run = out.trigger(availableNow=True).start(f"{base}/marked")
        run.awaitTermination()
    seen = spark.read.parquet(f"{base}/marked")
    return seen.groupBy("body_hash").agg(F.count_if("served").alias("served"), F.sum("left_out").alias("left_out"))


@query
def requests_stream(spark, sf_dir):
    """The requests of all orders dropped as files and served by the stream: the enriched tapes it leaves."""
    from arrears.plans.service import PortfolioSources
    from arrears.sources.loan_tape import read_loan_tape
    from arrears.streaming.service import start_request_service

    base = _scratch(spark, "stream")
    loans = _loans(spark, sf_dir)
    for code in TD.COMPANIES:
        loans.where(F.col("company_code") == code).write.parquet(f"{base}/in/{code}.parquet")
    TD.order_requests(spark, sf_dir, f"{base}/in", f"{base}/out").write.text(f"{base}/requests")
    src = PortfolioSources(_sched(spark, sf_dir), _pays(spark, sf_dir), company_map=TD.company_map(spark))
    q = start_request_service(spark, f"{base}/requests", f"{base}/checkpoint", src, f"{base}/responses",
                              f"{base}/rejects", TD.SERVICE_NAME, as_of=TD.CALC_DATE)
    q.awaitTermination()
    cols = [CONTRACT, "company_code", "dpd_current", "dpd_max", "amount_in_arrears", "payment_tape_ref"]
    tapes = [read_loan_tape(spark, f"{base}/out/{code}.parquet").select(*cols) for code in TD.COMPANIES]
    return reduce(DataFrame.unionByName, tapes)


@query
def load_loan_tape(spark, sf_dir):
    """Loan tape written as CSV and read back by extension (types inferred)."""
    from arrears.sources.loan_tape import read_loan_tape

    path = _scratch(spark, "tape") + "/loan_tape.csv"
    _loans(spark, sf_dir).write.option("header", True).csv(path)
    return read_loan_tape(spark, path)


@query
def schedule_append_idempotent(spark, sf_dir):
    """A generated schedule appended by two batches, one of them twice: each instalment is stored once."""
    from arrears.operators.schedule import generate_schedule as gen
    from arrears.sources.loan_tape import append_schedule, read_schedule_table

    stored = _scratch(spark, "schedule_table")
    for batch in ("a", "b", "a"):
        append_schedule(gen(messy_loans(spark, sf_dir), company_code="ONE"), stored, "ONE", batch)
    return read_schedule_table(spark, stored).drop("id")


@query
def schedule_append_concurrent(spark, sf_dir):
    """Two writers append overlapping parts of a generated schedule at the same time: each instalment is stored once."""
    from concurrent.futures import ThreadPoolExecutor

    from arrears.operators.schedule import generate_schedule as gen
    from arrears.sources.loan_tape import append_schedule, read_schedule_table

    stored = _scratch(spark, "schedule_table")
    made = gen(messy_loans(spark, sf_dir), company_code="ONE")
    parts = {"a": made.where(F.col("installment_number") % 3 != 0), "b": made.where(F.col("installment_number") % 3 != 1)}
    with ThreadPoolExecutor(max_workers=2) as pool:
        for done in [pool.submit(append_schedule, rows, stored, "ONE", name) for name, rows in parts.items()]:
            done.result()
    return read_schedule_table(spark, stored, "ONE").drop("id")


@query
def summary_with_cases(spark, sf_dir):
    """Run summary with each contract's case label attached."""
    from arrears.operators.classify import attach_cases, classify_contracts as classify

    s, p = _sched(spark, sf_dir), _pays(spark, sf_dir)
    summ = R.summary(R.detail(s, p, cfg(), with_contract_max=False))
    return attach_cases(summ, classify(s, p, TD.CALC_DATE))


@query
def detail_with_cases(spark, sf_dir):
    """Detail rows of a whole run with each contract's case label attached."""
    from arrears.plans.run import run_tables

    d, _ = run_tables(TD.schedule(spark, sf_dir), TD.payments(spark, sf_dir), TD.CALC_DATE, cases=True)
    return d


@query
def generation_gate(spark, sf_dir):
    """Per branch request: use the stored schedule, generate one (fixed rate) or reject (variable)."""
    from arrears.operators.schedule import schedule_gate

    requests = _branch(_loans(spark, sf_dir)).select(
        "company_code", F.when(F.col("num_installments") % 2 == 0, F.lit("variable")).otherwise(F.lit("fixed")).alias("rate_type"))
    return schedule_gate(requests, _branch(TD.schedule(spark, sf_dir)))


@query
def export_detail_summary(spark, sf_dir):
    """Detail and summary written side by side; both parts read back."""
    from arrears.plans.run import run_detail_summary

    base = _scratch(spark, "export")
    TD.schedule(spark, sf_dir).write.parquet(f"{base}/schedule.parquet")
    TD.payments(spark, sf_dir).write.parquet(f"{base}/payments.parquet")
    run_detail_summary(spark, f"{base}/schedule.parquet", f"{base}/payments.parquet", f"{base}/out", as_of=TD.CALC_DATE)
    part = lambda name, **more: spark.read.parquet(f"{base}/out/{name}").select(
        F.lit(name).alias("part"), CONTRACT, *[c.alias(k) for k, c in more.items()])
    d = part("detail", id=F.col("id"), cuotas=F.lit(None).cast("long"), cascade_dpd=F.col("cascade_dpd"), cascade_arrears=F.col("cascade_arrears"),
             join_dpd=F.col("join_dpd"), join_arrears=F.col("join_arrears"))
    s = part("summary", id=F.lit(None).cast("long"), cuotas=F.col("cuotas"), cascade_dpd=F.col("cascade_dpd_max"),
             cascade_arrears=F.col("cascade_arrears_total"), join_dpd=F.col("join_dpd_max"), join_arrears=F.col("join_arrears_total"))
    return d.unionByName(s)


@query
def bucket_mismatch(spark, sf_dir):
    """Data-quality count: instalments whose components do not add up to gross, per company."""
    from arrears.operators.clean import component_mismatch

    s = _sched(spark, sf_dir)
    return s.groupBy("company_code").agg(
        F.count(F.lit(1)).alias("instalments"),
        F.count_if(component_mismatch()).alias("mismatched"),
    )


#: Outputs that the driver data's batch has for each company.
BATCH_OUTPUTS = 40


@query
def batch_enrichment(spark, sf_dir):
    """All units of a batch in one plan: each company's tape cut into ``BATCH_OUTPUTS`` outputs, with parameters of their own."""
    from arrears.operators.batch import enrich_units

    part = F.pmod(F.col(CONTRACT).cast("long"), F.lit(BATCH_OUTPUTS)).cast("int")
    tapes = _loans(spark, sf_dir).withColumn("part", part)
    tapes = tapes.withColumn("unit", F.concat("company_code", F.lit("/"), F.col("part").cast("string")))
    k = F.col("part") % 3
    products = F.when(k == 0, F.array(F.lit("dpd"))).when(k == 1, F.array(F.lit("dpd"), F.lit("total_amount"), F.lit("vpn"))).otherwise(F.array(F.lit("total_amount"), F.lit("vpn")))
    units = tapes.select("unit", "company_code", "part").distinct().select(
        "unit", "company_code", products.alias("products"),
        F.when(F.col("part") % 2 == 0, 0.8).otherwise(1.0).alias("paid_threshold"),
        F.when(F.col("part") % 4 == 0, 1.0).alias("highest_share"),
        F.when(F.col("part") % 5 != 0, (F.col("part") % 20) / F.lit(100.0)).alias("interest_rate"),
    )
    pays = tables.with_company_code(_pays(spark, sf_dir), TD.company_map(spark))
    out = enrich_units(units, tapes.select("unit", CONTRACT, "company_code"), _sched(spark, sf_dir), pays, TD.CALC_DATE)
    return out


@query
def dpd_max_state(spark, sf_dir):
    """The high-watermark table after batches of two cut-offs, one replayed and late, and a compaction between them."""
    from arrears.sources.state import append_watermarks, compact_watermarks, read_watermarks

    path = _scratch(spark, "watermarks")
    sched, pays = _sched(spark, sf_dir), _pays(spark, sf_dir)

    def run(as_of):
        late = A.allocate(sched, pays, Cutoff(as_of=as_of), "cascade")
        return late.groupBy("company_code", CONTRACT).agg(F.max("dpd_current").alias("dpd_max"))

    append_watermarks(run(TD.CALC_DATE), path, 2)
    append_watermarks(run(TD.PREVIOUS_CALC_DATE), path, 1)
    compact_watermarks(spark, path)
    append_watermarks(run(TD.PREVIOUS_CALC_DATE), path, 1)
    return read_watermarks(spark, path)
