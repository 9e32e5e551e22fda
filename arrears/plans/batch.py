"""A request batch as one job: every output of the batch from one plan and one write.

``plans.service`` serves one unit after the other, each into its own versioned
folder.  Here all units of a batch are rows: their tapes are read together, units
without a stored schedule get theirs generated in the same plan, and all outputs
are written at once, a folder for each under the batch.  The number of Spark jobs
does not depend on the number of outputs.

A batch writes, replacing what the same batch wrote before:

* ``<out>/batch=<id>/unit=<u>``: the enriched tapes, with lineage;
* ``<out>-units/batch=<id>``: a row per unit with its output file, products, and the reason if it was not served;
* ``<out>-state``: the high-watermarks of lateness by output and contract, a delta per batch;
* rejects and responses as ``plans.service`` does.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.config import CONTRACT, GENERATION_COLUMNS
from arrears.operators.batch import enrich_units, write_units
from arrears.operators.schedule import generate_schedule, loan_terms, schedule_gate
from arrears.plans.service import PortfolioSources, _freshness, units
from arrears.sources.loan_tape import file_format
from arrears.sources.state import append_watermarks, read_watermarks
from arrears.streaming.requests import build_responses, parse_requests, split_valid, validate_requests

STATE_KEYS = ("unit", CONTRACT)


def batch_units(valid: DataFrame, company_map: DataFrame | None = None) -> DataFrame:
    """A row per output: ``unit`` (a name for it), the last request's tape and parameters, and its company's code."""
    u = units(valid)
    last = u.groupBy("output_file").agg(F.max_by(F.struct(*[c for c in u.columns if c != "output_file"]), "at").alias("u"), F.max("highest_share").alias("highest"))
    u = last.select("output_file", "u.*", "highest").drop("highest_share", "at").withColumnRenamed("highest", "highest_share")
    u = u.withColumn("unit", F.substring(F.sha2("output_file", 256), 1, 24))
    own = F.col("target_id").cast("string")
    if company_map is None:
        return u.withColumn("company_code", own)
    codes = company_map.select(F.col("company_id").cast("int").alias("target_id"), F.col("company_code").alias("__code"))
    return u.join(codes, "target_id", "left").withColumn("company_code", F.coalesce("__code", own)).drop("__code")


def _qualified(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString() if fs.exists(p) else None


def read_tapes(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, dict[str, str]]:
    """All tapes as one table with ``__tape`` (the path as asked for), and for each that cannot be read the reason.

    Parquet tapes are read together with their columns merged; each other file is a read of its own in the same plan.
    A tape's own column ``unit`` is called ``tape_unit``.
    """
    found = {p: _qualified(spark, p) for p in paths}
    missing = {p: "the loan tape does not exist" for p, q in found.items() if q is None}
    parts = []
    together = {q: p for p, q in found.items() if q and file_format(p) == "parquet"}
    if together:
        rows = spark.read.option("mergeSchema", True).parquet(*together)
        name = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")  # noqa: E731  file:///a and file:/a are one
        names = spark.createDataFrame([(q, p) for q, p in together.items()], "__q string, __tape string").withColumn("__q", name(F.col("__q")))
        file = name(F.col("_metadata.file_path"))
        columns = rows.columns
        rows = rows.select("*", F.explode(F.array(file, F.regexp_replace(file, "/[^/]*$", ""))).alias("__q"))  # a file, or a folder of files
        parts.append(rows.join(names, "__q").select(*columns, "__tape"))
    for p, q in found.items():
        if q and file_format(p) != "parquet":
            parts.append(spark.read.option("header", True).csv(p).withColumn("__tape", F.lit(p)))
    if not parts:
        return None, missing
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.withColumnRenamed("unit", "tape_unit"), missing


def serve_batch(spark: SparkSession, bodies: DataFrame, src: PortfolioSources, as_of: _dt.date, now: _dt.datetime, service_name: str,
                out_path: str, rejects_path: str, responses_path: str, batch_id: int | str = 0, mode: str = "cascade", grace: int = 1) -> str:
    """Parse, validate, serve and answer a batch of request bodies in one plan; returns the folder of its outputs.

    The driver holds a row per output, never requests or loans.  ``src.payments`` carries company_id.
    """
    out_path, rejects_path, responses_path = (p.rstrip("/") for p in (out_path, rejects_path, responses_path))
    parsed = validate_requests(parse_requests(bodies)).persist()
    try:
        valid, rejected = split_valid(parsed)
        gate = schedule_gate(batch_units(valid, src.company_map), src.schedule.select("company_code"))
        todo = gate.collect()  # a row per output
        tapes, missing = read_tapes(spark, sorted({r["input_file"] for r in todo}))
        failure = {}
        for r in todo:
            if r["input_file"] in missing:
                failure[r["unit"]] = missing[r["input_file"]]
            elif r["key"] not in tapes.columns:
                failure[r["unit"]] = f"the loan tape has no column {r['key']}"
            elif r["decision"] == "reject":
                failure[r["unit"]] = f"company {r['target_id']}: no schedule and rate_type 'variable'; the schedule must be loaded before the request"
        rows = [(*[r[c] for c in gate.columns], failure.get(r["unit"])) for r in todo]
        held = spark.createDataFrame(rows, gate.withColumn("failure", F.lit(None).cast("string")).schema)
        held.write.mode("overwrite").parquet(f"{out_path}-units/batch={batch_id}")
        served = held.where("failure is null")
        target = f"{out_path}/batch={batch_id}"
        if len(failure) < len(todo):
            keys = sorted({r["key"] for r in todo if r["unit"] not in failure})
            named = served.select("unit", F.col("input_file").alias("__tape"), F.col("key").alias("__key"), F.col("decision").alias("__decision"), F.col("company_code").alias("__code"))
            loans = tapes.join(named, "__tape")
            loans = loans.withColumn("__contract", F.coalesce(*[F.when(F.col("__key") == k, F.col(k).cast("string")) for k in keys]))
            schedule, bad = src.schedule, None
            if any(r["decision"] == "generate" and r["unit"] not in failure for r in todo):
                # A contract of several units of one company is generated once.
                terms = [c for c in GENERATION_COLUMNS if c != CONTRACT]
                new = loans.where("__decision = 'generate'").select(F.col("__contract").alias(CONTRACT), F.col("__code").alias("company_code"),
                                                                  *[F.col(c) if c in loans.columns else F.lit(None).cast("string").alias(c) for c in terms])
                new = new.dropDuplicates([CONTRACT, "company_code"])
                schedule = schedule.unionByName(generate_schedule(new), allowMissingColumns=True)
                bad = loan_terms(new).where(F.size("errors") > 0).select(F.col(CONTRACT).alias("__contract"), F.col("company_code").alias("__code"), F.lit(True).alias("__bad"))
                bad = bad.where("__contract is not null").distinct()
            pays = src.payments.where(F.col("payment_date").isNotNull() & (F.col("total_payment") > 0))
            if src.company_map is None:
                pays = pays.withColumn("company_code", F.col("company_id").cast("string"))
            else:
                pays = pays.join(src.company_map.select("company_id", "company_code"), "company_id")
            state = read_watermarks(spark, f"{out_path}-state", STATE_KEYS)
            previous = state.withColumnRenamed(CONTRACT, "__contract") if state is not None else None
            tape = loans.select("unit", "__contract", "__decision", "__code", *[c for c in tapes.columns if c != "__tape"])
            out = enrich_units(served, tape, schedule, pays, as_of, grace, mode, previous, key="__contract")
            if bad is not None:  # loans that could not be generated have no products, but keep their high-watermark
                out = out.join(bad, ["__contract", "__code"], "left")
                gone = F.coalesce(F.col("__bad") & (F.col("__decision") == "generate"), F.lit(False))
                out = out.withColumns({c: F.when(gone, F.lit(None)).otherwise(F.col(c)) for c in ("dpd_current", "amount_in_arrears", "total_amount_paid", "vpn")}).drop("__bad")
            jobs = served.select("unit", F.col("job_id").alias("payment_tape_ref"))
            out = out.drop("__decision", "__code").withColumn("last_update_date", F.lit(now.isoformat())).join(F.broadcast(jobs), "unit")  # a row per output
            target = write_units(out, out_path, batch_id)
            written = spark.read.schema(out.schema).parquet(target)
            append_watermarks(written.withColumn(CONTRACT, F.col("__contract")), f"{out_path}-state", batch_id, STATE_KEYS)
        reasons = held.select("output_file", "failure")
        answers = valid.join(reasons, "output_file")
        rejects = rejected.select("body", "job_id", F.array_join("errors", "; ").alias("errors")).unionByName(
            answers.where("failure is not null").select("body", "job_id", F.col("failure").alias("errors")))
        rejects.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        fresh = _freshness(spark, src, sorted({r["target_id"] for r in todo if r["unit"] not in failure}))
        build_responses(answers.where("failure is null").drop("failure"), fresh, service_name).write.mode("overwrite").parquet(f"{responses_path}/batch={batch_id}")
        return target
    finally:
        parsed.unpersist()


def read_output(spark: SparkSession, out_path: str, output_file: str, batch_id: int | str = 0) -> DataFrame:
    """One output of a batch with the columns that its request asked for."""
    out_path = out_path.rstrip("/")
    unit = spark.read.parquet(f"{out_path}-units/batch={batch_id}").where((F.col("output_file") == output_file) & F.col("failure").isNull()).first()
    if unit is None:
        raise ValueError(f"batch {batch_id} has no output {output_file}")
    of = {"dpd_current": "dpd", "dpd_max": "dpd", "amount_in_arrears": "dpd", "total_amount_paid": "total_amount", "vpn": "vpn"}
    df = spark.read.parquet(f"{out_path}/batch={batch_id}").where(F.col("unit") == unit["unit"])
    return df.drop("unit", "__contract", *[c for c, p in of.items() if p not in unit["products"]])
