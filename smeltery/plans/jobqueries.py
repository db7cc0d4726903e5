"""Registered queries that run the jobs: files into a new lake in the shared folder, results read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.dates import iso_utc
from smeltery.functions.numbers import cell_amount
from smeltery.operators import flags, ledger
from smeltery.operators.keys import IngestionError
from smeltery.plans import jobs, standin
from smeltery.plans.catalog import query
from smeltery.plans.oracle import ORACLE, job_twins
from smeltery.schemas import MEASURES
from smeltery.session import checkpoint_root
from smeltery.sources.tables import Lake
from smeltery.sources.workbook import WORKBOOK_ROWS, workbook_rows
from smeltery.streaming.discovery import ingest_stream

SOURCES = {1: "events", 2: "orders", 3: "events", 4: "mirror"}


def new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/jobs-{uuid.uuid4().hex}"


def ingest_files(spark: SparkSession, lake: Lake, sf_dir: str, files: tuple[int, ...]) -> None:
    """Each source file, written as CSV and ingested under its source."""
    for file_ord in files:
        folder = f"{lake.root}/in/{file_ord}"
        raw = standin.raw_batch(spark, sf_dir, (file_ord,))
        raw.select("source_id", "event_time", "value", "category").write.csv(
            folder, header=True, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        jobs.ingest(spark, lake, SOURCES[file_ord], [folder])


@query("job_ingest_bronze")
def _job_ingest_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files, the last one twice: the repeat inserts nothing."""
    lake = Lake(new_folder(spark))
    ingest_files(spark, lake, sf_dir, (1, 2, 3, 4))
    jobs.ingest(spark, lake, "mirror", [f"{lake.root}/in/4"])
    return lake.read(spark, "raw_records").select(
        "source", "record_hash", "source_id", iso_utc(F.col("event_time")).alias("event_time"), "category", "value",
    )


@query("job_silver_refresh")
def _job_silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, with a refresh after each: silver holds every bronze row."""
    lake = Lake(new_folder(spark))
    ingest_files(spark, lake, sf_dir, (1, 2))
    jobs.refresh_clean(spark, lake)
    ingest_files(spark, lake, sf_dir, (3, 4))
    jobs.refresh_clean(spark, lake)
    return lake.read(spark, "clean_records").select(
        "source", "record_hash", "source_id", iso_utc(F.col("event_time")).alias("event_time"), "category",
        "value_text", "value_decimal",
    )


def gold_tables(spark: SparkSession, lake: Lake) -> DataFrame:
    """The three stored metric tables, and how many checks failed."""
    parts = []
    for name, day in (("monthly_metrics", "month_start"), ("daily_metrics", "day_date"), ("monthly_metrics_raw", "month_start")):
        parts.append(lake.read(spark, name).select(F.lit(name).alias("table_name"), F.col(day).alias("day"), *MEASURES))
    failed = lake.read(spark, "data_quality_checks").where("status <> 'pass'")
    none = [F.count(F.lit(1)).alias(m) for m in MEASURES]
    parts.append(failed.agg(*none).select(F.lit("failed_checks").alias("table_name"), F.lit(None).cast("date").alias("day"), *MEASURES))
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("job_gold_tables")
def _job_gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold tables after one refresh of all files."""
    lake = Lake(new_folder(spark))
    ingest_files(spark, lake, sf_dir, (1, 2, 3, 4))
    jobs.refresh(spark, lake)
    return gold_tables(spark, lake)


@query("job_gold_increments")
def _job_gold_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files in three refreshes, each of which reads only what is new: gold is the same."""
    lake = Lake(new_folder(spark))
    for files in ((1, 2), (3,), (4,)):
        ingest_files(spark, lake, sf_dir, files)
        jobs.refresh(spark, lake)
    return gold_tables(spark, lake)


@query("job_flag_report_csv")
def _job_flag_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over all of bronze, written and read back."""
    lake = Lake(new_folder(spark))
    ingest_files(spark, lake, sf_dir, (1, 2, 3, 4))
    done = jobs.flag_report(spark, lake, f"{lake.root}/report", now=standin.NOW)
    return spark.read.csv(done.path, header=True, quote='"', escape='"').select(
        "source", "source_id", "record_hash", "severity", "flag_codes", "flag_messages")


@query("job_row_numbers")
def _job_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files whose rows carry their own place and a cell with a line break: stored row numbers agree."""
    lake = Lake(new_folder(spark))
    raw = standin.raw_batch(spark, sf_dir, (2,)).withColumn("row_id", F.col("row_num"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    spread = raw.repartitionByRange(8, "row_id").sortWithinPartitions("row_id")
    note = F.concat(F.lit("order "), F.col("row_id"), F.lit("\n"), F.lit('said "thanks", twice'))
    spread.select("source_id", "event_time", "value", "category", place.alias("place"), note.alias("note")).write.csv(
        f"{lake.root}/in", header=True, quote='"', escape='"')
    jobs.ingest(spark, lake, "orders", [f"{lake.root}/in"])
    rows = lake.read(spark, "raw_records")
    agrees = F.col("row_num") == F.col("payload")["place"].cast("bigint")
    kept = F.col("payload")["note"].rlike(r"^order \d+\nsaid \"thanks\", twice$")
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("stored"), F.count_if(agrees).alias("numbered"), F.count_if(kept).alias("notes"))


@query("job_ledger")
def _job_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain of ingest and flags, a refresh, and a batch without a required column: what the ledger says of them."""
    lake = Lake(new_folder(spark))
    raw = standin.raw_batch(spark, sf_dir, (2,))
    for name, columns in (("in", ("source_id", "event_time", "value", "category")), ("bad", ("source_id", "event_time", "value"))):
        raw.select(*columns).write.csv(f"{lake.root}/{name}", header=True, quote='"', escape='"')
    jobs.run_all(spark, lake, "orders", [f"{lake.root}/in"], f"{lake.root}/report", now=standin.NOW)
    jobs.refresh_clean(spark, lake)
    failed(jobs.ingest, spark, lake, "orders", [f"{lake.root}/bad"])
    runs = ledger.current(lake.read(spark, "pipeline_runs"))
    steps = F.array_join(F.array_distinct(F.transform("steps", lambda x: x["step"])), ",")
    return runs.select("pipeline", "status", "records_in", "records_out", "error_type", "error_message", steps.alias("steps"))


def failed(job, *args, **options) -> None:
    """Runs a job that breaks the contract; its run stays in the ledger."""
    try:
        job(*args, **options)
    except IngestionError:
        return
    raise AssertionError("the batch was accepted")


# How orders are spelled in a batch that breaks the contract, and the rows that do.
BROKEN = {
    "no_time": {"event_time": "if(row_num % 10 = 0, '', event_time)"},
    "odd_time": {"event_time": "if(row_num % 4 = 0, 'on ' || event_time, event_time)"},
    "long_id": {"source_id": "if(row_num % 5 = 0, repeat('7', 101), source_id)"},
    "long_category": {"category": "if(row_num % 3 = 0, repeat('é', 101), category)"},
}


@query("contract_summary")
def _contract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that break one rule each are refused whole, with the rule and a count; nothing of them is stored."""
    lake = Lake(new_folder(spark))
    raw = standin.raw_batch(spark, sf_dir, (2,))
    for name, spelled in BROKEN.items():
        cells = [F.expr(spelled.get(c, c)).alias(c) for c in ("source_id", "event_time", "value", "category")]
        raw.select(*cells).write.csv(f"{lake.root}/{name}", header=True, quote='"', escape='"')
        failed(jobs.ingest, spark, lake, name, [f"{lake.root}/{name}"])
    runs = lake.read(spark, "ingest_runs").where("status = 'failed'").select("source", F.col("error").alias("message"))
    none = lake.read(spark, "raw_records").agg(F.count(F.lit(1)).cast("string").alias("message")).select(F.lit("stored").alias("source"), "message")
    return runs.unionByName(none)


@query("job_rows_set_aside")
def _job_rows_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches with bad rows set aside: rows stored and rejected by reason add up."""
    lake = Lake(new_folder(spark))
    raw = standin.raw_batch(spark, sf_dir, (2,))
    for name, spelled in BROKEN.items():
        cells = [F.expr(spelled.get(c, c)).alias(c) for c in ("source_id", "event_time", "value", "category")]
        raw.select(*cells).write.csv(f"{lake.root}/{name}", header=True, quote='"', escape='"')
        jobs.ingest(spark, lake, name, [f"{lake.root}/{name}"], set_aside=True)
    runs = lake.read(spark, "ingest_runs").select(F.col("id").alias("run_id"), F.col("source").alias("batch")).distinct()
    kind = F.regexp_replace(F.array_join("reasons", "; "), r"'.*'", "'...'")
    bad = lake.read(spark, "rejected_rows").join(runs, "run_id").groupBy("batch", kind.alias("outcome")).count()
    good = lake.read(spark, "raw_records").groupBy(F.col("source").alias("batch"), F.lit("stored").alias("outcome")).count()
    return bad.unionByName(good).withColumnRenamed("count", "records")


@query("stream_ingest")
def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder watched twice: files with another order of columns each time, every file seen once."""
    lake = Lake(new_folder(spark))
    orders = {1: ("source_id", "event_time", "value", "category"), 3: ("category", "value", "event_time", "source_id")}
    for file_ord, columns in orders.items():
        standin.raw_batch(spark, sf_dir, (file_ord,)).select(*columns).write.csv(
            f"{lake.root}/drop/{file_ord}", header=True, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        ingest_stream(spark, lake, "events", f"{lake.root}/drop/*", f"{lake.root}/seen").awaitTermination()
    return lake.read(spark, "raw_records").select("record_hash", "source_id", "category", "value")


@query("scan_workbook")
def _scan_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in workbooks, one for each thousand, read back: numeric cells are numbers, text cells money as written."""
    files = standin.workbooks(spark, sf_dir).mapInPandas(workbook_rows, WORKBOOK_ROWS)
    cell = F.col("payload")["value"]
    return files.select(
        F.col("payload")["source_id"].alias("source_id"), cell.alias("value"),
        F.array_contains("numeric", "value").alias("is_number"),
        cell_amount(cell, F.array_contains("numeric", "value")).alias("amount"))


@query("flags_text_times")
def _flags_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag rules over times as text, some of them unreadable."""
    rows, first = standin.bronze(spark, sf_dir), F.left("record_hash", F.lit(1))
    text = F.when(first < "3", F.lit("soon")).when(first >= "5", iso_utc(F.col("event_time")))
    return flags.flag(rows.withColumn("event_time", text), standin.NOW).select("source", "record_hash", "severity", "flag_codes")


ORACLE.update(job_twins())
