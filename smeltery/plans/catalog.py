"""The registered queries: each runs one operator over the shared test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.config import CleaningConfig, OutlierRule
from smeltery.functions.dates import iso_utc, normalize_date, parse_event_time
from smeltery.functions.hashing import record_hash
from smeltery.functions.numbers import (
    normalize_currency,
    normalize_float,
    normalize_int,
    outlier_bounds,
    parse_float,
)
from smeltery.functions.text import (
    is_null,
    normalize_category,
    normalize_text,
    null_literals_to_null,
)
from smeltery.operators import clean as cleaning
from smeltery.operators import dedupe, flags, keys, ledger, quality, rollup
from smeltery.operators.merge import upsert
from smeltery.plans import standin
from smeltery.session import checkpoint_root, ensure_utc, stage
from smeltery.sources.batch import read_batch
from smeltery.sources.tables import latest_n

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SLICE = (date(1996, 3, 15), date(2001, 1, 1))
TREND = (date(1997, 1, 15), date(2024, 1, 25))
CATEGORY_NAMES = {
    "click": "Click", "view": "Page view", "purchase": "Sale",
    "o": "open", "f": "filled", "p": "partial",
}
PRIORITY_NAMES = {"1-urgent": "Urgent", "2-high": "High", "5-low": "Low"}
CLEAN_FIELDS = ("title", "category", "published_at", "price", "views", "score")
CLEAN_CONFIG = CleaningConfig(
    allowed_keys=frozenset({"o_orderkey", *CLEAN_FIELDS}),
    day_first=True,
    category_mapping=PRIORITY_NAMES,
    outlier_rules={
        "views": OutlierRule(min_value=0),
        "score": OutlierRule(min_value=0, max_value=1),
        "price": OutlierRule(max_value=450000),
    },
)


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; every query runs in a UTC session."""

    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: run(ensure_utc(spark), sf_dir)
        return run

    return register


# Gold --------------------------------------------------------------------------------


@query("monthly_metrics")
def _monthly_metrics(spark, sf_dir):
    return rollup.monthly_metrics(standin.silver(spark, sf_dir))


@query("daily_metrics")
def _daily_metrics(spark, sf_dir):
    return rollup.daily_metrics(standin.bronze(spark, sf_dir))


@query("monthly_metrics_raw")
def _monthly_metrics_raw(spark, sf_dir):
    return rollup.monthly_metrics_raw(standin.bronze(spark, sf_dir))


@query("monthly_slice")
def _monthly_slice(spark, sf_dir):
    months = rollup.within(standin.keyed_batch(spark, sf_dir), *SLICE, "month")
    silver = standin.silver_of(standin.first_rows(months))
    monthly = rollup.monthly_metrics(silver, *SLICE)
    return rollup.monthly_slice(monthly, *SLICE)


@query("latest_month")
def _latest_month(spark, sf_dir):
    return rollup.latest_month(rollup.monthly_metrics(standin.silver(spark, sf_dir)))


def _trend(spark: SparkSession, sf_dir: str, granularity: str, metric: str) -> DataFrame:
    # Equal keys share their event time, so the range may go below keep-first. Bronze keys are
    # unique, which spares the distinct count of the hashes.
    days = rollup.within(standin.keyed_batch(spark, sf_dir), *TREND, "day")
    daily = rollup.daily_metrics(standin.first_rows(days), *TREND, unique_keys=True)
    return rollup.trend(daily, *TREND, granularity, metric)


@query("trend_day")
def _trend_day(spark, sf_dir):
    return _trend(spark, sf_dir, "day", "total_records")


@query("trend_week")
def _trend_week(spark, sf_dir):
    return _trend(spark, sf_dir, "week", "distinct_source_ids")


@query("trend_month")
def _trend_month(spark, sf_dir):
    return _trend(spark, sf_dir, "month", "distinct_records")


@query("trend_share_of_max")
def _trend_share_of_max(spark, sf_dir):
    return rollup.share_of_max(_trend(spark, sf_dir, "month", "total_records"))


# Bronze ------------------------------------------------------------------------------


@query("scan_csv_contract")
def _scan_csv_contract(spark, sf_dir):
    """Source rows written as CSV files to the shared folder and read back as a batch."""
    raw = standin.raw_batch(spark, sf_dir, (1, 2))
    folder = f"{checkpoint_root(spark)}/csv-{uuid.uuid4().hex}"
    raw.select("source_id", "event_time", "value", "category").write.csv(
        folder, header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    rows, _ = read_batch(spark, [folder])
    read = keys.extract_keys(rows)
    return read.select(
        "source_id", iso_utc(F.col("event_time")).alias("event_time"), "category", "value",
        "record_hash",
    )


@query("latest_n_raw")
def _latest_n_raw(spark, sf_dir):
    newest = latest_n(standin.first_rows(standin.staged_batch(spark, sf_dir)), 5000)
    return newest.select("id", "source", "record_hash", "row_num")


@query("invalid_event_time_rows")
def _invalid_event_time_rows(spark, sf_dir):
    broken = f"""CASE event_id % 10 WHEN 0 THEN '' WHEN 1 THEN null WHEN 2 THEN 'not-a-date'
      WHEN 3 THEN '2024-02-30T00:00:00Z' WHEN 4 THEN '2024-13-01' WHEN 5 THEN '2026'
      WHEN 6 THEN 'T06:00' ELSE {standin.EVENT_TIME} END"""
    rows = standin.table(spark, sf_dir, "events").selectExpr("event_id", f"{broken} AS event_time")
    return keys.invalid_event_times(rows)


@query("parse_event_time")
def _parse_event_times(spark, sf_dir):
    raw = standin.with_id(standin.raw_batch(spark, sf_dir))
    return raw.select("id", iso_utc(parse_event_time(F.col("event_time"))).alias("event_time"))


@query("extract_keys")
def _extract_keys(spark, sf_dir):
    keyed = standin.keyed_batch(spark, sf_dir)
    return keyed.select(
        "id", "source_id", iso_utc(F.col("event_time")).alias("event_time"), "category", "value"
    )


@query("record_hash")
def _record_hashes(spark, sf_dir):
    return standin.keyed_batch(spark, sf_dir).select("id", "record_hash")


@query("record_hash_text")
def _record_hash_text(spark, sf_dir):
    """Hash over whole documents: line breaks, quotes and every script in the texts."""
    docs = standin.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    at = F.lit(standin.NOW).cast("timestamp")
    return docs.select(
        "doc_id",
        record_hash(F.col("doc_id").cast("string"), at, F.col("lang"), F.col("text"))
        .alias("record_hash"),
    )


@query("ingest_counts")
def _ingest_counts(spark, sf_dir):
    return dedupe.batch_counts(standin.keyed_batch(spark, sf_dir), "file_ord")


@query("dedupe_keep_first")
def _dedupe_keep_first(spark, sf_dir):
    return standin.bronze(spark, sf_dir).select("source", "record_hash", "file_ord", "row_num")


@query("ingest_new_only")
def _ingest_new_only(spark, sf_dir):
    batch = standin.staged_batch(spark, sf_dir)
    stored = standin.first_rows(batch, (1, 2))
    fresh = dedupe.new_only(standin.first_rows(batch), stored, probe=batch)
    return fresh.select("source", "record_hash", "file_ord", "row_num")


@query("ingest_idempotent_replay")
def _ingest_idempotent_replay(spark, sf_dir):
    """First run, then the same batch again: the second run finds nothing to insert."""
    batch = standin.staged_batch(spark, sf_dir)
    stored = stage(standin.first_rows(batch).select(*dedupe.KEY), "stored")
    again = standin.first_rows(batch).select(*dedupe.KEY)
    replay = dedupe.new_only(again, stored, probe=batch)
    counted = stored.selectExpr("source", "1 AS stored", "0 AS again").unionByName(
        replay.selectExpr("source", "0 AS stored", "1 AS again")
    )
    return counted.groupBy("source").agg(
        F.sum("stored").cast("bigint").alias("first_inserted"),
        F.sum("again").cast("bigint").alias("replay_inserted"),
    )


@query("backfill_keys")
def _backfill_keys(spark, sf_dir):
    raw = standin.keyed_batch(spark, sf_dir).select("id", "run_id", "payload")
    # Staged, so that Spark knows before it plans the join that there are few runs; a shuffled join would send each
    # run's rows to one task.
    runs = stage(standin.raw_batch(spark, sf_dir).select("source").distinct(), "runs")
    filled = keys.backfill_keys(raw, runs.withColumn("id", F.concat(F.lit("run-"), "source")))
    return filled.select(
        "id", "source", "source_id", iso_utc(F.col("event_time")).alias("event_time"),
        "category", "value", "record_hash",
    )


# Scalar and row rules ----------------------------------------------------------------


@query("project_allowed_keys")
def _project_allowed_keys(spark, sf_dir):
    payload = F.expr(
        f"map('source_id', cast(user_id AS string), 'value', {standin.V}, 'props', props, "
        "'category', event_type)"
    )
    kept = cleaning.project_allowed_map(payload, {"value", "category"})
    events = standin.table(spark, sf_dir, "events")
    return events.select("event_id", F.explode(kept).alias("key", "text"))


@query("null_literals")
def _null_literals(spark, sf_dir):
    raw = standin.with_id(standin.raw_batch(spark, sf_dir))
    return raw.select(
        "id",
        is_null(F.col("value")).cast("int").alias("value_is_null"),
        null_literals_to_null(F.col("value")).alias("value"),
        null_literals_to_null(F.col("category")).alias("category"),
    )


@query("normalize_text")
def _normalize_texts(spark, sf_dir):
    docs = standin.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), "doc_id").alias("id"), "text"
    )
    turns = standin.table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("id"), "text"
    )
    texts = docs.unionByName(turns)
    return texts.select("id", normalize_text(F.col("text")).alias("text"))


@query("normalize_category")
def _normalize_categories(spark, sf_dir):
    raw = standin.with_id(standin.raw_batch(spark, sf_dir))
    return raw.select(
        "id", normalize_category(F.col("category"), CATEGORY_NAMES).alias("category")
    )


@query("map_categories")
def _map_categories(spark, sf_dir):
    """The mapping as a table: every nation name maps to its region's name."""
    nation, region = (standin.table(spark, sf_dir, t) for t in ("nation", "region"))
    mapping = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "lower(n_name) AS key", "r_name AS canonical"
    )
    customers = standin.table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = customers.selectExpr(
        "c_custkey",
        "CASE c_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN '  ' || lower(n_name) "
        "ELSE n_name || ' (old)' END AS category",
    )
    return cleaning.map_categories(rows, "category", mapping)


DATE_SPELLING = """CASE event_id % 8 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd')
  WHEN 1 THEN date_format(ts, 'dd/MM/yyyy') WHEN 2 THEN date_format(ts, 'yyyy/M/d')
  WHEN 3 THEN date_format(ts, 'd-M-yyyy') WHEN 4 THEN date_format(ts, 'yyyy-M-d HH:mm:ss')
  WHEN 5 THEN date_format(ts, 'yyyyMMdd') WHEN 6 THEN date_format(ts, 'yyyy-MM-dd') || 'junk'
  ELSE date_format(ts, 'MM/dd/yyyy') END"""


def _dates(spark: SparkSession, sf_dir: str, day_first: bool) -> DataFrame:
    events = standin.table(spark, sf_dir, "events")
    spelled = events.selectExpr("event_id", f"{DATE_SPELLING} AS written")
    return spelled.select("event_id", normalize_date(F.col("written"), day_first).alias("day"))


@query("normalize_date_dayfirst")
def _normalize_date_dayfirst(spark, sf_dir):
    return _dates(spark, sf_dir, True)


@query("normalize_date_monthfirst")
def _normalize_date_monthfirst(spark, sf_dir):
    return _dates(spark, sf_dir, False)


LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
MONEY_SPELLING = """CASE l_linenumber % 5 WHEN 0 THEN '$' || format_number(price, 2)
  WHEN 1 THEN translate(format_number(price, 2), ',.', '.,') || ' €'
  WHEN 2 THEN cast(price AS string) WHEN 3 THEN '(' || format_number(price, 2) || ')'
  ELSE '1-' || cast(price AS string) END"""
NUMBER_SPELLING = """CASE l_linenumber % 6 WHEN 0 THEN format_number(price, 2)
  WHEN 1 THEN ' -' || cast(price AS string) WHEN 2 THEN cast(price AS string) || 'e2'
  WHEN 3 THEN cast(price AS string) || 'd'
  WHEN 4 THEN '1_0' || lpad(cast(cast(l_quantity AS int) AS string), 2, '0') ELSE 'n/a' END"""


def _lines(spark: SparkSession, sf_dir: str, spelling: str) -> DataFrame:
    priced = standin.table(spark, sf_dir, "lineitem").selectExpr(
        *LINE, "l_quantity", "cast(l_extendedprice AS decimal(18,2)) AS price"
    )
    return priced.selectExpr(*LINE, f"{spelling} AS written")


@query("normalize_currency")
def _normalize_currency(spark, sf_dir):
    money = normalize_currency(F.col("written"), precision=18, scale=4)
    return _lines(spark, sf_dir, MONEY_SPELLING).select(*LINE, money.alias("amount"))


@query("normalize_int")
def _normalize_int(spark, sf_dir):
    whole = normalize_int(F.col("written"))
    return _lines(spark, sf_dir, NUMBER_SPELLING).select(*LINE, whole.alias("whole"))


@query("normalize_float")
def _normalize_float(spark, sf_dir):
    number = normalize_float(F.col("written"))
    return _lines(spark, sf_dir, NUMBER_SPELLING).select(*LINE, number.alias("number"))


@query("parse_value_float")
def _parse_value_float(spark, sf_dir):
    """The flag rules' reader: no thousands separators."""
    number = parse_float(F.col("written"))
    return _lines(spark, sf_dir, NUMBER_SPELLING).select(*LINE, number.alias("number"))


@query("outlier_bounds")
def _outlier_bound(spark, sf_dir):
    orders = standin.table(spark, sf_dir, "orders")
    dtype = orders.schema["o_totalprice"].dataType
    price = F.col("o_totalprice")
    return orders.select(
        "o_orderkey",
        outlier_bounds(price, dtype, 1000.0, 300000.0).alias("both"),
        outlier_bounds(price, dtype, None, 300000.0).alias("upper"),
        outlier_bounds(price, dtype, 1000.0, None).alias("lower"),
    )


def _messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders")
    return orders.selectExpr(
        "o_orderkey",
        "'  Order ' || chr(9) || ' ' || o_orderkey || '  ' AS title",
        "o_orderpriority AS category",
        "date_format(o_orderdate, 'dd/MM/yyyy') AS published_at",
        "'$' || cast(cast(o_totalprice AS decimal(18,2)) AS string) AS price",
        "if(o_orderkey % 4 = 0, '-' || o_orderkey, cast(o_orderkey AS string)) AS views",
        "CASE o_orderkey % 3 WHEN 0 THEN '0.5' WHEN 1 THEN '1.5' ELSE 'none' END AS score",
        "o_orderstatus AS scratch",
    )


@query("clean_row_e2e")
def _clean_row_e2e(spark, sf_dir):
    cleaned = cleaning.clean(_messy_orders(spark, sf_dir), CLEAN_CONFIG)
    return cleaned.withColumn("price", F.col("price").cast("decimal(18,4)"))


@query("clean_before_after")
def _clean_before_after(spark, sf_dir):
    fields = ("title", "category", "published_at", "views", "score")
    audit = cleaning.before_after(_messy_orders(spark, sf_dir), CLEAN_CONFIG, "o_orderkey", fields)
    return audit


# Silver and gold upserts -------------------------------------------------------------


@query("silver_upsert")
def _silver_upsert(spark, sf_dir):
    batch = standin.staged_batch(spark, sf_dir)
    stored = standin.first_silver(batch, "first", (1, 2))
    incoming = standin.first_silver(batch, "second")
    merged = upsert(stored, incoming, standin.BYTE_KEY, keep=("id",))
    return merged.select(
        "id", "source", "record_hash", "raw_id", "source_id",
        iso_utc(F.col("event_time")).alias("event_time"), "category", "value_text",
        "value_decimal", F.col("payload_clean")["category"].alias("payload_category"),
    )


@query("gold_upsert")
def _gold_upsert(spark, sf_dir):
    batch = standin.staged_batch(spark, sf_dir)
    stored = rollup.daily_metrics(standin.first_rows(batch, (1, 2)))
    incoming = rollup.daily_metrics(standin.first_rows(batch), date(2024, 1, 10))
    return upsert(stored, incoming, ("day_date",))


# Flags -------------------------------------------------------------------------------


@query("fingerprint_counts")
def _fingerprint_counts(spark, sf_dir):
    counted = flags.fingerprint_counts(standin.staged_batch(spark, sf_dir))
    return counted.select("id", F.col("_copies").alias("copies"))


def _flagged(batch: DataFrame) -> DataFrame:
    return flags.flag(batch, standin.NOW)


@query("flags_report")
def _flags_report(spark, sf_dir):
    # Staged, because a global sort reads its input twice: once to find the ranges.
    batch = stage(flags.of_report(standin.keyed_batch(spark, sf_dir)), "batch")
    return flags.report(stage(_flagged(batch), "flagged"))


@query("flags_severity")
def _flags_severity(spark, sf_dir):
    per = _flagged(standin.staged_batch(spark, sf_dir)).groupBy("severity", "flag_codes")
    return per.agg(F.count(F.lit(1)).alias("records"))


@query("flags_top10")
def _flags_top10(spark, sf_dir):
    return flags.top(_flagged(standin.staged_batch(spark, sf_dir)), 10)


@query("flag_totals")
def _flag_totals(spark, sf_dir):
    batch = standin.staged_batch(spark, sf_dir)
    return flags.totals(batch, _flagged(batch))


# Audit -------------------------------------------------------------------------------


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary built from the first two files only, so some months must differ."""
    batch = standin.staged_batch(spark, sf_dir)
    summary = rollup.monthly_metrics(standin.silver_of(standin.first_rows(batch, (1, 2))))
    return quality.control_totals(summary, standin.silver_of(standin.first_rows(batch)))


@query("control_totals")
def _control_totals(spark, sf_dir):
    return _totals(spark, sf_dir)


@query("dq_checks")
def _dq_checks(spark, sf_dir):
    checks = quality.quality_checks(_totals(spark, sf_dir), standin.NOW)
    return checks.drop("id", "created_at")


@query("run_rollup")
def _run_rollup(spark, sf_dir):
    since = datetime(2024, 1, 15, tzinfo=timezone.utc)
    return ledger.run_rollup(standin.pipeline_runs(spark, sf_dir), since)


@query("recent_runs")
def _recent_runs(spark, sf_dir):
    recent = ledger.recent_runs(standin.pipeline_runs(spark, sf_dir))
    stamps = {c: iso_utc(F.col(c)) for c in ("started_at", "finished_at")}
    return recent.withColumns(stamps)


@query("failed_run_steps")
def _failed_run_steps(spark, sf_dir):
    return ledger.failed_run_steps(standin.pipeline_runs(spark, sf_dir))
