"""Source batches, bronze and silver derived from the shared test tables.

The test tables hold no bronze table, so the registered queries build one: events and
orders are written the way messy source files spell them (many time formats, blanks,
null words, currency signs), purchases arrive a second time in a later file, and signups
arrive once more under another source label.
"""

from __future__ import annotations

import io
import zipfile
from datetime import datetime, timezone
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.operators.clean import to_silver
from smeltery.operators.dedupe import keep_first
from smeltery.operators.keys import extract_keys, with_hash
from smeltery.session import stage

NOW = datetime(2024, 1, 20, tzinfo=timezone.utc)
FILES = (1, 2, 3, 4)
FILE_ORDER = ("file_ord", "row_num")
BYTE_KEY = ("source", "_key")

# How the source files spell things, as SQL text.
V = "cast(cast(value AS decimal(18,2)) AS string)"
TS = "cast(ts AS timestamp)"
EVENT_VALUE = f"""CASE event_id % 20 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN 'abc'
  WHEN 3 THEN '-' || {V} WHEN 4 THEN '$' || {V} WHEN 5 THEN ' ' || {V} || ' '
  WHEN 6 THEN '€1.234,' || lpad(cast(event_id % 100 AS string), 2, '0')
  WHEN 7 THEN '--' WHEN 8 THEN '1e7' WHEN 9 THEN 'nan' ELSE {V} END"""
EVENT_CATEGORY = """CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type)
  WHEN 2 THEN ' ' || event_type || ' ' WHEN 3 THEN chr(9) || event_type
  ELSE CASE WHEN event_id % 25 = 24 THEN 'N/A' ELSE event_type END END"""
EVENT_TIME = f"""CASE event_id % 6
  WHEN 0 THEN translate(cast({TS} AS string), ' ', 'T') || 'Z'
  WHEN 1 THEN cast({TS} AS string)
  WHEN 2 THEN translate(cast({TS} + INTERVAL 2 HOURS AS string), ' ', 'T') || '+02:00'
  WHEN 3 THEN translate(cast({TS} AS string), ' -:', 'T')
  WHEN 4 THEN translate(cast({TS} AS string), ' .', 'T,')
  ELSE translate(cast({TS} - INTERVAL '05:30' HOUR TO MINUTE AS string), ' ', 'T') || '-0530'
  END"""
DAY = "cast(cast(o_orderdate AS date) AS string)"
ORDER_TIME = f"""CASE o_orderkey % 3 WHEN 0 THEN {DAY} WHEN 1 THEN translate({DAY}, '-', '')
  ELSE {DAY} || 'T00:00:00Z' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_batch(spark: SparkSession, sf_dir: str, files: tuple[int, ...] = FILES) -> DataFrame:
    """Source rows as text, one ``file_ord`` per file in arrival order."""
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")

    def event_rows(rows: DataFrame, file_ord: int, source: str, category: str, value: str):
        return rows.selectExpr(
            f"{file_ord} AS file_ord", "event_id + 1 AS row_num", f"'{source}' AS source",
            "cast(user_id AS string) AS source_id", f"{EVENT_TIME} AS event_time",
            f"{category} AS category", f"{value} AS value",
        )

    purchases, signups = (events.where(f"event_type = '{t}'") for t in ("purchase", "signup"))
    frames = {
        1: event_rows(events, 1, "events", EVENT_CATEGORY, EVENT_VALUE),
        2: orders.selectExpr(
            "2 AS file_ord", "o_orderkey + 1 AS row_num", "'orders' AS source",
            "cast(o_custkey AS string) AS source_id", f"{ORDER_TIME} AS event_time",
            "o_orderstatus AS category", "cast(cast(o_totalprice AS decimal(18,2)) AS string) AS value",
        ),
        3: event_rows(
            purchases, 3, "events", f"upper({EVENT_CATEGORY})", f"'  ' || {EVENT_VALUE} || ' '"
        ),
        4: event_rows(signups, 4, "mirror", EVENT_CATEGORY, EVENT_VALUE),
    }
    return reduce(DataFrame.unionByName, [frames[i] for i in files])


# Cells of the value column in the workbooks, by order: what stands in the file, and whether as a number.
CELLS = """CASE o_orderkey % 7 WHEN 0 THEN '1e+16' WHEN 1 THEN '1.5e-05' WHEN 2 THEN ' $1,234.50 ' WHEN 3 THEN '1e+16'
  WHEN 4 THEN cast(o_custkey AS string) ELSE cast(cast(o_totalprice AS decimal(18,2)) AS string) || '25' END"""
NUMERIC = "o_orderkey % 7 NOT IN (2, 3)"
SHEET = {
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
                       'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="a" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/a.xml"/></Relationships>',
}


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path`` and ``content`` of workbooks of orders, built in tasks; a workbook holds a thousand order numbers."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(o_custkey AS string) AS source_id", f"{CELLS} AS cell", f"{NUMERIC} AS number", "floor(o_orderkey / 1000) AS book")

    def build(key, frame):
        body = ['<row><c t="inlineStr"><is><t>source_id</t></is></c><c t="inlineStr"><is><t> event_time</t></is></c>'
                '<c t="inlineStr"><is><t>value </t></is></c><c t="inlineStr"><is><t>category</t></is></c></row>']
        for r in frame.sort_values("o_orderkey").itertuples():
            value = f"<c><v>{r.cell}</v></c>" if r.number else f'<c t="inlineStr"><is><t>{r.cell}</t></is></c>'
            body.append(f'<row><c t="inlineStr"><is><t>{r.source_id}</t></is></c><c t="inlineStr"><is><t>2024-01-05</t></is></c>{value}'
                        f'<c t="inlineStr"><is><t>c</t></is></c></row>')
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as book:
            for name, text in SHEET.items():
                book.writestr(name, text)
            book.writestr("xl/worksheets/a.xml", '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
                          + "".join(body) + "</sheetData></worksheet>")
        return pd.DataFrame({"path": [f"{key[0]}.xlsx"], "content": [held.getvalue()]})

    return rows.groupBy("book").applyInPandas(build, "path string, content binary")


def with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("id", F.concat_ws("-", "source", "file_ord", "row_num"))


def keyed_batch(spark: SparkSession, sf_dir: str, files: tuple[int, ...] = FILES) -> DataFrame:
    """The batch with payload, typed keys and hash, before any dedupe."""
    stamped = raw_batch(spark, sf_dir, files).selectExpr(
        "*",
        "concat_ws('-', source, file_ord, row_num) AS id",
        "map('source_id', source_id, 'event_time', event_time, 'category', category, "
        "'value', value) AS payload",
        "timestamp_seconds(1704844800 + file_ord * 86400) AS ingested_at",
        "'run-' || source AS run_id",
    )
    return extract_keys(stamped)


def staged_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed batch written once, for queries that read it more than once; hashes are made again of the keys."""
    return with_hash(stage(keyed_batch(spark, sf_dir).drop("record_hash"), "batch"))


def first_rows(batch: DataFrame, files: tuple[int, ...] = FILES) -> DataFrame:
    """Bronze from a keyed batch: the first row of every key in the given files."""
    chosen = batch if files == FILES else batch.where(F.col("file_ord").isin(*files))
    return keep_first(chosen, FILE_ORDER)


def first_silver(batch: DataFrame, run: str, files: tuple[int, ...] = FILES) -> DataFrame:
    """``silver_of`` ``first_rows`` with the hash's bytes as ``_key``: shuffled rows carry them instead of digits."""
    chosen = batch if files == FILES else batch.where(F.col("file_ord").isin(*files))
    short = chosen.withColumn("_key", F.unhex("record_hash")).drop("record_hash")
    rows = keep_first(short, FILE_ORDER, BYTE_KEY).withColumn("record_hash", F.lower(F.hex("_key")))
    return silver_of(rows, run, "_key")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(keyed_batch(spark, sf_dir))


def silver_of(rows: DataFrame, run: str = "run", *more: str) -> DataFrame:
    return to_silver(rows, run, F.lit(NOW).cast("timestamp"), more)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_of(bronze(spark, sf_dir))


# Stand-in for the run ledger: one run per day and kind of event.
RUN_COLUMNS = (
    "concat_ws('|', cast(day AS string), event_type) AS id",
    "CASE event_type WHEN 'click' THEN 'ingest' WHEN 'view' THEN 'flags' WHEN 'signup' "
    "THEN 'clean' WHEN 'purchase' THEN 'metrics' ELSE 'demo' END AS pipeline",
    "if(failed, 'failed', 'succeeded') AS status",
    "started_at", "finished_at",
    "(unix_micros(finished_at) - unix_micros(started_at)) div 1000 AS duration_ms",
    "records_in", "records_out",
    "if(failed, 'stopped after ' || records_out, null) AS error_summary",
    "if(failed, 'ValueError', null) AS error_type",
    "if(failed, 'stopped after ' || records_out, null) AS error_message",
    "array(named_struct('step', 'parse', 'status', 'ok', 'duration_ms', records_in), "
    "named_struct('step', 'upsert', 'status', if(failed, 'failed', 'ok'), "
    "'duration_ms', records_out)) AS steps",
)


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    daily = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.min("ts").alias("started_at"),
        F.max("ts").alias("finished_at"),
        F.count(F.lit(1)).alias("records_in"),
        F.count_if(F.col("value") > 50).cast("bigint").alias("records_out"),
    )
    return daily.withColumn("failed", F.col("records_in") % 5 == 0).selectExpr(*RUN_COLUMNS)
