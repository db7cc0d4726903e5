"""The passes over a batch before it is inserted: headers, open lines and the contract, without sorting or payloads."""

import pytest
from pyspark.sql import functions as F

from smeltery.operators import keys
from smeltery.plans import jobs
from smeltery.session import stage
from smeltery.sources import batch as q

HEADER = "source_id,event_time,value,category"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_contract_is_counted_without_payloads_or_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\na,2026-01-01,1,c\nb,soon,1,c\nc, ,1,c\n")
    rows, _ = q.read_batch(spark, [str(tmp_path / "a.csv")])
    staged = stage(keys.with_unread(keys.extract_keys(rows.withColumn("source", F.lit("s")))), "t")
    summary = keys.contract_summary(staged)
    plan = plan_of(summary)
    assert "payload" not in plan and "SortAggregate" not in plan
    found = summary.first()
    assert (found.total_records, found.missing_event_time, found.invalid_event_time, found.header_errors) == (3, 1, 1, 0)


@pytest.mark.parametrize("lines, message", [
    ([HEADER, "a,soon,1,c", "b, later ,1,c", "c,,1,c,"], r"^event_time is required \(1 rows have none\)$"),
    ([HEADER, "a,soon,1,c", "b, later ,1,c"], r"^Invalid event_time format: 'later' \(2 rows in all\)$"),
    ([HEADER, "a,,1,c,z", "b,2026-01-01,1,c,y"], r"^A row has more cells than the header: y$"),
])
def test_messages_quote_the_smallest_text(spark, lake, tmp_path, lines, message):
    (tmp_path / "a.csv").write_text("\n".join(lines))
    with pytest.raises(keys.IngestionError, match=message):
        jobs.ingest(spark, lake, "s", [str(tmp_path / "a.csv")])


def test_headers_are_first_lines_and_nothing_is_sorted(spark, tmp_path, monkeypatch):
    texts = {
        "plain.csv": f"{HEADER}\na,2026-01-01,1,c\n",
        "again.csv": f"value,{HEADER}\n{HEADER}\nsource_id event_time value category,x,y,z\n",   # lines that look like headers
        "mark.csv": f"﻿{HEADER}\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    files = q._files_of(spark, str(tmp_path))
    plans, collect = [], type(spark.range(0)).collect
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda df: plans.append(df._jdf.queryExecution().toString()) or collect(df))
    groups = q.csv_headers(spark, files)
    assert {f.rsplit("/", 1)[1]: h for (h, _), held in groups.items() for f in held} == {
        "plain.csv": tuple(HEADER.split(",")), "again.csv": ("value", *HEADER.split(",")), "mark.csv": tuple(HEADER.split(","))}
    assert len(plans) == 1
    physical = plans[0].split("== Physical Plan ==")[1]
    assert "FileScan text" in physical.split("HashAggregate")[-1] and "Sort" not in physical.split("HashAggregate")[-1]


def test_a_first_line_without_all_names_is_the_header_all_the_same(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"source_id,value\n{HEADER}\na,1\n")
    with pytest.raises(keys.IngestionError, match=r"Missing required columns: \['event_time', 'category'\]"):
        q.read_batch(spark, [str(tmp_path / "a.csv")])


def test_paths_are_spelled_with_three_slashes(spark):
    paths = spark.createDataFrame([("file:/a",), ("file:///a",), ("file:////a",), ("hdfs://n/a",)], "file_path string")
    held = paths.select(F.struct("file_path").alias("_metadata")).select(q._file_path().alias("p"))
    assert [r.p for r in held.collect()] == ["file:///a", "file:///a", "file:///a", "hdfs://n/a"]
