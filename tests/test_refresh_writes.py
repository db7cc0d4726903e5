"""A refresh that brings only new keys merges parts without a join, and stages no cleaned rows."""

from pyspark.sql import functions as F

from smeltery.plans import jobs
from smeltery.sinks import tables


def lines(tmp_path, name, rows):
    (tmp_path / name).write_text("source_id,event_time,value,category\n" + "".join(f"{i},2026-01-05,{v},c\n" for i, v in rows))
    return str(tmp_path / name)


def test_new_keys_are_merged_without_a_join(spark, lake, tmp_path, monkeypatch):
    upserts, real = [], tables.upsert
    monkeypatch.setattr(tables, "upsert", lambda *a, **k: upserts.append(1) or real(*a, **k))
    staged, stage = [], jobs.stage
    monkeypatch.setattr(jobs, "stage", lambda df, label: staged.append(label) or stage(df, label))
    jobs.ingest(spark, lake, "s", [lines(tmp_path, "a.csv", [(i, i) for i in range(60)])])
    assert jobs.refresh_clean(spark, lake) == 60
    jobs.ingest(spark, lake, "s", [lines(tmp_path, "b.csv", [(i, i) for i in range(50, 90)])])
    assert jobs.refresh_clean(spark, lake) == 90
    assert not upserts and "clean" not in staged
    before = {r.record_hash: r.id for r in lake.read(spark, "clean_records").collect()}
    assert jobs.refresh_clean(spark, lake, everything=True) == 90 and upserts   # keys that meet go through the upsert
    after = lake.read(spark, "clean_records")
    assert {r.record_hash: r.id for r in after.collect()} == before and len(before) == 90
    assert after.where(F.col("id") != F.sha2(F.concat_ws("|", "run_id", "source", "record_hash"), 256)).isEmpty()
