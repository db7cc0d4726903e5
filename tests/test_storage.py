"""Publishing by one rename: refused, late and broken writes, and what a refresh reads and rewrites."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from smeltery.operators import dedupe, ledger
from smeltery.plans import jobs
from smeltery.sinks import tables
from smeltery.sources.tables import Lake

HEADER = "source_id,event_time,value,category"


def write(path, lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    return str(path)


def hidden(lake, table):
    import pathlib

    return [p for p in pathlib.Path(lake.path(table)).glob(".pending*")]


def test_refresh_reads_and_rewrites_only_what_is_new(spark, lake, tmp_path, monkeypatch):
    first = [f"r{i},2026-0{1 + i % 3}-05,{i},c" for i in range(60)]
    jobs.ingest(spark, lake, "s", [write(tmp_path / "1.csv", first)])
    assert jobs.refresh_clean(spark, lake) == 60
    jobs.ingest(spark, lake, "s", [write(tmp_path / "2.csv", ["new,2026-02-07,5,c", first[0]])])
    read = []
    real = Lake._read
    monkeypatch.setattr(Lake, "_read", lambda self, s, t, folders, extra=(): (
        lambda kept: read.append((t, kept)) or real(self, s, t, kept, extra))(list(folders)))
    assert jobs.refresh_clean(spark, lake) == 61
    monkeypatch.undo()
    assert [f for t, kept in read if t == "raw_records" for f in kept] == ["batch=00000002.0"]
    silver = [f for t, kept in read if t == "clean_records" for f in kept]
    new = lake.read(spark, "clean_records").where("source_id = 'new'").first()
    assert set(silver) <= {f"version=00000001/event_month=2026-02-01/prefix={new.record_hash[0]}"}
    assert [(p.month, p.prefix) for p in lake.parts(spark, "clean_records") if p.version == 2] == [("2026-02-01", new.record_hash[0])]
    # Nothing new: no version, the count from the ledger.
    assert jobs.refresh_clean(spark, lake) == 61 and lake.versions(spark, "clean_records") == [1, 2]
    assert jobs.refresh_clean(spark, lake, everything=True) == 61
    assert lake.read(spark, "clean_records").count() == 61


def test_limit_sets_no_mark(spark, lake, tmp_path):
    jobs.ingest(spark, lake, "s", [write(tmp_path / "1.csv", [f"r{i},2026-01-05,{i},c" for i in range(9)])])
    assert jobs.refresh_clean(spark, lake, limit=4) == 4
    assert jobs.refresh_clean(spark, lake) == 9


def test_a_batch_published_in_between_is_looked_up(spark, lake, tmp_path, monkeypatch):
    one = write(tmp_path / "1.csv", ["a,2026-01-05,1,c", "b,2026-01-05,1,c"])
    two = write(tmp_path / "2.csv", ["b,2026-01-05,1,c", "d,2026-02-05,1,c"])
    real, calls = tables.PendingBatch.publish, []

    def late(self, last):
        calls.append(last)
        if len(calls) == 1:
            jobs.ingest(spark, lake, "s", [two])   # another writer, just before the rename
        return real(self, last)

    monkeypatch.setattr(tables.PendingBatch, "publish", late)
    done = jobs.ingest(spark, lake, "s", [one])
    assert done.inserted_records == 1 and lake.batches(spark) == [1, 2]
    rows = lake.read(spark, "raw_records")
    assert sorted(r.source_id for r in rows.collect()) == ["a", "b", "d"] and dedupe.duplicate_keys(rows).isEmpty()
    assert not hidden(lake, "raw_records") and jobs.unproven(spark, lake) == []


def broken(df, column):
    return df.withColumn(column, F.when(F.col(column) == 3, F.raise_error(F.lit("disk full")).cast("bigint")).otherwise(F.col(column)))


def test_broken_gold_write_keeps_the_table(spark, lake):
    days = spark.createDataFrame([(date(2026, 1, d), d, 1, 1, 1, 1) for d in (1, 2)], "day_date date, " + ", ".join(f"{m} long" for m in jobs.schemas.MEASURES))
    tables.upsert_small(spark, lake, "daily_metrics", days, ("day_date",))
    worse = broken(days.withColumn("total_records", F.lit(3).cast("bigint")), "total_records")
    with pytest.raises(Exception, match="disk full"):
        tables.upsert_small(spark, lake, "daily_metrics", worse, ("day_date",))
    assert sorted(r.total_records for r in lake.read(spark, "daily_metrics").collect()) == [1, 2]
    assert not hidden(lake, "daily_metrics")
    for k in range(4):
        tables.upsert_small(spark, lake, "daily_metrics", days.withColumn("total_records", F.lit(k).cast("bigint")), ("day_date",))
    assert lake.versions(spark, "daily_metrics") == [4, 5] and lake.read(spark, "daily_metrics").first().total_records == 3


def test_broken_silver_write_keeps_the_table(spark, lake, tmp_path):
    jobs.ingest(spark, lake, "s", [write(tmp_path / "1.csv", [f"r{i},2026-01-05,{i},c" for i in range(9)])])
    jobs.refresh_clean(spark, lake)
    silver = lake.read(spark, "clean_records")
    before = sorted(map(str, silver.collect()))
    worse = silver.withColumn("value_text", F.when(F.col("source_id") == "r3", F.raise_error(F.lit("disk full"))).otherwise(F.lit("x")))
    with pytest.raises(Exception, match="disk full"):
        tables.upsert_by_part(spark, lake, "clean_records", worse, dedupe.KEY)
    assert sorted(map(str, lake.read(spark, "clean_records").collect())) == before and not hidden(lake, "clean_records")
    for k in range(3):
        tables.upsert_by_part(spark, lake, "clean_records", silver.withColumn("value_text", F.lit(str(k))), dedupe.KEY)
        silver = lake.read(spark, "clean_records")
    assert {r.value_text for r in silver.collect()} == {"2"} and silver.count() == 9
    kept = [p.version for p in lake.parts(spark, "clean_records") + lake.parts(spark, "clean_records", old=True)]
    assert set(kept) == {3, 4}


def test_rows_set_aside(spark, lake, tmp_path):
    path = write(tmp_path / "1.csv", ["a,2026-01-05,1,c", "b,,1,c", "d,soon,1,c", f"{'x' * 101},never,1,{'y' * 101}", "e,2026-01-06,1,c,more"])
    done = jobs.ingest(spark, lake, "s", [path], set_aside=True)
    assert (done.total_records, done.inserted_records, done.deduped_records, done.rejected_records) == (5, 1, 0, 4)
    bad = {r.row_num: r.reasons for r in lake.read(spark, "rejected_rows").collect()}
    assert bad == {2: ["event_time is required"], 3: ["Invalid event_time format: 'soon'"],
                   4: ["Invalid event_time format: 'never'", "source_id exceeds 100 characters", "category exceeds 100 characters"],
                   5: ["A row has more cells than the header: more"]}
    assert lake.read(spark, "raw_records").first().row_num == 1


def test_lost_amounts_show_as_a_check(spark, lake, tmp_path):
    jobs.ingest(spark, lake, "s", [write(tmp_path / "1.csv", ["a,2026-01-05,1000000000000000,N/A", "b,2026-01-05,12.5,c", "d,2026-01-05,abc,c"])])
    jobs.refresh_clean(spark, lake)
    check = lake.read(spark, "data_quality_checks").first()
    assert (check.check_name, check.status, check.expected, check.observed) == ("amounts_lost", "warn", 0, 1)
    run = ledger.current(lake.read(spark, "pipeline_runs")).where("pipeline = 'clean'").first()
    assert [s.meta for s in run.steps if s.step == "losses"] == [{"amounts_lost": "1", "category_fallbacks": "1"}]
    jobs.refresh_clean(spark, lake)
    assert lake.read(spark, "data_quality_checks").count() == 1


def test_marks_survive_a_run_that_died(spark, lake, tmp_path):
    jobs.ingest(spark, lake, "s", [write(tmp_path / "1.csv", ["a,2026-01-05,1,c"])])
    bronze = lake.read(spark, "raw_records")
    tables.upsert_by_part(spark, lake, "clean_records", jobs.to_silver(bronze, F.col("run_id"), F.lit(datetime(2026, 1, 9, tzinfo=timezone.utc))), dedupe.KEY)
    ids = [r.id for r in lake.read(spark, "clean_records").collect()]
    assert jobs.refresh_clean(spark, lake) == 1
    assert [r.id for r in lake.read(spark, "clean_records").collect()] == ids
