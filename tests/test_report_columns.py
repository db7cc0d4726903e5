"""The report carries no payloads, and fingerprints go through shuffles as bytes."""

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.operators import dedupe, flags
from smeltery.plans import jobs
from smeltery.sinks import tables


def test_payloads_are_not_staged_for_the_report(spark, lake, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("source_id,event_time,value,category\n1,2026-01-05,n/a,c\n2,2026-01-05,3,c\n")
    jobs.ingest(spark, lake, "s", [str(tmp_path / "a.csv")])
    real, seen = jobs.stage, {}
    monkeypatch.setattr(jobs, "stage", lambda df, label: seen.setdefault(label, df.columns) and real(df, label))
    done = jobs.flag_report(spark, lake, str(tmp_path / "out"), now=datetime(2026, 1, 6, tzinfo=timezone.utc))
    assert (done.scanned, done.flagged) == (2, 1)
    assert "payload" not in seen["flagged"] and set(flags.REPORT_COLUMNS) <= set(seen["flagged"])


def test_fingerprints_are_bytes(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("a", "")], "x string, y string")
    digest = rows.select(dedupe.fingerprint(("x", "y")).alias("d"))
    assert digest.schema["d"].dataType == T.BinaryType()
    assert digest.distinct().count() == 2 and digest.agg(F.max(F.length("d"))).first()[0] == 32
    counted = dedupe.with_group_size(rows, ("x", "y"), "n").collect()
    assert sorted((r.x, r.y or "-", r.n) for r in counted if r.y is None) == [("a", "-", 2)] * 2


def test_the_report_shuffles_no_digests_that_follow_from_other_columns(spark, lake, tmp_path):
    rows = [f"{i},2025-01-0{1 + i % 5},{'n/a' if i % 3 else i},C{i}" for i in range(60)]
    (tmp_path / "a.csv").write_text("\n".join(["source_id,event_time,value,category", *rows]) + "\n")
    jobs.ingest(spark, lake, "s", [str(tmp_path / "a.csv")])
    other = lake.read(spark, "raw_records").limit(5).withColumn("id", F.lit("mine")).drop("event_month")
    other.withColumn("record_hash", F.lit("0" * 64)).write.parquet(f"{lake.path('raw_records')}/batch=00000002.0/event_month=2025-01-01")
    now = datetime(2026, 1, 6, tzinfo=timezone.utc)
    found = flags.flag(flags.of_report(lake.read(spark, "raw_records")), now, unique_keys=True)
    small = tables._packed(found)
    assert small.where("_made_id").select(F.count("id"), F.count("_hex_id"), F.count("record_hash"), F.count("_hex_record_hash")).first() == (0, 0, 0, 0)
    small.write.parquet(str(tmp_path / "small"))
    held = spark.read.parquet(str(tmp_path / "small"))
    parts = flags.report_parts(held, tables.packed_id(found), lambda r: tables._unpacked(r, found))
    assert parts.collect() == flags.report(found).collect() and parts.count() == 65
    plan = parts._jdf.queryExecution().executedPlan().toString().splitlines()
    # What is shuffled are the rows as they were staged.
    final = plan[:next(i for i, line in enumerate(plan) if "Initial Plan" in line)]
    shuffle = next(i for i, line in enumerate(final) if "Exchange rangepartitioning" in line)
    assert not any("Project [" in line for line in final[shuffle + 1:]) and any("FileScan" in line for line in final[shuffle + 1:])
    done = jobs.flag_report(spark, lake, str(tmp_path / "out"), now=now)
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    lines = [line for f in files for line in f.read_text().splitlines()[1:]]
    # No run has looked up the second batch's keys, so here fingerprints are counted.
    whole = flags.report(flags.flag(flags.of_report(lake.read(spark, "raw_records")), now)).collect()
    assert done.flagged == 65 and [line.split(",")[0] for line in lines] == [r.id for r in whole]
    assert [line.split(",")[8] for line in lines] == [r.record_hash for r in whole]


def test_silver_rows_can_leave_out_their_hash(spark, lake, tmp_path):
    (tmp_path / "a.csv").write_text("source_id,event_time,value,category\n1,2026-01-05, 7 ,Cc\n2,2026-01-05,n/a,c\n")
    jobs.ingest(spark, lake, "s", [str(tmp_path / "a.csv")])
    jobs.refresh_clean(spark, lake)
    silver = lake.read(spark, "clean_records")
    small = tables._packed(silver).select("source_id", "_made_record_hash", "_hex_record_hash")
    # A value that means nothing is null in silver, so that row's hash doesn't follow from it.
    assert {r[0]: (r[1], r[2] is None) for r in small.collect()} == {"1": (True, True), "2": (False, False)}
    back = tables._unpacked(tables._packed(silver), silver)
    assert sorted(map(str, back.collect())) == sorted(map(str, silver.collect()))
