"""What files and shuffles leave out because it follows from other columns, and that readers see it again."""

import glob

from pyspark.sql import functions as F

from smeltery.operators import states as merging
from smeltery.plans import jobs

HEADER = "source_id,event_time,value,category"


def ingested(spark, lake, tmp_path, rows, **options):
    path = tmp_path / "a.csv"
    path.write_text("\n".join([HEADER, *rows]) + "\n", encoding="utf-8")
    return jobs.ingest(spark, lake, "s", [str(path)], **options)


def test_batches_are_staged_without_hashes(spark, lake, tmp_path, monkeypatch):
    staged, real = {}, jobs.stage
    monkeypatch.setattr(jobs, "stage", lambda df, label: staged.setdefault(label, df.columns) and real(df, label))
    ingested(spark, lake, tmp_path, ["a,2026-01-05T06:00:00Z, 10 ,Alpha", "a,2026-01-05 06:00:00,10,alpha", "b,2026-01-05,1,c"])
    assert "record_hash" not in staged["ingest"] and "payload" in staged["ingest"]
    rows = {r.source_id: r for r in lake.read(spark, "raw_records").collect()}
    assert set(rows) == {"a", "b"} and rows["a"].row_num == 1
    want = spark.sql("""SELECT sha2('{"category":"alpha","event_time":"2026-01-05T06:00:00+00:00","source_id":"a","value":"10"}', 256)""").first()[0]
    assert rows["a"].record_hash == want


def test_files_hold_marks_instead_of_made_ids(spark, lake, tmp_path):
    ingested(spark, lake, tmp_path, [f"r{i},2026-01-05,{i},c" for i in range(9)])
    jobs.refresh_clean(spark, lake)
    for table, names in (("raw_records", ("id",)), ("clean_records", ("id", "raw_id"))):
        held = spark.read.parquet(*glob.glob(f"{lake.path(table)}/*=*/*=*", recursive=True))
        assert held.select([F.count(n) for n in names]).first() == (0,) * len(names)
    bronze, silver = lake.read(spark, "raw_records"), lake.read(spark, "clean_records")
    assert bronze.where(F.col("id") == F.sha2(F.concat_ws("|", "source", "record_hash"), 256)).count() == 9
    assert silver.join(bronze.select(F.col("id").alias("raw_id")), "raw_id").count() == 9
    # Ids of the first run stay when a later one brings the rows again, whatever they follow from.
    ids = {r.record_hash: r.id for r in silver.collect()}
    jobs.refresh_clean(spark, lake, everything=True)
    assert {r.record_hash: r.id for r in lake.read(spark, "clean_records").collect()} == ids


def test_files_that_hold_their_ids_are_read_as_they_are(spark, lake, tmp_path):
    ingested(spark, lake, tmp_path, ["a,2026-01-05,1,c"])
    other = lake.read(spark, "raw_records").withColumn("id", F.lit("mine")).drop("event_month")
    other.write.parquet(f"{lake.path('raw_records')}/batch=00000002.0/event_month=2026-01-01")
    assert sorted(r.id == "mine" for r in lake.read(spark, "raw_records").collect()) == [False, True]


def test_hashes_are_counted_as_bytes(spark):
    rows = spark.range(60).selectExpr(
        "'p' AS part", "DATE '2026-01-01' AS event_month", "DATE '2026-01-01' AS day",
        "CASE WHEN id < 40 THEN sha2(cast(id % 25 AS string), 256) WHEN id < 50 THEN cast(id % 4 AS string) END AS record_hash")
    counted = merging.counts(rows, hashes=True)
    assert {r.name: r.n for r in counted.collect()} == {"records": 60, "hashes": 29}
    exchange = [x for x in counted._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]
    assert all("record_hash" not in x or "unhex" in x for x in exchange)


def test_bits_are_set_after_the_shuffle(spark, tmp_path):
    spark.range(50).selectExpr(
        "concat('p', id % 3) AS part", "DATE '2026-01-01' AS event_month", "DATE '2026-01-01' AS day", "'source' AS name", "cast(id AS string) AS value",
        "id + 1 AS number").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    held = merging.bitmaps(rows.drop("number"), rows.select("name", "value", "number"))
    plan = held._jdf.queryExecution().executedPlan().toString().splitlines()
    last = min(i for i, line in enumerate(plan) if "Exchange" in line)   # its input stands below
    assert "partial_bitmap_construct_agg" in "".join(plan[:last]) and "bitmap_construct_agg" not in "".join(plan[last:])
    assert held.selectExpr("sum(bitmap_count(bits))").first()[0] == 50
