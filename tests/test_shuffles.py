"""What goes through shuffles: not whole rows where marks or bytes do, and no group in one task."""

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from smeltery.operators import dedupe
from smeltery.sinks import tables
from smeltery.sources.batch import read_batch, with_row_numbers
from smeltery.sources.tables import Lake


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_files_are_not_gathered_by_file_or_block(spark, tmp_path):
    (tmp_path / "a.csv").write_text("source_id,event_time,value,category\n1,2026-01-05,2,c\n2,2026-01-05,3,c\n")
    rows, _ = read_batch(spark, [str(tmp_path / "a.csv")])
    assert "Exchange hashpartitioning(file_path" not in plan_of(rows)
    numbered = with_row_numbers(rows, rows)
    assert "SortMergeJoin" not in plan_of(numbered)
    assert [(r.source_id, r.row_num) for r in numbered.orderBy("row_num").collect()] == [("1", 1), ("2", 2)]


def test_first_new_compares_only_shared_keys(spark, monkeypatch):
    rows = spark.range(300).selectExpr("'s' AS source", "cast(id % 200 AS string) AS record_hash", "id AS at", "repeat('x', 9) AS wide")
    stored = spark.range(150, 160).selectExpr("'s' AS source", "cast(id AS string) AS record_hash")
    got = dedupe.first_new(rows, stored, ("at",))
    want = dedupe.new_only(dedupe.keep_first(rows, ("at",)), stored)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*rows.columns).collect())) and got.count() == 190
    alone = rows.where("at < 100")
    assert dedupe.first_new(alone, stored, ("at",)) is alone
    # Marks that meet by chance only cost a closer look.
    monkeypatch.setattr(dedupe, "mark", lambda keys=dedupe.KEY: (F.xxhash64(*keys) % 7).alias("_mark"))
    assert sorted(map(tuple, dedupe.first_new(rows, stored, ("at",)).collect())) == sorted(map(tuple, got.collect()))


def test_digests_travel_as_bytes_and_come_back(spark):
    made = F.sha2(F.concat_ws("|", "source", "record_hash"), 256)
    rows = spark.range(6).select(
        F.when(F.col("id") == 1, "ABC").when(F.col("id") == 2, F.sha2(F.lit("other"), 256)).when(F.col("id") != 3, F.lit("")).alias("id0"),
        F.lit("s").alias("source"), F.when(F.col("id") == 4, "h").when(F.col("id") != 5, F.sha2(F.col("id").cast("string"), 256)).alias("record_hash"),
        (F.col("id") * 2).alias("n"),
    ).withColumn("id", F.when(F.col("id0") == "", made).otherwise(F.col("id0"))).drop("id0")
    small = tables._packed(rows)
    back = tables._unpacked(small, rows)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect())) and back.columns == rows.columns
    text = small.agg(F.sum(F.length("id")), F.sum(F.length("record_hash"))).first()
    assert tuple(text) == (3, 1)   # what is no digest stays text
    upper = rows.withColumn("record_hash", F.upper("record_hash"))
    assert sorted(map(str, tables._unpacked(tables._packed(upper), upper).collect())) == sorted(map(str, upper.collect()))


def test_nothing_stored_is_joined_without_a_shuffle(spark, lake):
    rows = spark.range(5).selectExpr("'s' AS source", "cast(id AS string) AS record_hash")
    assert "Exchange" not in plan_of(rows.join(lake.read(spark, "raw_records").select(*dedupe.KEY), list(dedupe.KEY), "left_anti"))
