"""Metrics from merged states: equal to a recount after each batch, and only new parts are read."""

from pyspark.sql import functions as F

from smeltery.operators import states as merging
from smeltery.operators.numbering import numbered, placed
from smeltery.plans import jobs
from smeltery.sinks import states, tables
from smeltery.sources.tables import Lake

HEADER = "source_id,event_time,value,category"
GOLD = ("monthly_metrics", "daily_metrics", "monthly_metrics_raw")


def write(path, lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    return str(path)


def batch(k, rows=40):
    """Readings whose ids and categories come back in later batches, over two months and some days."""
    return [f"id{(i * 7 + k) % 23},2026-0{1 + (i + k) % 2}-{1 + i % 4:02d},{k}.{i},kind {i % (2 + k)}" for i in range(rows)]


def gold(spark, lake):
    return {name: sorted(tuple(r) for r in lake.read(spark, name).collect()) for name in GOLD}


def test_three_batches_equal_the_recount(spark, lake, tmp_path, monkeypatch):
    for k in range(3):
        path = write(tmp_path / f"{k}.csv", batch(k))
        # The second source repeats records, so hashes are fewer than rows in silver.
        jobs.ingest(spark, lake, "s" if k < 2 else "t", [path] if k < 2 else [path, str(tmp_path / "0.csv")])
        jobs.refresh_clean(spark, lake)
        read = []
        real = Lake._read
        monkeypatch.setattr(Lake, "_read", lambda self, s, t, folders, extra=(): (
            lambda kept: read.append((t, kept)) or real(self, s, t, kept, extra))(list(folders)))
        jobs.refresh_metrics(spark, lake, check=False)
        monkeypatch.undo()
        assert [f for t, kept in read if t == "raw_records" for f in kept] == [f"batch={k + 1:08d}.0"]
        assert all(f.startswith(f"version={k + 1:08d}/") for t, kept in read if t == "clean_records" for f in kept)
        merged = gold(spark, lake)
        jobs.refresh_metrics(spark, lake, check=False, recount=True)
        assert gold(spark, lake) == merged and merged["daily_metrics"]
    assert sum(r[1] for r in merged["monthly_metrics"]) > sum(r[2] for r in merged["monthly_metrics"])
    # Numbers are given once and without gaps.
    numbers = sorted(r.number for r in lake.read(spark, "value_numbers").collect())
    assert numbers == list(range(1, len(numbers) + 1))
    assert states.refresh(spark, lake, "raw_records")[1] == 0


def test_repaired_batches_are_counted_anew(spark, lake, tmp_path):
    jobs.ingest(spark, lake, "s", [write(tmp_path / "0.csv", batch(0))])
    jobs.refresh_metrics(spark, lake, check=False)
    before = gold(spark, lake)["daily_metrics"]
    tables.append(lake, "raw_records", lake.read(spark, "raw_records"))
    jobs.refresh_metrics(spark, lake, check=False)   # recounts by itself
    assert [r[2] for r in gold(spark, lake)["daily_metrics"]] == [r[2] for r in before]
    jobs.repair(spark, lake)
    jobs.refresh_metrics(spark, lake, check=False)
    assert gold(spark, lake)["daily_metrics"] == before


def test_segments_come_together_and_a_lost_race_is_tried_again(spark, lake, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SEGMENTS", 2)
    for k in range(4):
        jobs.ingest(spark, lake, "s", [write(tmp_path / f"{k}.csv", batch(k, 12))])
        jobs.refresh_metrics(spark, lake, check=False)
    assert lake.segments(spark, "raw_states") == ["segment=00000004.00000004", "segment=00000003.00000001"]
    assert lake.segments(spark, "raw_states", old=True) == []
    merged = gold(spark, lake)
    jobs.refresh_metrics(spark, lake, check=False, recount=True)
    assert gold(spark, lake) == merged

    late = spark.createDataFrame([("source", "late", 1000)], "name string, value string, number long")
    tries = []

    def new(stored):
        if not tries:
            tables.add_segment(spark, lake, "value_numbers", lambda _: late)
        tries.append(stored.agg(F.max("number")).first()[0])
        return spark.createDataFrame([("source", "mine", tries[-1] + 1)], late.schema)

    tables.add_segment(spark, lake, "value_numbers", new)
    assert len(tries) == 2 and tries[1] == 1000
    assert lake.read(spark, "value_numbers").where("value = 'mine'").first().number == 1001


def test_values_fill_several_buckets(spark):
    rows = spark.range(100_000).selectExpr(
        "concat('p=', id % 3) AS part", "DATE '2026-01-01' AS event_month", "DATE '2026-01-02' AS day",
        "concat('x', id % 70000) AS source_id", "if(id % 2 = 0, 's', NULL) AS source", "concat('c', id % 5) AS category",
        "concat('h', id % 90000) AS record_hash").cache()
    found = merging.values(rows)
    numbers = numbered(placed(merging.unnumbered(found, spark.createDataFrame([], "name string, value string"))).cache(), "number")
    held = merging.counts(rows, hashes=False).unionByName(merging.bitmaps(found, numbers))
    assert tuple(merging.metrics(held, "day_date", "records").first())[1:] == (100_000, 100_000, 70_000, 1, 5)
    rows.unpersist()


def test_numbers_follow_an_order(spark):
    rows = spark.range(1000, numPartitions=7).selectExpr("id", "if(id = 5, NULL, concat('k', id * 37 % 1000)) AS key")
    order = F.col("key").isNull(), F.col("key")
    got = numbered(placed(rows, *order).cache(), "n", 10).orderBy("n").collect()
    assert [r.n for r in got] == list(range(11, 1011)) and got[-1].id == 5
    assert [r.key for r in got[:-1]] == sorted(r.key for r in got[:-1])
