"""Physical plans: what is pushed down, pruned, broadcast and split."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from smeltery.operators import dedupe, flags, rollup
from smeltery.sinks import tables
from smeltery.sources.tables import Lake, latest_n


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("stored")))
    rows = spark.range(4000).selectExpr(
        "cast(id AS string) AS id", "'r' AS run_id", "id AS row_num",
        "if(id % 3 = 0, 'hot', cast(id % 5 AS string)) AS source", "cast(id % 50 AS string) AS source_id",
        "timestamp'2026-01-01' + make_interval(0, cast(id % 12 AS int)) AS event_time",
        "'c' AS category", "cast(id AS string) AS value", "sha2(cast(id AS string), 256) AS record_hash",
        "map('value', 'x') AS payload",
        "timestamp'2026-01-01' + make_interval(0, 0, 0, cast(id % 9 AS int)) AS ingested_at",
    ).withColumn("event_month", F.trunc("event_time", "month"))
    assert tables.append(lake, "raw_records", rows) == 4000
    return lake


def test_slice_reaches_partitions_and_statistics(spark, stored):
    sliced = rollup.monthly_metrics_raw(
        stored.read(spark, "raw_records"), date(2026, 3, 15), date(2026, 6, 1))
    plan = plan_of(sliced)
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in plan
    assert "event_month" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert {r.month_start for r in sliced.collect()} == {date(2026, 4, 1), date(2026, 5, 1)}


def test_unique_keys_spare_the_hash_column(spark, stored):
    raw = stored.read(spark, "raw_records")
    short = rollup.daily_metrics(raw, unique_keys=True)
    assert "record_hash" not in plan_of(short)
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, rollup.daily_metrics(raw).collect()))


def test_two_scans_count_the_same_from_pruned_reads(spark, stored):
    raw = stored.read(spark, "raw_records")
    one, two = rollup.monthly_metrics(raw), rollup.monthly_metrics(raw, two_scans=True)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.select(*one.columns).collect()))
    scans = [line for line in plan_of(two).splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert sorted("record_hash" in line for line in scans) == [False, True]
    assert sorted("source_id" in line for line in scans) == [False, True]


def test_unique_rows_are_flagged_without_a_shuffle(spark, stored):
    now = datetime(2026, 6, 1, tzinfo=timezone.utc)
    raw = stored.read(spark, "raw_records")
    scan = flags.flag(raw, now, unique_keys=True)
    assert "Exchange" not in plan_of(scan)
    pick = ("id", "severity", "flag_codes", "flag_messages")
    one, two = (set(map(tuple, d.select(*pick).collect())) for d in (scan, flags.flag(raw, now)))
    assert one == two and one


def test_small_batch_scans_but_never_shuffles_the_table(spark, stored):
    raw = stored.read(spark, "raw_records")
    batch = raw.limit(20).select("source", "record_hash").union(
        spark.createDataFrame([("new", "h")], "source string, record_hash string"))
    fresh = dedupe.new_only(batch, raw)
    assert [tuple(r) for r in fresh.collect()] == [("new", "h")]
    assert "BroadcastHashJoin" in plan_of(fresh) and "LeftSemi" in plan_of(fresh)


def test_latest_rows_bound_the_scan(spark, stored):
    raw = stored.read(spark, "raw_records")
    newest = latest_n(raw, 500)
    assert "TakeOrderedAndProject" in plan_of(newest)
    want = sorted(raw.collect(), key=lambda r: (-r.ingested_at.timestamp(), r.source, r.record_hash))
    assert [r.id for r in newest.collect()] == [r.id for r in want[:500]]
    assert latest_n(raw, None) is raw


def test_flags_read_only_their_columns(spark, stored):
    now = datetime(2026, 6, 1, tzinfo=timezone.utc)
    report = flags.report(flags.flag(stored.read(spark, "raw_records").drop("event_month"), now))
    scans = [line for line in plan_of(report).splitlines() if "FileScan" in line]
    assert scans and all("payload" not in line for line in scans)
    assert "rangepartitioning" in plan_of(report)


def test_partition_order_does_not_matter(spark, stored):
    raw = stored.read(spark, "raw_records")
    twice = raw.union(raw.withColumn("row_num", F.col("row_num") + 10000))
    one = dedupe.keep_first(twice.repartition(7), ("row_num",)).select("id", "row_num")
    two = dedupe.keep_first(twice.coalesce(1), ("row_num",)).select("id", "row_num")
    assert one.exceptAll(two).isEmpty() and one.count() == 4000
    assert one.agg(F.max("row_num")).first()[0] < 10000
    assert dedupe.duplicate_keys(raw).isEmpty() and dedupe.duplicate_keys(twice).count() == 4000


def test_trend_rejects_unknown_requests(spark, stored):
    daily = rollup.daily_metrics(stored.read(spark, "raw_records"))
    with pytest.raises(ValueError, match="granularity"):
        rollup.trend(daily, date(2026, 1, 1), date(2026, 2, 1), "year")
    with pytest.raises(ValueError, match="metric"):
        rollup.trend(daily, date(2026, 1, 1), date(2026, 2, 1), "day", "rows")
