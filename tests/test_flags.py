"""Flag rules on a fixed batch, hot fingerprints, and the report."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from smeltery.operators import dedupe, flags

NOW = datetime(2026, 1, 16, tzinfo=timezone.utc)
SCHEMA = "id string, source string, source_id string, category string, event_time string, value string"


def batch(spark):
    now = NOW.isoformat()
    late, edge = (NOW + timedelta(days=1)).isoformat(), (NOW + timedelta(minutes=5)).isoformat()
    old = (NOW - timedelta(days=30)).isoformat()
    rows = [
        ("1", "pump", now, "\t\n"), ("2", "fan", now, "12 bar"), ("3", "valve", late, "-0.25"),
        ("4", "lamp", edge, "7.5"), ("5", "lamp", edge, "7.5"), ("6", "door", edge, "10"),
        ("7", "belt", old, "10"), ("8", "gate", "soon", "--"), ("9", "horn", now, "nan"),
        ("10", "tank", now, "12345678"), ("11", "coil", now, "1000000"), ("12", "wire", None, None),
        ("13", "bolt", "2025-12-16T23:00:00-05:00", "1"), ("14", "nut", "2025-01-02T01:00:00+05:00", "inf"),
    ]
    return spark.createDataFrame([(i, "s", k, "c", t, v) for i, k, t, v in rows], SCHEMA)


def test_rules_and_severity(spark):
    got = {r.id: r for r in flags.flag(batch(spark), NOW).collect()}
    codes = {i: (r.severity, r.flag_codes) for i, r in got.items()}
    assert codes == {
        "1": (40, "VALUE_EMPTY_OR_NULLISH"),
        "2": (40, "VALUE_NOT_NUMERIC"),
        "3": (60, "FUTURE_EVENT_TIME|VALUE_OUT_OF_RANGE"),
        "4": (30, "POSSIBLE_DUPLICATE_FINGERPRINT"),
        "5": (30, "POSSIBLE_DUPLICATE_FINGERPRINT"),
        "8": (80, "VALUE_NOT_NUMERIC|EVENT_TIME_INVALID"),
        "10": (35, "VALUE_OUT_OF_RANGE"),
        "12": (80, "VALUE_EMPTY_OR_NULLISH|EVENT_TIME_INVALID"),
        "14": (50, "STALE_EVENT_TIME|VALUE_OUT_OF_RANGE"),
    }
    assert got["1"].flag_messages == "VALUE_EMPTY_OR_NULLISH: value='' is empty or null-ish"
    assert got["3"].flag_messages == (
        "FUTURE_EVENT_TIME: event_time=2026-01-17T00:00:00+00:00 is in the future "
        "vs now=2026-01-16T00:00:00+00:00 || VALUE_OUT_OF_RANGE: value=-0.25 must be > 0")
    assert got["4"].flag_messages.endswith("Fingerprint appears 2 times in this batch")
    assert got["10"].flag_messages == "VALUE_OUT_OF_RANGE: value=12345678.0 exceeds 1,000,000"
    # The stale message quotes the day as written, with its own offset.
    assert got["14"].flag_messages == (
        "STALE_EVENT_TIME: event_time=2025-01-02 is older than 30 days || "
        "VALUE_OUT_OF_RANGE: value=inf exceeds 1,000,000")


def test_report_order_and_missing_columns(spark):
    report = flags.report(flags.flag(batch(spark), NOW))
    rows = report.collect()
    assert [r.id for r in rows] == ["12", "8", "3", "14", "1", "2", "10", "4", "5"]
    assert report.columns[:3] == ["id", "run_id", "row_num"] and rows[0].run_id == ""
    assert rows[0].event_time == "" and rows[0].value == ""
    assert [r.id for r in flags.top(flags.flag(batch(spark), NOW), 2).collect()] == ["12", "8"]
    assert flags.totals(batch(spark), flags.flag(batch(spark), NOW)).first()[:] == (14, 9)


def test_group_sizes_with_hot_keys(spark, monkeypatch):
    rows = spark.range(20000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string"))
        .alias("k"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("")).alias("n"),
    )
    want = {
        (r.k, r.n): r.c
        for r in rows.groupBy("k", "n").agg(F.count(F.lit(1)).alias("c")).collect()
    }
    for share in (2, 50, 2000):
        monkeypatch.setattr(dedupe, "HOT_SHARE", share)
        got = dedupe.with_group_size(rows, ("k", "n"), "copies").collect()
        assert len(got) == 20000
        assert all(r.copies == want[(r.k, r.n)] for r in got)


def test_keep_first_limits_groups_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("concat('s', id % 1) AS source", "concat('h', id % 1) AS record_hash", "id AS row_num")
    first = dedupe.keep_first(rows, ("row_num",))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert [r.row_num for r in first.collect()] == [0]
