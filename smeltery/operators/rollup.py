"""Gold metrics: daily and monthly rollups, slices, trends and cards."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from smeltery.functions.dates import bucket
from smeltery.schemas import MEASURES

# What a trend may ask for.
GRANULARITIES = ("day", "week", "month")


def _utc_midnight(day: date) -> Column:
    return F.lit(datetime.combine(day, time(), timezone.utc))


def _month_ceiling(day: date) -> date:
    """First month start on or after ``day``."""
    if day.day == 1:
        return day
    return (day.replace(day=1) + timedelta(days=32)).replace(day=1)


def within(df: DataFrame, start: date | None, end: date | None, unit: str) -> DataFrame:
    """Rows whose bucket start lies in ``[start, end)``.

    A filter on the computed bucket would not reach file statistics, so the same range
    is stated on ``event_time`` itself and, where the table is partitioned by month,
    on the partition column as well.
    """
    ceiling = _month_ceiling if unit == "month" else (lambda day: day)
    if start is not None:
        first = ceiling(start)
        df = df.where(F.col("event_time") >= _utc_midnight(first))
        if "event_month" in df.columns:
            df = df.where(F.col("event_month") >= F.lit(first.replace(day=1)))
    if end is not None:
        stop = ceiling(end)
        df = df.where(F.col("event_time") < _utc_midnight(stop))
        if "event_month" in df.columns:
            df = df.where(F.col("event_month") < F.lit(stop))
    return df


def _distincts(*names: str) -> list[Column]:
    plural = {"source_id": "source_ids", "source": "sources", "category": "categories"}
    return [F.count_distinct(name).alias(f"distinct_{plural[name]}") for name in names]


def _rollup(
    df: DataFrame, name: str, unit: str, record_key: Sequence[str],
    unique_keys: bool = False, two_scans: bool = False,
) -> DataFrame:
    """Counts per bucket.

    By default one pass counts everything: Spark expands each row once per distinct count.
    ``two_scans`` is for stored tables: rows are first merged per bucket, source, category
    and source id, which shrinks them to what the narrow counts need, and only the record
    key, nearly unique, is shuffled at full length, in a scan of its own two columns.
    """
    day = bucket(unit, F.col("event_time")).alias(name)
    record = F.col(record_key[0]) if len(record_key) == 1 else F.struct(*record_key)
    dims = ("source_id", "source", "category")
    rows = F.count(F.lit(1))
    if two_scans and not unique_keys:
        merged = df.groupBy(day, *dims).agg(rows.alias("_rows"))
        by_dims = merged.groupBy(name).agg(
            F.sum("_rows").cast("bigint").alias("total_records"), *_distincts(*dims)
        )
        by_key = df.groupBy(day).agg(F.count_distinct(record).alias("distinct_records"))
        return by_dims.join(by_key, name).select(name, *MEASURES)
    return (
        df.select(day, *dims, "record_hash")
        .groupBy(name)
        .agg(
            rows.alias("total_records"),
            (rows if unique_keys else F.count_distinct(record)).alias("distinct_records"),
            *_distincts(*dims),
        )
    )


def monthly_metrics(
    silver: DataFrame, start: date | None = None, end: date | None = None,
    two_scans: bool = False,
) -> DataFrame:
    """Monthly rollup of silver; a record is its hash, whichever source it came from."""
    dated = within(silver.where(F.col("event_time").isNotNull()), start, end, "month")
    return _rollup(dated, "month_start", "month", ("record_hash",), two_scans=two_scans)


def daily_metrics(
    bronze: DataFrame, start: date | None = None, end: date | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """Daily rollup of bronze; a record is the pair of source and hash.

    ``unique_keys`` states that no pair occurs twice, as in the bronze table. Distinct
    records are then the row count, and nothing as wide as the table is shuffled.
    """
    days = within(bronze, start, end, "day")
    return _rollup(days, "day_date", "day", ("source", "record_hash"), unique_keys)


def monthly_metrics_raw(
    bronze: DataFrame, start: date | None = None, end: date | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """Monthly rollup of bronze; otherwise as :func:`daily_metrics`."""
    months = within(bronze, start, end, "month")
    return _rollup(months, "month_start", "month", ("source", "record_hash"), unique_keys)


def monthly_slice(
    monthly: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Months in ``[start, end)``, either bound optional, in order."""
    if start is not None:
        monthly = monthly.where(F.col("month_start") >= F.lit(start))
    if end is not None:
        monthly = monthly.where(F.col("month_start") < F.lit(end))
    return monthly.select("month_start", *MEASURES).orderBy("month_start")


def trend(
    daily: DataFrame,
    start: date,
    end: date,
    granularity: str = "day",
    metric: str = "total_records",
) -> DataFrame:
    """Daily metric re-bucketed and summed over ``[start, end)``.

    Sums of daily distinct counts count a value once per day, by contract; the first
    week's bucket may begin before ``start``.
    """
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}, got {granularity!r}")
    if metric not in MEASURES:
        raise ValueError(f"metric must be one of {MEASURES}, got {metric!r}")
    days = daily.where((F.col("day_date") >= F.lit(start)) & (F.col("day_date") < F.lit(end)))
    start_of = F.col("day_date") if granularity == "day" else bucket(granularity, F.col("day_date"))
    return (
        days.groupBy(start_of.alias("bucket_start"))
        .agg(F.sum(metric).cast("bigint").alias("value"))
        .orderBy("bucket_start")
    )


def last_days(today: date, days: int = 30) -> tuple[date, date]:
    """The range a dashboard opens with."""
    return today - timedelta(days=days), today


def share_of_max(points: DataFrame, column: str = "value") -> DataFrame:
    """Each point as a whole percentage of the largest one; 0 when the largest is 0."""
    # One row a bucket: few enough for one task, and the points are computed once.
    top = F.max(column).over(Window.partitionBy())
    share = F.floor(F.col(column) / F.nullif(top, F.lit(0)) * 100 + 0.5)
    return points.withColumn("share", F.coalesce(share, F.lit(0)).cast("bigint"))


def latest_month(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy(F.desc("month_start")).limit(1)
