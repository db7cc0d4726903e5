"""Typed keys, the content hash and the contract check of a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.dates import bucket, parse_event_time
from smeltery.functions.hashing import record_hash
from smeltery.functions.text import norm_str
from smeltery.schemas import MAX_LENGTHS


class IngestionError(ValueError):
    """The batch breaks the source contract; nothing of it is written."""


def extract_keys(df: DataFrame, read: Callable[[str], Column] = F.col) -> DataFrame:
    """Replace the four raw fields by trimmed, typed keys and add ``record_hash``.

    ``read`` says where a raw field lives: a column by default, or e.g. an entry of
    the payload map.
    """
    dtype = df.schema["event_time"].dataType if "event_time" in df.columns else T.StringType()
    keyed = df.withColumns(
        {
            "source_id": norm_str(read("source_id")),
            "event_time": parse_event_time(read("event_time"), dtype),
            "category": F.lower(norm_str(read("category"))),
            "value": norm_str(read("value")),
        }
    )
    return with_hash(keyed)


# Fixed value: the typed keys that the content hash covers.
HASHED = ("source_id", "event_time", "category", "value")


def with_hash(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("record_hash", record_hash(*[F.col(name) for name in HASHED]))


def with_event_month(df: DataFrame) -> DataFrame:
    return df.withColumn("event_month", bucket("month", F.col("event_time")))


def invalid_event_times(df: DataFrame) -> DataFrame:
    """Raw rows whose event time is missing or unreadable (the quarantine side of the split)."""
    dtype = df.schema["event_time"].dataType
    return df.where(parse_event_time(F.col("event_time"), dtype).isNull())


def with_unread(keyed: DataFrame) -> DataFrame:
    """Adds ``unread``: the trimmed text of an event time that can't be read, empty where there is none, and null
    where it was read. The raw text is still found in the payload."""
    raw = norm_str(F.col("payload")["event_time"])
    return keyed.withColumn("unread", F.when(F.col("event_time").isNull(), raw))


def contract_summary(keyed: DataFrame) -> DataFrame:
    """One row: how many rows break which rule.

    ``keyed`` carries ``unread``, so the payload isn't read for it. A single pass, aggregated on the map side.
    Only numbers are aggregated, which Spark does in generated code; ``check_batch`` asks for texts if there are any.
    """
    too_long = [
        F.count_if(F.length(name) > limit).alias(f"long_{name}")
        for name, limit in MAX_LENGTHS.items()
    ]
    return keyed.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("unread") == "").alias("missing_event_time"),
        F.count_if(F.col("unread") != "").alias("invalid_event_time"),
        F.count("header_error").alias("header_errors"),
        *too_long,
    )


def with_reasons(keyed: DataFrame) -> DataFrame:
    """Adds ``reasons``: what in the row breaks the contract, in fixed order; empty for a good row."""
    raw = norm_str(F.col("payload")["event_time"])
    unread = F.col("event_time").isNull()
    tests = [
        (F.col("header_error").isNotNull(), F.col("header_error")),
        (unread & (raw == ""), F.lit("event_time is required")),
        (unread & (raw != ""), F.concat(F.lit("Invalid event_time format: '"), raw, F.lit("'"))),
        *[(F.length(name) > limit, F.lit(f"{name} exceeds {limit} characters")) for name, limit in MAX_LENGTHS.items()],
    ]
    return keyed.withColumn("reasons", F.array_compact(F.array(*[F.when(broken, text) for broken, text in tests])))


def backfill_keys(raw: DataFrame, runs: DataFrame) -> DataFrame:
    """Source from the ingest run, keys and hash recomputed from the stored payload.

    The join is left to Spark: the run table is broadcast when its size allows it,
    otherwise both sides are shuffled and a hot run is split by the skew-join rule.
    """
    sources = runs.select(F.col("id").alias("run_id"), "source")
    stored = raw.select("id", "run_id", "payload").join(sources, "run_id")
    return extract_keys(stored, lambda name: F.col("payload")[name])
