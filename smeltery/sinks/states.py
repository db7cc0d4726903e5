"""The states of stored parts, computed once for each part that a table shows.

Bronze batches and the parts of silver never change: a repair or an upsert replaces them under a new name. So a
state is right as long as its part is shown, and a refresh reads only the parts that have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.dates import bucket
from smeltery.operators import states
from smeltery.operators.numbering import numbered, placed
from smeltery.session import stage
from smeltery.sinks.tables import add_segment
from smeltery.sources.tables import Lake

STATES = {"raw_records": "raw_states", "clean_records": "clean_states"}


def number_values(spark: SparkSession, lake: Lake, found: DataFrame) -> DataFrame:
    """``value_numbers``, with a number for every value found. A number once given stays."""
    def new(numbers: DataFrame) -> DataFrame:
        last = numbers.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        return numbered(stage(placed(states.unnumbered(found, numbers)), "new-values"), "number", last)

    add_segment(spark, lake, "value_numbers", new)
    return lake.read(spark, "value_numbers")


def refresh(spark: SparkSession, lake: Lake, table: str) -> tuple[DataFrame, int]:
    """States of all parts that the table shows, and how many parts were read for them."""
    shown = lake.part_names(spark, table)
    stored = lake.read(spark, STATES[table])
    # One name for each part, as many as the driver lists anyway.
    known = {r[0] for r in stored.where("name = 'records'").select("part").distinct().collect()}
    missing = [name for name in shown if name not in known]
    if missing:
        rows = lake.read_named(spark, table, missing)
        day = bucket("day", F.col("event_time")) if table == "raw_records" else F.col("event_month")
        narrow = rows.where("event_time IS NOT NULL").select(
            "part", "event_month", day.alias("day"), *states.DIMS, "record_hash")
        found = stage(states.values(narrow), "values")
        numbers = number_values(spark, lake, found)
        new = stage(states.counts(narrow, hashes=table == "clean_records").unionByName(states.bitmaps(found, numbers)), "states")
        add_segment(spark, lake, STATES[table], lambda _: new, keep=_of(spark, shown))
    return _of(spark, shown)(lake.read(spark, STATES[table])), len(missing)


def _of(spark: SparkSession, parts: list[str]) -> Callable[[DataFrame], DataFrame]:
    """The states of these parts."""
    names = spark.createDataFrame([(p,) for p in parts], "part string")
    return lambda rows: rows.join(names, "part", "left_semi")
