"""Counts that merge: rows as numbers, distinct values as bitmaps, for each stored part of a table.

A value has a number of its own in ``numbers(name, value, number)``. A state row holds, for a part and a day
(or month), either a count ``n`` or the bits of one bucket of numbers. Counts of different parts add up, bits are
or-ed, so metrics of all parts follow from their states without a look at their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMS = ("source_id", "source", "category")
BY = ("part", "event_month", "day")


def values(rows: DataFrame) -> DataFrame:
    """The distinct values of each part and day; nulls aren't counted."""
    pairs = F.array(*[F.struct(F.lit(d).alias("name"), F.col(d).alias("value")) for d in DIMS])
    return rows.select(*BY, F.inline(pairs)).where("value IS NOT NULL").distinct()


def unnumbered(found: DataFrame, numbers: DataFrame) -> DataFrame:
    """The values without a number, once each."""
    return found.select("name", "value").distinct().join(numbers, ["name", "value"], "left_anti")


def counts(rows: DataFrame, hashes: bool) -> DataFrame:
    """Rows of each part and day, and with ``hashes`` their distinct record hashes. These add up over parts only
    where parts split the hashes between them."""
    wanted = [F.struct(F.lit("records").alias("name"), F.col("records").alias("n"))]
    aggregates = [F.count(F.lit(1)).alias("records")]
    if hashes:
        # Digests are shuffled as bytes; another text stays as it is, beside them.
        digest = F.col("record_hash").rlike("^[0-9a-f]{64}$")
        short = F.struct(F.when(digest, F.unhex("record_hash")).alias("bytes"), F.when(~digest, F.col("record_hash")).alias("text"))
        aggregates.append(F.count_distinct(F.when(F.col("record_hash").isNotNull(), short)).alias("hashes"))
        wanted.append(F.struct(F.lit("hashes").alias("name"), F.col("hashes").alias("n")))
    each = rows.groupBy(*BY).agg(*aggregates).select(*BY, F.inline(F.array(*wanted)))
    return each.select(*BY, "name", F.lit(0).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bits"), "n")


def bitmaps(found: DataFrame, numbers: DataFrame) -> DataFrame:
    """Numbers go through the shuffle, not bits: a bitmap has 4 KB however few of a bucket's numbers a task holds."""
    marked = found.join(numbers, ["name", "value"]).select(*BY, "name", F.bitmap_bucket_number("number").alias("bucket"), "number")
    by = [*BY, "name", "bucket"]
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    return marked.repartition(*by).groupBy(*by).agg(bits, F.lit(None).cast("bigint").alias("n"))


def metrics(states: DataFrame, name: str, records: str) -> DataFrame:
    """The measures by ``day_date`` or ``month_start``; ``records`` names the count of distinct records.

    A state that two refreshes have stored counts once.
    """
    day = F.col("day" if name == "day_date" else "event_month").alias(name)
    bits = states.where("bits IS NOT NULL").groupBy(day, "name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    sizes = bits.select(name, "name", F.bitmap_count("bits").alias("n"))
    once = states.where("bits IS NULL").dropDuplicates([*BY, "name"])
    sizes = sizes.union(once.groupBy(day, "name").agg(F.sum("n").alias("n")))

    def total(of: str, alias: str):
        return F.coalesce(F.sum(F.when(F.col("name") == of, F.col("n"))), F.lit(0)).cast("bigint").alias(alias)

    return sizes.groupBy(name).agg(
        total("records", "total_records"), total(records, "distinct_records"), total("source_id", "distinct_source_ids"),
        total("source", "distinct_sources"), total("category", "distinct_categories"),
    )
