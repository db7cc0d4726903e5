"""Keep-first, insert-if-absent and duplicate counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from smeltery.session import stage

KEY = ("source", "record_hash")

# A group is called hot when it holds more than 1/HOT_SHARE of all rows. At most
# HOT_SHARE groups can be hot, whatever the size of the data.
HOT_SHARE = 2000


def keep_first(df: DataFrame, order: Sequence[str], keys: Sequence[str] = KEY) -> DataFrame:
    """First row of each key in ``order``.

    Written as ``row_number() = 1`` so that Spark puts a partial group limit before the
    shuffle: every map task sends at most one row per key, however many copies there are.
    """
    by_key = W.Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(by_key)).where("_rn = 1").drop("_rn")


def new_only(
    batch: DataFrame, existing: DataFrame, keys: Sequence[str] = KEY,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``batch`` (unique keys) whose key is not in ``existing``.

    The stored keys are first reduced to those that occur in the batch. For a small
    batch Spark broadcasts the batch's keys and the stored table is only scanned, never
    shuffled; for a large one both sides are hashed on the key and the anti join reuses
    that partitioning. ``probe`` may name a cheaper frame that holds the batch's keys,
    such as the staged rows before dedupe; their copies are merged on the map side.
    """
    asked = (batch if probe is None else probe).select(*keys).distinct()
    seen = existing.select(*keys).join(asked, list(keys), "left_semi")
    return batch.join(seen, list(keys), "left_anti")


def mark(keys: Sequence[str] = KEY) -> Column:
    """Eight bytes for a key. Equal keys have equal marks; other keys seldom do, and nothing may rest on that."""
    return F.xxhash64(*keys).alias("_mark")


def disjoint(one: DataFrame, other: DataFrame, keys: Sequence[str] = KEY) -> bool:
    """True only if no key is in both frames; marks alone are compared, so it may be False by chance."""
    return one.select(mark(keys)).join(other.select(mark(keys)), "_mark", "left_semi").isEmpty()


def first_new(
    staged: DataFrame, existing: DataFrame, order: Sequence[str], keys: Sequence[str] = KEY
) -> DataFrame:
    """``new_only`` of ``keep_first`` for staged rows whose ``order`` differs between all rows.

    Marks say which keys may occur twice or be stored. Only those rows' keys are compared in full; what remains
    leaves out the rows that lose, by their place. So rows whose key is alone and new are never shuffled.
    """
    marks = staged.select(mark(keys))
    twice = marks.groupBy("_mark").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_mark")
    stored = existing.select(mark(keys)).join(marks, "_mark", "left_semi")
    shared = stage(twice.union(stored).distinct(), "shared")
    if shared.isEmpty():
        return staged
    asked = staged.select(*keys, *order, mark(keys)).join(shared, "_mark", "left_semi").drop("_mark")
    held = existing.select(*keys, mark(keys)).join(shared, "_mark", "left_semi").drop("_mark")
    kept = new_only(keep_first(asked, order, keys), held, keys)
    losers = stage(asked.select(*order).join(kept.select(*order), list(order), "left_anti"), "losers")
    return staged.join(losers, list(order), "left_anti").select(*staged.columns)


def batch_counts(batch: DataFrame, file_ord: str, keys: Sequence[str] = KEY) -> DataFrame:
    """Rows per file and in all: total, inserted (first file that brings the key), deduped.

    Copies are counted per key and file on the map side first. A key then has at most one
    row per file, and its first file is the smallest of them.
    """
    per_file = batch.groupBy(*keys, file_ord).agg(F.count(F.lit(1)).alias("_rows"))
    first = F.row_number().over(W.Window.partitionBy(*keys).orderBy(file_ord)) == 1
    placed = per_file.select(file_ord, "_rows", F.when(first, 1).otherwise(0).alias("_new"))
    counted = placed.rollup(file_ord).agg(
        F.sum("_rows").cast("bigint").alias("total_records"),
        F.sum("_new").cast("bigint").alias("inserted_records"),
    )
    return counted.select(
        F.coalesce(F.col(file_ord).cast("string"), F.lit("all")).alias("file"),
        "total_records", "inserted_records",
        (F.col("total_records") - F.col("inserted_records")).alias("deduped_records"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Keys stored more than once; empty on a table that only the jobs here write."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def fingerprint(columns: Sequence[str]) -> Column:
    """Fixed-width digest of the columns, as bytes; lengths keep neighbours apart, null is not empty."""

    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))

    # Never null, which spares the join a null test that would compute the digest twice.
    return F.coalesce(F.unhex(F.sha2(F.concat(*[part(c) for c in columns]), 256)), F.lit(b""))


def _spread_key() -> Column:
    """Differs between all rows; it is shorter than a digest and matches none, so it only decides where a row goes."""
    return F.concat(F.lit("hot-"), F.monotonically_increasing_id().cast("string")).cast("binary")


def with_group_size(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Add how often the row's ``columns`` occur in ``df`` without gathering any group.

    Sizes are counted with map-side partial sums. Only groups of two or more rows are
    joined back. Hot groups come back through a broadcast that holds at most
    ``HOT_SHARE`` digests; their rows then get a spread-out join key, so the shuffled
    join of the remaining groups sees no group above 1/HOT_SHARE of the rows.
    """
    tagged = df.withColumn("_fp", fingerprint(columns))
    sizes = tagged.groupBy("_fp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    total = df.agg(F.count(F.lit(1))).scalar()
    hot = sizes.where(F.col("_n") * HOT_SHARE > total)
    rest = sizes.where(F.col("_n") * HOT_SHARE <= total)
    spread = (
        tagged.join(F.broadcast(hot.withColumnRenamed("_n", "_hot")), "_fp", "left")
        .withColumn("_key", F.when(F.col("_hot").isNull(), F.col("_fp")).otherwise(_spread_key()))
        .join(rest.select(F.col("_fp").alias("_key"), "_n"), "_key", "left")
    )
    return spread.withColumn(
        name, F.coalesce(F.col("_hot"), F.col("_n"), F.lit(1)).cast("bigint")
    ).select(*df.columns, name)
