"""Appends, upserts and replacements of Parquet tables. What a table shows changes by one rename."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.hashing import record_hash
from smeltery.functions.text import norm_str
from smeltery.operators.dedupe import disjoint
from smeltery.operators.keys import HASHED
from smeltery.operators.merge import upsert
from smeltery.sources.tables import BATCHED, MADE, MONTH, PREFIX, TABLES, Lake, made_ids

KEPT = 2   # versions of a part or table that stay, so that running readers finish
SEGMENTS = 16   # of a table before the next one stands for all of them

# Columns of SHA-256 digests in hexadecimal digits.
DIGESTS = ("id", "raw_id", "record_hash")


def _conform(df: DataFrame, table: str, *more: str) -> DataFrame:
    """The table's columns in order; rows without ``numeric`` have no numeric cells."""
    if "numeric" in TABLES[table].names and "numeric" not in df.columns:
        df = df.withColumn("numeric", F.array().cast("array<string>"))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[table].fields], *more)


def _counted(rows: DataFrame, path: str, by: Sequence[str] = (), mode: str = "errorifexists") -> int:
    """Writes the rows and returns their number, counted by the writing job itself.

    Partitioned tables are rebalanced first: a folder gets as many files as its size asks for, and a
    folder with a third of all rows is split over many tasks.
    """
    seen = Observation()
    out = _unpacked(_packed(rows).hint("rebalance", *by), rows, thin=True) if by else rows
    writer = out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return int(seen.get["n"])


def _derived(rows: DataFrame) -> dict[str, Column]:
    """Digests that the jobs make of other columns, each after those it is made of. A table may hold others, so
    each is compared before it is left out."""
    names = set(rows.columns)
    # Silver keeps the spelling of categories and values; the hash covers lower-case categories and trimmed values.
    asis, spelled = {n: F.col(n) for n in HASHED}, {"category": F.lower("category"), "value": norm_str(F.col("value_text"))}
    of = {**asis, **spelled} if "value_text" in names else asis
    held = {"record_hash", *HASHED} - ({"value"} if "value_text" in names else set()) <= names
    content = {"record_hash": record_hash(*of.values())} if held else {}
    return {**content, **made_ids(rows.columns)}


def _packed(rows: DataFrame) -> DataFrame:
    """The rows as they go through a shuffle: digests as bytes, or not at all where they follow from other columns."""
    made = {MADE + name: F.col(name).eqNullSafe(digest) for name, digest in _derived(rows).items()}
    tested = rows.withColumns(made) if made else rows
    small = {}
    for name in [n for n in DIGESTS if n in rows.columns]:
        rest = F.when(~F.col(MADE + name), F.col(name)) if MADE + name in made else F.col(name)
        small[f"_hex_{name}"] = F.when(rest.rlike("^[0-9a-f]{64}$"), F.unhex(rest))
        small[name] = F.when(~rest.rlike("^[0-9a-f]{64}$"), rest)
    return tested.withColumns(small) if small else tested


def packed_id(rows: DataFrame) -> Column:
    """The id of ``_packed`` rows as an expression, so that rows can be ordered by ids that they don't carry."""
    derived = _derived(rows)

    def read(name: str, digest: Column | None) -> Column:
        kept = F.coalesce(F.lower(F.hex(f"_hex_{name}")), F.col(name))
        return kept if digest is None else F.when(F.col(MADE + name), digest).otherwise(kept)

    hashed = read("record_hash", derived.get("record_hash"))
    return read("id", made_ids(rows.columns, hashed).get("id"))


def _unpacked(small: DataFrame, rows: DataFrame, thin: bool = False) -> DataFrame:
    """The columns of ``rows`` again, from ``_packed`` ones; ``thin`` leaves ids that follow from other columns to
    the reader and adds their marks."""
    plain = {n: F.coalesce(F.lower(F.hex(f"_hex_{n}")), F.col(n)) for n in DIGESTS if n in rows.columns}
    out, marks = small.withColumns(plain) if plain else small, []
    for n, digest in _derived(rows).items():
        if thin and n in made_ids(rows.columns):
            marks.append(MADE + n)
        else:
            out = out.withColumn(n, F.when(F.col(MADE + n), digest).otherwise(F.col(n)))
    return out.select(*rows.columns, *marks)


def append(lake: Lake, table: str, rows: DataFrame) -> int:
    """Append and return the number of rows."""
    if table not in BATCHED:
        return _counted(_conform(rows, table), lake.path(table), mode="append")
    batch = PendingBatch.write(rows.sparkSession, lake, rows)
    while batch.number is None:
        batch.publish(max(lake.batches(rows.sparkSession), default=0))
    return batch.rows


@dataclass
class PendingBatch:
    """Rows of bronze in a folder that readers don't see, until ``publish`` gives it a number."""

    spark: SparkSession
    lake: Lake
    hidden: str
    rows: int
    number: int | None = None

    @classmethod
    def write(cls, spark: SparkSession, lake: Lake, rows: DataFrame) -> "PendingBatch":
        folders = lake.folders(spark, "raw_records")
        hidden = folders.hidden()
        try:
            n = _counted(_conform(rows, "raw_records"), f"{folders.root}/{hidden}", (MONTH,))
        except Exception:
            folders.drop(hidden)
            raise
        return cls(spark, lake, hidden, n)

    def read(self) -> DataFrame:
        return self.lake._read(self.spark, "raw_records", [self.hidden])

    def publish(self, last: int) -> bool:
        """Takes the number after ``last``; False if another batch has it by now. No rows, no batch."""
        folders = self.lake.folders(self.spark, "raw_records")
        if not self.rows:
            folders.drop(self.hidden)
            self.number = 0
        elif folders.publish(self.hidden, f"batch={last + 1:08d}.0"):
            self.number = last + 1
        return self.number is not None

    def drop(self) -> None:
        if self.number is None:
            self.lake.folders(self.spark, "raw_records").drop(self.hidden)


def touched_months(rows: DataFrame) -> list:
    """The months a batch touches: one value per calendar month, so the list stays short."""
    return [r[0] for r in rows.select(MONTH).distinct().collect()]


def upsert_by_part(
    spark: SparkSession, lake: Lake, table: str, incoming: DataFrame,
    keys: Sequence[str], keep: Sequence[str] = (), unique: bool = False,
) -> tuple[int, int]:
    """Upsert into a table of months and hash prefixes, rewriting only the parts it touches.

    The merged parts are written to a hidden folder, which becomes the next version by one rename: readers
    see all of the upsert or nothing. If another version came first, the parts are merged anew. Parts that
    were replaced before the last version are deleted. Returns the version and how many rows were added.

    ``unique`` states that no key comes twice in ``incoming``. Where none of them is stored either, the merged
    parts are the rows of both, without a join.
    """
    folders, prefix = lake.folders(spark, table), F.substring("record_hash", 1, lake.digits).alias(PREFIX)
    rows = _conform(incoming, table, prefix)
    # At most 16 ** digits folders a month.
    touched = {(str(r[0]), r[1]) for r in rows.select(MONTH, PREFIX).distinct().collect()}
    while True:
        last = max(lake.versions(spark, table), default=0)
        if not touched:
            return last, 0
        stored = [p for p in lake.parts(spark, table) if (p.month, p.prefix) in touched]
        existing = lake.read_parts(spark, table, stored)
        if unique and (not stored or disjoint(existing, rows, keys)):
            merged = existing.select("*", prefix).unionByName(rows)
        else:
            merged = upsert(existing.select("*", prefix), rows, (MONTH, PREFIX, *keys), keep)
        hidden = folders.hidden()
        try:
            written = _counted(merged.select(*TABLES[table].names, PREFIX), f"{folders.root}/{hidden}", (MONTH, PREFIX))
            added = written - existing.count()   # from file footers
        except Exception:
            folders.drop(hidden)
            raise
        if folders.publish(hidden, f"version={last + 1:08d}"):
            break
        folders.drop(hidden)
    for part in lake.parts(spark, table, old=True):
        if part.version < last or (part.month, part.prefix) not in touched:
            folders.drop(part.folder)
    return last + 1, added


def upsert_small(
    spark: SparkSession, lake: Lake, table: str, incoming: DataFrame, keys: Sequence[str]
) -> None:
    """Upsert into a gold table (one row per day or month) by writing its next version."""
    folders = lake.folders(spark, table)
    while True:
        last = max(lake.versions(spark, table), default=0)
        hidden = folders.hidden()
        try:
            _counted(upsert(lake.read(spark, table), _conform(incoming, table), keys), f"{folders.root}/{hidden}")
        except Exception:
            folders.drop(hidden)
            raise
        if folders.publish(hidden, f"version={last + 1:08d}"):
            break
        folders.drop(hidden)
    for name in folders.names()[:-KEPT]:
        folders.drop(name)


def add_segment(
    spark: SparkSession, lake: Lake, table: str, new: Callable[[DataFrame], DataFrame],
    keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Adds the rows that ``new`` makes of those stored, as the next segment; no rows, no segment.

    Each time ``SEGMENTS`` have come together the next one holds their rows as well, as far as ``keep`` leaves
    them. What it stands for is deleted with the segment after it. If another writer took the number, ``new``
    sees its rows in the next try.
    """
    folders, by = lake.folders(spark, table), (MONTH,) if MONTH in TABLES[table].names else ()
    while True:
        names, old = lake.segments(spark, table), lake.segments(spark, table, old=True)
        last = int(names[0].split("=")[1].split(".")[0]) if names else 0
        stored, first = lake._read(spark, table, names), last + 1
        rows = _conform(new(stored), table)
        if len(names) >= SEGMENTS:
            rows, first = keep(stored.unionByName(rows)), 1
        hidden = folders.hidden()
        try:
            written = _counted(rows, f"{folders.root}/{hidden}", by)
        except Exception:
            folders.drop(hidden)
            raise
        if written and folders.publish(hidden, f"segment={last + 1:08d}.{first:08d}"):
            break
        folders.drop(hidden)
        if not written:
            return
    for name in old:
        folders.drop(name)


def replace_batch(spark: SparkSession, lake: Lake, batch: str, rows: DataFrame) -> None:
    """A batch of bronze anew, as its next generation; ``batch`` is the number and generation it replaces."""
    folders, (number, generation) = lake.folders(spark, "raw_records"), batch.split(".")
    hidden = folders.hidden()
    _counted(_conform(rows, "raw_records"), f"{folders.root}/{hidden}", (MONTH,))
    if not folders.publish(hidden, f"batch={number}.{int(generation) + 1}"):
        folders.drop(hidden)
        raise RuntimeError(f"Batch {number} was changed by another run")
    folders.drop(f"batch={batch}")
