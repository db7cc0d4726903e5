"""The stored tables of one lake folder, and the latest-rows scan.

Bronze is a folder of batches, each published by one rename: ``batch=<number>.<generation>``, of which the
highest generation counts. Silver is a folder of versions, each with the months and hash prefixes that it
rewrote: ``version=<number>/event_month=<month>/prefix=<digits>``, of which the highest version counts. A gold
table is a folder of whole versions, of which the last one counts. States and numbers of values are segments,
``segment=<number>.<first>``, each of which stands for those from ``first`` on. Logs are appended to.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery import schemas
from smeltery.sources.folders import Folders, literal

TABLES: dict[str, T.StructType] = {
    "raw_records": schemas.RAW_RECORDS,
    "clean_records": schemas.CLEAN_RECORDS,
    "daily_metrics": schemas.DAILY_METRICS,
    "monthly_metrics": schemas.MONTHLY_METRICS,
    "monthly_metrics_raw": schemas.MONTHLY_METRICS,
    "ingest_runs": schemas.INGEST_RUNS,
    "pipeline_runs": schemas.PIPELINE_RUNS,
    "data_quality_checks": schemas.DATA_QUALITY_CHECKS,
    "rejected_rows": schemas.REJECTED_ROWS,
    "raw_states": schemas.PART_STATES,
    "clean_states": schemas.PART_STATES,
    "value_numbers": schemas.VALUE_NUMBERS,
}
BATCHED, MERGED = ("raw_records",), ("clean_records",)
REPLACED = ("daily_metrics", "monthly_metrics", "monthly_metrics_raw")
SEGMENTED = ("raw_states", "clean_states", "value_numbers")
MONTH, PREFIX = "event_month", "prefix"

# The columns that ids are digests of. Where an id is that digest, files hold a mark instead of it.
BRONZE_ID, SILVER_ID = ("source", "record_hash"), ("run_id", "source", "record_hash")
MADE = "_made_"


def made_ids(columns: Iterable[str], hashed: Column | None = None) -> dict[str, Column]:
    """The ids among the columns of bronze or silver, as the jobs make them of other columns; ``hashed`` may say how
    the record hash is had where its column doesn't hold it."""
    ids = {"raw_id": BRONZE_ID, "id": SILVER_ID} if "raw_id" in columns else {"id": BRONZE_ID}
    given = {} if hashed is None else {"record_hash": hashed}
    return {name: F.sha2(F.concat_ws("|", *[given.get(c, F.col(c)) for c in of]), 256) for name, of in ids.items() if {name, *of} <= set(columns)}


def _none(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, and Spark knows it when it plans: what is joined to them needn't be shuffled."""
    return spark.createDataFrame([], schema).where(F.lit(False))


@dataclass(frozen=True)
class Part:
    """One month and hash prefix of silver, as a version wrote it."""

    version: int
    month: str
    prefix: str

    @property
    def folder(self) -> str:
        return f"version={self.version:08d}/{MONTH}={self.month}/{PREFIX}={self.prefix}"


@dataclass(frozen=True)
class Lake:
    """A folder with one table per name in ``TABLES``.

    ``digits`` of the hash name the folders of a silver month (16 for one, 256 for two); a table keeps the
    number that it began with.
    """

    root: str
    digits: int = 1

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def folders(self, spark: SparkSession, table: str) -> Folders:
        return Folders(spark, self.path(table))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table, empty when nothing has been written yet."""
        if table in BATCHED:
            return self._read(spark, table, self._batch_folders(spark).values())
        if table in MERGED:
            return self.read_parts(spark, table, self.parts(spark, table))
        if table in REPLACED:
            return self._read(spark, table, self.folders(spark, table).names()[-1:])
        if table in SEGMENTED:
            return self._read(spark, table, self.segments(spark, table))
        try:
            return spark.read.schema(TABLES[table]).parquet(literal(self.path(table)))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return _none(spark, TABLES[table])

    def _read(self, spark: SparkSession, table: str, folders: Iterable[str], extra: Sequence[str] = ()) -> DataFrame:
        schema = TABLES[table]
        paths = [f"{literal(self.path(table))}/{folder}" for folder in folders]
        if not paths:
            return _none(spark, T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in extra]]))
        # The folders' own numbers stay text.
        named = T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in extra]])
        ids = made_ids(schema.names) if table in (*BATCHED, *MERGED) else {}
        held = T.StructType([*named.fields, *[T.StructField(MADE + n, T.BooleanType()) for n in ids]])
        rows = spark.read.schema(held).option("basePath", literal(self.path(table))).parquet(*paths)
        # Files without marks hold every id as it is.
        return rows.select(*[F.when(F.col(MADE + n), ids[n]).otherwise(F.col(n)).alias(n) if n in ids else n for n in named.names])

    def versions(self, spark: SparkSession, table: str) -> list[int]:
        return [int(name.split("=")[1]) for name in self.folders(spark, table).names()]

    def _batch_folders(self, spark: SparkSession) -> dict[int, str]:
        """The folder of each batch; names sort by number, then generation."""
        return {int(name.split("=")[1].split(".")[0]): name for name in self.folders(spark, "raw_records").names()}

    def batches(self, spark: SparkSession) -> list[int]:
        """Numbers of the published batches. They are given in the order of publishing."""
        return list(self._batch_folders(spark))

    def read_batches(self, spark: SparkSession, numbers: Iterable[int], with_batch: bool = False) -> DataFrame:
        """Only the given batches of bronze; ``with_batch`` adds the name of each row's batch."""
        found = self._batch_folders(spark)
        return self._read(spark, "raw_records", [found[n] for n in numbers if n in found], ("batch",) if with_batch else ())

    def read_months(self, spark: SparkSession, table: str, months: Sequence[date], after: int = 0) -> DataFrame:
        """Only the given months, and of bronze only batches ``after`` that number.

        The other months' folders are not even listed by Spark, so looking up a batch costs what its
        months hold, however many files the whole table has.
        """
        chosen = {str(month) for month in months}
        if table in MERGED:
            return self.read_parts(spark, table, [p for p in self.parts(spark, table) if p.month in chosen])
        folders, wanted = self.folders(spark, table), {f"{MONTH}={month}" for month in chosen}
        batches = [name for number, name in self._batch_folders(spark).items() if number > after]
        return self._read(spark, table, [f"{b}/{m}" for b in batches for m in folders.names(b) if m in wanted])

    def parts(self, spark: SparkSession, table: str, old: bool = False) -> list[Part]:
        """The current parts of a merged table; with ``old``, those that later versions have replaced."""
        folders, current, replaced = self.folders(spark, table), {}, []
        for version in folders.names():
            for month in folders.names(version):
                for prefix in folders.names(f"{version}/{month}"):
                    part = Part(int(version.split("=")[1]), month.split("=")[1], prefix.split("=")[1])
                    if (key := (part.month, part.prefix)) in current:
                        replaced.append(current[key])
                    current[key] = part
        return replaced if old else list(current.values())

    def read_parts(self, spark: SparkSession, table: str, parts: Iterable[Part]) -> DataFrame:
        return self._read(spark, table, [p.folder for p in parts])

    def part_names(self, spark: SparkSession, table: str) -> list[str]:
        """The folders that the table shows now: batches of bronze, parts of silver. What one holds never changes."""
        if table in BATCHED:
            return list(self._batch_folders(spark).values())
        return [part.folder for part in self.parts(spark, table)]

    def read_named(self, spark: SparkSession, table: str, names: Iterable[str]) -> DataFrame:
        """The rows of these folders, with the folder's name as ``part``."""
        extra = ("batch",) if table in BATCHED else ("version", PREFIX)
        keys = ("batch",) if table in BATCHED else ("version", MONTH, PREFIX)
        name = F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
        return self._read(spark, table, names, extra).withColumn("part", name)

    def segments(self, spark: SparkSession, table: str, old: bool = False) -> list[str]:
        """The current segments, the last one first; with ``old``, those that a later one stands for."""
        current, replaced, first = [], [], None
        for name in reversed(self.folders(spark, table).names()):
            number, begins = map(int, name.split("=")[1].split("."))
            if first is not None and number >= first:
                replaced.append(name)
            else:
                current.append(name)
                first = begins
        return replaced if old else current


def latest_n(
    table: DataFrame,
    n: int | None,
    by: str = "ingested_at",
    tiebreak: Sequence[str] = ("source", "record_hash"),
) -> DataFrame:
    """The ``n`` newest rows; ``None`` means the whole table.

    All rows of a batch share ``ingested_at``, so the order needs a tiebreak. The oldest
    moment that can still matter is found from that column alone; the wide rows are then
    read only from there on, with the bound pushed to the file scan.
    """
    if n is None:
        return table
    oldest = table.select(by).orderBy(F.desc(by)).limit(n).agg(F.min(by)).scalar()
    recent = table.where(F.col(by) >= oldest)
    return recent.orderBy(F.desc(by), *[F.asc(c) for c in tiebreak]).limit(n)
