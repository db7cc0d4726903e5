"""Incremental ingest: new files of a folder, each seen once, through the same job as any batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from smeltery.plans.jobs import ingest
from smeltery.session import ensure_utc
from smeltery.sources.tables import Lake

# The columns of Spark's source of whole files.
FILES = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])


def new_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Names of new files; their contents aren't read here."""
    reader = spark.readStream.format("binaryFile").schema(FILES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select("path", "modificationTime")


def ingest_stream(
    spark: SparkSession, lake: Lake, source: str, folder: str, checkpoint: str,
    max_files: int | None = None, set_aside: bool = False,
) -> StreamingQuery:
    """Ingest what is new, at most ``max_files`` files per micro-batch, and stop.

    The stream carries names only; each micro-batch's files go through ``ingest`` in the order they were
    last written, so headers may be in any order and workbooks are welcome. A micro-batch that is replayed
    after a failure inserts nothing twice, because the job inserts only keys that are absent. A file that
    breaks the contract stops the stream, unless its rows are ``set_aside``.
    """
    ensure_utc(spark)

    def sink(files: DataFrame, batch_id: int) -> None:
        names = [r["path"] for r in files.orderBy("modificationTime", "path").collect()]
        if names:
            ingest(files.sparkSession, lake, source, names, set_aside=set_aside)

    return (
        new_files(spark, folder, max_files)
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
