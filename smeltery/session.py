"""Session settings and the staging helper every job shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job needs for right results or for skew safety; sizes stay with the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "smeltery", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Month and day buckets depend on the session zone, so every entry point pins it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where all runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="smeltery-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the written table.

    This cuts the lineage and survives the loss of executors. Parquet rather than
    ``checkpoint()`` because later steps read few of the columns and Spark then
    knows the size of the table when it plans joins. Zstandard halves hexadecimal digests.
    ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    if _collectors:
        _collectors[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


# What is staged inside a ``collected`` block, innermost last.
_collectors: list[list[str]] = []


@contextmanager
def collected() -> Iterator[list[str]]:
    """Notes the folders staged inside the block, for ``drop_staged``."""
    paths: list[str] = []
    _collectors.append(paths)
    try:
        yield paths
    finally:
        _collectors[:] = [c for c in _collectors if c is not paths]


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Deletes staged folders that no frame will read again."""
    while paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what is staged inside the block."""
    with collected() as paths:
        try:
            yield
        finally:
            drop_staged(spark, paths)
