"""Column helpers the text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

BLANKS = " \t\n\x0b\x0c\r"
BREAK = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where a lambda repeats it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Runs of anything but space and ``\\x09-\\x0D``, in order. Splitting at one plain character is fastest."""
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def text_key(text: Column) -> list[Column]:
    """Three numbers that stand for a text: two independent 64-bit hashes and its length."""
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(7), text).alias("_h2"),
            F.octet_length(text).cast("long").alias("_len")]


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts in ``column`` hold about ``size`` bytes; a longer text is a run of its own."""
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    start = total = 0
    for at, n in enumerate(lengths):
        if at > start and total + (n or 0) > size:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += n or 0
    if start < len(lengths):
        yield batch.slice(start)


def reach_package(spark) -> None:
    """Lets Python workers of this machine import the package, wherever the session was started.

    On a cluster the package travels as usual (``--py-files`` or an installed wheel).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def documents(spark, sf_dir: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
