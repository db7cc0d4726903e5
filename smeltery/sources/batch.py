"""Reading a batch of source files: format dispatch, header contract, row numbers."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from smeltery.operators.keys import IngestionError
from smeltery.schemas import REQUIRED_COLUMNS
from smeltery.sources.folders import literal
from smeltery.sources.workbook import WORKBOOK_ROWS, workbook_rows

# Every cell is text; quotes are doubled; quoted cells may hold line breaks.
CSV_OPTIONS = {"header": True, "inferSchema": False, "quote": '"', "escape": '"',
               "encoding": "UTF-8", "multiLine": True}
# Columns of a batch, whatever the format of its files.
BATCH_COLUMNS = ("file_path", "file_ord", "block_start", "seq", "payload", "numeric", *REQUIRED_COLUMNS)
SUFFIXES = ("csv", "xlsx")


def check_headers(headers: Sequence[str]) -> None:
    missing = [name for name in REQUIRED_COLUMNS if name not in headers]
    if missing:
        raise IngestionError(f"Missing required columns: {missing}")


def split_by_format(files: Sequence[str]) -> dict[str, list[str]]:
    """The files found, by suffix in any case; a file of another kind is refused, wherever it lies."""
    groups: dict[str, list[str]] = {suffix: [] for suffix in SUFFIXES}
    for file in files:
        leaf = file.rsplit("/", 1)[-1].lower()
        suffix = leaf.rsplit(".", 1)[-1] if "." in leaf else ""
        if suffix not in groups:
            raise IngestionError(f"Unsupported file type: {unquote(file)}")
        groups[suffix].append(file)
    return groups


def _files_of(spark: SparkSession, path: str) -> list[str]:
    return sorted(spark.read.format("binaryFile").load(literal(path)).inputFiles())


def _file_path() -> Column:
    """The row's file, spelled as Spark lists it (local paths come with one or three slashes)."""
    path = F.col("_metadata.file_path")
    spelled = path.startswith("file:///") & ~path.startswith("file:////") | ~path.startswith("file:/")
    return F.when(spelled, path).otherwise(F.regexp_replace(path, "^file:/+", "file:///"))


# How a CSV file is cut into records, cheapest first: a line each, in many tasks; lines joined where a quoted cell
# holds line breaks, in many tasks; or by one task that reads the file from its start.
LINES, RECORDS, WHOLE = "lines", "records", "whole"


def csv_headers(
    spark: SparkSession, files: Sequence[str], multi_line: bool | None = None
) -> dict[tuple[tuple[str, ...], str], list[str]]:
    """Files by header and by the way to read them, from one distributed pass that also finds bytes that
    aren't UTF-8. What comes back is one line for each file.

    Where every line holds an even number of quotes, no cell holds a line break. Lines of blanks alone, which
    the reader of lines would skip, ask for records as well.
    """
    if not files:
        return {}
    lines = spark.read.text([literal(unquote(f)) for f in files]).select(
        _file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value",
    )
    blank = (F.length("value") > 0) & (F.trim("value") == "")
    # Texts in an aggregate make Spark sort all lines, so lines that may be a header are groups and numbers are
    # aggregated; few lines hold all names. What follows sees a few rows for each task.
    begins = F.when(F.col("block") == 0, F.col("seq"))
    title = F.when((F.col("block") == 0) & reduce(Column.__and__, [F.col("value").contains(n) for n in REQUIRED_COLUMNS]), F.col("value"))
    grouped = lines.groupBy("file", title.alias("title")).agg(
        F.min(begins).alias("begins"), F.count_if(~F.is_valid_utf8("value")).alias("broken"),
        F.count_if(F.col("value").contains('"') & (quotes(F.col("value")) % 2 == 1) | blank).alias("open"))
    found = grouped.groupBy("file").agg(
        F.min_by("title", "begins").alias("header"), F.sum("broken").alias("broken"), F.sum("open").alias("open"))
    first = {r["file"]: r for r in found.collect()}
    ways = {}
    for file in files:
        row = first.get(file)
        if row and row["broken"]:
            raise IngestionError(f"{unquote(file)} is not UTF-8 ({row['broken']} lines)")
        ways[file] = WHOLE if multi_line else RECORDS if multi_line is None and row and row["open"] else LINES
    joined = [f for f in files if ways[f] == RECORDS]
    headers = {f: r["header"] for f, r in first.items()}
    untitled = [f for f in first if headers[f] is None and ways.get(f) != RECORDS]
    if untitled:   # the first line lacks a column; the message needs it as it is
        begun = lines.where((F.col("block") == 0) & F.col("file").isin(untitled))
        headers.update({r["file"]: r["header"] for r in begun.groupBy("file").agg(F.min_by("value", "seq").alias("header")).collect()})
    if joined:
        rows = records(spark, joined)
        # Quotes in unusual places mean something else to a reader that starts at the file's beginning.
        odd = rows.groupBy("file").agg(F.count_if(~F.col("text").rlike(WELL_FORMED)).alias("odd"), F.min_by("text", F.struct("block", "seq")).alias("header"))
        for r in odd.collect():
            ways[r["file"]], headers[r["file"]] = (WHOLE if r["odd"] else RECORDS), r["header"]
    groups: dict[tuple[tuple[str, ...], str], list[str]] = {}
    for file in files:
        text = (headers.get(file) or "").lstrip("\ufeff")
        header = tuple(next(csv.reader(io.StringIO(text, newline="")), []))
        check_headers(header)
        groups.setdefault((header, ways[file]), []).append(file)
    return groups


def quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
WELL_FORMED = rf"^\ufeff?{_CELL}(?:,{_CELL})*+$"


def records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``file``, ``block``, ``seq`` and ``text`` of the records of CSV files, read by many tasks without a shuffle.

    A line begins a record where an even number of quotes stands before it in the file. Quotes are counted for
    each line and summed for each block (what one task reads of a file); a block's first lines belong to the last
    record of the blocks before it if the sum up to there is odd, and that record began in the last block there
    that has a line with an odd number of quotes. So only a small row for each block is compared over the file. A
    task joins the lines of its blocks as it reads them; only records that go on in another block, one a block at
    most, are gathered. A record stands in the block where it begins, numbered by ``seq``.
    """
    lines = spark.read.option("lineSep", "\n").text([literal(unquote(f)) for f in files]).select(
        _file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
    ).withColumn("odd", quotes(F.col("value")) % 2 == 1)
    blocks = lines.groupBy("file", "block").agg(F.count_if("odd").alias("n"))
    earlier = W.Window.partitionBy("file").orderBy("block").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = blocks.select(
        "file", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) % 2 == 1).alias("inside"),
        F.last(F.when(F.col("n") > 0, F.col("block")), True).over(earlier).alias("owner"))
    placed = lines.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "value", "odd", "inside", "owner")
    joined = placed.mapInArrow(_line_joiner(), "file string, block long, seq long, text string, owner long")
    whole = joined.where("owner IS NULL").select("file", "block", "seq", "text")
    parts = joined.where("owner IS NOT NULL").groupBy("file", F.col("owner").alias("of")).agg(
        F.max("seq").alias("seq"), F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    several = parts.select("file", F.col("of").alias("block"), "seq", F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text"))
    ended = whole.unionByName(several).withColumn("text", F.regexp_replace("text", "\r$", ""))
    return ended.where(F.col("text") != "")


def _line_joiner():
    """Joins lines to records, block by block, in the order in which a task reads them. What a block has of a record
    that goes on in another one is a row with the block where the record began as ``owner``. The function travels
    to the tasks as it is, without this module."""

    def join(batches):
        import pyarrow as pa

        names = ["file", "block", "seq", "text", "owner"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        key, held, owner, seq, inside = None, [], None, 0, False
        out = []

        def close(goes_on):
            """Ends the lines held so far: a record, or a part of one."""
            nonlocal seq
            text = "\n".join(held)
            if owner is not None:
                out.append((*key, None, text, owner))
            elif held and text not in ("", "\r", "\r\r"):   # blank lines are no records and have no number
                seq += 1
                out.append((*key, seq, text, key[1] if goes_on else None))

        def taken():
            columns = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for file, block, value, odd, starts_inside, began in zip(*[c.to_pylist() for c in batch.columns]):
                if (file, block) != key:
                    if key:
                        close(inside)
                    key, held, seq, inside = (file, block), [], 0, starts_inside
                    owner = began if inside else None
                elif not inside:
                    close(False)
                    held, owner = [], None
                held.append(value)
                inside ^= odd
            yield taken()
        if key:
            close(inside)
        yield taken()

    return join


def read_csv_records(spark: SparkSession, files: Sequence[str], header: Sequence[str]) -> DataFrame:
    """As ``read_csv_group``, for files whose quoted cells hold line breaks, in many tasks."""
    rows = records(spark, files).where((F.col("block") > 0) | (F.col("seq") > 1))   # without the header
    cells = F.from_csv("text", ", ".join(f"_{i} string" for i in range(len(header) + 1)), {"quote": '"', "escape": '"'})
    parsed = rows.select(F.col("file").alias("file_path"), F.col("block").alias("block_start"), "seq", cells.alias("c")).select("*", "c.*")
    return parsed.select("file_path", "block_start", "seq", *_columns(header))


def _columns(header: Sequence[str]) -> list[Column]:
    """What the cells ``_0``, ``_1``, ... of a row become."""
    cells = {name: F.col(f"_{i}") for i, name in enumerate(header)}
    payload = F.create_map(*[x for name, c in cells.items() for x in (F.lit(name), c)])
    beyond = F.col(f"_{len(header)}")
    return [
        payload.alias("payload"),
        F.array().cast("array<string>").alias("numeric"),
        F.when(beyond.isNotNull(), F.concat(F.lit("A row has more cells than the header: "), beyond)).alias("header_error"),
        *[cells[name].alias(name) for name in REQUIRED_COLUMNS],
    ]


def read_csv_group(
    spark: SparkSession, files: Sequence[str], header: Sequence[str], multi_line: bool = True
) -> DataFrame:
    """Files that share one header, as text columns plus their place in the batch.

    Cells are read by position and named afterwards, so empty, repeated and look-alike column names
    are fine; of equal names the last one counts. A cell beyond the header breaks the contract.
    """
    schema = T.StructType([T.StructField(f"_{i}", T.StringType(), True) for i in range(len(header) + 1)])
    options = {**CSV_OPTIONS, "multiLine": multi_line, "enforceSchema": True}
    rows = spark.read.schema(schema).csv([literal(unquote(f)) for f in files], **options)
    return rows.select(
        _file_path().alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
        *_columns(header),
    )


def read_workbooks(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """One workbook per task row; a bad header surfaces as an error row, see ``check_batch``."""
    blobs = spark.read.format("binaryFile").load([literal(unquote(f)) for f in files])
    named = blobs.select(_file_path().alias("path"), "content")
    rows = named.mapInPandas(workbook_rows, WORKBOOK_ROWS)
    return rows.select(
        F.col("path").alias("file_path"),
        F.lit(0).cast("bigint").alias("block_start"),
        "seq", "payload", "numeric", "header_error",
        *[F.col("payload")[name].alias(name) for name in REQUIRED_COLUMNS],
    )


def read_batch(
    spark: SparkSession, paths: Sequence[str], multi_line: bool | None = None
) -> tuple[DataFrame, list[str]]:
    """All rows of the files, in arrival order of ``paths``; headers are checked before any row.

    Also returns the files found. Files are grouped by header, so a folder of like files is one
    scan, however many files it holds. One CSV file is read by many tasks, also where quoted cells hold line
    breaks. ``multi_line`` spares the test for such cells: False says that there are none, True has each
    file read by one task.
    """
    files = [file for path in paths for file in _files_of(spark, path)]
    by_format = split_by_format(files)
    groups = csv_headers(spark, by_format["csv"], multi_line)
    parts = [
        read_csv_records(spark, group, header) if way == RECORDS else read_csv_group(spark, group, header, way == WHOLE)
        for (header, way), group in groups.items()
    ]
    if by_format["xlsx"]:
        parts.append(read_workbooks(spark, by_format["xlsx"]))
    if not parts:
        raise IngestionError(f"No files found: {list(paths)}")
    batch = parts[0]
    for part in parts[1:]:
        batch = batch.unionByName(part, allowMissingColumns=True)
    if "header_error" not in batch.columns:
        batch = batch.withColumn("header_error", F.lit(None).cast("string"))
    # The driver has listed these files; a shuffled join would gather a file's rows in one task.
    placed = batch.join(F.broadcast(file_order(spark, files)), "file_path")
    return placed.select(*BATCH_COLUMNS, "header_error"), files


def file_order(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Position of each file in the batch."""
    rows = [(file, position) for position, file in enumerate(files, 1)]
    return spark.createDataFrame(rows, "file_path string, file_ord long")


def with_row_numbers(rows: DataFrame, batch: DataFrame) -> DataFrame:
    """1-based row number per file for ``rows`` of ``batch``, without gathering a file in one task.

    A block is what one task reads of a file. Blocks are counted first (one small row per
    block); a row's number is its place within its block plus the rows of earlier blocks.
    The blocks are broadcast, as a shuffled join would gather each block's rows in one task.
    """
    blocks = batch.groupBy("file_path", "block_start").agg(
        F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = W.Window.partitionBy("file_path").orderBy("block_start").rowsBetween(
        W.Window.unboundedPreceding, -1
    )
    offsets = blocks.select(
        "file_path", "block_start",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    return rows.join(F.broadcast(offsets), ["file_path", "block_start"]).withColumn(
        "row_num", F.col("seq") + F.col("_shift")
    ).drop("_shift")
