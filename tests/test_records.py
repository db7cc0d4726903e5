"""CSV files with line breaks in quoted cells, read by many tasks, against the reader that starts at the beginning."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from smeltery.operators.keys import IngestionError
from smeltery.sources import batch as q

HEADER = "source_id,event_time,value,category"


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def cell(rng, text):
    return '"' + text.replace('"', '""') + '"' if rng.random() < 0.5 or any(c in text for c in ',"\n\r') else text


def lines_of(rng, n, end="\n"):
    words = ["a", "bb", "say \"hi\"", "x,y", "line\nbreak", "two\n\nbreaks", "tail\n", "\"", "", " ", "é", "\r\nin a cell" if end == "\r\n" else "z"]
    rows = [HEADER]
    for i in range(n):
        rows.append(",".join(cell(rng, t) for t in (f"id{i}", "2026-01-05", rng.choice(words) + rng.choice(words), rng.choice(words))))
        if rng.random() < 0.02:
            rows.append("")
    return end.join(rows) + end


def plain(text):
    """Row number and cells as the standard library reads them."""
    return {n: tuple(r[c] or "" for c in HEADER.split(",")) for n, r in enumerate(csv.DictReader(io.StringIO(text)), 1)}


def rows_of(frame):
    keep = ("file_path", "source_id", "event_time", "value", "category", "header_error", "row_num")
    return sorted(map(str, (tuple(r) for r in q.with_row_numbers(frame, frame).select(*keep).collect())))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_many_tasks_equal_one(spark, tmp_path, small_splits, end):
    rng = random.Random(len(end))
    files, texts = [], []
    for name, n in (("big.csv", 9000), ("small.csv", 5)):
        texts.append(lines_of(rng, n, end))
        (tmp_path / name).write_bytes(texts[-1].encode())
        files.append(str(tmp_path / name))
    split, found = q.read_batch(spark, files)
    assert {way for _, way in q.csv_headers(spark, found)} == {q.RECORDS}
    one, _ = q.read_batch(spark, files, multi_line=True)
    assert split.select("block_start").distinct().count() >= 8
    # Spark's own reader of whole files makes line feeds of the breaks inside cells.
    assert (rows_of(split) == rows_of(one)) == (end == "\n")
    for name, text in zip(("big.csv", "small.csv"), texts):
        got = q.with_row_numbers(split, split).where(F.col("file_path").endswith(name)).collect()
        assert {r.row_num: tuple(r[c] or "" for c in HEADER.split(",")) for r in got} == plain(text) and len(got) == len(plain(text))


def test_one_cell_over_many_splits(spark, tmp_path, small_splits):
    body = f"{HEADER}\na,2026-01-01,1,c\nb,2026-01-01,\"{'long\n' * 40_000}\",c\nd,2026-01-01,\"x\ny\",c\n"
    (tmp_path / "wide.csv").write_text(body)
    frame, _ = q.read_batch(spark, [str(tmp_path / "wide.csv")])
    rows = {r.source_id: r for r in q.with_row_numbers(frame, frame).collect()}
    assert rows["b"].value == "long\n" * 40_000 and rows["d"].value == "x\ny"
    assert [rows[k].row_num for k in "abd"] == [1, 2, 3]


def test_ways_to_read(spark, tmp_path):
    bodies = {
        "plain.csv": (f"{HEADER}\na,2026-01-01,\"1,5\",c\n", q.LINES),
        "breaks.csv": (f"{HEADER}\na,2026-01-01,\"1\n5\",c\n", q.RECORDS),
        "stray.csv": (f"{HEADER}\na,2026-01-01,5\" pipe,c\nb,2026-01-01,1,c\n", q.WHOLE),
        "blank.csv": (f"{HEADER}\na,2026-01-01,1,c\n  \n", q.RECORDS),
        "header.csv": ("source_id,event_time,value,category,\"a\nnote\"\na,2026-01-01,1,c,n\n", q.RECORDS),
    }
    for name, (body, way) in bodies.items():
        (tmp_path / name).write_text(body)
        frame, files = q.read_batch(spark, [str(tmp_path / name)])
        assert [w for _, w in q.csv_headers(spark, files)] == [way], name
        assert rows_of(frame) == rows_of(q.read_batch(spark, [str(tmp_path / name)], multi_line=True)[0]) or name == "header.csv"
    frame, _ = q.read_batch(spark, [str(tmp_path / "header.csv")])
    assert frame.first().payload["a\nnote"] == "n"
    (tmp_path / "none.csv").write_text("source_id,event_time,\"val\nue\"\na,2026-01-01,1\n")
    with pytest.raises(IngestionError, match="Missing required columns"):
        q.read_batch(spark, [str(tmp_path / "none.csv")])


def test_lines_of_records_are_not_shuffled(spark, tmp_path, small_splits):
    text = lines_of(random.Random(3), 9000)
    (tmp_path / "big.csv").write_bytes(text.encode())
    frame = q.records(spark, [f"file://{tmp_path}/big.csv"])
    rows = frame.collect()
    assert len(rows) == len(plain(text)) + 1 and len({r.block for r in rows}) >= 8
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Counts by block, and the records that go on in another block: no window over lines, no other shuffle.
    assert "Window" not in plan.split("MapInArrow")[0]
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(file" in x and "block" in x and "value" in x]
    numbers = {}
    for r in rows:
        numbers.setdefault(r.block, []).append(r.seq)
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in numbers.values())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_blank_lines_beside_records_that_go_on(spark, tmp_path, end):
    body = end.join([HEADER, "", "a,2026-01-05,\"1", "", "2\",c", "", "b,2026-01-05,3,c", "\"open", "x"])
    (tmp_path / "a.csv").write_bytes(body.encode())
    rows = sorted((r.seq, r.text) for r in q.records(spark, [f"file://{tmp_path}/a.csv"]).collect())
    assert rows == [(1, HEADER), (2, f'a,2026-01-05,"1{end}{end}2",c'), (3, "b,2026-01-05,3,c"), (4, f'"open{end}x')]
