"""The run ledger: a row when a run begins and a row when it ends, with its steps in between.

Rows are only ever appended. ``operators.ledger.current`` keeps the last row of each run, so a run
whose process died stays visible as ``running``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Row, SparkSession

from smeltery import schemas
from smeltery.sinks import tables
from smeltery.sources.tables import Lake


class Book:
    """What one run has noted so far. Jobs set ``counts`` to the records that went in and out."""

    def __init__(self, spark: SparkSession, lake: Lake, pipeline: str, input_ref: str, meta: dict):
        self.id, self.opened = str(uuid.uuid4()), datetime.now(timezone.utc)
        self.counts: tuple[int | None, int | None] = (None, None)
        self.notes: list[Row] = []
        self.meta = {k: str(v) for k, v in meta.items()}
        self._target, self._what = (spark, lake), (pipeline, input_ref)

    def note(self, step: str, status: str = "ok", took: float = 0.0, **facts) -> None:
        self.notes.append(Row(step, status, round(took * 1000), {k: str(v) for k, v in facts.items()}))

    @contextmanager
    def timed(self, step: str, **facts) -> Iterator[None]:
        clock, outcome = time.perf_counter(), {"status": "failed"}
        try:
            yield
            outcome = {"status": "ok"}
        except Exception as problem:
            facts = {**facts, "error": problem}
            raise
        finally:
            self.note(step, took=time.perf_counter() - clock, **outcome, **facts)

    def write(self, status: str, problem: Exception | None = None) -> None:
        spark, lake = self._target
        ended = None if status == "running" else datetime.now(timezone.utc)
        values = dict.fromkeys(schemas.PIPELINE_RUNS.fieldNames())
        values.update(
            id=self.id, pipeline=self._what[0], input_ref=self._what[1], status=status, meta=self.meta,
            started_at=self.opened, finished_at=ended, steps=self.notes,
            records_in=self.counts[0], records_out=self.counts[1],
        )
        if ended:
            values["duration_ms"] = (ended - self.opened).total_seconds() * 1000 // 1
            values["duration_ms"] = int(values["duration_ms"])
        if problem is not None:
            values.update(error_type=type(problem).__name__, error_message=str(problem), error_summary=str(problem))
        rows = spark.createDataFrame([tuple(values.values())], schemas.PIPELINE_RUNS)
        tables.append(lake, "pipeline_runs", rows)


@contextmanager
def recorded(
    spark: SparkSession, lake: Lake, pipeline: str, input_ref: str, **meta
) -> Iterator[Book]:
    """A run from its first row to its last; an exception ends it as failed and goes on."""
    book = Book(spark, lake, pipeline, input_ref, meta)
    book.write("running")
    try:
        yield book
    except Exception as problem:
        book.write("failed", problem)
        raise
    book.write("succeeded")
