"""Questions asked of the run ledger."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The stages a chained run adds up, and the columns of the run list.
CHAINED = ("ingest", "flags")
RUN_COLUMNS = (
    "pipeline", "run_id", "status", "started_at", "finished_at", "duration_ms",
    "records_in", "records_out", "error_summary",
)


def current(runs: DataFrame) -> DataFrame:
    """The last row of each run: its end, or its start where it hasn't ended."""
    ended = F.col("finished_at").isNotNull()
    by_end = F.max_by(F.struct(*runs.columns), ended.cast("int")).alias("_run")
    return runs.groupBy(F.col("id").alias("_id")).agg(by_end).select("_run.*")


def run_rollup(runs: DataFrame, since: datetime) -> DataFrame:
    """Records in and out of the chained stages since a moment; one row, zeros when empty."""
    chosen = runs.where(F.col("pipeline").isin(*CHAINED) & (F.col("started_at") >= F.lit(since)))
    return chosen.agg(
        *[
            F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)
            for name in ("records_in", "records_out")
        ]
    )


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    listed = runs.withColumnRenamed("id", "run_id").select(*RUN_COLUMNS)
    return listed.orderBy(F.desc("started_at"), F.asc("run_id")).limit(n)


def failed_run_steps(runs: DataFrame) -> DataFrame:
    """Steps of the latest failed run, in order."""
    latest = (
        runs.where("status = 'failed'").orderBy(F.desc("started_at"), F.asc("id")).limit(1)
    )
    return latest.select(
        F.col("id").alias("run_id"), "error_type", "error_message",
        F.posexplode("steps").alias("position", "_step"),
    ).select(
        "run_id", "error_type", "error_message", "position",
        F.col("_step.step").alias("step"), F.col("_step.status").alias("status"),
        F.col("_step.duration_ms").alias("duration_ms"),
    )
