"""Control totals and the quality-check log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.dates import bucket
from smeltery.schemas import DATA_QUALITY_CHECKS


def recount(silver: DataFrame) -> DataFrame:
    dated = silver.where(F.col("event_time").isNotNull())
    return dated.groupBy(bucket("month", F.col("event_time")).alias("month_start")).agg(
        F.count(F.lit(1)).alias("clean_count")
    )


def control_totals(monthly: DataFrame, silver: DataFrame) -> DataFrame:
    """Summary against recount per month; a month missing on either side shows as a difference."""
    summary = monthly.select("month_start", F.col("total_records").alias("summary_count"))
    both = summary.join(recount(silver), "month_start", "full_outer")
    left, right = (F.coalesce(c, F.lit(0)) for c in ("summary_count", "clean_count"))
    return both.select(
        "month_start", left.alias("summary_count"), right.alias("clean_count"),
        (left - right).alias("diff"),
    )


def quality_checks(
    totals: DataFrame, created_at: datetime, scope: str = "monthly_metrics"
) -> DataFrame:
    """Control totals as rows of the quality log: ``pass`` when the counts agree."""
    scope, name = F.lit(scope), F.lit("control_totals")
    key = F.concat_ws("|", name, scope, F.col("month_start").cast("string"),
                      F.lit(created_at.isoformat()))
    columns = {
        "id": F.sha2(key, 256),
        "check_name": name,
        "check_scope": scope,
        "month_start": F.col("month_start"),
        "status": F.when(F.col("diff") == 0, F.lit("pass")).otherwise(F.lit("fail")),
        "expected": F.col("clean_count"),
        "observed": F.col("summary_count"),
        "details": F.concat(F.lit('{"diff":'), F.col("diff").cast("string"), F.lit("}")),
        "created_at": F.lit(created_at).cast("timestamp"),
    }
    return totals.select(*[columns[f.name].alias(f.name) for f in DATA_QUALITY_CHECKS.fields])


def count_check(spark: SparkSession, name: str, scope: str, observed: int, created_at: datetime) -> DataFrame:
    """A count that should be zero as a row of the quality log."""
    row = {
        "id": f"{name}|{scope}|{created_at.isoformat()}", "check_name": name, "check_scope": scope, "month_start": None,
        "status": "warn" if observed else "pass", "expected": 0, "observed": observed,
        "details": None, "created_at": created_at,
    }
    return spark.createDataFrame([tuple(row.values())], DATA_QUALITY_CHECKS)
