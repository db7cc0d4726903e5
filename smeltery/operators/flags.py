"""Weighted quality rules, severity and the sorted report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.dates import (
    datetime_text,
    iso_utc,
    local_iso,
    parse_event_time_loose,
)
from smeltery.functions.numbers import float_text, parse_float
from smeltery.functions.text import ustrip
from smeltery.operators.dedupe import with_group_size
from smeltery.schemas import REPORT_COLUMNS

# Codes, weights and thresholds of the rules.
NULLISH = ("null", "none", "na", "n/a", "nil", "-")
WEIGHTS = {
    "VALUE_EMPTY_OR_NULLISH": 40,
    "VALUE_NOT_NUMERIC": 40,
    "EVENT_TIME_INVALID": 40,
    "FUTURE_EVENT_TIME": 25,
    "STALE_EVENT_TIME": 15,
    "VALUE_OUT_OF_RANGE": 35,
    "POSSIBLE_DUPLICATE_FINGERPRINT": 30,
}
FUTURE_SLACK = timedelta(minutes=5)
STALE_AFTER = timedelta(days=30)
VALUE_LIMIT = 1_000_000
MAX_SEVERITY = 100
DUPLICATE = "POSSIBLE_DUPLICATE_FINGERPRINT"
FINGERPRINT = ("source", "source_id", "event_time", "category", "value")


@dataclass(frozen=True)
class Rule:
    """A code, its weight, when it fires and what it says."""

    code: str
    weight: int
    fires: Column
    message: Column


def _inputs(df: DataFrame) -> DataFrame:
    dtype = df.schema["event_time"].dataType
    event_time = F.col("event_time")
    when = parse_event_time_loose(event_time, dtype)
    written = local_iso(event_time) if isinstance(dtype, T.StringType) else iso_utc(when)
    text = F.coalesce(ustrip(F.col("value").cast("string")), F.lit(""))
    return df.withColumns(
        {"_text": text, "_number": parse_float(text), "_when": when, "_written": written}
    )


def default_rules(now: datetime) -> list[Rule]:
    """The rules in reporting order. ``now`` is a parameter, so reports can be repeated."""
    now = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
    text, number, when = F.col("_text"), F.col("_number"), F.col("_when")
    written, copies = F.col("_written"), F.col("_copies")
    empty = (text == "") | F.lower(text).isin(*NULLISH)
    value = float_text(number)

    def rule(code: str, fires: Column, *message: str | Column) -> Rule:
        parts = [F.lit(m) if isinstance(m, str) else m for m in message]
        return Rule(code, WEIGHTS[code], F.coalesce(fires, F.lit(False)), F.concat(*parts))

    return [
        rule("VALUE_EMPTY_OR_NULLISH", empty, "value='", text, "' is empty or null-ish"),
        rule(
            "VALUE_NOT_NUMERIC", ~empty & number.isNull(),
            "value='", text, "' cannot be parsed as float",
        ),
        rule("EVENT_TIME_INVALID", when.isNull(), "event_time could not be parsed"),
        rule(
            "FUTURE_EVENT_TIME", when > F.lit(now + FUTURE_SLACK),
            "event_time=", written, f" is in the future vs now={now.isoformat()}",
        ),
        rule(
            "STALE_EVENT_TIME", when < F.lit(now - STALE_AFTER),
            "event_time=", F.left(written, F.lit(10)),
            f" is older than {STALE_AFTER.days} days",
        ),
        # NaN is not comparable: it is neither too small nor too large.
        rule(
            "VALUE_OUT_OF_RANGE", ~F.isnan(number) & ((number <= 0) | (number > VALUE_LIMIT)),
            "value=", value,
            F.when(number <= 0, F.lit(" must be > 0")).otherwise(
                F.lit(f" exceeds {VALUE_LIMIT:,}")
            ),
        ),
        rule(
            "POSSIBLE_DUPLICATE_FINGERPRINT", copies > 1,
            "Fingerprint appears ", copies.cast("string"), " times in this batch",
        ),
    ]


def fingerprint_counts(df: DataFrame) -> DataFrame:
    """Add ``_copies``: how many rows of the batch share the row's fingerprint."""
    return with_group_size(df, FINGERPRINT, "_copies")


def flag(
    df: DataFrame,
    now: datetime,
    rules: Callable[[datetime], Sequence[Rule]] = default_rules,
    unique_keys: bool = False,
) -> DataFrame:
    """Rows with at least one flag, with ``severity``, ``flag_codes`` and ``flag_messages``.

    ``unique_keys`` states that no two rows share source and record hash, as in the bronze
    table. The hash covers the other fingerprint fields, so no fingerprint repeats either
    and nothing has to be counted: flagging is then a scan without any shuffle.

    Rules are evaluated once, below the join that counts fingerprints, and travel as one
    bit mask; the filter above the join reads the mask only. Messages are written after it,
    for flagged rows alone. ``concat_ws`` skips the rules that do not fire.
    """
    checks = list(rules(now))
    below = [(i, c) for i, c in enumerate(checks) if c.code != DUPLICATE]
    mask = sum(
        (F.when(c.fires, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in below), F.lit(0)
    )
    masked = _inputs(df).withColumn("_mask", mask).select(*df.columns, "_mask")
    if unique_keys:
        counted = masked.withColumn("_copies", F.lit(1).cast("bigint"))
    else:
        counted = with_group_size(masked, FINGERPRINT, "_copies")
    flagged = _inputs(counted.where((F.col("_mask") != 0) | (F.col("_copies") > 1)))
    fired = [
        (F.col("_mask").bitwiseAND(F.lit(1 << i)) != 0 if c.code != DUPLICATE else c.fires, c)
        for i, c in enumerate(checks)
    ]
    total = sum((F.when(on, F.lit(c.weight)).otherwise(F.lit(0)) for on, c in fired), F.lit(0))
    codes = [F.when(on, F.lit(c.code)) for on, c in fired]
    messages = [F.when(on, F.concat(F.lit(f"{c.code}: "), c.message)) for on, c in fired]
    return flagged.select(
        *df.columns,
        F.least(F.lit(MAX_SEVERITY), total).cast("int").alias("severity"),
        F.concat_ws("|", *codes).alias("flag_codes"),
        F.concat_ws(" || ", *messages).alias("flag_messages"),
    )


def of_report(rows: DataFrame) -> DataFrame:
    """Only the columns that the report shows, which hold all that the rules read; payloads aren't carried along."""
    return rows.select(*[c for c in REPORT_COLUMNS if c in rows.columns])


def report_rows(flagged: DataFrame) -> DataFrame:
    """The report columns as text, missing ones empty, in no order."""

    def cell(name: str) -> Column:
        if name not in flagged.columns:
            return F.lit("").alias(name)
        col = F.col(name)
        if isinstance(flagged.schema[name].dataType, T.TimestampType):
            col = datetime_text(col)
        return F.coalesce(col.cast("string"), F.lit("")).alias(name)

    cells = [cell(name) for name in REPORT_COLUMNS if name != "severity"]
    at = REPORT_COLUMNS.index("severity")
    return flagged.select(*cells[:at], "severity", *cells[at:])


def report(flagged: DataFrame) -> DataFrame:
    """The report columns as text, most severe first, then by id."""
    return report_rows(flagged).orderBy(F.desc("severity"), F.asc("id"))


def report_parts(small: DataFrame, flagged_id: Column, widen: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``report`` of the rows that ``widen`` makes of ``small`` ones, whose id ``flagged_id`` is: the small rows are
    cut into ranges and each range is widened and sorted, so the parts in order are the report."""
    ranges = small.repartitionByRange(F.desc("severity"), F.asc(F.coalesce(flagged_id, F.lit(""))))
    return report_rows(widen(ranges)).sortWithinPartitions(F.desc("severity"), F.asc("id"))


def top(flagged: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` of the report: severity, id, source_id and codes."""
    picked = report(flagged).limit(n)
    return picked.select("severity", "id", "source_id", "flag_codes")


def totals(scanned: DataFrame, flagged: DataFrame) -> DataFrame:
    """Scanned and flagged row counts, each from its own pruned pass."""
    return scanned.agg(F.count(F.lit(1)).alias("scanned")).withColumn(
        "flagged", flagged.agg(F.count(F.lit(1))).scalar()
    )
