"""Fixed schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

_PAYLOAD = T.MapType(T.StringType(), T.StringType(), True)
_TS = T.TimestampType()
_STR = T.StringType()
_LONG = T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Names and types of the stored columns, table by table.
# ``event_month`` is the partition column of the two large tables. The record hash
# covers event_time, so equal keys always share a month and key lookups can be
# limited to the months a batch touches.
RAW_RECORDS = _schema(
    ("id", _STR), ("run_id", _STR), ("row_num", _LONG), ("source", _STR),
    ("source_id", _STR), ("event_time", _TS), ("category", _STR), ("value", _STR),
    ("record_hash", _STR), ("payload", _PAYLOAD),
    # Payload fields that were numeric cells: their text is a number whatever its spelling.
    ("numeric", T.ArrayType(_STR, True)),
    ("ingested_at", _TS), ("event_month", T.DateType()),
)

CLEAN_RECORDS = _schema(
    ("id", _STR), ("raw_id", _STR), ("run_id", _STR), ("source", _STR),
    ("record_hash", _STR), ("source_id", _STR), ("event_time", _TS), ("category", _STR),
    ("value_text", _STR), ("value_decimal", T.DecimalType(18, 4)),
    ("payload_clean", _PAYLOAD), ("cleaned_at", _TS), ("event_month", T.DateType()),
)

_MEASURES = tuple(
    (name, _LONG)
    for name in (
        "total_records", "distinct_records", "distinct_source_ids",
        "distinct_sources", "distinct_categories",
    )
)
MEASURES = tuple(name for name, _ in _MEASURES)
DAILY_METRICS = _schema(("day_date", T.DateType()), *_MEASURES)
MONTHLY_METRICS = _schema(("month_start", T.DateType()), *_MEASURES)

INGEST_RUNS = _schema(
    ("id", _STR), ("created_at", _TS), ("source", _STR), ("status", _STR),
    ("files", _STR), ("error", _STR),
)

STEP = _schema(
    ("step", _STR), ("status", _STR), ("duration_ms", _LONG),
    ("meta", T.MapType(_STR, _STR, True)),
)
PIPELINE_RUNS = _schema(
    ("id", _STR), ("pipeline", _STR), ("status", _STR), ("started_at", _TS),
    ("finished_at", _TS), ("duration_ms", _LONG), ("records_in", _LONG),
    ("records_out", _LONG), ("error_summary", _STR), ("input_ref", _STR),
    ("meta", T.MapType(_STR, _STR, True)), ("steps", T.ArrayType(STEP, True)),
    ("error_type", _STR), ("error_message", _STR),
)

DATA_QUALITY_CHECKS = _schema(
    ("id", _STR), ("check_name", _STR), ("check_scope", _STR), ("month_start", T.DateType()),
    ("status", _STR), ("expected", _LONG), ("observed", _LONG), ("details", _STR),
    ("created_at", _TS),
)

# Rows that break the contract, where a caller asks for them to be set aside.
REJECTED_ROWS = _schema(
    ("run_id", _STR), ("source", _STR), ("file_path", _STR), ("row_num", _LONG), ("payload", _PAYLOAD),
    ("reasons", T.ArrayType(_STR, True)), ("rejected_at", _TS),
)

# Counts and bitmaps of stored parts, and the numbers of the values whose bits they are.
PART_STATES = _schema(
    ("part", _STR), ("day", T.DateType()), ("name", _STR), ("bucket", _LONG), ("bits", T.BinaryType()), ("n", _LONG),
    ("event_month", T.DateType()),
)
VALUE_NUMBERS = _schema(("name", _STR), ("value", _STR), ("number", _LONG))

# The columns of the flag report, in order.
REPORT_COLUMNS = (
    "id", "run_id", "row_num", "source", "source_id", "category", "event_time",
    "value", "record_hash", "ingested_at", "severity", "flag_codes", "flag_messages",
)

# The columns every source file must have, and the longest text each key may hold.
REQUIRED_COLUMNS = ("source_id", "event_time", "value", "category")
MAX_LENGTHS = {"source": 50, "source_id": 100, "category": 100}
