"""Date and event-time parsing as Column expressions.

The common spellings take one pattern test and one cast; basic-format, comma and other
near-common spellings are first rewritten to the common one by a single replacement.
Rare but legal ISO spellings (week dates, hour-only clocks, long offsets) are rebuilt from
their parts. That last step sits in a lambda, which Spark calls only for the rows that
reach it and keeps out of the generated method of everybody else's rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.text import is_null, let, ustrip

_ISO_COMMON = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)?)?\z"
)
_DATE = r"^(?!0000)(\d{4})(-?)(\d{2})\2(\d{2})"
_ZONE = r"(Z|[+-](?:0\d|1[0-7])(?::?[0-5]\d)?)?\z"
# Pattern and its rewrite to the common spelling: date, minutes, seconds, fraction.
_ISO_REWRITES = (
    (_DATE + r"[^0-9](\d{2})(:?)(\d{2})\6(\d{2})[.,](\d{1,6})\d*" + _ZONE,
     "$1-$3-$4T$5:$7:$8.$9$10"),
    (_DATE + r"[^0-9](\d{2})(:?)(\d{2})\6(\d{2})" + _ZONE, "$1-$3-$4T$5:$7:$8$9"),
    (_DATE + r"[^0-9](\d{2}):?(\d{2})" + _ZONE, "$1-$3-$4T$5:$6$7"),
    (_DATE + r"\z", "$1-$3-$4"),
)
_ISO_GENERAL = (
    r"^(?s)(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?)"
    r"(?:[^0-9]"
    r"(\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{4}(?:\d{2}(?:[.,]\d+)?)?)"
    r"(Z|[+-]\d{2}(?::\d{2}(?::\d{2})?)?|[+-]\d{4}(?:\d{2})?)?)?\z"
)


def _week_date(digits: Column) -> Column:
    """``yyyyww[d]`` to a date; null when the year has no such week."""
    year = F.left(digits, F.lit(4))
    week = F.substring(digits, 5, 2).try_cast("int")
    day = F.coalesce(F.nullif(F.substring(digits, 7, 1), F.lit("")), F.lit("1")).try_cast("int")
    first_monday = F.trunc(F.concat(year, F.lit("-01-04")).try_cast("date"), "week")
    monday = F.date_add(first_monday, (week - 1) * 7)
    valid = week.between(1, 53) & day.between(1, 7) & (F.weekofyear(monday) == week)
    return F.when(valid & (year != "0000"), F.date_add(monday, day - 1))


def _iso_date(text: Column) -> Column:
    def from_digits(digits: Column) -> Column:
        dashed = F.concat_ws(
            "-", F.left(digits, F.lit(4)), F.substring(digits, 5, 2), F.substring(digits, 7, 2)
        )
        return F.when(text.contains("W"), _week_date(digits)).when(
            ~text.startswith("0000"), dashed.try_cast("date")
        )

    return let(F.regexp_replace(text, "[-W]", ""), from_digits)


def _offset_seconds(text: Column) -> Column:
    def total(digits: Column) -> Column:
        parts = [
            F.coalesce(F.substring(digits, start, 2).try_cast("int"), F.lit(0))
            for start in (1, 3, 5)
        ]
        seconds = parts[0] * 3600 + parts[1] * 60 + parts[2]
        return F.when(text.startswith("-"), -seconds).otherwise(seconds)

    seconds = let(F.regexp_replace(text, "[+:Z-]", ""), total)
    return F.when(F.abs(seconds) < 86400, seconds)


def _wall_clock(text: Column) -> Column:
    """Local wall-clock timestamp of any accepted ISO text."""
    date = _iso_date(F.regexp_extract(text, _ISO_GENERAL, 1)).cast("string")
    clock = F.regexp_replace(F.regexp_extract(text, _ISO_GENERAL, 2), "[:.,]", "")

    def join(hms: Column) -> Column:
        return F.concat(
            date, F.lit(" "), F.substring(hms, 1, 2), F.lit(":"), F.substring(hms, 3, 2),
            F.lit(":"), F.substring(hms, 5, 2), F.lit("."), F.substring(hms, 7, 6),
        ).try_cast("timestamp")

    return let(F.rpad(clock, 12, "0"), join)


def _offset_of(text: Column) -> Column:
    return _offset_seconds(F.regexp_extract(text, _ISO_GENERAL, 3))


def _parse_rare(text: Column) -> Column:
    micros = F.unix_micros(_wall_clock(text)) - _offset_of(text).cast("bigint") * 1_000_000
    return F.when(text.rlike(_ISO_GENERAL), F.timestamp_micros(micros))


def _parse_iso(text: Column) -> Column:
    common = F.when(text.rlike(_ISO_COMMON), text)
    for pattern, rewrite in _ISO_REWRITES:
        common = common.when(text.rlike(pattern), F.regexp_replace(text, pattern, rewrite))
    rare = F.when(text.isNotNull(), let(text, _parse_rare))
    return F.coalesce(common.try_cast("timestamp"), rare)


def parse_event_time(col: Column, dtype: T.DataType | None = None) -> Column:
    """UTC timestamp; a missing offset means UTC; null when the text is not ISO-8601."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    return _parse_iso(ustrip(col))


def parse_event_time_loose(col: Column, dtype: T.DataType | None = None) -> Column:
    """Reader of the flag rules: no trimming, otherwise as :func:`parse_event_time`."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    return _parse_iso(col)


def iso_utc(ts: Column) -> Column:
    """``2026-01-05T06:00:00+00:00``; a fraction always has six digits and only shows when set."""
    return F.concat(_with_micros(F.translate(ts.cast("string"), " ", "T")), F.lit("+00:00"))


def datetime_text(ts: Column) -> Column:
    """As :func:`iso_utc` with a blank between date and time (the report's spelling)."""
    return F.concat(_with_micros(ts.cast("string")), F.lit("+00:00"))


def _with_micros(text: Column) -> Column:
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)


def local_iso(col: Column) -> Column:
    """Wall-clock text with the offset it was written in (messages quote it unchanged)."""

    def two(number: Column) -> Column:
        return F.lpad(number.cast("bigint").cast("string"), 2, "0")

    def zone(offset: Column) -> Column:
        size = F.abs(offset)
        seconds = F.when(size % 60 > 0, F.concat(F.lit(":"), two(size % 60)))
        return F.concat(
            F.when(offset < 0, F.lit("-")).otherwise(F.lit("+")),
            two(F.floor(size / 3600)), F.lit(":"), two(F.floor(size / 60) % 60),
            F.coalesce(seconds, F.lit("")),
        )

    def written(text: Column) -> Column:
        wall = _with_micros(F.translate(_wall_clock(text).cast("string"), " ", "T"))
        return F.concat(wall, let(_offset_of(text), zone))

    return F.when(col.isNotNull(), let(col, written))


def bucket(unit: str, col: Column) -> Column:
    """First day of the day, ISO week or month."""
    return F.date_trunc(unit, col).cast("date")


_ISO_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"
_ISO_WEEK_PREFIX = r"^\d{4}-W\d{2}-\d"
_ISO_SHORT = r"^(?:\d{8}|\d{4}W\d{2}\d?|\d{4}-W\d{2})$"
_SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
_YEAR_FIRST = r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})$"
_DASHED = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
_DATE_CLOCK = r"^(\d{4}-\d{1,2}-\d{1,2})(?:[Tt]|\s+)(?:2[0-3]|[01]?\d):[0-5]?\d:[0-5]?\d$"


def normalize_date(
    col: Column, day_first: bool = True, dtype: T.DataType | None = None
) -> Column:
    """ISO prefix first, then slashes by preference, then the remaining written forms.

    Dashed day/month dates are always tried day first, whatever the preference.
    """
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    text = ustrip(col)
    slashed = F.regexp_replace(text, _SLASHED, "$3-$2-$1" if day_first else "$3-$1-$2")
    parsed = (
        F.when(text.rlike(_ISO_DATE_PREFIX), F.left(text, F.lit(10)).try_cast("date"))
        .when(text.rlike(_SLASHED), slashed.try_cast("date"))
        .when(text.rlike(_ISO_WEEK_PREFIX), _iso_date(F.left(text, F.lit(10))))
        .when(text.rlike(_ISO_SHORT), _iso_date(text))
        .when(
            text.rlike(_YEAR_FIRST),
            F.regexp_replace(text, _YEAR_FIRST, "$1-$3-$4").try_cast("date"),
        )
        .when(
            text.rlike(_DASHED),
            F.coalesce(
                F.regexp_replace(text, _DASHED, "$3-$2-$1").try_cast("date"),
                F.regexp_replace(text, _DASHED, "$3-$1-$2").try_cast("date"),
            ),
        )
        .when(text.rlike(_DATE_CLOCK), F.regexp_extract(text, _DATE_CLOCK, 1).try_cast("date"))
    )
    return F.when(~is_null(col) & (F.year(parsed) > 0), parsed)
