"""Text rules as Column expressions that stay inside generated code."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the source format counts as whitespace.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
_NOT_BLANK = "".join(rf"\x{{{ord(c):x}}}" for c in WHITESPACE if c != " ")
# Whitespace runs other than a single blank: the only ones a replacement would change.
_SPACE_RUN = f"[{_NOT_BLANK}][ {_NOT_BLANK}]*| [ {_NOT_BLANK}]+"

# Texts that mean "no value", compared after trimming and lower-casing.
NULL_LITERALS = ("", "na", "n/a", "none", "null", "nil", "-", "--", "—")
_LONGEST_LITERAL_BYTES = max(len(s.encode()) for s in NULL_LITERALS)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with ``value`` computed once, outside the generated method."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ustrip(col: Column) -> Column:
    """Trim Unicode whitespace on both sides (Spark's plain ``trim`` removes blanks only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def norm_str(col: Column) -> Column:
    """Null becomes the empty string, anything else is trimmed."""
    return F.coalesce(ustrip(col.cast("string")), F.lit(""))


def _is_literal(trimmed: Column) -> Column:
    # The length test keeps long texts from being lower-cased just to be compared.
    return (F.octet_length(trimmed) <= _LONGEST_LITERAL_BYTES) & F.lower(trimmed).isin(
        *NULL_LITERALS
    )


def is_null(col: Column) -> Column:
    return col.isNull() | _is_literal(ustrip(col))


def null_literals_to_null(col: Column) -> Column:
    """Keep the value untouched (untrimmed) unless it means "no value"."""
    return F.when(~_is_literal(ustrip(col)), col)


def normalize_text(col: Column) -> Column:
    trimmed = ustrip(col)
    return F.when(~_is_literal(trimmed), F.regexp_replace(trimmed, _SPACE_RUN, " "))


def normalize_category(col: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """Case-insensitive lookup; unknown categories keep their cleaned spelling.

    ``mapping`` is configuration held in the plan as a literal. For a mapping kept in a
    table use :func:`smeltery.operators.clean.map_categories`.
    """
    cleaned = normalize_text(col)
    if not mapping:
        return cleaned
    table = F.create_map(*[F.lit(part) for item in mapping.items() for part in item])
    return F.coalesce(F.try_element_at(table, F.lower(cleaned)), cleaned)
