"""Number parsing and rendering with the source format's rules, as Column expressions.

Spark and the source format disagree on several spellings (``1d``, ``1_000``, signed
``nan``), so each parser checks the spelling first and casts only what is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.text import is_null, let, normalize_text, ustrip

_DECIMAL_FLOAT = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
_NAN = r"^[+-]?nan$"
_INFINITY = r"^[+-]?inf(?:inity)?$"
_RARE_FLOAT = r"_|(?i:^[+-]?(?:nan|inf(?:inity)?)$)"
_MONEY = r"^-?(?:\d+\.?\d*|\.\d+)$"
_NOT_MONEY = r"[^\d,.\-]"


def parse_float(col: Column) -> Column:
    """Double for every accepted spelling, null otherwise."""
    text = ustrip(col)
    return F.when(text.rlike(_DECIMAL_FLOAT), text.try_cast("double")).when(
        text.rlike(_RARE_FLOAT), let(text, _parse_rare)
    )


def _parse_rare(text: Column) -> Column:
    digits = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    infinity = F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        F.when(digits.rlike(_DECIMAL_FLOAT), digits.try_cast("double"))
        .when(F.lower(text).rlike(_NAN), F.lit(float("nan")))
        .when(F.lower(text).rlike(_INFINITY), infinity)
    )


def normalize_float(col: Column, dtype: T.DataType | None = None) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("double")
    if isinstance(dtype, T.NumericType):
        return col.cast("double")
    return parse_float(F.replace(normalize_text(col.cast("string")), F.lit(","), F.lit("")))


def normalize_int(col: Column, dtype: T.DataType | None = None) -> Column:
    """Whole part of the number; NaN, infinities and values beyond 64 bits become null."""
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("bigint")
    if isinstance(dtype, T.IntegralType):
        return col.cast("bigint")
    return normalize_float(col, dtype).try_cast("bigint")


def normalize_currency(
    col: Column, dtype: T.DataType | None = None, precision: int = 38, scale: int = 10
) -> Column:
    """Money text to an exact decimal; ``1.234,56`` and ``1,234.56`` are both understood.

    Values that do not fit ``decimal(precision, scale)`` become null.
    """
    target = f"decimal({precision},{scale})"
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast(target)
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return col.try_cast(target)
    if isinstance(dtype, T.FractionalType):
        return col.cast("string").try_cast(target)

    def amount(kept: Column) -> Column:
        # One comma, at least one dot, and the comma after the last dot.
        decimal_comma = kept.rlike(r"^[^,]*\.[^,]*,[^,.]*$")
        several_dots = kept.rlike(r"\..*\.")
        plain = (
            F.when(decimal_comma, F.translate(kept, ",.", "."))
            .when(several_dots, kept)
            .otherwise(F.replace(kept, F.lit(","), F.lit("")))
        )
        return let(plain, lambda text: F.when(text.rlike(_MONEY), text.try_cast(target)))

    text = ustrip(col)
    return F.when(text.rlike(_MONEY), text.try_cast(target)).when(
        ~is_null(col), let(F.regexp_replace(text, _NOT_MONEY, ""), amount)
    )


def cell_amount(text: Column, is_number: Column, precision: int = 38, scale: int = 10) -> Column:
    """Amount of a cell: a numeric one is its number (``1e+16`` is no text with an odd sign), others are read as money."""
    number = text.try_cast(f"decimal({precision},{scale})")
    return F.when(is_number, number).otherwise(normalize_currency(text, precision=precision, scale=scale))


def outlier_bounds(
    col: Column, dtype: T.DataType, min_value: float | None, max_value: float | None
) -> Column:
    """Null outside the inclusive bounds. NaN compares false with both bounds, so it stays."""
    if not isinstance(dtype, (T.NumericType, T.BooleanType)):
        return F.lit(None).cast(dtype)
    number = col.cast("double")
    outside = F.lit(False)
    if min_value is not None:
        outside = outside | (number < F.lit(float(min_value)))
    if max_value is not None:
        outside = outside | (number > F.lit(float(max_value)))
    return F.when(F.isnan(number) | ~outside, col)


def float_text(number: Column) -> Column:
    """Shortest decimal text: ``12345678.0``, ``1e+16``, ``1e-05``, ``inf``, ``nan``."""
    java = number.cast("string")
    size = F.abs(number)
    positional = F.regexp_replace(java.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    positional = F.when(positional.endswith("."), F.concat(positional, F.lit("0"))).otherwise(
        positional
    )
    exponent = F.regexp_replace(java, r"\.0E", "E")
    exponent = F.regexp_replace(exponent, r"E(-?)(\d)$", "E$10$2")
    exponent = F.regexp_replace(F.regexp_replace(exponent, r"E(\d)", "e+$1"), "E-", "e-")
    return (
        F.when(F.isnan(number), F.lit("nan"))
        .when(size == float("inf"), F.when(number > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), java)
        .when((size >= 1e-4) & (size < 1e16), positional)
        .otherwise(exponent)
    )
