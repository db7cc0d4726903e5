"""Row cleaning as one projection, the silver columns, and the before/after audit."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.config import SILVER_CONFIG, CleaningConfig
from smeltery.functions.dates import normalize_date
from smeltery.functions.numbers import (
    cell_amount,
    normalize_currency,
    normalize_float,
    normalize_int,
    outlier_bounds,
)
from smeltery.functions.text import is_null, normalize_category, normalize_text, null_literals_to_null

# Which rule each conventional field name gets.
TEXT_FIELDS = ("title",)
CATEGORY_FIELDS = ("category",)
DATE_FIELDS = ("published_at", "created_at")
MONEY_FIELDS = ("price", "revenue")
INT_FIELDS = ("views",)
FLOAT_FIELDS = ("score",)


def project_allowed(df: DataFrame, allowed: Iterable[str] | None) -> DataFrame:
    """Keep the allowed columns; an empty or missing set keeps all."""
    wanted = set(allowed or ())
    return df.select(*[c for c in df.columns if c in wanted]) if wanted else df


def project_allowed_map(payload: Column, allowed: Iterable[str] | None) -> Column:
    """The same for a payload map."""
    wanted = sorted(allowed or ())
    return F.map_filter(payload, lambda k, _: k.isin(*wanted)) if wanted else payload


def null_literals_in_map(payload: Column) -> Column:
    """Null-literal rule for every value of a payload map."""
    return F.transform_values(payload, lambda _, value: null_literals_to_null(value))


def _as_text(col: Column, dtype: T.DataType) -> Column:
    return col if isinstance(dtype, T.StringType) else col.cast("string")


def cleaned_column(name: str, dtype: T.DataType, cfg: CleaningConfig) -> tuple[Column, T.DataType]:
    """Expression and type of one field after null, field and outlier rules."""
    col = F.col(name)
    if isinstance(dtype, T.StringType):
        col = null_literals_to_null(col)
    if name in TEXT_FIELDS:
        out, kind = normalize_text(_as_text(col, dtype)), T.StringType()
    elif name in CATEGORY_FIELDS:
        out, kind = normalize_category(_as_text(col, dtype), cfg.category_mapping), T.StringType()
    elif name in DATE_FIELDS:
        out, kind = normalize_date(col, cfg.day_first, dtype), T.DateType()
    elif name in MONEY_FIELDS:
        out, kind = normalize_currency(col, dtype), T.DecimalType(38, 10)
    elif name in INT_FIELDS:
        out, kind = normalize_int(col, dtype), T.LongType()
    elif name in FLOAT_FIELDS:
        out, kind = normalize_float(col, dtype), T.DoubleType()
    else:
        out, kind = col, dtype
    return out, kind


def clean(df: DataFrame, cfg: CleaningConfig) -> DataFrame:
    """All cleaning rules; narrow, so it adds no shuffle to the plan it sits in."""
    kept = project_allowed(df, cfg.allowed_keys)
    parsed, kinds = [], {}
    for field in kept.schema.fields:
        out, kinds[field.name] = cleaned_column(field.name, field.dataType, cfg)
        parsed.append(out.alias(field.name))
    # Bounds apply to parsed values, one step later, so that a value is parsed once.
    bounds = {
        name: outlier_bounds(F.col(name), kinds[name], rule.min_value, rule.max_value)
        for name, rule in cfg.outlier_rules.items()
        if name in kinds
    }
    cleaned = kept.select(*parsed)
    return cleaned.withColumns(bounds) if bounds else cleaned


def map_categories(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Category mapping kept in a table with unique lower-case ``key`` and ``canonical``.

    Spark broadcasts the table when its size allows; otherwise the shuffled left join
    has plain exchanges on both sides, which the skew-join rule can split for hot categories.
    """
    cleaned = df.withColumn(column, normalize_text(F.col(column)))
    lookup = mapping.select(F.col("key").alias("_key"), F.col("canonical").alias("_canonical"))
    joined = cleaned.join(lookup, F.lower(F.col(column)) == F.col("_key"), "left")
    return joined.withColumn(column, F.coalesce("_canonical", column)).select(*df.columns)


def before_after(
    df: DataFrame, cfg: CleaningConfig, key: str, fields: Sequence[str]
) -> DataFrame:
    """One row per key and field with the value before and after cleaning.

    Both states come from the same input row, so no join is needed. They are computed in
    a projection of their own; the step that makes one row per field only copies them.
    """
    hidden = cfg.allowed_keys and [f for f in fields if f not in cfg.allowed_keys]
    kept = [f for f in fields if f not in (hidden or ())]
    kinds, before, after = {}, [], []
    for name in fields:
        before.append(F.col(name).cast("string").alias(f"before_{name}"))
        if name in kept:
            out, kinds[name] = cleaned_column(name, df.schema[name].dataType, cfg)
            after.append(out.alias(f"after_{name}"))
    states = df.select(F.col(key).alias("_key"), *before, *after)
    pairs = []
    for name in fields:
        value = F.lit(None)
        if name in kept:
            value, rule = F.col(f"after_{name}"), cfg.outlier_rules.get(name)
            if rule is not None:
                value = outlier_bounds(value, kinds[name], rule.min_value, rule.max_value)
        pairs.append(
            F.struct(
                F.lit(name).alias("field"),
                F.col(f"before_{name}").alias("before"),
                value.cast("string").alias("after"),
            )
        )
    return states.select(F.col("_key").alias(key), F.inline(F.array(*pairs)))


def amount_of(bronze: DataFrame, precision: int, scale: int) -> Column:
    """The amount in the payload's value, which may be a numeric cell."""
    text = F.col("payload")["value"]
    if "numeric" not in bronze.columns:
        return normalize_currency(text, precision=precision, scale=scale)
    is_number = F.coalesce(F.array_contains("numeric", "value"), F.lit(False))
    return cell_amount(text, is_number, precision, scale)


def losses(bronze: DataFrame) -> list[Column]:
    """Counts of what cleaning these rows can't keep: amounts too large for silver, categories that mean nothing."""
    too_large = amount_of(bronze, 18, 4).isNull() & amount_of(bronze, 38, 4).isNotNull()
    no_category = is_null(F.col("payload")["category"])
    return [F.count_if(too_large).alias("amounts_lost"), F.count_if(no_category).alias("category_fallbacks")]


def to_silver(bronze: DataFrame, run_id: str | Column, cleaned_at: Column, more: Sequence[str] = ()) -> DataFrame:
    """Bronze rows to silver columns (before the upsert); ``more`` names columns that stay as they are."""
    cfg = SILVER_CONFIG
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    names = sorted(cfg.allowed_keys)
    raw = {name: F.col("payload")[name] for name in names}
    cleaned = {name: null_literals_to_null(raw[name]) for name in names}
    cleaned["category"] = normalize_category(raw["category"], cfg.category_mapping)
    payload_clean = F.create_map(
        *[part for name in names for part in (F.lit(name), cleaned[name])]
    )
    columns = {
        "id": F.sha2(F.concat_ws("|", run, F.col("source"), F.col("record_hash")), 256),
        "raw_id": F.col("id"),
        "run_id": F.col("run_id"),
        "source": F.col("source"),
        "record_hash": F.col("record_hash"),
        "source_id": F.col("source_id"),
        "event_time": F.col("event_time"),
        # A category that means "no value" falls back to the bronze text.
        "category": F.coalesce(cleaned["category"], F.col("category")),
        "value_text": cleaned["value"],
        "value_decimal": amount_of(bronze, 18, 4),
        "payload_clean": payload_clean,
        "cleaned_at": cleaned_at,
    }
    if "event_month" in bronze.columns:
        columns["event_month"] = F.col("event_month")
    return bronze.select(*[c.alias(name) for name, c in columns.items()], *more)
