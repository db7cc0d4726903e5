"""Key-stable upsert as one join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """``existing`` overwritten by ``incoming`` where keys meet; nothing is deleted.

    Columns in ``keep`` stay as stored. Rows of ``incoming`` with equal keys become one; this is
    done on the join's own partitioning. ``existing`` is unique, so the join meets each key once.
    """
    once = incoming.dropDuplicates(list(keys))
    old, new = existing.alias("old"), once.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, list(keys), "full_outer")

    def pick(name: str):
        if name in keys:
            return F.col(name)
        stored, fresh = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in keep:
            return F.coalesce(stored, fresh).alias(name)
        return F.when(F.col("_new"), fresh).otherwise(stored).alias(name)

    return joined.select(*[pick(name) for name in existing.columns])
