"""Numbers without gaps for the rows of a table, found without gathering them in a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PLACE = "_at"


def placed(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows with their place, in this order if one is given. To be staged, as places change with every run."""
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.withColumn(PLACE, F.monotonically_increasing_id())


def numbered(staged: DataFrame, name: str, last: int = 0) -> DataFrame:
    """Staged rows of :func:`placed`, numbered from ``last + 1`` in the order of their places."""
    block, seq = F.shiftright(PLACE, 33), F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    blocks = staged.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("rows"), F.min(seq).alias("first"))
    # One row for each task that wrote rows.
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first") + last + 1
    shifts = blocks.select("_block", shift.alias("_shift"))
    return staged.withColumn("_block", block).join(shifts, "_block").withColumn(name, seq + F.col("_shift")).drop("_block", "_shift", PLACE)
