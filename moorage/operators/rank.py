"""Positions in a global order, without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorage.functions.storage import cut


def with_position(rows: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``rows`` with ``name``: 1, 2, ... in the order of ``by``, which should leave no ties.

    Rows are dealt by ranges of the whole order, sorted and written with their place in their range; a row's position is that
    place on top of the sizes of the ranges before, of which there are as many as partitions.
    """
    # the upper 31 bits are the partition's, the lower 33 count its rows
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    ranged = cut(placed)
    of_range, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    sizes = ranged.groupBy(of_range.alias("_range")).agg(F.max(within).alias("_n"))
    # one row for each partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sizes.select("_range", before.alias("_base"))
    numbered = ranged.withColumn("_range", of_range).join(F.broadcast(base), "_range")
    return numbered.withColumn(name, (F.col("_base") + within).cast("long")).drop("_range", "_base", "_at")
