"""Positions in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairforge.functions.scratch import stage

#: ``monotonically_increasing_id`` holds the partition above these bits and the row of it below.
ROW_BITS = 33


def with_global_position(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """Number all rows 0, 1, 2 .. in the given order.

    Rows are range-partitioned and sorted by the order and written once with their
    row number inside their partition. One count per partition gives the offsets,
    a table as long as there are partitions. Rows that are equal in the order get
    neighbouring numbers; give a column that tells them apart as the last one.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = stage(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", ROW_BITS)
    counts = table.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    row = F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)
    return (
        table.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + row).cast("long"))
        .drop("_part", "_at", "_offset")
    )
