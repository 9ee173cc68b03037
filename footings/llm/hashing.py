"""Deterministic shuffles and prefix sums without an unbounded group.

Every hash here is a pure function of the row, so a lost executor recomputes the same
values and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 60
STRIDE = 12


def hash60(text: Column) -> Column:
    """The first 60 bits of the md5 of `text`, as a non-negative bigint (null text: empty)."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, BITS // 4), 16, 10).cast("bigint")


def sums_before(cells: DataFrame, group: list[str], cell: str, value: str, bits: int) -> DataFrame:
    """Per (group, cell): the sum of `value` over the smaller cells of the group, as `before`.

    `cells` holds one row per (group, cell) and `cell` numbers below 2**bits.  A window
    never spans more than 2**STRIDE cells: above that, totals of coarser cells are summed
    first and added.
    """
    coarse = f"_coarse{bits}"
    parts = cells.withColumn(coarse, F.shiftright(cell, STRIDE) if bits > STRIDE else F.lit(0))
    running = F.sum(value).over(Window.partitionBy(*group, coarse).orderBy(cell)
                                .rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("_inner", F.coalesce(running, F.lit(0)))
    if bits <= STRIDE:
        return parts.withColumnRenamed("_inner", "before").drop(coarse)
    above = sums_before(parts.groupBy(*group, coarse).agg(F.sum(value).alias(value)), group, coarse, value, bits - STRIDE)
    return (parts.join(above.select(*group, coarse, F.col("before").alias("_base")), [*group, coarse])
            .withColumn("before", F.col("_inner") + F.col("_base")).drop("_inner", "_base", coarse))
