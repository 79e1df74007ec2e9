"""Prefix scans over ordered rows of an entity, in blocks.

A plain window hands all rows of one entity to one task. Here rows are cut into
blocks along their order, each block is scanned alone, and only one summary row
a block takes part in the scan over the whole entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_and_next(df: DataFrame, entity: list[str], at: str, block: Column, fill: list[str], next_as: str) -> DataFrame:
    """Add to each row the value last known of each ``fill`` column (NULL = not
    known here) and, as ``next_as``, the ``at`` of the entity's next row.

    ``at`` must be unique within an entity; ``block`` must not decrease with it.
    """
    x = df.withColumn("_blk", block)
    w = Window.partitionBy(*entity, "_blk").orderBy(at)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = x.select(
        *[c for c in x.columns if c not in fill],
        *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in fill],
        F.lead(at).over(w).alias("_next"),
    )
    ends = x.groupBy(*entity, "_blk").agg(
        F.min(at).alias("_first"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at))).alias(f"_end_{i}") for i, c in enumerate(fill)],
    )
    wb = Window.partitionBy(*entity).orderBy("_blk")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *entity,
        "_blk",
        F.lead("_first").over(wb).alias("_next_block"),
        *[F.last(f"_end_{i}", ignorenulls=True).over(before).alias(f"_carry_{i}") for i in range(len(fill))],
    )
    out = local.join(carried, [*entity, "_blk"])
    return out.select(
        *[c for c in df.columns if c not in fill],
        *[F.coalesce(c, f"_carry_{i}").alias(c) for i, c in enumerate(fill)],
        F.coalesce("_next", "_next_block").alias(next_as),
    )


def running_sum(df: DataFrame, entity: list[str], at: str, block: str, delta: str, out: str) -> DataFrame:
    """Add the sum of ``delta`` over the entity's rows up to and including
    ``at``; ``at`` unique within an entity, ``block`` not decreasing with it."""
    w = Window.partitionBy(*entity, block).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("_local", F.sum(delta).over(w))
    wb = Window.partitionBy(*entity).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*entity, block).agg(F.sum(delta).alias("_d"))
    carried = totals.select(*entity, block, F.coalesce(F.sum("_d").over(wb), F.lit(0)).alias("_carry"))
    return local.join(carried, [*entity, block]).select(*df.columns, (F.col("_local") + F.col("_carry")).alias(out))
