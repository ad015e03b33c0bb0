"""Positions within groups, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import free_name
from marquee.session import materialise

IN_PART = (1 << 33) - 1  # the bits of monotonically_increasing_id that count within a partition


def positions(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with a 1-based position ``name`` of each row within its ``group`` in the given order.

    Rows are sorted over the whole table by ranges, so a hot group lies in many partitions. Its rows
    are counted per partition and only these counts, one row per group and partition, are summed up.
    Rows that tie in group and order get consecutive positions, which of them first is open. The result
    is stored once before the counts are joined.
    """
    part, at = free_name(df, "part_"), free_name(df, "at_")
    ranged = df.repartitionByRange(*[F.col(g) for g in group], *order).sortWithinPartitions(*[F.col(g) for g in group], *order)
    rows = materialise(ranged.withColumn(part, F.spark_partition_id()).withColumn(
        at, F.monotonically_increasing_id().bitwiseAND(F.lit(IN_PART))), "positions")
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    keys = [F.col(g).alias(f"{g}_at") for g in group]
    counts = rows.groupBy(part, *group).agg(F.count(F.lit(1)).alias("n_at"), F.min(at).alias("first_at"))
    shift = counts.select(F.col(part).alias("part_at"), *keys,
                          (F.coalesce(F.sum("n_at").over(earlier), F.lit(0)) - F.col("first_at") + 1).alias("shift_at"))
    same = F.col(part) == F.col("part_at")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"{g}_at"))
    return rows.join(shift, same).withColumn(name, F.col(at) + F.col("shift_at")).drop(
        part, at, "part_at", "shift_at", *[f"{g}_at" for g in group])
