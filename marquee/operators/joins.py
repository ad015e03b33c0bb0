"""Joins that follow the data's null rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join where a null key matches a null key.

    Spark hashes null-safe keys, so this stays a hash or sort-merge join. With a
    ``right`` that is unique on ``keys`` the row count of ``left`` is kept. No
    broadcast is forced: adaptive execution measures the side first.
    """
    renamed = right.select(
        *[F.col(k).alias(f"__k_{k}") if k in keys else F.col(k) for k in right.columns]
    )
    on = reduce(Column.__and__, [left[k].eqNullSafe(renamed[f"__k_{k}"]) for k in keys])
    return left.join(renamed, on, "left").drop(*[f"__k_{k}" for k in keys])


def lookup_with_default(
    pairs: DataFrame, table: DataFrame, keys: Sequence[str], value: str, default: float
) -> DataFrame:
    """Value of ``table`` for each row of ``pairs``, ``default`` where there is none."""
    found = pairs.join(table.select(*keys, value), list(keys), "left")
    return found.withColumn(value, F.coalesce(F.col(value), F.lit(float(default))))


def fanout_factor(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows of ``right`` share a key at most (1 = no fan-out)."""
    return right.groupBy(*keys).count().agg(F.max("count").alias("max_rows_per_key"))


def expected_rows(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows of ``left``, and rows that a null-safe left join with ``right`` would give.

    Only counts per key meet, so a key that multiplies costs one row a side here.
    """
    many = left.groupBy(*keys).agg(F.count("*").alias("__left"))
    found = null_safe_left_join(many, right.groupBy(*keys).agg(F.count("*").alias("__right")), keys)
    return found.agg(F.coalesce(F.sum("__left"), F.lit(0)).alias("left_rows"),
                     F.coalesce(F.sum(F.col("__left") * F.coalesce("__right", F.lit(1))), F.lit(0)).alias("joined_rows"))


def guarded_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], max_factor: float) -> DataFrame:
    """Many-to-many null-safe left join that stops with an error before it joins, if the result
    would have more than ``max_factor`` times the rows of ``left``.

    The guard is a scalar subquery of the plan and runs when the plan runs.
    """
    fits = F.col("joined_rows") <= F.col("left_rows") * F.lit(float(max_factor))
    message = F.format_string(f"join on {', '.join(keys)} gives %d rows for %d, more than {max_factor:g} times as many",
                              "joined_rows", "left_rows")
    allowed = expected_rows(left, right, keys).select(F.when(fits, True).otherwise(F.raise_error(message).cast("boolean")))
    return null_safe_left_join(left.filter(allowed.scalar()), right, keys)
