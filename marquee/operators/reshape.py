"""Unpivot, user-item matrix, pivot, one-hot, distinct and append."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unpivot_flags(df: DataFrame, ids: Sequence[str], flags: Sequence[str], name: str = "genre") -> DataFrame:
    """One row per set flag."""
    return df.unpivot(list(ids), list(flags), name, "__set").filter("__set").drop("__set")


def user_item_cells(ratings: DataFrame) -> DataFrame:
    """The user-item matrix in long form; repeated ratings of a pair are averaged."""
    return ratings.groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating"))


def pivot_ranked_items(cells: DataFrame, ratings: DataFrame, n: int) -> DataFrame:
    """Users by the ``n`` most rated items as columns ``item_1`` .. ``item_n``.

    The item list has exactly ``n`` rows, which bounds both the broadcast and the
    number of columns.
    """
    top = (
        ratings.groupBy("item_id").count()
        .orderBy(F.desc("count"), "item_id").limit(n)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("c"), "item_id"))).alias("t"))
        .select(F.posexplode("t").alias("pos", "t"))
        .select(F.col("t.item_id").alias("item_id"), (F.col("pos") + 1).alias("rank"))
    )
    # A left join: users who rated none of the top items keep a row of nulls.
    kept = cells.join(F.broadcast(top), "item_id", "left")
    wide = kept.groupBy("user_id").pivot("rank", list(range(1, n + 1))).agg(F.first("rating"))
    return wide.select("user_id", *[F.col(str(i)).alias(f"item_{i}") for i in range(1, n + 1)])


def fit_levels(df: DataFrame, columns: Sequence[str], limit: int = 1000) -> dict[str, list[str]]:
    """Sorted levels of each categorical column. Above ``limit`` levels a column per level is refused:
    ``one_hot_rows`` takes any number."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    wide = [c for c in columns if row[c] > limit]
    if wide:
        raise ValueError(f"more than {limit} levels, use one_hot_rows: {wide}")
    sets = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in columns]).first()
    return {c: list(sets[c]) for c in columns}


def level_name(column: str, level: str) -> str:
    return f"{column}_{re.sub(r'[^0-9a-z]+', '_', level.lower()).strip('_')}"


def one_hot_rows(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The ones of a one-hot encoding as rows (column, level), for any number of levels. A missing value has none."""
    levels = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])
    return df.select(*keep, F.inline(levels)).where("level IS NOT NULL")


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]], keep: Sequence[str]) -> DataFrame:
    """0/1 column per level; a missing value stays missing in all of its columns."""
    return df.select(
        *keep,
        *[
            (F.col(c) == lv).cast("int").alias(level_name(c, lv))
            for c, lvs in levels.items() for lv in lvs
        ],
    )


def append_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack two tables by column name; columns only one side has are null in the other."""
    return first.unionByName(second, allowMissingColumns=True)


def number_levels(df: DataFrame, column: str, buckets: int = 4096) -> DataFrame:
    """Consecutive integers from 0 for the distinct values of a column.

    Values are numbered inside hash buckets and shifted by the sizes of the
    buckets before, so no task sees more than one bucket of values.
    """
    levels = df.select(column).distinct().withColumn(
        "__b", F.pmod(F.xxhash64(column), F.lit(buckets))
    )
    upto = Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = levels.groupBy("__b").count().select(
        "__b", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("__o")
    )
    inside = Window.partitionBy("__b").orderBy(column)
    return (
        levels.withColumn("__r", F.row_number().over(inside) - 1)
        .join(offsets, "__b")
        .select(column, (F.col("__r") + F.col("__o")).cast("int").alias(f"{column}_index"))
    )
