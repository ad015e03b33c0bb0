"""Counts, shares, top lists and group statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.joins import null_safe_left_join
from marquee.functions.columns import r6
from marquee.operators.quantiles import exact_quantiles


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def long_form(df: DataFrame, columns: Mapping[str, Column], name: str, value: str) -> DataFrame:
    """Stack named expressions under each other as (name, value) rows."""
    ready = df.select(*[c.alias(k) for k, c in columns.items()])
    return ready.unpivot([], list(columns), name, value)


def count_levels(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Row count per level of several columns in one scan and one shuffle."""
    return count_by(long_form(df, columns, "kind", "level"), ["kind", "level"])


def top_n_with_ties(counts: DataFrame, n: int, by: str = "n") -> DataFrame:
    """The ``n`` largest rows and every row tied with the last of them.

    The n-th value comes from a distributed top-n and enters the filter as a
    scalar subquery: there is no global window.
    """
    nth = counts.orderBy(F.desc(by)).limit(n).agg(F.min(by)).scalar()
    return counts.filter(F.col(by) >= nth)


def top_share(counts: DataFrame, n: int, by: str = "n") -> DataFrame:
    """One row: rows held by the top ``n`` keys (ties kept), all rows, the share."""
    nth = counts.orderBy(F.desc(by)).limit(n).agg(F.min(by)).scalar()
    top = F.sum(F.when(F.col(by) >= nth, F.col(by)))
    return counts.agg(
        F.count(F.when(F.col(by) >= nth, 1)).alias("keys"),
        top.alias("top_ratings"),
        F.sum(by).alias("all_ratings"),
        r6(top / F.sum(by)).alias("share"),
    )


def per_item_sums(df: DataFrame, keys: Sequence[str], item: str = "item_id") -> DataFrame:
    """Rating sum and count per item and keys: the small table behind genre reports."""
    return df.groupBy(item, *keys).agg(
        F.sum("rating").alias("__s"), F.count("*").alias("__n")
    )


def combination_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean, votes, distinct items and votes per item for each key combination.

    Two plain aggregations replace the distinct count: first per item, then per
    combination, where each item is one row.
    """
    return (
        per_item_sums(df, keys)
        .groupBy(*keys)
        .agg(
            r6(F.sum("__s") / F.sum("__n")).alias("avg_rating"),
            F.sum("__n").alias("votes"),
            F.count("*").alias("dist_movies"),
        )
        .withColumn("ratio", r6(F.col("votes") / F.col("dist_movies")))
    )


def flag_stats(df: DataFrame, flags: Sequence[str], name: str = "genre") -> DataFrame:
    """The same statistics per flag; an item counts under each flag it carries.

    Ratings are summed per item first, so only the item table is unpivoted.
    """
    items = per_item_sums(df, flags)
    stacked = items.unpivot(["item_id", "__s", "__n"], list(flags), name, "__set")
    return (
        stacked.filter("__set")
        .groupBy(name)
        .agg(
            r6(F.sum("__s") / F.sum("__n")).alias("avg_rating"),
            F.sum("__n").alias("votes"),
            F.count("*").alias("dist_movies"),
        )
        .withColumn("ratio", r6(F.col("votes") / F.col("dist_movies")))
    )


def size_summary(sizes: DataFrame, by: Sequence[str], size: str = "n") -> DataFrame:
    """Distribution of group sizes: quartiles, mean, groups above one, singletons."""
    basic = sizes.groupBy(*by).agg(
        F.count("*").alias("groups"),
        F.min(size).alias("smallest"),
        r6(F.avg(size)).alias("mean_size"),
        F.max(size).alias("largest"),
        F.count(F.when(F.col(size) > 1, 1)).alias("above_one"),
        F.count(F.when(F.col(size) == 1, 1)).alias("singletons"),
    )
    quart = exact_quantiles(sizes, by, size, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return null_safe_left_join(basic, quart, list(by))


def rmse(predictions: DataFrame, by: Sequence[str] = (), truth: str = "rating",
         pred: str = "prediction") -> DataFrame:
    """Rows scored and root mean squared error; rows without a prediction (null or NaN) are skipped."""
    told = F.col(pred).isNotNull() & ~F.isnan(F.col(pred).cast("double"))
    scored = predictions.filter(told & F.col(truth).isNotNull())
    return scored.groupBy(*by).agg(
        F.count("*").alias("n"),
        r6(F.sqrt(F.avg(F.pow(F.col(truth) - F.col(pred), 2)))).alias("rmse"),
    )
