"""Seeded splits and folds that do not depend on partitioning or row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX = 4      # hex digits per step: 16**4 counts bound the one-task running count
RANKED = 10_000  # rows that may be ranked one by one


def row_hash(seed: int | str, keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def split_cut(df: DataFrame, fraction: float, seed: int, keys: Sequence[str]) -> str:
    """The row hash at position floor(fraction * rows), or "" for an empty part.

    Rows are counted per hash prefix and the prefix that holds the cut is counted
    again by its next digits, until few rows are left to rank. Every pass reads
    the keys only, and its running count sees at most 16**PREFIX counts. ``keys``
    must identify a row. One value reaches the driver, so every later pass over a
    split part is a plain filter.
    """
    near = df.select(row_hash(seed, keys).alias("h"))
    want, depth = None, 0
    while True:
        counts = near.groupBy(F.substring("h", depth + 1, PREFIX).alias("p")).agg(F.count("*").alias("n"))
        whole = Window.partitionBy(F.lit(0))
        upto = whole.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        goal = F.floor(F.sum("n").over(whole) * F.lit(fraction)) if want is None else F.lit(want)
        edge = (
            counts.select("p", "n", F.sum("n").over(upto).alias("end"), goal.alias("want"))
            .filter("want > end - n AND want <= end").first()
        )
        if edge is None:
            return ""
        near = near.filter(F.substring("h", depth + 1, PREFIX) == edge["p"])
        want, depth = edge["want"] - edge["end"] + edge["n"], depth + PREFIX
        if edge["n"] <= RANKED or depth > 32 - PREFIX:
            return near.orderBy("h").limit(want).agg(F.max("h")).first()[0]


def split_exact(
    df: DataFrame, fraction: float, seed: int, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Exactly floor(fraction * rows) rows and the rest, without a global sort."""
    inside = row_hash(seed, keys) <= F.lit(split_cut(df, fraction, seed, keys))
    return df.filter(inside), df.filter(~inside)


def split_fraction(
    df: DataFrame, fraction: float, seed: int, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """About ``fraction`` of the rows and the rest, in the scan itself."""
    place = F.conv(F.substring(row_hash(seed, keys), 1, 8), 16, 10).cast("long")
    inside = place < F.lit(int(fraction * 16**8)).cast("long")
    return df.filter(inside), df.filter(~inside)


def hash_fold(k: int, seed: int | str, keys: Sequence[str]) -> Column:
    """Fold 0..k-1 from the row hash alone: no shuffle."""
    return (F.conv(F.substring(row_hash(seed, keys), 1, 8), 16, 10).cast("long") % k).cast("int")


def balanced_folds(
    df: DataFrame, k: int, seed: int, keys: Sequence[str], target: str, digits: int = 4
) -> DataFrame:
    """Folds whose sizes differ by at most one row within each target value.

    A row's fold is its hash rank within the target value, modulo ``k``. Ranks
    are taken inside (target, hash prefix) groups and shifted by the counts of
    the prefixes before, so one target value may hold any share of the rows.
    """
    hashed = df.withColumn("__h", row_hash(seed, keys)).withColumn(
        "__p", F.substring("__h", 1, digits)
    )
    before = Window.partitionBy(target).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(target, "__p").agg(F.count("*").alias("__n"))
        .select(target, "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    )
    inside = Window.partitionBy(target, "__p").orderBy("__h")
    ranked = hashed.withColumn("__r", F.row_number().over(inside) - 1)
    return (
        ranked.join(offsets, [target, "__p"])
        .withColumn("fold", ((F.col("__r") + F.col("__o")) % k).cast("int"))
        .drop("__h", "__p", "__r", "__o")
    )


def repeated_folds(df: DataFrame, k: int, repeats: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """One fold column per repeat: ``fold_1`` .. ``fold_<repeats>``."""
    return df.withColumns(
        {f"fold_{r}": hash_fold(k, f"{seed}-{r}", keys) for r in range(1, repeats + 1)}
    )
