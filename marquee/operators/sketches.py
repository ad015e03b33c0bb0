"""Profiles from mergeable sketches, for tables where exact quantiles and distinct counts cost too much.

A part of the table (a day, a file, a partition value) is read once. Per part and column a row is
stored that holds counts, sums, a KLL quantile sketch and an HLL distinct sketch, a few kilobytes
however many rows the part has. A profile of any set of parts merges these rows and reads the table
no more; a new day adds its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import r6

KLL_K = 400  # rank error of a quantile about 0.7 %
HLL_LOG2_K = 14  # standard error of a distinct count about 0.8 %
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def numeric_parts(df: DataFrame, part: Column, columns: Sequence[str], k: int = KLL_K) -> DataFrame:
    """A row per part and column: rows, nulls, minimum, maximum, sum and quantile sketch.

    NaN counts as null here, as it has no rank. A null part is a part of its own. An empty table has no parts.
    """
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    ready = df.select(part.alias("part"), *[v.alias(c) for c, v in values.items()])
    stacked = ready.unpivot(["part"], list(values), "column", "value")
    return stacked.groupBy("part", "column").agg(
        F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("nulls"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.sum("value").alias("sum"),
        F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"),
    )


def numeric_profile_of(parts: DataFrame) -> DataFrame:
    """The columns of ``numeric_profile`` from stored parts; quartiles are approximate, the rest is exact.

    A quartile is a value of the column, not interpolated. A column without values has null there.
    """
    filled = F.sum("n") - F.sum("nulls")
    merged = parts.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), r6(F.min("min")).alias("min"),
        r6(F.sum("sum") / F.when(filled > 0, filled)).alias("mean"), r6(F.max("max")).alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    known = F.col("n") > F.col("nulls")
    return merged.select(
        "column", "n", "nulls", "min", "mean", "max",
        *[F.when(known, r6(F.kll_sketch_get_quantile_double("sketch", F.lit(q)))).alias(name) for name, q in QUARTILES.items()])


def distinct_parts(df: DataFrame, part: Column, keys: dict[str, Sequence[str]], log2_k: int = HLL_LOG2_K) -> DataFrame:
    """A row per part with a distinct sketch for each named key; rows with a null in a key do not count for it."""
    def value(columns: Sequence[str]) -> Column:
        text = [F.col(c).cast("string") for c in columns]
        if len(text) == 1:
            return text[0]
        # Lengths in front keep ('a', 'bc') and ('ab', 'c') apart; concat is null if a part is.
        return F.concat(*[x for t in text for x in (F.length(t).cast("string"), F.lit(":"), t)])

    return df.groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), *[F.hll_sketch_agg(value(columns), F.lit(log2_k)).alias(name) for name, columns in keys.items()])


def distinct_counts_of(parts: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: estimated distinct counts over the stored parts, 0 if there are none."""
    return parts.agg(*[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).cast("long").alias(name) for name in names])
