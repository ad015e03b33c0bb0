"""Table profiles, histograms, box statistics and correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.joins import null_safe_left_join
from marquee.functions.columns import any_null, r6
from marquee.operators.quantiles import exact_quantiles
from marquee.operators.summaries import count_levels, long_form

PAIRS = 8  # correlations per pass over the table
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls, minimum, quartiles, mean and maximum of each column."""
    stacked = long_form(df, {c: F.col(c).cast("double") for c in columns}, "column", "value")
    basic = stacked.groupBy("column").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        r6(F.min("value")).alias("min"),
        r6(F.avg("value")).alias("mean"),
        r6(F.max("value")).alias("max"),
    )
    return basic.join(exact_quantiles(stacked, ["column"], "value", QUARTILES), "column", "left")


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count per column and level, null being a level."""
    return count_levels(df, {c: F.col(c).cast("string") for c in columns}).select(
        F.col("kind").alias("column"), F.col("level").alias("value"), "n"
    )


def schema_profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Type, filled rows and distinct values per column.

    Exact distinct counts use (column, value) groups, so no task has to hold the
    distinct values of a column. ``approximate`` replaces them by a sketch.
    """
    types = F.create_map(*[F.lit(x) for c in columns for x in (c, df.schema[c].dataType.simpleString())])
    stacked = long_form(df, {c: F.col(c).cast("string") for c in columns}, "column", "value")
    if approximate:
        out = stacked.groupBy("column").agg(
            F.count("value").alias("filled"), F.approx_count_distinct("value").alias("distinct_values")
        )
    else:
        out = (
            stacked.groupBy("column", "value").agg(F.count("value").alias("filled"))
            .groupBy("column")
            .agg(F.sum("filled").alias("filled"), F.count("value").alias("distinct_values"))
        )
    return out.select("column", types[F.col("column")].alias("type"), "filled", "distinct_values")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column and whether there are any: one aggregate, then unpivoted."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], list(columns), "column", "nulls").withColumn(
        "any_null", F.col("nulls") > 0
    )


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Complete and incomplete row counts and their sum."""
    return df.select(any_null(columns).alias("gap")).agg(
        F.count_if(~F.col("gap")).alias("complete"),
        F.count_if("gap").alias("incomplete"),
        F.count("*").alias("total"),
    )


def histogram(df: DataFrame, columns: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """Rows per bin of fixed width; ``columns`` maps a name to (value, bin width)."""
    bins = {
        name: r6(F.floor(F.round(value.cast("double") / F.lit(float(width)), 9)) * F.lit(float(width)))
        for name, (value, width) in columns.items()
    }
    stacked = long_form(df, bins, "column", "bin").filter("bin IS NOT NULL")
    return stacked.groupBy("column", "bin").agg(F.count("*").alias("n"))


def box_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Quartiles and whiskers per group.

    Whiskers are the outermost values within 1.5 quartile distances of the box.
    The box uses type-7 quartiles; Tukey hinges differ slightly on small groups.
    """
    quart = exact_quantiles(df, by, value, QUARTILES)
    spread = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - spread, F.col("q3") + spread)
    ends = (
        null_safe_left_join(df.filter(F.col(value).isNotNull()), quart, list(by))
        .groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            r6(F.min(F.when(inside, F.col(value)))).alias("lower_whisker"),
            r6(F.max(F.when(inside, F.col(value)))).alias("upper_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    return null_safe_left_join(quart, ends, list(by))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every column pair; an empty table has none.

    ``corr`` uses the rows where both are filled; ``corr_everything`` is null as
    soon as one value of the pair is missing anywhere. A batch of ``PAIRS`` pairs is
    one ungrouped aggregate over its columns: no row is copied, one row per task is shuffled.
    """
    pairs = [(a, b) for a in columns for b in columns if a < b]

    def batch(some: Sequence[tuple[str, str]]) -> DataFrame:
        sums = [F.count("*").alias("rows")]
        for i, (a, b) in enumerate(some):
            x, y = F.col(a).cast("double"), F.col(b).cast("double")
            both = x.isNotNull() & y.isNotNull()
            sums += [F.count_if(both).alias(f"n_{i}"), F.corr(F.when(both, x), F.when(both, y)).alias(f"c_{i}")]
        told = [F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"), F.col("rows"),
                         F.col(f"n_{i}").alias("n"), F.col(f"c_{i}").alias("c")) for i, (a, b) in enumerate(some)]
        return df.agg(*sums).filter("rows > 0").select(F.inline(F.array(*told)))

    batches = [batch(pairs[i : i + PAIRS]) for i in range(0, len(pairs), PAIRS)]
    return reduce(DataFrame.unionAll, batches).select(
        "var_x", "var_y", "n", r6(F.col("c")).alias("corr"),
        r6(F.when(F.col("n") == F.col("rows"), F.col("c"))).alias("corr_everything"),
    )


def association(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, correlation and least-squares slope of ``y`` on ``x`` per group."""
    filled = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    dx, dy = F.col(x).cast("double"), F.col(y).cast("double")
    return filled.groupBy(*by).agg(
        F.count("*").alias("n"), r6(F.corr(dx, dy)).alias("corr"),
        r6(F.regr_slope(dy, dx)).alias("slope"),
    )
