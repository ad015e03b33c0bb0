"""Missing values: mean imputation, row dropping and indicators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Train mean of each column, nulls skipped: a fixed handful of numbers."""
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def fill_means(df: DataFrame, means: Mapping[str, float]) -> DataFrame:
    """Fill nulls with fitted means. Columns become double, so no mean is cut off."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in means.items()}
    )


def add_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A 0/1 column per feature that tells whether the value was missing."""
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in columns})


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))
