"""Mean-rating encodings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import r6
from marquee.operators.joins import null_safe_left_join
from marquee.session import materialise
from marquee.sources.ratings import GENRES, GENRES_15, GENRES_16, ITEM_MEANS, train_rows

# Encoding variants: name -> grouping keys.
USER_GENRE = {
    "15": ("age_band", "gender") + GENRES_15,
    "16": ("age_band", "gender") + GENRES_16,
    "19": ("age_band", "gender") + GENRES,
}
USER_INDEX = {
    "v1": ("age", "gender", "occupation"),
    "v2": ("age", "gender", "occupation", "user_mean_rating"),
    "v3": ("occupation", "hour"),
    "v4": ("age_band", "gender", "occupation", "hour"),
    "v5": ("age", "gender", "occupation", "hour"),
    "v6": ("age_band", "hour", "occupation", "top_1000_band"),
}
ITEM_INDEX = {
    "v1": GENRES + ("item_imdb_length",),
    "v2": GENRES + ("item_imdb_length", "item_imdb_mature_rating"),
    "v3": GENRES + ("item_mean_rating", "item_imdb_length", "item_imdb_mature_rating"),
    "v4": ("item_mean_rating", "item_imdb_length", "item_imdb_mature_rating"),
    "v5": ("item_mean_rating", "item_imdb_length", "item_imdb_mature_rating", "rating_band"),
    "v6": GENRES + ("item_length_band", "item_imdb_mature_rating"),
}


# A mean that serves as a grouping key, and the id it belongs to.
ID_OF = {"item_mean_rating": "item_id", "user_mean_rating": "user_id"}
Means = Mapping[str, DataFrame]


def rating_sums(
    df: DataFrame, keys: Sequence[str], means: Means | None = None, extra: Sequence[str] = (), target: str = "rating"
) -> DataFrame:
    """Sum (``__s``) and count (``__n``) of ``target`` per key and ``extra`` column, null keys being groups.

    Partial sums are formed before the shuffle, so a key that holds a large part of all rows sends
    one row per input partition. A key found in ``means`` (name -> table of id and mean) need not be
    a column of ``df``: rows are summed per id first, and only these sums are joined to the mean.
    """
    derived = {k: means[k] for k in keys if means and k in means}
    own = dict.fromkeys([*(ID_OF[k] for k in derived), *(k for k in keys if k not in derived), *extra])
    sums = df.groupBy(*own).agg(F.sum(target).alias("__s"), F.count(target).alias("__n"))
    if not derived:
        return sums
    for k, table in derived.items():
        sums = null_safe_left_join(sums, table, [ID_OF[k]])
    return sums.groupBy(*keys, *extra).agg(F.sum("__s").alias("__s"), F.sum("__n").alias("__n"))


def mean_encode(
    df: DataFrame, keys: Sequence[str], name: str, target: str = "rating", means: Means | None = None
) -> DataFrame:
    """Mean of ``target`` per key, null keys being a group of their own."""
    mean = F.when(F.col("__n") > 0, F.col("__s") / F.col("__n"))
    return rating_sums(df, keys, means, target=target).select(*keys, r6(mean).alias(name))


def _join_all(df: DataFrame, store, specs: Mapping[str, Sequence[str]], extra: Sequence[str] = ()) -> DataFrame:
    with ThreadPoolExecutor(max_workers=4) as pool:
        tables = list(pool.map(store, specs.items()))
    for keys, table in zip(specs.values(), tables):
        df = null_safe_left_join(df, table, [*keys, *extra])
    return df


def add_encodings(
    df: DataFrame, fit_on: DataFrame, specs: Mapping[str, Sequence[str]], target: str = "rating",
    means: Means | None = None,
) -> DataFrame:
    """Left-join one encoding per entry of ``specs`` (name -> keys).

    Each encoding is stored first, so the planner knows its real size: a small one
    is broadcast and ``df`` is not shuffled for it, a large one is merge-joined.
    The encodings do not depend on each other and are computed at the same time.
    """
    def store(item):
        name, keys = item
        return materialise(mean_encode(fit_on, keys, name, target, means), name)

    return _join_all(df, store, specs)


def add_item_means(ratings: DataFrame) -> DataFrame:
    """The rating means that come with the data, fitted on train rows."""
    return add_encodings(ratings, train_rows(ratings), ITEM_MEANS)


def add_out_of_fold(
    df: DataFrame, fit_on: DataFrame, specs: Mapping[str, Sequence[str]], fold: str = "fold",
    target: str = "rating", means: Means | None = None,
) -> DataFrame:
    """Encode every row from the folds it is not in.

    All encodings are fitted on ``fit_on``, the labelled rows as stored, before the first is joined. One
    aggregate per (key, fold) carries all sums. The window only sees these sums, at most one row
    per fold and key, never the raw rows.
    """
    def store(item):
        name, keys = item
        whole = Window.partitionBy(*keys)
        others_n = F.sum("__n").over(whole) - F.col("__n")
        others_s = F.sum("__s").over(whole) - F.coalesce("__s", F.lit(0))
        return materialise(rating_sums(fit_on, keys, means, [fold], target).select(
            *keys, fold, r6(F.when(others_n > 0, others_s / others_n)).alias(name)), name)

    return _join_all(df, store, specs, [fold])


def out_of_fold_encode(
    df: DataFrame, keys: Sequence[str], name: str, fold: str = "fold", target: str = "rating"
) -> DataFrame:
    """One encoding, fitted on the other folds of ``df`` itself."""
    return add_out_of_fold(df, df, {name: keys}, fold, target)
