"""The model table: time and length features plus four mean-rating encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import columns as C
from marquee.operators.encode import ITEM_INDEX, USER_GENRE, USER_INDEX, add_encodings, add_out_of_fold, mean_encode
from marquee.operators.joins import null_safe_left_join
from marquee.operators.resample import balanced_folds, hash_fold, split_exact
from marquee.session import materialise
from marquee.sources.ratings import ITEM_MEANS, ROW_KEY, load_ratings, test_rows, train_rows

ENCODINGS = {
    "user_mean_rating": ("user_id",),
    "user_genre_mean_rating": USER_GENRE["15"],
    "item_index_mean_rating": ITEM_INDEX["v4"],
    "user_index_mean_rating": USER_INDEX["v5"],
}
FEATURES = (
    "user_mean_rating", "item_mean_rating", "user_genre_mean_rating",
    "item_index_mean_rating", "user_index_mean_rating",
)
FEATURES_4 = tuple(f for f in FEATURES if f != "item_mean_rating")
FEATURES_2 = ("item_index_mean_rating", "user_index_mean_rating")
LARGE = 250_000  # rows of an encoding that is hardly broadcast
FEATURE_COLUMNS = ROW_KEY + (
    "user_id", "item_id", "rating", "is_test", "hour", "release_month", "item_length_band",
) + FEATURES


def with_time_and_bands(ratings: DataFrame) -> DataFrame:
    return ratings.withColumns({
        "hour": C.rating_hour(F.col("timestamp")),
        "release_month": C.release_month(F.col("release_date")),
        "item_length_band": C.length_band(F.col("item_imdb_length")),
        "top_1000_band": C.quality_band(F.col("item_imdb_top_1000_voters_average")),
        "rating_band": C.quality_band(F.col("item_imdb_rating_of_ten")),
    })


def item_means(ratings: DataFrame) -> DataFrame:
    """Stored table of ``item_id`` and ``item_mean_rating``, the one item mean the encodings need."""
    name = "item_mean_rating"
    return materialise(mean_encode(train_rows(ratings), ITEM_MEANS[name], name), name)


def with_item_mean(ratings: DataFrame) -> DataFrame:
    """Add only ``item_mean_rating``."""
    return null_safe_left_join(ratings, item_means(ratings), ["item_id"])


# What the feature table reads; nothing else is written to the stored ratings.
FEATURE_INPUT = tuple(dict.fromkeys(
    ROW_KEY + ("user_id", "item_id", "rating", "is_test", "release_month", "item_length_band")
    + tuple(k for keys in ENCODINGS.values() for k in keys if not k.endswith("mean_rating"))
))


def stored_ratings(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """Chosen columns of the joined ratings, written once.

    Every encoding and every fit then scans its own few columns of this table
    and does not repeat the joins behind it.
    """
    return materialise(with_time_and_bands(load_ratings(spark, sf_dir)).select(*columns), "ratings")


def _encoded(ratings: DataFrame, fit_on: DataFrame, items: DataFrame) -> DataFrame:
    """``ratings`` with the item mean and all encodings.

    The means of attributes have few rows and come first; after them no attribute is needed, so the joins by user and by
    item, which may have to shuffle the rows, have narrow ones. Where both do, the rows are stored between them, and only the
    shuffle files of one such join exist at a time.
    """
    after = {n: k for n, k in ENCODINGS.items() if "item_mean_rating" in k}
    before = {n: k for n, k in ENCODINGS.items() if n not in after and k != ("user_id",)}
    users = materialise(mean_encode(fit_on, ("user_id",), "user_mean_rating"), "user_mean_rating")
    needed = dict.fromkeys([*FEATURE_COLUMNS, *(k for keys in after.values() for k in keys)])
    rows = add_encodings(ratings, fit_on, before)
    rows = null_safe_left_join(rows.select([c for c in rows.columns if c in needed]), users, ["user_id"])
    if users.count() > LARGE:
        rows = materialise(rows, "users-joined")
    return add_encodings(null_safe_left_join(rows, items, ["item_id"]), fit_on, after, means={"item_mean_rating": items})


def feature_table(ratings: DataFrame, fit_on: str = "all", folds: int = 5) -> DataFrame:
    """Features of all rows.

    ``fit_on="all"`` fits the encodings on every labelled row, which leaks the
    hold-out rows of a later split; ``"train"`` fits on the 80 % split part only;
    ``"out_of_fold"`` encodes each labelled row from the other folds.
    """
    if fit_on not in ("all", "train", "out_of_fold"):
        raise ValueError(f"fit_on: {fit_on}")
    items = item_means(ratings)
    means = {"item_mean_rating": items}
    # Encodings are fitted on the stored rows; the item mean is joined only to the rows that leave.
    labelled = train_rows(ratings)
    if fit_on == "all":
        out = _encoded(ratings, labelled, items)
    elif fit_on == "train":
        out = _encoded(ratings, split_exact(labelled, 0.8, 42, ROW_KEY)[0], items)
    else:
        rows = null_safe_left_join(ratings, items, ["item_id"])
        fold = hash_fold(folds, 42, ROW_KEY)
        known = add_out_of_fold(
            train_rows(rows).withColumn("fold", fold), labelled.withColumn("fold", fold), ENCODINGS, means=means)
        out = known.drop("fold").unionByName(add_encodings(test_rows(rows), labelled, ENCODINGS, means=means))
    return out.select(*FEATURE_COLUMNS)


def model_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored feature table as (80 % training part, 20 % hold-out, rows to score)."""
    table = materialise(feature_table(stored_ratings(spark, sf_dir, FEATURE_INPUT)), "features")
    train, holdout = split_exact(train_rows(table), 0.8, 42, ROW_KEY)
    return train, holdout, test_rows(table)


def folded(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """Folds balanced on the rating, stored because every fit reads them again."""
    return materialise(balanced_folds(df, k, seed, ROW_KEY, "rating"), "folds")


def two_attribute_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Labelled rows and rows to score, with one mean by user attributes and one by item attributes."""
    specs = {"user_rating": USER_INDEX["v1"], "item_rating": ITEM_INDEX["v6"]}
    needed = dict.fromkeys([*ROW_KEY, "user_id", "item_id", "rating", "is_test", *specs["user_rating"], *specs["item_rating"]])
    rows = stored_ratings(spark, sf_dir, list(needed))
    table = materialise(
        add_encodings(with_item_mean(rows), train_rows(rows), specs).select(
            *ROW_KEY, "user_id", "item_id", "rating", "is_test", "item_mean_rating", *specs),
        "attribute_means")
    return train_rows(table), test_rows(table)


def two_attribute_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled rows of ``two_attribute_parts``."""
    return two_attribute_parts(spark, sf_dir)[0]
