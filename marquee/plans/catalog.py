"""Named queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import columns as C
from marquee.operators import boosted, encode, factor, gram, joins, missing, profile, regress, resample, reshape, similarity, sketches, summaries
from marquee.plans.features import (
    FEATURE_INPUT, FEATURES, FEATURES_2, FEATURES_4, feature_table, folded, item_means, model_parts, stored_ratings,
    two_attribute_means, two_attribute_parts, with_item_mean, with_time_and_bands,
)
from marquee.plans.submission import boosted_submission, submission, to_submission
from marquee.session import configure, deal, materialise, new_path
from marquee.sources import side
from marquee.sources.files import read_csv, write_csv
from marquee.sources.ratings import (
    CATEGORICAL, GENRES, MOVIE_COLUMNS, NUMERIC, ROW_KEY, USER_COLUMNS, load_ratings, test_rows, train_rows,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RAW_NUMERIC = tuple(c for c in NUMERIC if not c.endswith("mean_rating"))
NEIGHBOURS = 25
MAX_FANOUT = 8.0  # four ratings for maturity and null share a key of the index without it
BASELINE_KEYS = {
    "user_mean": ("user_id",),
    "item_mean": ("item_id",),
    "age_band_item_mean": ("age_band", "item_id"),
}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        return run

    return register


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_rows(load_ratings(spark, sf_dir))


def full(spark: SparkSession, sf_dir: str, columns=()) -> DataFrame:
    """Stored ratings with the numeric columns, ``columns`` and all derived item means."""
    needed = dict.fromkeys([*ROW_KEY, "item_id", "is_test", "age_band", "gender", *RAW_NUMERIC, *columns])
    return encode.add_item_means(stored_ratings(spark, sf_dir, list(needed)))


def narrow(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """Stored ratings with just the row key, the label and ``keys``."""
    needed = dict.fromkeys([*ROW_KEY, "item_id", "rating", "is_test", *keys])
    return stored_ratings(spark, sf_dir, [c for c in needed if not c.endswith("mean_rating")])


def keyed(df: DataFrame, *cols) -> DataFrame:
    return df.select(*ROW_KEY, *cols)


# --- sources, sinks, profiles ------------------------------------------------

@query("load_ratings")
def _(spark, d):
    return load_ratings(spark, d)


@query("csv_roundtrip")
def _(spark, d):
    df = keyed(load_ratings(spark, d), "user_id", "item_id", "rating", "movie_title",
               "release_date", "item_imdb_length", "item_imdb_mature_rating")
    path = new_path(spark, "csv")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


@query("profile_numeric")
def _(spark, d):
    return profile.numeric_profile(train_rows(full(spark, d)), NUMERIC)


@query("profile_categorical")
def _(spark, d):
    return profile.categorical_profile(train(spark, d), CATEGORICAL + ("zip_code",))


@query("profile_schema")
def _(spark, d):
    return profile.schema_profile(
        train(spark, d), ("user_id", "item_id", "rating", "age", "release_date", "movie_title")
        + CATEGORICAL + ("item_imdb_length", "item_imdb_rating_of_ten", "war")
    )


@query("null_profile")
def _(spark, d):
    return profile.null_profile(full(spark, d, CATEGORICAL + ("release_date",)), NUMERIC + CATEGORICAL + ("release_date",))


@query("side_table")
def _(spark, d):
    return side.parse(side.load_raw(spark, d))


@query("side_fields")
def _(spark, d):
    return side.field_report(side.load_raw(spark, d))


@query("side_profile")
def _(spark, d):
    return profile.numeric_profile(side.parse(side.load_raw(spark, d)), side.NUMBERS)


@query("side_histogram")
def _(spark, d):
    widths = {"votes": 250, "score": 0.5, "critic_score": 10, "budget": 5000, "gross": 5000}
    return profile.histogram(side.parse(side.load_raw(spark, d)), {c: (F.col(c), w) for c, w in widths.items()})


@query("side_correlation")
def _(spark, d):
    return profile.correlations(side.parse(side.load_raw(spark, d)), side.NUMBERS)


@query("profile_sketch")
def _(spark, d):
    labelled = train_rows(full(spark, d, ("timestamp",)))
    parts = materialise(sketches.numeric_parts(labelled, F.trunc("timestamp", "month"), NUMERIC), "sketches")
    return sketches.numeric_profile_of(parts)


DISTINCT_KEYS = {"users": ("user_id",), "items": ("item_id",), "titles": ("movie_title",), "pairs": ("user_id", "item_id")}


@query("distinct_sketch")
def _(spark, d):
    parts = sketches.distinct_parts(train(spark, d), F.trunc("timestamp", "month"), DISTINCT_KEYS)
    return sketches.distinct_counts_of(materialise(parts, "sketches"), list(DISTINCT_KEYS))


# --- projection, predicates, scalar expressions --------------------------------

@query("project_ratings")
def _(spark, d):
    return keyed(load_ratings(spark, d), "user_id", "item_id", "rating", "zip_code").drop("zip_code")


@query("filter_predicates")
def _(spark, d):
    keep = (F.col("age") > 70) | F.col("release_date").isNull() | (F.col("item_id") == 267)
    return keyed(load_ratings(spark, d).filter(keep), "age", "release_date", "item_id")


@query("cast_ids")
def _(spark, d):
    return keyed(
        load_ratings(spark, d), "user_id", F.col("user_id").try_cast("long").alias("user_number"),
        F.col("item_id").cast("string").alias("item_text"),
        F.col("item_id").cast("string").try_cast("double").alias("item_number"),
        F.col("occupation").try_cast("int").alias("occupation_number"),
    )


@query("flags_to_numeric")
def _(spark, d):
    return keyed(load_ratings(spark, d), *C.flags_as_int(GENRES))


@query("rating_hour")
def _(spark, d):
    return keyed(load_ratings(spark, d), C.rating_hour(F.col("timestamp")).alias("hour"))


@query("release_month")
def _(spark, d):
    month = C.release_month(F.col("release_date"))
    return keyed(load_ratings(spark, d), month.alias("month"),
                 C.explicit_missing(month).alias("month_level"))


@query("day_part_counts")
def _(spark, d):
    hour = C.rating_hour(F.col("timestamp"))
    parts = train(spark, d).select(C.day_part(hour).alias("view_cat"), C.day_part_order(hour).alias("position"))
    return summaries.count_by(parts, ["view_cat", "position"], "freq")


@query("length_band")
def _(spark, d):
    return keyed(load_ratings(spark, d), "item_imdb_length",
                 C.length_band(F.col("item_imdb_length")).alias("band"))


@query("length_band_unknown")
def _(spark, d):
    return keyed(load_ratings(spark, d), "item_imdb_length",
                 C.length_band(F.col("item_imdb_length"), unknown=True).alias("band"))


@query("quality_band")
def _(spark, d):
    return keyed(with_time_and_bands(load_ratings(spark, d)), "top_1000_band", "rating_band")


@query("occupation_class")
def _(spark, d):
    return train(spark, d).select("user_id", "occupation").distinct().withColumn(
        "occu_class", C.occupation_class(F.col("occupation")))


@query("coalesce_feature")
def _(spark, d):
    rows = narrow(spark, d, *encode.USER_GENRE["19"])
    enc = {"user_genre_mean_rating": encode.USER_GENRE["19"]}
    return keyed(
        encode.add_encodings(test_rows(with_item_mean(rows)), train_rows(rows), enc),
        F.coalesce("user_genre_mean_rating", "item_mean_rating").alias("user_genre_mean_rating"),
    )


@query("submission_key")
def _(spark, d):
    return keyed(test_rows(load_ratings(spark, d)),
                 C.submission_key(F.col("user_id"), F.col("item_id")).alias("user_item"))


@query("clamp_rating")
def _(spark, d):
    return keyed(load_ratings(spark, d), C.clamp_rating(F.col("item_imdb_rating_of_ten")).alias("rating"))


@query("clamp_rating_mean")
def _(spark, d):
    ratings = load_ratings(spark, d)
    mean = train_rows(ratings).agg(C.r6(F.avg("rating"))).scalar()
    return keyed(ratings, C.clamp_rating(F.col("item_imdb_rating_of_ten"), mean).alias("rating"))


@query("clamp_rating_keep")
def _(spark, d):
    return keyed(load_ratings(spark, d),
                 C.clamp_rating(F.col("item_imdb_rating_of_ten"), None).alias("rating"))


@query("genre_string")
def _(spark, d):
    return load_ratings(spark, d).select("item_id", C.genre_string(GENRES).alias("genre")).distinct()


@query("primary_genre")
def _(spark, d):
    return load_ratings(spark, d).select("item_id", C.primary_genre(GENRES).alias("genre")).distinct()


@query("complete_cases")
def _(spark, d):
    return profile.completeness(train(spark, d), RAW_NUMERIC + CATEGORICAL + ("release_date",))


# --- reshape and set operations -------------------------------------------------

def movies(spark, d):
    return train(spark, d).select(*MOVIE_COLUMNS).distinct()


def movie_genres(spark, d):
    return reshape.unpivot_flags(
        train(spark, d).select("item_id", "movie_title", *GENRES).distinct(),
        ["item_id", "movie_title"], GENRES,
    )


@query("unpivot_genres")
def _(spark, d):
    return movie_genres(spark, d)


@query("user_item_matrix")
def _(spark, d):
    return reshape.user_item_cells(train(spark, d)).withColumn("rating", C.r6(F.col("rating")))


@query("pivot_top_items")
def _(spark, d):
    ratings = train(spark, d).select("user_id", "item_id", "rating")
    wide = reshape.pivot_ranked_items(reshape.user_item_cells(ratings), ratings, 10)
    return wide.select("user_id", *[C.r6(F.col(c)).alias(c) for c in wide.columns[1:]])


@query("one_hot")
def _(spark, d):
    ratings = load_ratings(spark, d)
    return reshape.one_hot(ratings, reshape.fit_levels(train_rows(ratings), CATEGORICAL), ROW_KEY)


@query("distinct_movies")
def _(spark, d):
    return movies(spark, d)


@query("append_rows")
def _(spark, d):
    ratings = load_ratings(spark, d)
    return reshape.append_rows(
        keyed(train_rows(ratings), "user_id", "item_id", "rating"),
        keyed(test_rows(ratings), "user_id", "item_id"),
    )


@query("split_exact")
def _(spark, d):
    return keyed(resample.split_exact(train_rows(narrow(spark, d)), 0.8, 42, ROW_KEY)[0])


@query("split_complement")
def _(spark, d):
    return keyed(resample.split_exact(train_rows(narrow(spark, d)), 0.8, 42, ROW_KEY)[1])


@query("split_fraction")
def _(spark, d):
    return keyed(resample.split_fraction(train(spark, d), 0.75, 1058, ROW_KEY)[0])


# --- joins ------------------------------------------------------------------------

@query("join_user_mean")
def _(spark, d):
    ratings = narrow(spark, d, "user_id")
    return keyed(encode.add_encodings(ratings, train_rows(ratings), {"user_mean_rating": ("user_id",)}),
                 "user_mean_rating")


@query("join_item_index")
def _(spark, d):
    rows = narrow(spark, d, *encode.ITEM_INDEX["v4"])
    items = item_means(rows)
    enc = {"item_index_mean_rating": encode.ITEM_INDEX["v4"]}
    out = encode.add_encodings(joins.null_safe_left_join(rows, items, ["item_id"]), train_rows(rows), enc,
                               means={"item_mean_rating": items})
    return keyed(out, "item_index_mean_rating")


@query("title_conflicts")
def _(spark, d):
    films = movies(spark, d).select("movie_title", "item_id", "release_date", "item_imdb_length")
    shared = summaries.count_by(films, ["movie_title"], "count").filter("count > 1")
    return shared.join(films, "movie_title")


@query("movie_stats_sql")
def _(spark, d):
    # The outer join as inner join plus the unmatched rows: an inner join can be
    # split on either side when one item holds much of the ratings. The last sort
    # columns let the range sort cut through a hot item.
    return spark.sql(
        """SELECT item_id, movie_title, genre, rating FROM (
             SELECT a.item_id, a.movie_title, a.genre, b.rating, b.rating_id
             FROM {movie_genre} a JOIN {ratings} b ON a.item_id = b.item_id
             UNION ALL
             SELECT a.*, NULL, NULL FROM {movie_genre} a
             LEFT ANTI JOIN (SELECT DISTINCT item_id FROM {ratings}) b ON a.item_id = b.item_id)
           ORDER BY item_id, genre, rating_id""",
        movie_genre=movie_genres(spark, d), ratings=train(spark, d),
    )


@query("lookup_default")
def _(spark, d):
    ratings = load_ratings(spark, d)
    cells = reshape.user_item_cells(train_rows(ratings)).withColumnRenamed("rating", "prediction")
    pairs = keyed(test_rows(ratings), "user_id", "item_id")
    return joins.lookup_with_default(pairs, cells, ["user_id", "item_id"], "prediction", 1.0).select(
        *ROW_KEY, "user_id", "item_id", C.r6(F.col("prediction")).alias("prediction"))


@query("join_fanout")
def _(spark, d):
    rows = narrow(spark, d, *encode.ITEM_INDEX["v6"])
    enc = materialise(
        encode.mean_encode(train_rows(rows), encode.ITEM_INDEX["v6"], "item_rating"), "index"
    ).withColumnRenamed("item_imdb_mature_rating", "mature_rating_y")
    keys = [k for k in encode.ITEM_INDEX["v6"] if k != "item_imdb_mature_rating"]
    return keyed(joins.guarded_left_join(test_rows(rows), enc, keys, MAX_FANOUT),
                 "item_imdb_mature_rating", "mature_rating_y", "item_rating")


# --- aggregations -----------------------------------------------------------------

@query("counts_by_key")
def _(spark, d):
    text = {"user": "user_id", "item": "item_id", "title": "movie_title", "zip": "zip_code",
            "occupation": "occupation"}
    columns = {k: F.col(c).cast("string") for k, c in text.items()}
    return summaries.count_levels(train(spark, d), {**columns, "genre": C.genre_string(GENRES)})


@query("distinct_counts")
def _(spark, d):
    return train(spark, d).agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("item_id").alias("items"),
        F.count_distinct("movie_title").alias("titles"),
        F.count_distinct("user_id", "item_id").alias("pairs"),
    )


def user_table(labelled):
    return labelled.groupBy(*USER_COLUMNS).agg(
        F.count("*").alias("count"), C.r6(F.avg("rating")).alias("user_mean"))


@query("user_profile")
def _(spark, d):
    return user_table(train(spark, d))


@query("enc_user_mean")
def _(spark, d):
    return encode.mean_encode(train(spark, d), ["user_id"], "user_mean_rating")


def _register_encoding(name: str, keys, out: str) -> None:
    @query(name)
    def _(spark, d):
        ids = {k: encode.ID_OF[k] for k in keys if k in encode.ID_OF}
        if not ids:
            return encode.mean_encode(train_rows(with_time_and_bands(load_ratings(spark, d))), keys, out)
        labelled = train_rows(narrow(spark, d, *ids.values(), *keys))
        means = {k: materialise(encode.mean_encode(labelled, [i], k), k) for k, i in ids.items()}
        return encode.mean_encode(labelled, keys, out, means=means)


for _v, _keys in encode.USER_GENRE.items():
    _register_encoding(f"enc_user_genre_{_v}", _keys, "user_genre_mean_rating")
for _v, _keys in encode.USER_INDEX.items():
    _register_encoding(f"enc_user_index_{_v}", _keys, "user_index_mean_rating")
for _v, _keys in encode.ITEM_INDEX.items():
    _register_encoding(f"enc_item_index_{_v}", _keys, "item_index_mean_rating")


@query("genre_combo_stats")
def _(spark, d):
    return summaries.combination_stats(train(spark, d), GENRES)


@query("genre_stats")
def _(spark, d):
    return summaries.flag_stats(train(spark, d), GENRES)


@query("group_size_summary")
def _(spark, d):
    labelled = train_rows(narrow(spark, d, *USER_COLUMNS, "movie_title"))
    users = materialise(user_table(labelled).select("zip_code", "occupation", "count"), "users")
    zips = summaries.count_by(users, ["zip_code"]).select(F.lit("users_per_zip").alias("grouping"), "n")
    jobs = summaries.count_by(users, ["occupation"]).select(
        F.lit("users_per_occupation").alias("grouping"), "n")
    titles = summaries.count_by(labelled, ["movie_title"]).select(
        F.lit("ratings_per_title").alias("grouping"), "n")
    per_user = users.select(F.lit("ratings_per_user").alias("grouping"), F.col("count").alias("n"))
    sizes = reduce(DataFrame.unionByName, [zips, jobs, titles, per_user])
    return summaries.size_summary(materialise(sizes, "sizes"), ["grouping"])


def _top_lists(spark, d):
    rows = train(spark, d)
    items = rows.select("item_id", C.genre_string(GENRES).alias("genre")).distinct()
    return {
        ("user", 250): summaries.count_by(rows, ["user_id"]).withColumnRenamed("user_id", "key"),
        ("item", 500): summaries.count_by(rows, ["item_id"]).withColumnRenamed("item_id", "key"),
        ("genre", 100): summaries.count_by(items, ["genre"]).withColumnRenamed("genre", "key"),
    }


@query("top_share")
def _(spark, d):
    return reduce(DataFrame.unionByName, [
        summaries.top_share(counts, n).withColumn("kind", F.lit(kind))
        for (kind, n), counts in _top_lists(spark, d).items()
    ])


@query("top_n_ties")
def _(spark, d):
    return reduce(DataFrame.unionByName, [
        summaries.top_n_with_ties(counts, n).select(
            F.lit(kind).alias("kind"), F.col("key").cast("string").alias("key"), "n")
        for (kind, n), counts in _top_lists(spark, d).items()
    ])


@query("title_counts")
def _(spark, d):
    return summaries.count_by(train(spark, d), ["movie_title"], "count").orderBy(
        F.desc("count"), "movie_title")


@query("rmse_baselines")
def _(spark, d):
    ratings = narrow(spark, d, "user_id", "age_band")
    labelled = train_rows(ratings)
    scored = encode.add_encodings(test_rows(ratings), labelled, BASELINE_KEYS).withColumn(
        "global_mean", labelled.agg(C.r6(F.avg("rating"))).scalar())
    models = ["global_mean", *BASELINE_KEYS]
    stacked = scored.select(F.col("rating").cast("double").alias("rating"), *models).unpivot(
        ["rating"], models, "model", "prediction")
    return summaries.rmse(stacked, ["model"])


# --- descriptive statistics -----------------------------------------------------

@query("rating_histogram")
def _(spark, d):
    return profile.histogram(train(spark, d), {
        "rating": (F.col("rating"), 1), "age": (F.col("age"), 5),
        "item_imdb_length": (F.col("item_imdb_length"), 25),
        "item_imdb_rating_of_ten": (F.col("item_imdb_rating_of_ten"), 0.5),
    })


def cells(spark, d):
    return reshape.user_item_cells(train(spark, d).select("user_id", "item_id", "rating"))


@query("rating_histogram_norm")
def _(spark, d):
    raw = cells(spark, d)
    return profile.histogram(
        similarity.normalise(raw, "center"), {"centered": (F.col("z"), 1)}
    ).unionByName(profile.histogram(similarity.normalise(raw), {"z": (F.col("z"), 0.25)}))


@query("box_stats")
def _(spark, d):
    users = user_table(train(spark, d)).select(
        "age_band", C.occupation_class(F.col("occupation")).alias("occu_class"), "user_mean")
    return profile.box_stats(materialise(users, "users"), ["age_band", "occu_class"], "user_mean")


@query("corr_matrix")
def _(spark, d):
    return profile.correlations(train_rows(full(spark, d)), NUMERIC)


@query("pair_association")
def _(spark, d):
    labelled = train_rows(narrow(spark, d, *USER_COLUMNS, "item_imdb_rating_of_ten", "item_imdb_length"))
    items = item_means(labelled)
    rows = joins.null_safe_left_join(labelled, items, ["item_id"])
    films = joins.null_safe_left_join(
        labelled.select("item_id", "item_imdb_rating_of_ten").distinct(), items, ["item_id"])
    parts = [
        (profile.association(films, "item_mean_rating", "item_imdb_rating_of_ten"), "mean_vs_imdb"),
        (profile.association(rows, "item_mean_rating", "item_imdb_length"), "mean_vs_length"),
    ]
    out = [p.select(F.lit(name).alias("pair"), F.lit("all").alias("gender"), "n", "corr", "slope")
           for p, name in parts]
    by_gender = profile.association(user_table(labelled), "age", "user_mean", ["gender"])
    out.append(by_gender.select(F.lit("age_vs_user_mean").alias("pair"), "gender", "n", "corr", "slope"))
    return reduce(DataFrame.unionByName, out)


# --- missing data, folds -----------------------------------------------------------

def _imputed(spark, d, pick):
    ratings = full(spark, d)
    cols = [c for c in NUMERIC if c != "rating"]
    means = missing.fit_means(train_rows(ratings), cols)
    return keyed(missing.fill_means(pick(ratings), means), *[C.r6(F.col(c)).alias(c) for c in cols])


@query("impute_mean")
def _(spark, d):
    return _imputed(spark, d, train_rows)


@query("impute_mean_test")
def _(spark, d):
    return _imputed(spark, d, test_rows)


@query("drop_incomplete")
def _(spark, d):
    return keyed(missing.drop_incomplete(load_ratings(spark, d), RAW_NUMERIC + CATEGORICAL + ("release_date",)))


@query("missing_indicators")
def _(spark, d):
    ratings = load_ratings(spark, d)
    cols = ["item_imdb_length", "item_imdb_rating_of_ten", "item_imdb_top_1000_voters_average"]
    means = missing.fit_means(train_rows(ratings), cols)
    out = missing.fill_means(missing.add_indicators(ratings, cols), means)
    return keyed(out, *[C.r6(F.col(c)).alias(c) for c in cols], *[f"{c}_missing" for c in cols])


@query("kfold_assign")
def _(spark, d):
    return keyed(resample.balanced_folds(train(spark, d), 10, 42, ROW_KEY, "rating"), "rating", "fold")


@query("repeated_kfold")
def _(spark, d):
    return keyed(resample.repeated_folds(train(spark, d), 10, 5, 42, ROW_KEY),
                 *[f"fold_{r}" for r in range(1, 6)])


@query("enc_oof")
def _(spark, d):
    rows = narrow(spark, d, "user_id", *encode.USER_INDEX["v5"])
    known = train_rows(rows).withColumn("fold", resample.hash_fold(5, 42, ROW_KEY))
    specs = {"user_mean_rating": ["user_id"], "user_index_mean_rating": encode.USER_INDEX["v5"]}
    folds = encode.add_out_of_fold(known, known, specs)
    return keyed(folds, "fold", "user_mean_rating", "user_index_mean_rating")


# --- neighbours --------------------------------------------------------------------

def _z_cells(spark, d):
    return materialise(similarity.normalise(cells(spark, d)), "cells")


@query("normalize_ratings")
def _(spark, d):
    return similarity.normalise(cells(spark, d)).select(
        "user_id", "item_id", *[C.r6(F.col(c)).alias(c) for c in ("rating", "user_mean", "user_sd", "z")])


@query("center_ratings")
def _(spark, d):
    return similarity.normalise(cells(spark, d), "center").select(
        "user_id", "item_id", *[C.r6(F.col(c)).alias(c) for c in ("rating", "user_mean", "z")])


def _neighbour_query(entity, other, k):
    def run(spark, d):
        found = similarity.nearest_neighbours(_z_cells(spark, d), entity, other, k)
        return found.withColumn("similarity", C.r6(F.col("similarity")))

    return run


query("ibcf_neighbours")(_neighbour_query("item_id", "user_id", 5))
query("ubcf_neighbours")(_neighbour_query("user_id", "item_id", NEIGHBOURS))


def _pairs(spark, d):
    return keyed(test_rows(load_ratings(spark, d)), "user_id", "item_id")


def _ibcf(spark, d):
    z = _z_cells(spark, d)
    near = similarity.nearest_neighbours(z, "item_id", "user_id", 5)
    return similarity.predict_item_based(_pairs(spark, d), z, near)


@query("ibcf_predict")
def _(spark, d):
    return _ibcf(spark, d)


@query("ubcf_predict")
def _(spark, d):
    z = _z_cells(spark, d)
    near = similarity.nearest_neighbours(z, "user_id", "item_id", NEIGHBOURS)
    return similarity.predict_user_based(_pairs(spark, d), z, near)


@query("ubcf_predict_5")
def _(spark, d):
    z = _z_cells(spark, d)
    near = similarity.nearest_neighbours(z, "user_id", "item_id", 5)
    return similarity.predict_user_based(_pairs(spark, d), z, near, default=0.0)


@query("head_predictions")
def _(spark, d):
    return _ibcf(spark, d).orderBy(F.desc("prediction"), *ROW_KEY).limit(10)


@query("top_n_recommend")
def _(spark, d):
    z = _z_cells(spark, d)
    near = materialise(similarity.nearest_neighbours(z, "item_id", "user_id", 5), "neighbours")
    return similarity.recommend_unseen(z, near, 25)


# --- end to end ----------------------------------------------------------------------

@query("feature_table")
def _(spark, d):
    return feature_table(stored_ratings(spark, d, FEATURE_INPUT))


@query("submission")
def _(spark, d):
    return submission(spark, d)


@query("submission_boosted")
def _(spark, d):
    return boosted_submission(spark, d)


# --- models ---------------------------------------------------------------------------

def _scored(df, *extra):
    return df.select(*ROW_KEY, C.r6(F.col("prediction")).alias("prediction"), *extra)


@query("ols_two_feature")
def _(spark, d):
    fit, holdout = resample.split_exact(two_attribute_means(spark, d), 0.75, 1058, ROW_KEY)
    model = regress.fit_linear(fit, ["user_rating", "item_rating"])
    return _scored(holdout.withColumn("prediction", model.predict()))


@query("ols_model0")
def _(spark, d):
    fit, holdout, _new = model_parts(spark, d)
    model = regress.fit_linear(fit, FEATURES)
    return _scored(holdout.withColumn("prediction", model.predict()))


@query("ols_ladder")
def _(spark, d):
    needed = [*NUMERIC, *CATEGORICAL]
    table = materialise(train_rows(full(spark, d, CATEGORICAL)).select(*ROW_KEY, *needed), "ladder")
    inside = resample.row_hash(1058, ROW_KEY) <= F.lit(resample.split_cut(table, 0.75, 1058, ROW_KEY))
    terms = {f: [t.strip() for t in f.split("~")[1].split("+")] for f in regress.LADDER.values()}
    levels = reshape.fit_levels(table.filter(inside), [c for c in CATEGORICAL if any(c in t for t in terms.values())])
    columns = {t: gram.level_columns(t, levels[t]) if t in levels else {t: F.col(t)} for ts in terms.values() for t in ts}
    sums = gram.grams(table, {n: c for t in columns.values() for n, c in t.items()}, F.col("rating"), inside.cast("int"))
    steps = []
    for step, formula in regress.LADDER.items():
        line = sums.fit([n for t in terms[formula] for n in columns[t]], {1})
        steps.append((step, formula, *sums.error(line, {0})))
    return spark.createDataFrame(steps, "step int, formula string, n long, rmse double").withColumn("rmse", C.r6(F.col("rmse")))


def _tree_parts(spark, d, features=FEATURES):
    fit, holdout, _new = model_parts(spark, d)
    means = missing.fit_means(fit, features)
    keep = [*ROW_KEY, "rating"]
    frame = materialise(regress.tree_frame(fit, features, means, keep), "training")
    return deal(frame, ROW_KEY), regress.tree_frame(holdout, features, means, keep)


@query("rf_predict")
def _(spark, d):
    fit, holdout = _tree_parts(spark, d)
    return _scored(regress.fit_trees(regress.random_forest(trees=20), fit).transform(holdout))


@query("gbt_predict")
def _(spark, d):
    fit, holdout = _tree_parts(spark, d)
    return _scored(regress.fit_trees(regress.boosting(rounds=20, rate=0.1), fit).transform(holdout))


@query("gbt_predict_4")
def _(spark, d):
    fit, holdout = _tree_parts(spark, d, FEATURES_4)
    return _scored(regress.fit_trees(regress.boosting(rounds=10, rate=0.1), fit).transform(holdout))


# Folds and depth are those of the tuning by hand. Every round of every fold costs several Spark jobs, so these
# registered runs keep patience, rounds, counts and repeats small; README has the measured cost of a round.
CV_COUNTS, CV_REPEATS = (1, 2), 1
STOP_PATIENCE, STOP_ROUNDS = 5, 10


@query("gbt_cv")
def _(spark, d):
    fit, holdout = _tree_parts(spark, d, FEATURES_2)
    frame = materialise(resample.repeated_folds(fit, 10, CV_REPEATS, 42, ROW_KEY), "folds")
    specs = [boosted.Boosting(rate=0.1, bag=bag, keys=tuple(ROW_KEY)) for bag in (0.40, 0.55)]
    columns = [f"fold_{i + 1}" for i in range(CV_REPEATS)]
    model, _best, _errors = boosted.search(frame, specs, CV_COUNTS, [columns, columns], 10)
    return _scored(model.transform(holdout))


@query("gbt_early_stop")
def _(spark, d):
    fit, holdout = _tree_parts(spark, d, FEATURES_4)
    spec = boosted.Boosting(rounds=STOP_ROUNDS, depth=6, rate=0.1, bag=0.5, keys=tuple(ROW_KEY))
    model, _rounds, _curve = boosted.early_stop(materialise(deal(folded(fit, 10, 11234), ROW_KEY), "dealt"), spec, 10, STOP_PATIENCE)
    return _scored(model.transform(holdout))


LINE = ("item_mean_rating", "user_rating", "item_rating")


def _penalised_line(labelled):
    """Scorer with the penalty that 10 folds of the training part prefer, and the hold-out; rows lacking a feature are left out."""
    fit, holdout = resample.split_exact(missing.drop_incomplete(labelled, LINE), 0.75, 1058, ROW_KEY)
    sums = gram.grams(folded(fit, 10), {n: F.col(n) for n in LINE}, F.col("rating"), F.col("fold"))
    folds = set(range(10))

    def error(penalty):
        return sum(sums.error(sums.fit(LINE, folds - {i}, penalty), {i})[1] for i in folds) / len(folds)

    line = sums.fit(LINE, penalty=min((0.0, 0.01, 0.1), key=error))
    return lambda df: df.withColumn("prediction", line.predict({n: F.col(n) for n in LINE})), holdout


@query("linear_cv")
def _(spark, d):
    score, holdout = _penalised_line(two_attribute_means(spark, d))
    return _scored(score(holdout))


@query("submission_linear")
def _(spark, d):
    labelled, new = two_attribute_parts(spark, d)
    score, _holdout = _penalised_line(labelled)
    return to_submission(score(missing.drop_incomplete(new, LINE)))


@query("feature_importance")
def _(spark, d):
    fit, _holdout = _tree_parts(spark, d)
    names = [*FEATURES, *[f"{f}_missing" for f in FEATURES]]
    models = {
        "random_forest": regress.fit_trees(regress.random_forest(trees=10), fit),
        "boosting": regress.fit_trees(regress.boosting(rounds=5, rate=0.1), fit),
    }
    rows = [(m, n, round(v, 6)) for m, fitted in models.items() for n, v in regress.importance(fitted, names)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def _als_parts(spark, d):
    ratings = load_ratings(spark, d).select("is_test", *ROW_KEY, "user_id", "item_id", "rating")
    frame, users, items = factor.als_frame(train_rows(ratings))
    return frame, factor.with_index(test_rows(ratings), users, items)


def _als_scored(model, new):
    pred = F.nullif(F.col("prediction").cast("double"), F.lit(float("nan")))
    return _scored(model.transform(new).withColumn("prediction", C.clamp_rating(pred, None)), "rating")


@query("als_predict")
def _(spark, d):
    frame, new = _als_parts(spark, d)
    return _als_scored(factor.fit_als(factor.als(rank=65, rounds=5), frame), new)


@query("als_tuned")
def _(spark, d):
    frame, new = _als_parts(spark, d)
    search = factor.tune_als(factor.als(rounds=3), frame, 3, {"rank": [5, 10], "regParam": [0.01, 0.1]})
    return _als_scored(search.bestModel, new)


@query("als_rank2_rmse")
def _(spark, d):
    frame, _new = _als_parts(spark, d)
    model = factor.fit_als(factor.als(rank=2, reg=0.01, rounds=10), frame)
    return summaries.rmse(model.transform(frame))


@query("als_rank2_gradient")
def _(spark, d):
    frame, _new = _als_parts(spark, d)
    model = factor.fit_als(factor.als(rank=2, reg=0.01, rounds=10), frame)
    return factor.als_gradient(model, frame, 0.01)


def _factor_parts(spark, d):
    """Training part and hold-out with seven factor scores per row."""
    numeric = [c for c in NUMERIC if c != "rating"]
    labelled = materialise(train_rows(full(spark, d, [*CATEGORICAL, *GENRES])), "labelled")
    levels = reshape.fit_levels(labelled, CATEGORICAL)
    means = missing.fit_means(labelled, numeric)
    hot = reshape.one_hot(labelled, levels, [*ROW_KEY, "rating", *numeric, *C.flags_as_int(GENRES)])
    wide = materialise(missing.fill_means(hot, means).fillna(0), "wide")
    fit, holdout = resample.split_exact(wide, 0.75, 1058, ROW_KEY)
    names = [c for c in wide.columns if c not in (*ROW_KEY, "rating")]
    scores = factor.fit_factors(fit, names, 7).scores()
    return fit.select(*ROW_KEY, "rating", *scores), holdout.select(*ROW_KEY, "rating", *scores)


@query("factor_scores")
def _(spark, d):
    fit, holdout = _factor_parts(spark, d)
    model = regress.fit_linear(fit, [f"factor_{i}" for i in (1, 2, 4, 6, 7)])
    return _scored(holdout.withColumn("prediction", model.predict()),
                   *[C.r6(F.col(f"factor_{i}")).alias(f"factor_{i}") for i in range(1, 8)])


@query("rf_factor_predict")
def _(spark, d):
    fit, holdout = _factor_parts(spark, d)
    rows = VectorAssembler(inputCols=[f"factor_{i}" for i in range(1, 8)], outputCol="features")
    model = regress.fit_trees(regress.random_forest(trees=20), deal(rows.transform(fit), ROW_KEY))
    return _scored(model.transform(rows.transform(holdout)))


def _leaderboard(scored):
    return summaries.rmse(reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("model"), "rating", F.col("prediction").cast("double").alias("prediction"))
        for name, df in scored.items()
    ]), ["model"])


def _plain_models(fit, holdout):
    return {
        "global_mean": holdout.withColumn("prediction", fit.agg(F.avg("rating")).scalar()),
        "least_squares": holdout.withColumn("prediction", regress.fit_linear(fit, FEATURES).predict()),
    }


@query("plain_leaderboard")
def _(spark, d):
    fit, holdout, _new = model_parts(spark, d)
    return _leaderboard(_plain_models(fit, holdout))


@query("model_leaderboard")
def _(spark, d):
    fit, holdout, _new = model_parts(spark, d)
    means = missing.fit_means(fit, FEATURES)
    keep = [*ROW_KEY, "rating"]
    tree_fit, tree_out = (regress.tree_frame(x, FEATURES, means, keep) for x in (fit, holdout))
    tree_fit = deal(materialise(tree_fit, "training"), ROW_KEY)
    return _leaderboard({
        **_plain_models(fit, holdout),
        "random_forest": regress.fit_trees(regress.random_forest(trees=10), tree_fit).transform(tree_out),
        "boosting": regress.fit_trees(regress.boosting(rounds=10, rate=0.1), tree_fit).transform(tree_out),
    })
