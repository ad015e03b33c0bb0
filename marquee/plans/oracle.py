"""The same queries as plain SQL over the given tables, for checking results."""

from __future__ import annotations

from collections.abc import Sequence

from marquee.functions.columns import DAY_PARTS, LENGTH_ABOVE, LENGTH_BANDS, QUALITY_BANDS
from marquee.operators.encode import ITEM_INDEX, USER_GENRE, USER_INDEX
from marquee.operators.regress import LADDER
from marquee.operators.reshape import level_name
from marquee.sources.side import RAW
from marquee.sources.ratings import (
    CATEGORICAL, GENRES, ITEM_MEANS, MOVIE_COLUMNS, NUMERIC, RATING_COLUMNS, USER_COLUMNS,
)

ORACLES: dict[str, str] = {}

KEY = "rating_id"
RAW_NUMERIC = [c for c in NUMERIC if not c.endswith("mean_rating")]
FEATURES = ("user_mean_rating", "item_mean_rating", "user_genre_mean_rating",
            "item_index_mean_rating", "user_index_mean_rating")
LEVELS = {
    "age_band": ("18-29", "30-44", "45-59", "60+", "Under 18"),
    "gender": ("F", "M"),
    "occupation": ("automobile", "building", "furniture", "homemaker", "household",
                   "machinery", "none", "other", "retired", "student"),
    "item_imdb_mature_rating": ("G", "PG", "PG-13", "R"),
}


def quote(col: str) -> str:
    return f'"{col}"' if col in ("unknown", "timestamp") else col


def names(cols: Sequence[str], alias: str = "") -> str:
    return ", ".join(f"{alias}{quote(c)}" for c in cols)


def same(keys: Sequence[str], a: str = "r", b: str = "e") -> str:
    return " AND ".join(f"{a}.{quote(k)} IS NOT DISTINCT FROM {b}.{quote(k)}" for k in keys)


def steps(col: str, bands, tail: str = "") -> str:
    arms = " ".join(f"WHEN {col} < {lim} THEN '{label}'" for lim, label, *_ in bands)
    return f"CASE {arms}{tail} END"


LENGTH_TAIL = f" WHEN item_imdb_length > {LENGTH_BANDS[-1][0]} THEN '{LENGTH_ABOVE}'"
LENGTH_BAND = steps("item_imdb_length", LENGTH_BANDS, LENGTH_TAIL)


def quality(col: str) -> str:
    return steps(col, QUALITY_BANDS, f" WHEN {col} IS NULL THEN 'Unknown'")


RATINGS = (
    "ratings AS MATERIALIZED (SELECT *, CAST(hour(\"timestamp\") AS INT) AS hour, "
    "CAST(month(release_date) AS INT) AS release_month, "
    f"{LENGTH_BAND} AS item_length_band, {quality('item_imdb_top_1000_voters_average')} AS top_1000_band, "
    f"{quality('item_imdb_rating_of_ten')} AS rating_band FROM (SELECT "
    + ", ".join(f"{e} AS {quote(c)}" for c, e in RATING_COLUMNS.items())
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN part ON l_partkey = p_partkey))"
)
TRAIN = "train AS (SELECT * FROM ratings WHERE NOT is_test)"


def encoding(name: str, keys: Sequence[str], source: str, out: str) -> str:
    return (f"{name} AS (SELECT {names(keys)}, round(avg(rating), 6) AS {out} "
            f"FROM {source} GROUP BY {names(keys)})")


def joined(name: str, left: str, specs: dict[str, Sequence[str]], source: str) -> list[str]:
    """CTEs that add one encoding per entry of ``specs`` to ``left``."""
    ctes, frm = [], f"{left} r"
    for i, (out, keys) in enumerate(specs.items()):
        ctes.append(encoding(f"{name}_{i}", keys, source, out))
        frm += f" LEFT JOIN {name}_{i} ON " + same(keys, "r", f"{name}_{i}")
    cols = ", ".join(f"{name}_{i}.{out}" for i, out in enumerate(specs))
    return [*ctes, f"{name} AS MATERIALIZED (SELECT r.*, {cols} FROM {frm})"]


ITEM_MEAN = joined("rm", "ratings", {"item_mean_rating": ("item_id",)}, "train")
ALL_MEANS = joined("ra", "ratings", ITEM_MEANS, "train")
LABELLED = "labelled AS (SELECT * FROM rm WHERE NOT is_test)"
ENCODINGS = {
    "user_mean_rating": ("user_id",), "user_genre_mean_rating": USER_GENRE["15"],
    "item_index_mean_rating": ITEM_INDEX["v4"], "user_index_mean_rating": USER_INDEX["v5"],
}
FEATURE_TABLE = [*ITEM_MEAN, LABELLED, *joined("ft", "rm", ENCODINGS, "labelled")]


def sql(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([RATINGS, TRAIN, *ctes])} {select}"


def add(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = sql(select, *ctes)


def rows(name: str, cols: str, source: str = "ratings", *ctes: str) -> None:
    add(name, f"SELECT {KEY}, {cols} FROM {source}", *ctes)


def md5(seed: int | str) -> str:
    return f"md5(concat('{seed}', '|', rating_id))"


def fold(k: int, seed: int | str) -> str:
    return f"CAST(CAST(concat('0x', substr({md5(seed)}, 1, 8)) AS BIGINT) % {k} AS INT)"


def split(source: str, fraction: float, seed: int) -> str:
    return (f"parts AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {md5(seed)}) <= "
            f"floor(count(*) OVER () * {fraction}) AS chosen FROM {source})")


# --- sources, sinks, profiles ---------------------------------------------------

add("load_ratings", f"SELECT {names(list(RATING_COLUMNS))} FROM ratings")
rows("csv_roundtrip", "user_id, item_id, rating, movie_title, release_date, item_imdb_length, item_imdb_mature_rating")


def stacked(cols: Sequence[str], source: str, cast: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({quote(c)} AS {cast}) AS value FROM {source}" for c in cols)


QUART = ", ".join(f"round(quantile_cont(value, {p}), 6) AS {n}"
                  for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)))
add("profile_numeric",
    f"SELECT \"column\", count(*) AS n, count(*) - count(value) AS nulls, round(min(value), 6) AS min, {QUART}, "
    f"round(avg(value), 6) AS mean, round(max(value), 6) AS max FROM ({stacked(NUMERIC, 'ra WHERE NOT is_test', 'DOUBLE')}) "
    "GROUP BY \"column\"", *ALL_MEANS)
add("profile_categorical",
    "SELECT \"column\", value, count(*) AS n FROM ("
    + stacked(CATEGORICAL + ("zip_code",), "train", "VARCHAR") + ") GROUP BY ALL")
SCHEMA = {"user_id": "string", "item_id": "bigint", "rating": "int", "age": "int", "release_date": "date",
          "movie_title": "string", "age_band": "string", "gender": "string", "occupation": "string",
          "item_imdb_mature_rating": "string", "item_imdb_length": "int", "item_imdb_rating_of_ten": "double",
          "war": "boolean"}
add("profile_schema", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS \"type\", count({c}) AS filled, "
    f"count(DISTINCT {c}) AS distinct_values FROM train" for c, t in SCHEMA.items()))
add("null_profile",
    "SELECT \"column\", count(*) - count(value) AS nulls, count(*) > count(value) AS any_null FROM ("
    + stacked(NUMERIC + CATEGORICAL + ("release_date",), "ra", "VARCHAR") + ") GROUP BY \"column\"", *ALL_MEANS)

# Fields of the side table, parsed without the rules of the library's parser.
SIDE_NUMBERS = ("votes", "score", "critic_score", "budget", "gross")
SIDE = ("raw AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in RAW.items()) + " FROM part)")
FIELD = "(SELECT '{c}' AS \"column\", nullif(nullif(nullif(trim({c}), ''), 'NA'), '-') AS f FROM raw)"
SIDE_LONG = "(SELECT \"column\", f, TRY_CAST(f AS DOUBLE) AS value FROM (" + " UNION ALL ".join(
    f"SELECT * FROM {FIELD.format(c=c)}" for c in SIDE_NUMBERS) + "))"
PARSED = "side AS (SELECT " + ", ".join(
    f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in SIDE_NUMBERS else c for c in RAW) + " FROM raw)"


def side(name: str, select: str) -> None:
    ORACLES[name] = f"WITH {SIDE}, {PARSED} {select}"


side("side_table", f"SELECT {', '.join(RAW)} FROM side")
side("side_fields", "SELECT \"column\", count(*) AS n, count(*) - count(f) AS gaps, count(f) - count(value) AS malformed "
     f"FROM {SIDE_LONG} GROUP BY \"column\"")
side("side_profile", "SELECT \"column\", count(*) AS n, count(*) - count(value) AS nulls, round(min(value), 6) AS min, "
     f"{QUART}, round(avg(value), 6) AS mean, round(max(value), 6) AS max FROM {SIDE_LONG} GROUP BY \"column\"")
side("side_histogram", "SELECT \"column\", round(floor(round(value / w, 9)) * w, 6) AS bin, count(*) AS n FROM "
     f"{SIDE_LONG} JOIN (VALUES ('votes', 250.0::DOUBLE), ('score', 0.5), ('critic_score', 10.0), ('budget', 5000.0), "
     "('gross', 5000.0)) widths(c, w) ON \"column\" = c WHERE value IS NOT NULL GROUP BY ALL")
side("side_correlation", " UNION ALL ".join(
    f"SELECT '{a}' AS var_x, '{b}' AS var_y, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
    f"round(corr({a}, {b}), 6) AS corr, round(CASE WHEN count({a}) = count(*) AND count({b}) = count(*) "
    f"THEN corr({a}, {b}) END, 6) AS corr_everything FROM side"
    for a in SIDE_NUMBERS for b in SIDE_NUMBERS if a < b))

# --- projection, predicates, scalar expressions ------------------------------------

rows("project_ratings", "user_id, item_id, rating")
rows("filter_predicates", "age, release_date, item_id",
     "ratings WHERE age > 70 OR release_date IS NULL OR item_id = 267")
rows("cast_ids", "user_id, CAST(user_id AS BIGINT) AS user_number, CAST(item_id AS VARCHAR) AS item_text, "
     "CAST(item_id AS DOUBLE) AS item_number, TRY_CAST(occupation AS INT) AS occupation_number")
rows("flags_to_numeric", ", ".join(f"CAST({quote(g)} AS INT) AS {quote(g)}" for g in GENRES))
rows("rating_hour", "hour")
rows("release_month", "release_month AS month, coalesce(CAST(release_month AS VARCHAR), '(Missing)') AS month_level")
add("day_part_counts",
    f"SELECT {steps('hour', DAY_PARTS)} AS view_cat, CAST({steps('hour', [(a, c) for a, _, c in DAY_PARTS])} AS INT) "
    "AS position, count(*) AS freq FROM train GROUP BY ALL")
rows("length_band", f"item_imdb_length, {LENGTH_BAND} AS band")
rows("length_band_unknown", "item_imdb_length, "
     + steps("item_imdb_length", LENGTH_BANDS, LENGTH_TAIL + " WHEN item_imdb_length IS NULL THEN 'Unknown'") + " AS band")
rows("quality_band", "top_1000_band, rating_band")
OCCU = ("CASE WHEN occupation = 'student' THEN 'Student' WHEN occupation IN ('other', 'none', 'homemaker', 'retired') "
        "THEN 'Other' ELSE 'Professional' END")
add("occupation_class", f"SELECT DISTINCT user_id, occupation, {OCCU} AS occu_class FROM train")
rows("coalesce_feature", "coalesce(user_genre_mean_rating, item_mean_rating) AS user_genre_mean_rating",
     "cf WHERE is_test", *ITEM_MEAN, *joined("cf", "rm", {"user_genre_mean_rating": USER_GENRE["19"]}, "train"))
rows("submission_key", "concat(user_id, '_', CAST(item_id AS VARCHAR)) AS user_item", "ratings WHERE is_test")


def clamp(col: str, null_to: str) -> str:
    return f"CASE WHEN {col} < 1 THEN 1.0 WHEN {col} > 5 THEN 5.0 WHEN {col} IS NULL THEN {null_to} ELSE {col} END"


rows("clamp_rating", f"CAST({clamp('item_imdb_rating_of_ten', '1.0')} AS DOUBLE) AS rating")
rows("clamp_rating_mean", "CAST("
     + clamp("item_imdb_rating_of_ten", "(SELECT round(avg(rating), 6) FROM train)") + " AS DOUBLE) AS rating")
rows("clamp_rating_keep", f"CAST({clamp('item_imdb_rating_of_ten', 'NULL')} AS DOUBLE) AS rating")
GENRE_STRING = ("nullif(concat_ws(' ', " + ", ".join(f"CASE WHEN {quote(g)} THEN '{g}' END" for g in GENRES) + "), '')")
add("genre_string", f"SELECT DISTINCT item_id, {GENRE_STRING} AS genre FROM ratings")
add("primary_genre", "SELECT DISTINCT item_id, CASE "
    + " ".join(f"WHEN {quote(g)} THEN '{g}'" for g in GENRES) + " END AS genre FROM ratings")
GAP = " OR ".join(f"{c} IS NULL" for c in [*RAW_NUMERIC, *CATEGORICAL, "release_date"])
add("complete_cases", f"SELECT count(*) FILTER (NOT ({GAP})) AS complete, count(*) FILTER ({GAP}) AS incomplete, "
    "count(*) AS total FROM train")

# --- reshape and set operations ----------------------------------------------------

FILMS = f"films AS (SELECT DISTINCT item_id, movie_title, {names(GENRES)} FROM train)"
GENRE_ROWS = " UNION ALL ".join(
    f"SELECT item_id, movie_title, '{g}' AS genre FROM films WHERE {quote(g)}" for g in GENRES)
add("unpivot_genres", GENRE_ROWS, FILMS)
CELLS = "cells AS MATERIALIZED (SELECT user_id, item_id, avg(rating) AS rating FROM train GROUP BY ALL)"
add("user_item_matrix", "SELECT user_id, item_id, round(rating, 6) AS rating FROM cells", CELLS)
add("pivot_top_items", "SELECT user_id, "
    + ", ".join(f"round(max(CASE WHEN pos = {i} THEN rating END), 6) AS item_{i}" for i in range(1, 11))
    + " FROM cells LEFT JOIN top USING (item_id) GROUP BY user_id",
    CELLS, "top AS (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS pos FROM train "
    "GROUP BY item_id QUALIFY pos <= 10)")
rows("one_hot", ", ".join(f"CAST({c} = '{lv}' AS INT) AS {level_name(c, lv)}"
                          for c, lvs in LEVELS.items() for lv in lvs))
add("distinct_movies", f"SELECT DISTINCT {names(MOVIE_COLUMNS)} FROM train")
rows("append_rows", "user_id, item_id, CASE WHEN NOT is_test THEN rating END AS rating")
add("split_exact", f"SELECT {KEY} FROM parts WHERE chosen", split("train", 0.8, 42))
add("split_complement", f"SELECT {KEY} FROM parts WHERE NOT chosen", split("train", 0.8, 42))
add("split_fraction", f"SELECT {KEY} FROM train WHERE substr({md5(1058)}, 1, 8) < 'c0000000'")

# --- joins ---------------------------------------------------------------------------

rows("join_user_mean", "user_mean_rating", "ju",
     *joined("ju", "ratings", {"user_mean_rating": ("user_id",)}, "train"))
rows("join_item_index", "item_index_mean_rating", "ji", *ITEM_MEAN, LABELLED,
     *joined("ji", "rm", {"item_index_mean_rating": ITEM_INDEX["v4"]}, "labelled"))
add("title_conflicts", "SELECT movie_title, count, item_id, release_date, item_imdb_length FROM films JOIN "
    "(SELECT movie_title, count(*) AS count FROM films GROUP BY movie_title HAVING count(*) > 1) USING (movie_title)",
    f"films AS (SELECT DISTINCT {names(MOVIE_COLUMNS)} FROM train)")
add("movie_stats_sql", f"SELECT g.item_id, g.movie_title, g.genre, t.rating FROM ({GENRE_ROWS}) g "
    "LEFT JOIN train t ON g.item_id = t.item_id", FILMS)
add("lookup_default", f"SELECT {KEY}, user_id, item_id, round(coalesce(c.rating, 1.0), 6) AS prediction "
    "FROM (SELECT * FROM ratings WHERE is_test) r LEFT JOIN cells c USING (user_id, item_id)", CELLS)
V6 = [k for k in ITEM_INDEX["v6"] if k != "item_imdb_mature_rating"]
add("join_fanout", f"SELECT {KEY}, r.item_imdb_mature_rating, e.item_imdb_mature_rating AS mature_rating_y, item_rating "
    f"FROM (SELECT * FROM ratings WHERE is_test) r LEFT JOIN e ON {same(V6)}",
    encoding("e", ITEM_INDEX["v6"], "train", "item_rating"))

# --- aggregations --------------------------------------------------------------------

LEVEL_COLUMNS = {"user": "user_id", "item": "item_id", "title": "movie_title", "zip": "zip_code",
                 "occupation": "occupation", "genre": GENRE_STRING}
add("counts_by_key", " UNION ALL ".join(
    f"SELECT '{k}' AS kind, CAST({e} AS VARCHAR) AS level, count(*) AS n FROM train GROUP BY ALL"
    for k, e in LEVEL_COLUMNS.items()))
add("distinct_counts", "SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, "
    "count(DISTINCT movie_title) AS titles, count(DISTINCT (user_id, item_id)) AS pairs FROM train")
USERS = (f"users AS (SELECT {names(USER_COLUMNS)}, count(*) AS count, round(avg(rating), 6) AS user_mean "
         "FROM train GROUP BY ALL)")
add("user_profile", "SELECT * FROM users", USERS)


def encoded(name: str, keys: Sequence[str], out: str) -> None:
    labelled = LABELLED
    if "user_mean_rating" in keys:
        labelled = ("labelled AS (SELECT *, round(avg(rating) OVER (PARTITION BY user_id), 6) AS user_mean_rating "
                    "FROM rm WHERE NOT is_test)")
    add(name, "SELECT * FROM e", *ITEM_MEAN, labelled, encoding("e", keys, "labelled", out))


encoded("enc_user_mean", ("user_id",), "user_mean_rating")
for _v, _keys in USER_GENRE.items():
    encoded(f"enc_user_genre_{_v}", _keys, "user_genre_mean_rating")
for _v, _keys in USER_INDEX.items():
    encoded(f"enc_user_index_{_v}", _keys, "user_index_mean_rating")
for _v, _keys in ITEM_INDEX.items():
    encoded(f"enc_item_index_{_v}", _keys, "item_index_mean_rating")

STATS = ("round(avg(rating), 6) AS avg_rating, count(*) AS votes, count(DISTINCT item_id) AS dist_movies, "
         "round(count(*) / count(DISTINCT item_id), 6) AS ratio")
add("genre_combo_stats", f"SELECT {names(GENRES)}, {STATS} FROM train GROUP BY {names(GENRES)}")
add("genre_stats", f"SELECT genre, {STATS} FROM ({GENRE_ROWS}) g LEFT JOIN "
    "(SELECT item_id, rating FROM train) t USING (item_id) GROUP BY genre", FILMS)
SIZES = ("SELECT 'users_per_zip' AS grouping, count(*) AS n FROM users GROUP BY zip_code UNION ALL "
         "SELECT 'users_per_occupation', count(*) FROM users GROUP BY occupation UNION ALL "
         "SELECT 'ratings_per_title', count(*) FROM train GROUP BY movie_title UNION ALL "
         "SELECT 'ratings_per_user', count FROM users")
add("group_size_summary", "SELECT grouping, count(*) AS groups, min(n) AS smallest, round(avg(n), 6) AS mean_size, "
    "max(n) AS largest, count(*) FILTER (n > 1) AS above_one, count(*) FILTER (n = 1) AS singletons, "
    + QUART.replace("quantile_cont(value", "quantile_cont(CAST(n AS DOUBLE)")
    + f" FROM ({SIZES}) GROUP BY grouping", USERS)
TOP = ("lists AS MATERIALIZED (SELECT kind, key, n, rank() OVER (PARTITION BY kind ORDER BY n DESC) <= "
       "CASE kind WHEN 'user' THEN 250 WHEN 'item' THEN 500 ELSE 100 END AS top FROM ("
       "SELECT 'user' AS kind, user_id AS key, count(*) AS n FROM train GROUP BY ALL UNION ALL "
       "SELECT 'item', CAST(item_id AS VARCHAR), count(*) FROM train GROUP BY ALL UNION ALL "
       f"SELECT 'genre', genre, count(*) FROM (SELECT DISTINCT item_id, {GENRE_STRING} AS genre FROM train) GROUP BY ALL))")
add("top_n_ties", "SELECT kind, key, n FROM lists WHERE top", TOP)
add("top_share", "SELECT kind, count(*) FILTER (top) AS keys, CAST(sum(n) FILTER (top) AS BIGINT) AS top_ratings, "
    "CAST(sum(n) AS BIGINT) AS all_ratings, round(sum(n) FILTER (top) / sum(n), 6) AS share FROM lists GROUP BY kind", TOP)
add("title_counts", "SELECT movie_title, count(*) AS count FROM train GROUP BY movie_title")
BASELINES = {"user_mean": ("user_id",), "item_mean": ("item_id",), "age_band_item_mean": ("age_band", "item_id")}
RMSE = "round(sqrt(avg(power(rating - prediction, 2))), 6) AS rmse"
add("rmse_baselines", f"SELECT model, count(*) AS n, {RMSE} FROM ("
    + " UNION ALL ".join(f"SELECT '{m}' AS model, rating, {m} AS prediction FROM rb WHERE is_test" for m in BASELINES)
    + " UNION ALL SELECT 'global_mean', rating, (SELECT round(avg(rating), 6) FROM train) FROM rb WHERE is_test) "
    "WHERE prediction IS NOT NULL GROUP BY model", *joined("rb", "ratings", BASELINES, "train"))

# --- descriptive statistics ------------------------------------------------------------

Z = ("z AS MATERIALIZED (SELECT user_id, item_id, rating, user_mean, user_sd, (rating - user_mean) / user_sd AS z FROM "
     "(SELECT *, avg(rating) OVER w AS user_mean, stddev_samp(rating) OVER w AS user_sd FROM cells "
     "WINDOW w AS (PARTITION BY user_id)) WHERE user_sd > 1e-9)")


def bins(col: str, width: float, source: str) -> str:
    return (f"SELECT '{col}' AS \"column\", round(floor(round(CAST({col} AS DOUBLE) / {width}, 9)) * {width}, 6) AS bin, "
            f"count(*) AS n FROM {source} WHERE {col} IS NOT NULL GROUP BY ALL")


add("rating_histogram", " UNION ALL ".join(bins(c, w, "train") for c, w in (
    ("rating", "CAST(1 AS DOUBLE)"), ("age", "CAST(5 AS DOUBLE)"), ("item_imdb_length", "CAST(25 AS DOUBLE)"),
    ("item_imdb_rating_of_ten", "CAST(0.5 AS DOUBLE)"))))
CENTERED = ("middled AS (SELECT *, rating - user_mean AS centered FROM "
            "(SELECT *, avg(rating) OVER (PARTITION BY user_id) AS user_mean FROM cells))")
add("rating_histogram_norm", bins("z", "CAST(0.25 AS DOUBLE)", "z") + " UNION ALL "
    + bins("centered", "CAST(1 AS DOUBLE)", "middled"), CELLS, Z, CENTERED)
add("center_ratings", "SELECT user_id, item_id, round(rating, 6) AS rating, round(user_mean, 6) AS user_mean, "
    "round(centered, 6) AS z FROM middled", CELLS, CENTERED)
add("box_stats", "SELECT age_band, occu_class, q1, median, q3, count(*) AS n, "
    "round(min(user_mean) FILTER (fits), 6) AS lower_whisker, round(max(user_mean) FILTER (fits), 6) AS upper_whisker, "
    "count(*) FILTER (NOT fits) AS outliers FROM (SELECT *, user_mean BETWEEN q1 - 1.5 * (q3 - q1) AND "
    "q3 + 1.5 * (q3 - q1) AS fits FROM classed JOIN quart USING (age_band, occu_class)) GROUP BY ALL",
    USERS, f"classed AS (SELECT *, {OCCU} AS occu_class FROM users)",
    "quart AS (SELECT age_band, occu_class, " + QUART.replace("value", "user_mean") + " FROM classed GROUP BY ALL)")
add("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS var_x, '{b}' AS var_y, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
    f"round(corr({a}, {b}), 6) AS corr, round(CASE WHEN count({a}) = count(*) AND count({b}) = count(*) "
    f"THEN corr({a}, {b}) END, 6) AS corr_everything FROM labelled"
    for a in NUMERIC for b in NUMERIC if a < b), *ALL_MEANS, "labelled AS (SELECT * FROM ra WHERE NOT is_test)")


def pair(name: str, x: str, y: str, source: str, group: str = "'all'") -> str:
    return (f"SELECT '{name}' AS pair, {group} AS gender, count(*) AS n, round(corr({x}, {y}), 6) AS corr, "
            f"round(regr_slope({y}, {x}), 6) AS slope FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY ALL")


add("pair_association", " UNION ALL ".join([
    pair("mean_vs_imdb", "item_mean_rating", "item_imdb_rating_of_ten",
         "(SELECT DISTINCT item_id, item_mean_rating, item_imdb_rating_of_ten FROM labelled)"),
    pair("mean_vs_length", "item_mean_rating", "item_imdb_length", "labelled"),
    pair("age_vs_user_mean", "age", "user_mean", "users", "gender")]), USERS, *ITEM_MEAN, LABELLED)

# --- missing data, folds -------------------------------------------------------------------

FILLED = [c for c in NUMERIC if c != "rating"]
AVGS = "avgs AS (SELECT " + ", ".join(f"avg({c}) AS {c}" for c in FILLED) + " FROM ra WHERE NOT is_test)"
FILL = ", ".join(f"round(coalesce(r.{c}, avgs.{c}), 6) AS {c}" for c in FILLED)
for _name, _part in (("impute_mean", "NOT is_test"), ("impute_mean_test", "is_test")):
    add(_name, f"SELECT {KEY}, {FILL} FROM ra r, avgs WHERE {_part}", *ALL_MEANS, AVGS)
add("drop_incomplete", f"SELECT {KEY} FROM ratings WHERE NOT ({GAP})")
GAPPED = ["item_imdb_length", "item_imdb_rating_of_ten", "item_imdb_top_1000_voters_average"]
rows("missing_indicators", ", ".join(
    f"round(coalesce({c}, (SELECT avg({c}) FROM train)), 6) AS {c}, CAST({c} IS NULL AS INT) AS {c}_missing"
    for c in GAPPED))
rows("kfold_assign", f"rating, CAST((row_number() OVER (PARTITION BY rating ORDER BY {md5(42)}) - 1) % 10 AS INT) AS fold",
     "train")
rows("repeated_kfold", ", ".join(f"{fold(10, f'42-{r}')} AS fold_{r}" for r in range(1, 6)), "train")


def others(keys: Sequence[str], out: str) -> str:
    inner = f"PARTITION BY {names(keys)}"
    n = f"(count(*) OVER ({inner}) - count(*) OVER ({inner}, fold))"
    s = f"(sum(rating) OVER ({inner}) - sum(rating) OVER ({inner}, fold))"
    return f"round(CASE WHEN {n} > 0 THEN CAST({s} AS DOUBLE) / {n} END, 6) AS {out}"


add("enc_oof", f"SELECT {KEY}, fold, {others(['user_id'], 'user_mean_rating')}, "
    f"{others(USER_INDEX['v5'], 'user_index_mean_rating')} FROM folded",
    f"folded AS (SELECT *, {fold(5, 42)} AS fold FROM train)")

# --- neighbours ---------------------------------------------------------------------------

add("normalize_ratings", "SELECT user_id, item_id, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in ("rating", "user_mean", "user_sd", "z")) + " FROM z", CELLS, Z)


def neighbours(entity: str, other: str, k: int) -> list[str]:
    unit = (f"unit AS MATERIALIZED (SELECT {entity}, {other}, z / sqrt(sum(z * z) OVER (PARTITION BY {entity})) AS w "
            f"FROM z QUALIFY sum(z * z) OVER (PARTITION BY {entity}) > 0)")
    near = (f"near AS MATERIALIZED (SELECT {entity}, neighbour, similarity, row_number() OVER (PARTITION BY {entity} "
            f"ORDER BY similarity DESC, neighbour) AS rank FROM (SELECT a.{entity}, b.{entity} AS neighbour, "
            f"round(sum(a.w * b.w), 9) AS similarity FROM unit a JOIN unit b ON a.{other} = b.{other} "
            f"AND a.{entity} <> b.{entity} GROUP BY ALL) WHERE similarity > 0 QUALIFY rank <= {k})")
    return [CELLS, Z, unit, near]


def neighbour_list(name: str, entity: str, other: str, k: int) -> None:
    add(name, f"SELECT {entity}, neighbour, round(similarity, 6) AS similarity, CAST(rank AS INT) AS rank FROM near",
        *neighbours(entity, other, k))


neighbour_list("ibcf_neighbours", "item_id", "user_id", 5)
neighbour_list("ubcf_neighbours", "user_id", "item_id", 25)
ITEM_SCORES = ("scores AS (SELECT p.user_id, p.item_id, round(any_value(user_mean) + any_value(user_sd) * "
               "(sum(similarity * z) / sum(similarity)), 6) AS prediction FROM pairs p JOIN near n ON n.item_id = p.item_id "
               "JOIN z ON z.user_id = p.user_id AND z.item_id = n.neighbour GROUP BY p.user_id, p.item_id)")
USER_SCORES = ("scores AS (SELECT p.user_id, p.item_id, round(any_value(u.user_mean) + any_value(u.user_sd) * "
               "(sum(similarity * z) / sum(similarity)), 6) AS prediction FROM pairs p JOIN near n ON n.user_id = p.user_id "
               "JOIN z ON z.user_id = n.neighbour AND z.item_id = p.item_id "
               "JOIN (SELECT DISTINCT user_id, user_mean, user_sd FROM z) u ON u.user_id = p.user_id "
               "GROUP BY p.user_id, p.item_id)")
PAIRS = "pairs AS (SELECT DISTINCT user_id, item_id FROM ratings WHERE is_test)"
PREDICTED = (f"SELECT {KEY}, user_id, item_id, coalesce(prediction, 1.0) AS prediction "
             "FROM (SELECT * FROM ratings WHERE is_test) LEFT JOIN scores USING (user_id, item_id)")
add("ibcf_predict", PREDICTED, *neighbours("item_id", "user_id", 5), PAIRS, ITEM_SCORES)
add("ubcf_predict", PREDICTED, *neighbours("user_id", "item_id", 25), PAIRS, USER_SCORES)
add("ubcf_predict_5", PREDICTED.replace("coalesce(prediction, 1.0)", "coalesce(prediction, 0.0)"),
    *neighbours("user_id", "item_id", 5), PAIRS, USER_SCORES)
add("head_predictions", PREDICTED + f" ORDER BY prediction DESC, {KEY} LIMIT 10",
    *neighbours("item_id", "user_id", 5), PAIRS, ITEM_SCORES)
add("top_n_recommend",
    "SELECT user_id, item_id, prediction, CAST(row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, item_id) AS INT) "
    "AS rank FROM (SELECT z.user_id, n.item_id, round(any_value(user_mean) + any_value(user_sd) * "
    "(sum(similarity * z) / sum(similarity)), 6) AS prediction FROM z JOIN near n ON n.neighbour = z.item_id "
    "GROUP BY z.user_id, n.item_id) s ANTI JOIN z USING (user_id, item_id) QUALIFY rank <= 25",
    *neighbours("item_id", "user_id", 5))

# --- least squares ------------------------------------------------------------------------


def least_squares(features: Sequence[str], source: str, out: str = "fit") -> list[str]:
    """CTEs that end in ``out``: intercept and slopes by elimination on the covariances.

    ``f<k>`` is 1 / remaining variance of feature k, or 0 where earlier features explain it.
    """
    p = len(features)
    col = [*features, "rating"]
    filled = " AND ".join(f"{f} IS NOT NULL" for f in features)
    cov = ", ".join(f"covar_pop({col[i]}, {col[j]}) AS c0_{i}_{j}" for i in range(p) for j in range(i, p + 1))
    ctes = [f"{out}_e0 AS MATERIALIZED (SELECT {', '.join(f'avg({c}) AS m_{i}' for i, c in enumerate(col))}, {cov} "
            f"FROM {source} WHERE {filled})"]
    last = f"{out}_e0"
    for k in range(p):
        ctes.append(f"{out}_g{k} AS MATERIALIZED (SELECT *, CASE WHEN c{k}_{k}_{k} > 1e-9 * c0_{k}_{k} "
                    f"THEN 1 / c{k}_{k}_{k} ELSE 0 END AS f{k} FROM {last})")
        new = "".join(f", c{k}_{i}_{j} - c{k}_{k}_{i} * c{k}_{k}_{j} * f{k} AS c{k + 1}_{i}_{j}"
                      for i in range(k + 1, p) for j in range(i, p + 1))
        ctes.append(f"{out}_e{k + 1} AS MATERIALIZED (SELECT *{new} FROM {out}_g{k})")
        last = f"{out}_e{k + 1}"
    for k in reversed(range(p)):
        known = "".join(f" - c{k}_{k}_{j} * b_{j}" for j in range(k + 1, p))
        ctes.append(f"{out}_s{k} AS MATERIALIZED (SELECT *, (c{k}_{k}_{p}{known}) * f{k} AS b_{k} FROM {last})")
        last = f"{out}_s{k}"
    slopes = "".join(f" - b_{i} * m_{i}" for i in range(p))
    return [*ctes, f"{out} AS MATERIALIZED (SELECT {', '.join(f'b_{i}' for i in range(p))}, m_{p}{slopes} AS b FROM {last})"]


def linear(features: Sequence[str]) -> str:
    return "b" + "".join(f" + b_{i} * {f}" for i, f in enumerate(features))


MODEL = [*FEATURE_TABLE, "known AS (SELECT * FROM ft WHERE NOT is_test)", split("known", 0.8, 42),
         "fitting AS (SELECT * FROM parts WHERE chosen)", *least_squares(FEATURES, "fitting")]
rows("feature_table", "user_id, item_id, rating, is_test, hour, release_month, item_length_band, " + names(FEATURES),
     "ft", *FEATURE_TABLE)
add("ols_model0", f"SELECT {KEY}, round({linear(FEATURES)}, 6) AS prediction FROM parts, fit WHERE NOT chosen", *MODEL)
add("submission", "SELECT round(CAST(" + clamp("prediction", "(SELECT avg(rating) FROM fitting)") + " AS DOUBLE), 6) AS rating, "
    f"concat(user_id, '_', item_id) AS user_item FROM (SELECT *, {linear(FEATURES)} AS prediction FROM ft, fit WHERE is_test)",
    *MODEL)
add("plain_leaderboard", " UNION ALL ".join(
    f"SELECT '{name}' AS model, count(*) AS n, {RMSE} FROM (SELECT rating, {value} AS prediction FROM parts, fit "
    "WHERE NOT chosen) WHERE prediction IS NOT NULL"
    for name, value in (("global_mean", "(SELECT avg(rating) FROM fitting)"), ("least_squares", linear(FEATURES)))), *MODEL)
TWO = {"user_rating": USER_INDEX["v1"], "item_rating": ITEM_INDEX["v6"]}
add("ols_two_feature", f"SELECT {KEY}, round({linear(list(TWO))}, 6) AS prediction FROM parts, fit WHERE NOT chosen",
    *joined("tf", "train", TWO, "train"), split("tf", 0.75, 1058), "fitting AS (SELECT * FROM parts WHERE chosen)",
    *least_squares(list(TWO), "fitting"))

# --- the least-squares ladder: 0/1 columns for text, the first level being the base -------------


def ladder() -> str:
    dummies = {c: [level_name(c, lv) for lv in LEVELS[c][1:]] for c in CATEGORICAL}
    cols = ", ".join(f"CAST({c} = '{lv}' AS DOUBLE) AS {level_name(c, lv)}"
                     for c in ("gender", "occupation", "item_imdb_mature_rating") for lv in LEVELS[c][1:])
    ctes = [*ALL_MEANS, "known AS (SELECT * FROM ra WHERE NOT is_test)", split("known", 0.75, 1058),
            f"wide AS MATERIALIZED (SELECT *, {cols} FROM parts)",
            "fitting AS (SELECT * FROM wide WHERE chosen)"]
    out = []
    for step, formula in LADDER.items():
        terms = formula.split("~")[1].replace(" ", "").split("+")
        features = [f for t in terms for f in dummies.get(t, [t])]
        ctes += least_squares(features, "fitting", f"step{step}")
        out.append(f"SELECT CAST({step} AS INT) AS step, '{formula}' AS formula, count(*) AS n, {RMSE} FROM "
                   f"(SELECT rating, {linear(features)} AS prediction FROM wide, step{step} WHERE NOT chosen) "
                   "WHERE prediction IS NOT NULL")
    return sql(" UNION ALL ".join(out), *ctes)


ORACLES["ols_ladder"] = ladder()
