"""The ratings table: one row per (user, item) rating with all attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The 19 genre flags in column order.
GENRES = (
    "unknown", "action", "adventure", "animation", "childrens", "comedy", "crime",
    "documentary", "drama", "fantasy", "film_noir", "horror", "musical", "mystery",
    "romance", "sci_fi", "thriller", "war", "western",
)
# Flags left out of the narrower genre profiles.
GENRES_15 = tuple(
    g for g in GENRES if g not in ("unknown", "documentary", "fantasy", "western")
)
GENRES_16 = GENRES_15 + ("western",)

ROW_KEY = ("rating_id",)
NUMERIC = (
    "rating", "age", "item_imdb_length", "item_imdb_rating_of_ten",
    "item_imdb_top_1000_voters_average", "item_mean_rating",
    "user_age_band_item_mean_rating", "user_gender_item_mean_rating",
)
CATEGORICAL = ("age_band", "gender", "occupation", "item_imdb_mature_rating")
USER_COLUMNS = ("user_id", "age", "age_band", "gender", "zip_code", "occupation")
MOVIE_COLUMNS = ("item_id", "movie_title", "release_date") + GENRES + (
    "item_imdb_length", "item_imdb_mature_rating", "item_imdb_rating_of_ten",
    "item_imdb_top_1000_voters_average",
)

_AGE = "7 + (o_custkey * 13) % 67"
_GENRE_RULE = {
    "unknown": "l_partkey % 97 = 0",
    **{g: f"p_name LIKE '{w} %'" for g, w in (
        ("action", "small"), ("adventure", "red"), ("animation", "blue"),
        ("childrens", "large"), ("comedy", "new"), ("crime", "cold"),
        ("documentary", "hot"), ("drama", "old"))},
    **{g: f"p_name LIKE '% {w}'" for g, w in (
        ("fantasy", "ring"), ("film_noir", "bolt"), ("horror", "gear"),
        ("musical", "gizmo"), ("mystery", "plate"), ("romance", "rod"),
        ("sci_fi", "widget"), ("thriller", "anvil"))},
    "war": "p_type = 'PROMO'",
    "western": "p_type = 'ECONOMY'",
}
# Column name -> SQL expression over lineitem, orders, customer and part. The
# expressions are valid in Spark SQL and DuckDB alike (see FIXTURES.md).
RATING_COLUMNS = {
    # Order and line number repeat in the given tables; with item and price they do not.
    "rating_id": (
        "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', "
        "CAST(l_partkey AS STRING), '-', CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING))"
    ),
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "user_id": "CAST(o_custkey AS STRING)",
    "item_id": "l_partkey",
    "rating": "CAST(floor((l_quantity - 1) / 10) AS INT) + 1",
    "age": f"CAST({_AGE} AS INT)",
    "age_band": (
        f"CASE WHEN {_AGE} < 18 THEN 'Under 18' WHEN {_AGE} < 30 THEN '18-29' "
        f"WHEN {_AGE} < 45 THEN '30-44' WHEN {_AGE} < 60 THEN '45-59' ELSE '60+' END"
    ),
    "gender": "CASE WHEN o_custkey % 10 < 7 THEN 'M' ELSE 'F' END",
    "occupation": (
        "CASE c_nationkey WHEN 0 THEN 'student' WHEN 1 THEN 'other' WHEN 2 THEN 'none' "
        "WHEN 3 THEN 'homemaker' WHEN 4 THEN 'retired' ELSE lower(c_mktsegment) END"
    ),
    "zip_code": "CAST(c_nationkey * 100 + o_custkey % 40 AS STRING)",
    "timestamp": "o_orderdate + INTERVAL '1' HOUR * (l_orderkey % 24)",
    "movie_title": (
        "CASE WHEN l_partkey % 10 = 0 THEN p_name "
        "ELSE concat(p_name, ' ', CAST(l_partkey AS STRING)) END"
    ),
    "release_date": (
        "CASE WHEN l_partkey % 97 <> 0 "
        "THEN date_add(DATE '1990-01-01', CAST(l_partkey % 3000 AS INT)) END"
    ),
    "item_imdb_length": "CAST(CASE WHEN l_partkey % 23 <> 0 THEN p_size * 5 END AS INT)",
    "item_imdb_mature_rating": (
        "CASE WHEN l_partkey % 29 <> 0 THEN CASE l_partkey % 4 WHEN 0 THEN 'G' "
        "WHEN 1 THEN 'PG' WHEN 2 THEN 'PG-13' ELSE 'R' END END"
    ),
    "item_imdb_rating_of_ten": (
        "CASE WHEN l_partkey % 31 <> 0 THEN CAST((l_partkey * 7) % 101 AS DOUBLE) / 10 END"
    ),
    "item_imdb_top_1000_voters_average": (
        "CASE WHEN l_partkey % 31 <> 0 THEN CAST((l_partkey * 11) % 101 AS DOUBLE) / 10 END"
    ),
    **{
        g: rule if g == "unknown" else f"l_partkey % 101 <> 0 AND {rule}"
        for g, rule in _GENRE_RULE.items()
    },
    "is_test": "l_orderkey % 5 = 0",
}
# Derived rating means: column -> grouping keys, fitted on train rows only.
ITEM_MEANS = {
    "item_mean_rating": ("item_id",),
    "user_age_band_item_mean_rating": ("age_band", "item_id"),
    "user_gender_item_mean_rating": ("gender", "item_id"),
}


_USER = ("user_id", "age", "age_band", "gender", "occupation", "zip_code")
_EVENT = ("rating_id", "l_orderkey", "l_linenumber", "rating", "timestamp", "is_test")
_ITEM = tuple(c for c in RATING_COLUMNS if c not in _USER + _EVENT)


def load_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings with user and item attributes, test rows flagged by ``is_test``.

    User and item columns are derived on the small tables, before the joins.
    """
    def table(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def derived(names):
        return [F.expr(RATING_COLUMNS[c]).alias(c) for c in names]

    users = table("customer").withColumnRenamed("c_custkey", "o_custkey").select(
        F.col("o_custkey").alias("__user"), *derived(_USER))
    items = table("part").withColumnRenamed("p_partkey", "l_partkey").select(
        F.col("l_partkey").alias("__item"), *derived(_ITEM))
    events = (
        table("lineitem")
        .join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("__user"), F.col("l_partkey").alias("__item"), *derived(_EVENT))
    )
    return events.join(users, "__user").join(items, "__item").select(*RATING_COLUMNS)


def train_rows(ratings: DataFrame) -> DataFrame:
    return ratings.filter(~F.col("is_test"))


def test_rows(ratings: DataFrame) -> DataFrame:
    return ratings.filter("is_test")
