"""Inputs that the fixture does not contain."""

import math
import time

import pytest
from pyspark.sql import functions as F

from marquee.functions.columns import clamp_rating
from marquee.operators import profile, quantiles, resample, reshape, summaries
from marquee.plans import features
from marquee.session import materialise, new_path, work_dir
from marquee.sources.files import read_csv, write_csv


@pytest.mark.parametrize(("fraction", "least", "most"), [(0.0, 0, 0), (0.5, 900, 1100), (1.0, 2000, 2000)])
def test_split_fraction_ends(spark, fraction, least, most):
    df = spark.range(2000)
    a, b = resample.split_fraction(df, fraction, 7, ["id"])
    assert least <= a.count() <= most and a.count() + b.count() == 2000


def test_null_group_stays(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("a", 4.0)], "g string, v double")
    got = {r.g: r.m for r in quantiles.exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {None: 2.0, "a": 3.0}
    assert {r.g: r.n for r in profile.box_stats(df, ["g"], "v").collect()} == {None: 2, "a": 2}
    sizes = df.select("g", F.col("v").alias("n"))
    assert {r.g: r.groups for r in summaries.size_summary(sizes, ["g"]).collect()} == {None: 2, "a": 2}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(math.nan, 4), (None, 4), (7.0, 4), (3.0, 4)], "prediction double, rating int")
    got = [r[0] for r in df.select(clamp_rating(F.col("prediction"))).collect()]
    assert got == [1.0, 1.0, 5.0, 3.0]
    row = summaries.rmse(df.where("prediction IS NULL OR isnan(prediction) OR prediction = 3")).first()
    assert (row.n, row.rmse) == (1, 1.0)


def test_many_levels(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("level "), F.col("id")).alias("c"))
    with pytest.raises(ValueError, match="one_hot_rows"):
        reshape.fit_levels(df, ["c"])
    rows = reshape.one_hot_rows(df, ["c"], ["id"])
    assert rows.count() == rows.select("level").distinct().count() == 5000


def test_pivot_keeps_all_users(spark):
    df = spark.createDataFrame([(1, 10, 5), (2, 10, 4), (3, 11, 2)], "user_id long, item_id long, rating int")
    got = {r.user_id: r.item_1 for r in reshape.pivot_ranked_items(reshape.user_item_cells(df), df, 1).collect()}
    assert got == {1: 5.0, 2: 4.0, 3: None}


def test_csv_keeps_texts(spark):
    texts = ["plain", " blank before and after ", "line\nbreak", 'a "quote"', "comma, and\\slash", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    path = new_path(spark, "csv")
    write_csv(df, path)
    assert dict(tuple(r) for r in read_csv(spark, path, df.schema).collect()) == dict(enumerate(texts))


def test_preset_checkpoint_folder_is_used(spark):
    # A setting names the folder; without one, what the application has set serves.
    work_dir(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert work_dir(spark) == folder.rstrip("/")


def test_storing_a_table_gives_up_its_shuffle_files(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffles()
    spark.sparkContext._marquee_forgot = float("-inf")
    kept = materialise(spark.range(1000).repartition(3, "id"), "gone")
    until = time.monotonic() + 10
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffles() - before and kept.count() == 1000


def test_joins_by_user_and_by_item_have_narrow_rows_and_one_is_stored(spark, monkeypatch):
    """Before, genre flags went through the joins by user and item, and both joins' shuffles were on disk at once."""
    values = {
        "rating_id": "string(id)", "user_id": "if(id % 11 = 0, NULL, string(id % 7))", "item_id": "id % 13", "rating": "int(id * id % 5) + 1",
        "is_test": "id % 5 = 0", "age": "int(id % 7) * 9", "age_band": "if(id % 7 < 3, 'a', 'b')", "gender": "if(id % 2 = 0, 'M', NULL)",
        "occupation": "string(id % 3)", "hour": "int(id % 4)", "item_imdb_length": "if(id % 13 = 4, NULL, int(id % 13 % 3))",
        "item_imdb_mature_rating": "string(id % 13 % 2)", "release_month": "int(id % 12)", "item_length_band": "string(id % 13 % 3)",
    }
    rows = materialise(spark.range(300).selectExpr(*[
        f"{values.get(c, 'id % 13 % 2 = 1')} AS {c}" for c in features.FEATURE_INPUT]), "rows")
    want = {tuple(r) for r in features.feature_table(rows).collect()}
    stored = {}
    monkeypatch.setattr(features, "LARGE", 0)
    monkeypatch.setattr(features, "materialise", lambda df, label, f=features.materialise: stored.setdefault(label, f(df, label)))
    assert {tuple(r) for r in features.feature_table(rows).collect()} == want and want
    kept = stored["users-joined"].columns
    assert "user_mean_rating" in kept and "action" not in kept and len(kept) == len(set(kept))
