"""Joins, encodings, splits, folds, quantiles, reshaping and missing values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import encode, joins, missing, profile, resample, reshape, summaries
from marquee.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def numbers(spark):
    """5,000 rows; one group holds a third of them, one value repeats a lot."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(5000):
        group = "hot" if i % 3 == 0 else f"g{rng.integers(12)}"
        value = 1.5 if rng.random() < 0.3 else float(np.round(rng.lognormal(1, 2), 4))
        rows.append((i, group, value, int(rng.integers(1, 6))))
    return spark.createDataFrame(rows, "id long, g string, v double, rating int").repartition(8)


def test_null_keys_match_and_form_a_group(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (None, "a", 2), (None, "a", 4), (1, None, 3), (None, None, 5)], "k1 int, k2 string, y int")
    enc = encode.mean_encode(df, ["k1", "k2"], "m", "y")
    assert enc.count() == 4
    out = joins.null_safe_left_join(df, enc, ["k1", "k2"])
    assert sorted((r.y, r.m) for r in out.collect()) == [(1, 1.0), (2, 3.0), (3, 3.0), (4, 3.0), (5, 5.0)]


def test_encoding_join_keeps_rows_and_leaves_unseen_null(spark):
    train = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, rating int")
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "k string")
    out = encode.add_encodings(new, train, {"m": ["k"]})
    assert sorted((r.k, r.m) for r in out.collect() if r.m) == [("a", 1.5), ("a", 1.5), ("b", 5.0)]
    assert out.filter("m IS NULL").count() == 1


def test_small_encoding_does_not_shuffle_the_rows(spark, numbers):
    out = encode.add_encodings(numbers, numbers, {"m": ["g"]})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_out_of_fold_ignores_the_own_fold(spark):
    df = spark.createDataFrame(
        [("a", 0, 1), ("a", 0, 3), ("a", 1, 5), ("b", 0, 2), (None, 0, 4), (None, 1, 1)],
        "k string, fold int, rating int")
    got = {(r.k, r.fold, r.rating): r.e for r in encode.out_of_fold_encode(df, ["k"], "e").collect()}
    assert got == {("a", 0, 1): 5.0, ("a", 0, 3): 5.0, ("a", 1, 5): 2.0, ("b", 0, 2): None,
                   (None, 0, 4): 1.0, (None, 1, 1): 4.0}


def test_fanout(spark):
    left = spark.createDataFrame([("x",), ("y",)], "k1 string")
    right = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1)], "k1 string, k2 int")
    assert joins.null_safe_left_join(left, right, ["k1"]).count() == 3
    assert joins.fanout_factor(right, ["k1"]).first()[0] == 2
    assert joins.fanout_factor(right, ["k1", "k2"]).first()[0] == 1


def test_lookup_default(spark):
    table = spark.createDataFrame([("u", 1, 4.0)], "user string, item int, p double")
    pairs = spark.createDataFrame([("u", 1), ("u", 2)], "user string, item int")
    out = joins.lookup_with_default(pairs, table, ["user", "item"], "p", 0.0)
    assert sorted(r.p for r in out.collect()) == [0.0, 4.0]


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.75, 0.8, 1.0])
@pytest.mark.parametrize("ranked", [0, 10_000])
def test_split_is_exact_disjoint_and_stable(numbers, fraction, ranked, monkeypatch):
    monkeypatch.setattr(resample, "RANKED", ranked)
    a, b = resample.split_exact(numbers, fraction, 42, ["id"])
    left, right = {r.id for r in a.collect()}, {r.id for r in b.collect()}
    assert len(left) == int(5000 * fraction) and not left & right and len(left | right) == 5000
    again = {r.id for r in resample.split_exact(numbers.repartition(1), fraction, 42, ["id"])[0].collect()}
    assert again == left


def test_split_of_nothing(spark, numbers):
    a, b = resample.split_exact(numbers.filter("id < 0"), 0.8, 42, ["id"])
    assert a.count() == b.count() == 0


def test_split_fraction_is_close(numbers):
    a, b = resample.split_fraction(numbers, 0.8, 42, ["id"])
    assert abs(a.count() - 4000) < 150 and a.count() + b.count() == 5000


@pytest.mark.parametrize("digits", [1, 4])
def test_balanced_folds(numbers, digits):
    out = resample.balanced_folds(numbers, 10, 42, ["id"], "rating", digits)
    sizes = {}
    for r in out.groupBy("rating", "fold").count().collect():
        sizes.setdefault(r.rating, []).append(r["count"])
    assert out.count() == 5000
    assert all(len(s) == 10 and max(s) - min(s) <= 1 for s in sizes.values())


def test_repeated_folds_differ(numbers):
    out = resample.repeated_folds(numbers, 10, 3, 42, ["id"])
    same = out.filter("fold_1 = fold_2").count()
    assert 350 < same < 650 and out.agg(F.max("fold_3")).first()[0] == 9


@pytest.mark.parametrize("slices", [2, 64])
def test_quantiles_match_numpy(numbers, slices):
    probs = {"q0": 0.0, "q1": 0.25, "m": 0.5, "q9": 0.9, "q100": 1.0}
    got = {r.g: r for r in exact_quantiles(numbers, ["g"], "v", probs, slices).collect()}
    data = {}
    for r in numbers.collect():
        data.setdefault(r.g, []).append(r.v)
    assert set(got) == set(data)
    for g, v in data.items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(v, p), abs=1e-6)
    whole = exact_quantiles(numbers, [], "v", {"m": 0.5}, slices).first()
    assert whole.m == pytest.approx(np.median([x for v in data.values() for x in v]), abs=1e-6)


def test_top_n_keeps_ties(spark):
    counts = spark.createDataFrame([("a", 9), ("b", 5), ("c", 5), ("d", 5), ("e", 1)], "id string, n long")
    assert {r.id for r in summaries.top_n_with_ties(counts, 2).collect()} == {"a", "b", "c", "d"}
    assert summaries.top_n_with_ties(counts, 50).count() == 5
    share = summaries.top_share(counts, 2).first()
    assert (share["keys"], share.top_ratings, share.all_ratings, share.share) == (4, 24, 25, 0.96)


def test_flag_stats(spark):
    df = spark.createDataFrame(
        [(1, True, True, 4), (1, True, True, 2), (2, True, False, 5), (3, False, False, 1)],
        "item_id long, a boolean, b boolean, rating int")
    got = {r.genre: (r.avg_rating, r.votes, r.dist_movies, r.ratio) for r in summaries.flag_stats(df, ["a", "b"]).collect()}
    assert got == {"a": (3.666667, 3, 2, 1.5), "b": (3.0, 2, 1, 2.0)}
    assert summaries.combination_stats(df, ["a", "b"]).count() == 3


def test_imputation_and_indicators(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 21)], "id int, x int")
    means = missing.fit_means(df, ["x"])
    out = missing.fill_means(missing.add_indicators(df, ["x"]), means).orderBy("id").collect()
    assert [(r.x, r.x_missing) for r in out] == [(10.0, 0), (15.5, 1), (21.0, 0)]
    assert missing.drop_incomplete(df, ["x"]).count() == 2


def test_reshape(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, None, 3), (2, "y", 1)], "id int, c string, rating int")
    levels = reshape.fit_levels(df, ["c"])
    assert levels == {"c": ["x", "y"]}
    assert sorted(tuple(r) for r in reshape.one_hot(df, levels, ["id"]).collect() if r.c_x is not None) == [
        (1, 1, 0), (2, 0, 1)]
    with pytest.raises(ValueError):
        reshape.fit_levels(df, ["c"], limit=1)
    both = reshape.append_rows(df, df.drop("rating"))
    assert both.count() == 6 and both.filter("rating IS NULL").count() == 3


def test_number_levels(spark, numbers):
    out = reshape.number_levels(numbers, "g", buckets=4)
    ids = [r.g_index for r in out.collect()]
    assert sorted(ids) == list(range(numbers.select("g").distinct().count()))


def test_profiles(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, "b"), (3, 6.0, None)], "x int, y double, c string")
    num = {r.column: r for r in profile.numeric_profile(df, ["x", "y"]).collect()}
    assert (num["y"].n, num["y"].nulls, num["y"]["median"], num["y"]["mean"]) == (3, 1, 4.0, 4.0)
    assert {(r.column, r.value, r.n) for r in profile.categorical_profile(df, ["c"]).collect()} == {
        ("c", "a", 1), ("c", "b", 1), ("c", None, 1)}
    cor = profile.correlations(df, ["x", "y"]).first()
    assert cor["n"] == 2 and cor["corr"] == 1.0 and cor["corr_everything"] is None
    approx = profile.schema_profile(df, ["x", "c"], approximate=True)
    assert {(r.column, r.type, r.filled, r.distinct_values) for r in approx.collect()} == {
        ("x", "int", 3, 3), ("c", "string", 2, 2)}


def test_same_result_under_other_partitioning(spark, numbers):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    one = sorted(map(tuple, encode.mean_encode(numbers.coalesce(1), ["g"], "m").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert one == sorted(map(tuple, encode.mean_encode(numbers, ["g"], "m").collect()))
