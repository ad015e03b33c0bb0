"""Registered model queries: complete keys, sound values, the same model on any placement."""

import compare
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marquee.operators import encode, factor, missing, profile, regress, resample
from marquee.plans import oracle
from marquee.plans.catalog import QUERIES
from marquee.plans.features import FEATURES, folded, two_attribute_parts
from marquee.session import deal
from marquee.sources.ratings import ROW_KEY

TREES = ("rf_predict", "gbt_predict", "gbt_predict_4", "gbt_cv", "gbt_early_stop")


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.database(sf_dir)


def holdout(con, fraction, seed):
    cte = oracle.split("train", fraction, seed)
    return {r[0]: r[1] for r in con.execute(oracle.sql("SELECT rating_id, rating FROM parts WHERE NOT chosen", cte)).fetchall()}


def base_error(truth):
    return np.std(list(truth.values()))


@pytest.mark.parametrize("name", TREES)
def test_trees_score_every_row_of_the_hold_out(spark, con, sf_dir, name):
    truth = holdout(con, 0.8, 42)
    got = {r.rating_id: r.prediction for r in QUERIES[name](spark, sf_dir).collect()}
    assert got.keys() == truth.keys()
    assert all(0 < p < 6 for p in got.values())  # boosting adds steps and may leave the scale a little
    error = np.sqrt(np.mean([(got[k] - truth[k]) ** 2 for k in truth]))
    assert error < base_error(truth)


def test_factor_queries(spark, con, sf_dir):
    truth = holdout(con, 0.75, 1058)
    scored = QUERIES["factor_scores"](spark, sf_dir).toPandas()
    assert set(scored.rating_id) == set(truth) and len(scored) == len(truth)
    assert not scored.isna().any().any()
    forest = QUERIES["rf_factor_predict"](spark, sf_dir).toPandas()
    assert set(forest.rating_id) == set(truth) and forest.prediction.between(1, 5).all()


def test_importance_sums_to_one(spark, sf_dir):
    rows = QUERIES["feature_importance"](spark, sf_dir).toPandas()
    assert rows.groupby("model").importance.sum().tolist() == pytest.approx([1, 1], abs=1e-4)
    assert set(rows.feature) == {*FEATURES, *[f"{f}_missing" for f in FEATURES]}


@pytest.mark.parametrize("name", ("als_predict", "als_tuned"))
def test_factorisation_queries(spark, con, sf_dir, name):
    keys = {r[0] for r in con.execute(oracle.sql("SELECT rating_id FROM ratings WHERE is_test")).fetchall()}
    known = {r[0] for r in con.execute(oracle.sql(
        "SELECT rating_id FROM ratings WHERE is_test AND user_id IN (SELECT user_id FROM train) "
        "AND item_id IN (SELECT item_id FROM train)")).fetchall()}
    got = {r.rating_id: r.prediction for r in QUERIES[name](spark, sf_dir).collect()}
    assert got.keys() == keys
    assert {k for k, p in got.items() if p is not None} == known
    assert all(1 <= got[k] <= 5 for k in known)


def test_rank_two_reconstruction(spark, con, sf_dir):
    row = QUERIES["als_rank2_rmse"](spark, sf_dir).first()
    pairs = con.execute(oracle.sql("SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM train)")).fetchone()[0]
    assert row.n == pairs and 0 < row.rmse < 1.5


def test_leaderboard_agrees_with_the_plain_one(spark, sf_dir):
    full = {r.model: (r.n, r.rmse) for r in QUERIES["model_leaderboard"](spark, sf_dir).collect()}
    plain = {r.model: (r.n, r.rmse) for r in QUERIES["plain_leaderboard"](spark, sf_dir).collect()}
    assert plain.items() <= full.items() and set(full) - set(plain) == {"random_forest", "boosting"}
    assert full["random_forest"][1] < full["global_mean"][1] and full["boosting"][1] < full["global_mean"][1]


def test_boosted_submission_covers_the_test_rows(spark, con, sf_dir):
    want = [r[0] for r in con.execute(oracle.sql("SELECT concat(user_id, '_', item_id) FROM ratings WHERE is_test")).fetchall()]
    got = QUERIES["submission_boosted"](spark, sf_dir).collect()
    assert sorted(r.user_item for r in got) == sorted(want)
    assert all(1 <= r.rating <= 5 for r in got)
    assert sum(r.rating == 1.0 for r in got) < 0.05 * len(got)


def test_penalised_line_matches_numpy(spark, sf_dir):
    """The same folds, grid and refit in closed form: the penalty acts on standardised columns."""
    names = ["item_mean_rating", "user_rating", "item_rating"]
    labelled, new = two_attribute_parts(spark, sf_dir)
    table = missing.drop_incomplete(labelled, names)
    fit, rest = resample.split_exact(table, 0.75, 1058, ROW_KEY)
    rows, rest = folded(fit, 10).toPandas(), rest.toPandas()

    def solve(part, reg):
        x, y = part[names].to_numpy(float), part.rating.to_numpy(float)
        xc, yc = x - x.mean(0), y - y.mean()
        cov = xc.T @ xc / len(x)
        beta = np.linalg.solve(cov + reg / y.std() * np.diag(np.diag(cov)), xc.T @ yc / len(x))
        return beta, y.mean() - x.mean(0) @ beta

    def errors(reg):
        for k in range(10):
            beta, at = solve(rows[rows.fold != k], reg)
            part = rows[rows.fold == k]
            yield np.sqrt(np.mean((part.rating - part[names].to_numpy(float) @ beta - at) ** 2))

    best = min((0.0, 0.01, 0.1), key=lambda reg: np.mean(list(errors(reg))))
    beta, at = solve(rows, best)
    want = dict(zip(rest.rating_id, rest[names].to_numpy(float) @ beta + at))
    got = {r.rating_id: r.prediction for r in QUERIES["linear_cv"](spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-5

    # New rows: those with all three means are scored by the same line and clamped, the others left out.
    new = new.dropna(subset=names).toPandas()
    scores = np.clip(new[names].to_numpy(float) @ beta + at, 1, 5)
    want = sorted(zip(new.user_id + "_" + new.item_id.astype(str), scores))
    got = sorted((r.user_item, r.rating) for r in QUERIES["submission_linear"](spark, sf_dir).collect())
    assert want and [k for k, _ in got] == [k for k, _ in want]
    assert max(abs(a - b) for (_, a), (_, b) in zip(got, want)) < 1e-5


def test_same_model_on_any_placement(spark):
    df = spark.range(3000).select(
        "id", F.hash("id").cast("double").alias("a"), (F.col("id") % 17).cast("double").alias("b"),
        (F.col("id") % 17 / 4 + F.pmod(F.hash("id"), F.lit(3))).alias("rating"))
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    told = []
    for parts in (3, 17):
        placed = deal(rows.repartition(parts).sortWithinPartitions(F.hash(F.col("id") * parts)), ["id"])
        forest = regress.fit_trees(regress.random_forest(trees=5, depth=4), placed).transform(rows)
        boost = regress.fit_trees(regress.boosting(rounds=3, rate=0.3), placed).transform(rows)
        told.append([[round(r.prediction, 9) for r in m.orderBy("id").collect()] for m in (forest, boost)])
    assert told[0] == told[1]


def test_tuned_folds_follow_the_cells(spark):
    cells = spark.range(600).select(
        (F.col("id") % 30).cast("int").alias("user"), (F.col("id") / 30).cast("int").alias("item"),
        (F.pmod(F.hash("id"), F.lit(5)) + 1).cast("float").alias("rating"))
    errors = [factor.tune_als(factor.als(rounds=2), deal(cells.repartition(p), ("user", "item")), 3, {"rank": [2, 3]}).avgMetrics
              for p in (2, 9)]
    assert errors[0] == pytest.approx(errors[1], abs=1e-4)


def test_derived_key_needs_no_row_join(spark):
    df = spark.createDataFrame(
        [("u", 1, 5, "a"), ("u", 2, 3, "a"), ("v", 1, 4, "b"), (None, 3, 1, None), ("v", 3, None, None)],
        "user_id string, item_id long, rating int, k string")
    means = encode.mean_encode(df, ["item_id"], "item_mean_rating")
    joined = encode.add_encodings(df, df, {"item_mean_rating": ["item_id"]})
    keys = ["item_mean_rating", "k"]
    want = sorted(map(repr, encode.mean_encode(joined, keys, "e").collect()))
    assert sorted(map(repr, encode.mean_encode(df, keys, "e", means={"item_mean_rating": means}).collect())) == want


def test_correlations_in_batches(spark, monkeypatch):
    df = spark.range(50).select(*[(F.pmod(F.hash("id", F.lit(i)), F.lit(9))).alias(f"c{i}") for i in range(6)])
    whole = {(r.var_x, r.var_y): r.corr for r in profile.correlations(df, df.columns).collect()}
    monkeypatch.setattr(profile, "PAIRS", 4)
    assert {(r.var_x, r.var_y): r.corr for r in profile.correlations(df, df.columns).collect()} == whole
    ref = df.toPandas().corr()
    assert all(c == pytest.approx(ref.loc[a, b], abs=1e-6) for (a, b), c in whole.items())
    assert profile.correlations(df.limit(0), df.columns).count() == 0


def test_entry_registers_the_model_queries():
    assert {*TREES, "submission_boosted", "plain_leaderboard", "ubcf_predict_5"} <= set(entry.queries())
