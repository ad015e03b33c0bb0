"""Every query that has an SQL counterpart must give the same rows."""

import compare
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.database(sf_dir)


def test_every_counterpart_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, sf_dir, name):
    assert compare.compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == ""


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["rating", "user_item"]
    assert out.filter("rating IS NULL OR rating < 1 OR rating > 5").count() == 0


def test_hour_and_length_survive_every_fit_policy(spark, sf_dir):
    from marquee.plans.features import FEATURE_INPUT, feature_table, stored_ratings

    rows = stored_ratings(spark, sf_dir, FEATURE_INPUT)
    for policy in ("all", "train", "out_of_fold"):
        assert feature_table(rows, policy).count() == rows.count()
    with pytest.raises(ValueError):
        feature_table(rows, "never")


def test_submission_file(spark, sf_dir):
    from marquee.plans.submission import submission
    from marquee.session import new_path
    from marquee.sources.files import read_csv

    path = new_path(spark, "submission")
    out = submission(spark, sf_dir, path)
    back = read_csv(spark, path, out.schema)
    assert back.exceptAll(out).count() == 0 and back.count() == out.count()
