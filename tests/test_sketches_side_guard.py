"""Sketch profiles against exact ones, the side table's contract, the fan-out guard."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marquee.operators import joins, profile, sketches
from marquee.sources import side


def test_numeric_sketches_of_parts_are_near_the_exact_profile(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 40).alias("day"), (F.col("id") * 7919 % 40_000).cast("double").alias("x"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 100).alias("y"), F.lit(None).cast("int").alias("z"))
    parts = sketches.numeric_parts(df, F.col("day"), ["x", "y", "z"])
    assert parts.count() == 120 and parts.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    got = {r.column: r.asDict() for r in sketches.numeric_profile_of(parts).collect()}
    want = {r.column: r.asDict() for r in profile.numeric_profile(df, ["x", "y", "z"]).collect()}
    for c, row in want.items():
        for name, value in row.items():
            if name in ("q1", "median", "q3") and value is not None:
                span = row["max"] - row["min"]
                assert abs(got[c][name] - value) <= 0.015 * span + 1
            else:
                assert got[c][name] == value
    few = sketches.numeric_profile_of(parts.where("part < 10")).collect()
    assert {r.n for r in few} == {10_000}
    assert sketches.numeric_profile_of(sketches.numeric_parts(df.limit(0), F.col("day"), ["x"])).count() == 0


def test_nan_is_a_gap(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (None, 3.0), (None, None)], "day int, x double")
    row = sketches.numeric_profile_of(sketches.numeric_parts(df, F.col("day"), ["x"])).first()
    assert (row.n, row.nulls, row.min, row["mean"], row.max) == (4, 2, 1.0, 2.0, 3.0)


def test_distinct_sketches_merge_over_days(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 30).alias("day"), (F.col("id") % 9_000).cast("string").alias("a"), (F.col("id") % 7).alias("b"))
    parts = sketches.distinct_parts(df, F.col("day"), {"a": ["a"], "ab": ["a", "b"]})
    row = sketches.distinct_counts_of(parts, ["a", "ab"]).first()
    exact = df.agg(F.count_distinct("a"), F.count_distinct("a", "b")).first()
    assert parts.count() == 30 and abs(row.a / exact[0] - 1) < 0.03 and abs(row.ab / exact[1] - 1) < 0.03
    alike = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "c"), ("a", None)], "a string, b string")
    assert sketches.distinct_counts_of(sketches.distinct_parts(alike, F.lit(1), {"ab": ["a", "b"]}), ["ab"]).first().ab == 2
    assert sketches.distinct_counts_of(parts.limit(0), ["a"]).first().a == 0


def test_side_fields(spark):
    fields = [" 12.5 ", "-3", "NA", "", " - ", None, "1,5", "NaN", "1e5", "12 votes", "."]
    raw = spark.createDataFrame([(x, x, x, x, x) for x in fields], ", ".join(f"{c} string" for c in side.NUMBERS))
    for name in ("item_id", "title", "kind", "note"):
        raw = raw.withColumn(name, F.lit("x"))
    assert [r.votes for r in side.parse(raw).collect()] == [12.5, -3.0] + [None] * 9
    report = side.field_report(raw).collect()
    assert {(r.n, r.gaps, r.malformed) for r in report} == {(11, 4, 5)} and {r.column for r in report} == set(side.NUMBERS)
    assert {(r.n, r.gaps, r.malformed) for r in side.field_report(raw.limit(0)).collect()} == {(0, 0, 0)}


def test_guard_of_a_join_that_multiplies(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (None, 13), (None, 14), (9, 0)], "k int, w int")
    row = joins.expected_rows(left, right, ["k"]).first()
    joined = joins.guarded_left_join(left, right, ["k"], 2.25)
    assert (row.left_rows, row.joined_rows) == (4, 9) and joined.count() == 9
    assert sorted(joined.collect(), key=str) == sorted(joins.null_safe_left_join(left, right, ["k"]).collect(), key=str)
    with pytest.raises((PySparkException, Py4JJavaError), match="gives 9 rows for 4, more than 2 times"):
        joins.guarded_left_join(left, right, ["k"], 2).collect()
    assert joins.guarded_left_join(left.limit(0), right, ["k"], 1).count() == 0
