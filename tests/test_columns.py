import datetime as dt

from pyspark.sql import functions as F

from marquee.functions import columns as C


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_length_band_edges(spark):
    df = spark.createDataFrame([(x,) for x in (49, 50, 99, 100, 150, 199, 200, 201, None)], "n int")
    plain = ["Less than 50", "50 to 100", "50 to 100", "100 to 150", "150 to 200", "150 to 200", None,
             "More than 200", None]
    assert values(df, C.length_band(F.col("n"))) == plain
    assert values(df, C.length_band(F.col("n"), unknown=True)) == plain[:-1] + ["Unknown"]


def test_quality_band_edges(spark):
    df = spark.createDataFrame([(x,) for x in (2.9, 3.0, 5.0, 7.0, 9.9, 10.0, None)], "s double")
    assert values(df, C.quality_band(F.col("s"))) == [
        "Poor", "Avergae", "Good", "Excellent", "Excellent", None, "Unknown"]


def test_day_parts(spark):
    rows = [(dt.datetime(2000, 1, 1, h),) for h in (0, 5, 6, 10, 11, 15, 16, 19, 20, 23)] + [(None,)]
    hour = C.rating_hour(F.col("ts"))
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    assert values(df, C.day_part_order(hour)) == [5, 5, 1, 1, 2, 2, 3, 3, 4, 4, None]
    assert values(df, C.day_part(hour))[2] == "Morning (6AM - 11AM)"


def test_clamp_policies(spark):
    df = spark.createDataFrame([(x,) for x in (0.4, 1.0, 3.2, 5.0, 5.7, None)], "p double")
    p = F.col("p")
    assert values(df, C.clamp_rating(p)) == [1.0, 1.0, 3.2, 5.0, 5.0, 1.0]
    assert values(df, C.clamp_rating(p, 3.5))[-1] == 3.5
    assert values(df, C.clamp_rating(p, None))[-1] is None
    assert values(df, C.clamp_rating(p, F.lit(2.5)))[-1] == 2.5


def test_genres(spark):
    df = spark.createDataFrame([(True, False, True, 1), (False, False, False, 1), (False, True, False, 2)],
                               "a boolean, b boolean, c boolean, n int")
    flags = ["a", "b", "c"]
    assert values(df, C.genre_string(flags)) == ["a c", None, "b"]
    assert values(df, C.genre_string(flags, F.col("n"))) == ["a c genre_count", "genre_count", "b"]
    assert values(df, C.primary_genre(flags)) == ["a", None, "b"]
    assert [c for c in df.select(*C.flags_as_int(flags)).first()] == [1, 0, 1]


def test_small_helpers(spark):
    df = spark.createDataFrame([("7", 12, None), ("8", 3, 4)], "u string, i long, x int")
    assert values(df, C.submission_key(F.col("u"), F.col("i"))) == ["7_12", "8_3"]
    assert values(df, C.explicit_missing(F.col("x"))) == ["(Missing)", "4"]
    assert values(df, C.any_null(["u", "x"])) == [True, False]
    jobs = spark.createDataFrame([("student",), ("none",), ("doctor",)], "o string")
    assert values(jobs, C.occupation_class(F.col("o"))) == ["Student", "Other", "Professional"]
