"""Literal edge cases for the column functions (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import arrays, dates, numeric, strings
from tessera.functions.porter import with_stem


def _col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_year_from_text(spark):
    assert _col(spark, ["01-Jan-1995", "", "unknown", None], strings.year_from_text) == [1995, 1900, 1900, 1900]


def test_title_strip(spark):
    got = _col(spark, ["Seven (Se7en) (1995)", "A (b c) (1999)", "No Year", "É (é) x"], strings.title_without_parenthesis)
    assert got == ["Seven", "A (b c)", "No Year", "É"]


def test_clean_numeric(spark):
    got = _col(spark, ['"0.5"', '"?"', "-1", '"3"', "abc"], numeric.clean_numeric)
    assert got == [0.5, 0.0, 0.0, 3.0, None]
    assert _col(spark, ['"0.5"', "abc", None], numeric.rejected) == [0, 1, 0]


def test_safe_half(spark):
    assert _col(spark, ["85711", "T8H1N", "05201"], numeric.safe_half) == [42855.5, None, 2600.5]


def test_time_of_day_bands(spark):
    hours = [0, 6, 7, 11, 12, 14, 18, 22, 23]
    got = _col(spark, hours, dates.time_of_day, "int")
    assert got == ["night", "night", "morning", "morning", "lunch", "afternoon", "evening", "evening", "night"]


def test_time_of_day_literal(spark):
    assert _col(spark, [7, 8, 23], dates.time_of_day_literal, "int") == ["night", "morning", "morning"]


def test_weekday_and_weekend(spark):
    days = [dt.date(2011, 1, 1), dt.date(2011, 1, 3)]
    assert _col(spark, days, dates.iso_weekday, "date") == [6, 1]
    assert _col(spark, days, dates.weekend_flag, "date") == [1.0, 0.0]


def test_hour_of_epoch_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert _col(spark, [0, 3600 * 25 + 5], dates.hour_of_epoch, "long") == [0, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_split_keeps_empty_fields(spark):
    assert _col(spark, ["A  B"], lambda c: strings.split_literal(c, " ")) == [["A", "", "B"]]
    assert _col(spark, ["a|b|"], lambda c: strings.split_literal(c, "|")) == [["a", "b", ""]]


def test_tokens_unicode(spark):
    assert _col(spark, ["Véronique a l'été_2"], strings.tokens) == [["véronique", "été_2"]]


def test_parent_folder(spark):
    got = _col(spark, ["/data/comp.graphics/1001", "nofolder"], strings.parent_folder)
    assert got == ["comp.graphics", None]


def test_array_helpers(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0, 0.0, 5.0], ["a", "b", "a", "c"])], "a array<double>, b array<double>, w array<string>")
    r = df.select(
        arrays.array_mean("a").alias("m"),
        arrays.squared_distance("a", "b").alias("d"),
        arrays.flags_to_names([("x", F.lit(True)), ("y", F.lit(False)), ("z", F.lit(True))], ",").alias("names"),
    ).first()
    assert r.m == 2.0 and r.d == 8.0 and r.names == "x,z"


def test_squared_log_error(spark):
    got = _col(spark, [0.0], lambda c: numeric.squared_log_error(c, F.lit(0.0)), "double")
    assert got == [0.0]


def test_porter_published_examples(spark):
    pairs = {
        "caresses": "caress", "ponies": "poni", "cats": "cat", "agreed": "agre", "plastered": "plaster",
        "motoring": "motor", "sing": "sing", "hopping": "hop", "filing": "file", "happy": "happi",
        "relational": "relat", "rational": "ration", "generalizations": "gener", "oscillators": "oscil",
        "electrical": "electr", "adjustment": "adjust", "adoption": "adopt", "controll": "control",
        "roll": "roll", "cease": "ceas", "goodness": "good",
    }
    pairs |= {"at": "at", "été": "été", "ies": "i", "yes": "ye", "say": "sai", "flies": "fli", "falling": "fall", "fizzed": "fizz"}
    pairs |= {"conflated": "conflat", "troubled": "troubl", "sized": "size", "feed": "feed", "bled": "bled", "abc1": "abc1"}
    df = spark.createDataFrame([(w,) for w in pairs] + [(None,)], "w0 string")
    got = {r.w0: r.stem for r in with_stem(df, "w0").collect()}
    assert got.pop(None) is None and got == pairs
