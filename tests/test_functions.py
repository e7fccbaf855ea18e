import datetime as dt

from pyspark.sql import functions as F

from wattlane import defaults as D
from wattlane.functions import (
    category_rank, clip, coerce_numeric, normalise_category, seconds_since_midnight, sentinel_to_null, slot_ceil,
    slot_floor, to_timestamp_dayfirst,
)


def one(spark, values, fn, dtype="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["o"] for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_dayfirst_and_iso_dates(spark):
    out = one(spark, ["01/02/2018 00:15", "1/2/2018 0:15", "2018-02-13 00:30:00", "bad", "", None], to_timestamp_dayfirst)
    feb1 = dt.datetime(2018, 2, 1, 0, 15)
    assert out == [feb1, feb1, dt.datetime(2018, 2, 13, 0, 30), None, None, None]


def test_numbers(spark):
    out = one(spark, [" 12 ", "1e3", "1,5", "1.0d", "inf", "NaN", "n/a", "<NA>", "True", "1.", ".5"], coerce_numeric)
    assert out == [12.0, 1000.0, None, None, float("inf"), None, None, None, None, 1.0, 0.5]


def test_nsm_rounds_half_to_even_and_does_not_wrap(spark):
    times = [dt.datetime(2018, 1, 1, *t) for t in ((0, 7, 30), (0, 22, 30), (23, 52, 29), (23, 52, 31))]
    assert one(spark, times, seconds_since_midnight, "timestamp_ntz") == [0, 1800, 85500, 86400]


def test_slots_keep_nulls_and_microseconds(spark):
    t = [dt.datetime(2018, 1, 1, 0, 15), dt.datetime(2018, 1, 1, 23, 59, 59, 999999), None]
    assert one(spark, t, slot_floor, "timestamp_ntz") == [t[0], dt.datetime(2018, 1, 1, 23, 45), None]
    assert one(spark, t, slot_ceil, "timestamp_ntz") == [t[0], dt.datetime(2018, 1, 2), None]
    assert one(spark, t[:2], lambda c: slot_floor(c, 7 * 3600 // 7), "timestamp_ntz")[1] == dt.datetime(2018, 1, 1, 23)


def test_load_type_variants(spark):
    out = one(spark, ["light load", "MEDIUM-LOAD", " Max ", "weird", None], normalise_category)
    assert out == ["Light_Load", "Medium_Load", "Maximum_Load", None, None]


def test_category_rank_and_sentinels(spark):
    assert one(spark, ["Maximum_Load", "x", None], lambda c: category_rank(c, D.LOAD_TYPES)) == [3, None, None]
    assert one(spark, ["bad", "Bad", "ok", None], sentinel_to_null) == [None, "Bad", "ok", None]


def test_clip_keeps_null(spark):
    assert one(spark, [5.0, None, -9.0, 1.0], lambda c: clip(c, F.lit(0.0), F.lit(2.0)), "double") == [2.0, None, 0.0, 1.0]
