import math

import pytest
from pyspark.sql import functions as F

from meterflow.functions.columns import (
    calendar_parts, clamp, event_time, measure_from_text, power_factor, rectify,
    timestamp_from_text,
)


def values(spark, kind, rows, expression):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    got = frame.select("i", expression(F.col("x")).alias("y")).orderBy("i")
    return [r.y for r in got.collect()]


def test_clamp_keeps_bounds_null_and_nan(spark):
    got = values(spark, "double", [0.0, 0.08, 5.0, 10.7, 11.0, None, math.nan],
                 lambda x: clamp(x, 0.08, 10.7))
    assert got[:6] == [0.08, 0.08, 5.0, 10.7, 10.7, None] and math.isnan(got[6])


def test_rectify(spark):
    assert values(spark, "double", [-1.0, 0.0, 2.0, None], rectify) == [0.0, 0.0, 2.0, None]


def test_power_factor_without_power_is_null(spark):
    frame = spark.createDataFrame(
        [(1, 3.0, 4.0), (2, 0.0, 0.0), (3, None, 1.0), (4, 2.0, 0.0)], "i int, p double, q double")
    got = frame.select("i", power_factor(F.col("p"), F.col("q")).alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == [0.6, None, None, 1.0]


def test_measure_from_text(spark):
    text = ["1.5", "1.5 ", "1e3", "-2", "?", "", None, "nan", "NaN", "1.5d", "2f", "1,5", "\t7 ", "inf", "-Infinity"]
    got = values(spark, "string", text, measure_from_text)
    assert got == [1.5, 1.5, 1000.0, -2.0] + [None] * 8 + [7.0, math.inf, -math.inf]


def test_timestamp_from_text_is_day_first(spark):
    frame = spark.createDataFrame(
        [(1, "16/12/2006", "17:24:00"), (2, "1/2/2007", "0:05:09"), (3, "31/02/2007", "00:00:00"),
         (4, None, "00:00:00"), (5, "2007-02-01", "00:00:00")], "i int, d string, t string")
    stamp = timestamp_from_text(F.col("d"), F.col("t"), "d/M/yyyy H:mm:ss")
    got = frame.select("i", stamp.cast("string").alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == ["2006-12-16 17:24:00", "2007-02-01 00:05:09", None, None, None]


def test_strict_timestamp_ends_the_job(spark):
    frame = spark.createDataFrame([("x", "y")], "d string, t string")
    strict = timestamp_from_text(F.col("d"), F.col("t"), "d/M/yyyy H:mm:ss", strict=True)
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        frame.select(strict).collect()


@pytest.mark.parametrize("zone", ["UTC", "Europe/Bucharest"])
def test_event_time_keeps_milliseconds_and_the_repeated_hour(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, "long", [1700000059999, 1729992600000, None],
                     lambda ms: F.unix_millis(event_time(ms)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1700000059999, 1729992600000, None]


def test_calendar_parts_are_zero_padded(spark):
    frame = spark.sql("select timestamp_ntz'2024-01-02 03:04:05' as t")
    assert tuple(frame.select(*calendar_parts("t")).first()) == ("2024", "01", "02", "03", "04")
