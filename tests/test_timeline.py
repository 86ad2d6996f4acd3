import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterflow.operators import gaps, minutes, panes, sketches
from meterflow.operators.asof import asof_join
from meterflow.operators.sessions import sessions
from meterflow.schema import SPEED_VIEW

DAY = datetime(2024, 1, 1)


def at(seconds):
    return DAY + timedelta(seconds=seconds)


# -- as-of join


def newest_before(left, right, strict):
    """By trying every pair."""
    found = {}
    for number, key, time in left:
        fits = [(t, v) for k, t, v in right if k is not None and t is not None and k == key
                and time is not None and (t < time if strict else t <= time)]
        found[number] = max(fits)[1] if fits else None
    return found


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("unit", ["day", "hour"])
def test_asof_against_every_pair(spark, strict, unit):
    draw = random.Random(7)
    times = [at(draw.choice([0, 3600, 86_399, 86_400, 200_000, draw.randrange(900_000)]))
             for _ in range(400)] + [None] * 5
    keys = [1, 1, 1, 2, 3, None]
    left = [(i, draw.choice(keys), draw.choice(times)) for i in range(400)]
    right = [(draw.choice(keys + [4]), draw.choice(times), draw.randrange(1000)) for _ in range(150)]
    right += right[:5]
    a = spark.createDataFrame(left, "number int, key int, time timestamp").repartition(3)
    b = spark.createDataFrame(right, "key int, made timestamp, value int").repartition(3)
    found = asof_join(a, b, ["key"], "time", "made", {"v": "value", "made": "made"}, unit, strict)
    assert found.columns == ["number", "key", "time", "v", "made"]
    assert {r.number: r.v for r in found.collect()} == newest_before(left, right, strict)


def test_asof_with_empty_sides(spark):
    a = spark.createDataFrame([(1, at(5))], "key int, time timestamp")
    none = a.limit(0)
    take = {"seen": "time"}
    assert asof_join(a, none, ["key"], "time", "time", take).first().seen is None
    assert asof_join(none, a, ["key"], "time", "time", take).count() == 0


def hot_rows(spark, n=60_000):
    """A third of all rows on one sensor, over sixty days."""
    return spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 997) + 2).cast("int")
        .alias("sensor_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 86).alias("timestamp"),
        F.col("id").cast("double").alias("global_active_power"))


def rows_per_task(spark, frame, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = frame().groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return [r["count"] for r in parts]


def test_asof_spreads_a_hot_key_and_makes_no_pairs(spark, plan):
    rows = hot_rows(spark)
    made = rows.filter("sensor_id < 200")

    def joined():
        return asof_join(rows, made, ["sensor_id"], "timestamp", "timestamp",
                         {"load": "global_active_power"})

    sizes = rows_per_task(spark, joined, 8)
    assert sum(sizes) == 60_000 and max(sizes) < 2 * sum(sizes) / 8
    text = plan(joined())
    assert "Cartesian" not in text and "NestedLoop" not in text


# -- sessions


def runs(rows, gap):
    found, last = {}, {}
    for key, seconds, load in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        if key in last and seconds - last[key] <= gap:
            found[key][-1].append((seconds, load))
        else:
            found.setdefault(key, []).append([(seconds, load)])
        last[key] = seconds
    return sorted(
        (str(key), at(run[0][0]), at(run[-1][0]), len(run), round(sum(v for _, v in run), 6))
        for key, each in found.items() for run in each)


def readings_of(spark, rows):
    return spark.createDataFrame(
        [(k, at(s) if s is not None else None, float(v)) for k, s, v in rows],
        "sensor_id int, timestamp timestamp, global_active_power double").repartition(3)


@pytest.mark.parametrize("gap", [1800, 86_400])
def test_sessions_against_row_by_row(spark, gap):
    draw = random.Random(gap)
    rows = []
    for key in (1, 2, None):
        seconds = draw.randrange(1000)
        while seconds < 5 * 86_400:
            rows.append((key, seconds, draw.randrange(10)))
            seconds += draw.choice([0, 60, 1799, 1800, 1801, 3000, 90_000])
    # One session over several borders of days.
    rows += [(9, s, 1) for s in range(80_000, 300_000, 1500)] + [(9, 86_400, 1)]
    found = sessions(readings_of(spark, rows + [(1, None, 5)]), gap).collect()
    assert sorted((str(r.sensor_id), r.start_time, r.last_time, r.readings, round(r.total_load, 6))
                  for r in found) == runs(rows, gap)


def test_sessions_agree_with_spark_windows(spark):
    rows = hot_rows(spark, 5000)
    window = F.session_window("timestamp", "1800 seconds")
    wanted = rows.groupBy("sensor_id", window).agg(F.count("*").alias("n")).groupBy("n").count()
    found = sessions(rows, 1800).groupBy(F.col("readings").alias("n")).count()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_a_gap_longer_than_a_chunk_is_an_error(spark):
    with pytest.raises(ValueError, match="longer than a chunk"):
        sessions(hot_rows(spark, 10), 86_401)
    assert sessions(hot_rows(spark, 0), 60).count() == 0


def test_sessions_spread_a_hot_sensor(spark, plan):
    sizes = rows_per_task(spark, lambda: sessions(hot_rows(spark), 60), 8)
    assert sum(sizes) == 60_000  # no two readings are that near
    assert plan(sessions(hot_rows(spark), 60)).count("Exchange") == 1  # border parts only


# -- gaps


def test_gaps_against_row_by_row(spark):
    draw, rows, wanted = random.Random(5), [], []
    for key in (1, 2, None):
        minute, before = 0, None
        while minute < 3 * 1440:
            value = None if draw.random() < 0.1 else float(draw.randrange(100))
            rows.append((key, at(minute * 60), value))
            if before and before[1] is not None and value is not None:
                span = minute - before[0]
                if span <= 60:
                    wanted += [(str(key), at((before[0] + k) * 60),
                                round(before[1] + (value - before[1]) * k / span, 6), True)
                               for k in range(1, span)]
            wanted.append((str(key), at(minute * 60), value, False))
            before = minute, value
            minute += draw.choice([1, 1, 2, 5, 60, 61, 700])
    frame = spark.createDataFrame(
        rows + [(1, None, 1.0)], "sensor_id int, start_time timestamp, load double").repartition(3)
    found = gaps.fill_gaps(frame, "load", "start_time", 3600).collect()
    assert sorted(((str(r.sensor_id), r.start_time, r.load and round(r.load, 6), r.filled)
                   for r in found), key=repr) == sorted(wanted, key=repr)
    assert gaps.fill_gaps(frame.limit(0), "load", "start_time", 3600).count() == 0
    with pytest.raises(ValueError, match="longer than a chunk"):
        gaps.fill_gaps(frame, "load", "start_time", 86_460)


def test_gaps_of_a_hot_sensor_are_spread(spark):
    view = hot_rows(spark).select(
        "sensor_id", F.col("timestamp").alias("start_time"), "global_active_power")
    sizes = rows_per_task(
        spark, lambda: gaps.fill_gaps(view, "global_active_power", "start_time", 60), 8)
    assert sum(sizes) == 60_000 and max(sizes) < 2 * sum(sizes) / 8


# -- sliding windows


def test_sliding_against_windows_over_readings(spark, make_readings, plan):
    draw = random.Random(3)
    rows = [(draw.choice([1, 2, None]), float(draw.choice([0, 86_000, 172_000]) + draw.randrange(3000)),
             float(draw.randrange(50))) for _ in range(300)]
    readings = make_readings(rows)
    partials = minutes.minute_partials(readings)
    found = panes.sliding(partials, SPEED_VIEW, minutes.parts_of(SPEED_VIEW), 15 * 60)
    # Windows of fifteen minutes over the readings, those that end with a minute that has some.
    every = F.window("timestamp", "15 minutes", "1 minute")
    view = [c for c in found.columns if c not in ("sensor_id", "start_time")]
    whole = readings.groupBy("sensor_id", every).agg(
        *[minutes.FIRST[fn](m).alias(name) for name, fn, m in SPEED_VIEW])
    last = (F.col("window.end") - F.expr("INTERVAL 1 MINUTE")).alias("start_time")
    whole = whole.select("sensor_id", last, *view)
    ends = partials.select("sensor_id", "start_time")
    on = F.col("w.sensor_id").eqNullSafe(F.col("e.sensor_id")) & (
        F.col("w.start_time") == F.col("e.start_time"))
    wanted = whole.alias("w").join(ends.alias("e"), on, "left_semi")

    def plain(frame):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                       for r in frame.collect()), key=repr)

    assert plain(found) == plain(wanted.select(*found.columns))
    assert "Expand" not in plan(found)


def test_a_window_longer_than_a_chunk_is_an_error(spark, make_readings):
    partials = minutes.minute_partials(make_readings([(1, 5.0, 1.0)]))
    with pytest.raises(ValueError, match="longer than a chunk"):
        panes.sliding(partials, SPEED_VIEW, minutes.parts_of(SPEED_VIEW), 90_000)


# -- summaries that merge


def test_quantiles_of_merged_sketches(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 2).alias("sensor_id"), (F.col("id") % 30).alias("day"),
        F.when(F.col("id") % 100 != 99, F.pow(F.col("id") % 9973, 2.0)).alias("load"))
    shares = {"median": 0.5, "top": 0.99}
    days = sketches.quantile_sketches(rows, "load", ["sensor_id", "day"])
    month = sketches.merge_sketches(days, ["sensor_id"])
    found = sketches.quantiles(month, shares)
    errors = sketches.rank_errors(rows, "load", found, ["sensor_id"], shares).collect()
    assert {r.sensor_id: r.n for r in errors} == {0: 20_000, 1: 19_600}
    assert all(r.median_error < 0.01 and r.top_error < 0.01 for r in errors)
    # An error is seen: the maximum as the median is off by almost half of all ranks.
    wrong = found.withColumn("median", F.lit(1e12))
    worst = sketches.rank_errors(rows, "load", wrong, ["sensor_id"], shares).first()
    assert worst.median_error == pytest.approx(0.5)


def test_few_values_are_exact(spark):
    rows = spark.range(1, 102).selectExpr("1 as sensor_id", "cast(id as double) as load")
    found = sketches.quantiles(
        sketches.quantile_sketches(rows, "load", ["sensor_id"]), {"median": 0.5})
    assert found.first().median in (50.0, 51.0)


def test_distinct_counts_from_bitmaps(spark):
    rows = spark.range(200_000).select(
        (F.col("id") * 7919 % 90_001).alias("sensor_id"), (F.col("id") % 14).alias("day"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1), (-5, 1), (0, 1)], rows.schema))
    days = sketches.id_bitmaps(rows, "sensor_id", ["day"])
    weeks = sketches.merge_bitmaps(days.withColumn("week", F.col("day") % 2), ["week"])
    plain = rows.filter("sensor_id >= 0")
    for bitmaps, key, wanted in (
            (days, "day", plain.groupBy("day")),
            (weeks, "week", plain.groupBy((F.col("day") % 2).alias("week")))):
        found = sketches.distinct_counts(bitmaps, [key]).collect()
        exact = wanted.agg(F.countDistinct("sensor_id").alias("n")).collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, exact))
