"""Registered queries over a sensor's whole history: as-of join, sessions, filled gaps, sliding
windows, mergeable summaries, and ranges that are refused."""

from functools import reduce

from pyspark.sql import functions as F

from meterflow.operators import forecast, gaps, minutes, panes, sketches
from meterflow.operators.asof import asof_join
from meterflow.operators.ranges import range_of, time_range
from meterflow.operators.sessions import sessions
from meterflow.plans.derived import naive, rounded
from meterflow.schema import SPEED_VIEW
from meterflow.session import written
from meterflow.sources import events as source

AVERAGES = [name for name, fn, _ in SPEED_VIEW if fn == "avg"]
SESSION_GAP = 30 * 60
LONGEST_GAP = 60 * 60
SLIDING = 15 * 60
SHARES = {"median": 0.5, "high": 0.9, "top": 0.99}
# Start, end and length in minutes of report ranges as users give them; some are refused.
RANGES = [
    ("2024-01-02 00:00:00", "2024-01-30 00:00:00", None),
    ("2024-01-05 12:00:00", None, 1440),
    ("2024-01-30 00:00:00", "2024-01-02 00:00:00", None),
    ("2024-01-05 12:00:00", "2024-01-05 12:00:00", None),
    ("2024-01-05 12:00:00", None, 0),
    ("last Tuesday", None, 5),
    ("2024-02-30 00:00:00", "2024-03-01 00:00:00", None),
    ("2024-01-05 12:00:00", "2024-01-06T12:00:00+00:00", None),
]


def hourly_predictions(spark, sf_dir):
    """A prediction per sensor and hour with readings, made at the end of the hour."""
    view = minutes.speed_minutes(source.readings(spark, sf_dir))
    return forecast.windowed_trend(view, "start_time", "avg_global_active_power", "1 hour")


def asof_forecast(spark, sf_dir):
    """Each reading with the newest stored prediction made for its sensor before it."""
    rows = source.readings(spark, sf_dir).select(
        "event_id", "sensor_id", "timestamp", "global_active_power")
    take = {"prediction_time": "prediction_time", "prediction1": "prediction1"}
    stored = written(hourly_predictions(spark, sf_dir), "predictions")
    found = asof_join(rows, stored, ["sensor_id"], "timestamp", "prediction_time", take)
    return rounded(naive(found, "prediction_time"), ["prediction1"], 9)


def usage_sessions(spark, sf_dir):
    found = sessions(source.readings(spark, sf_dir), SESSION_GAP)
    return rounded(found, ["total_load"], 9)


def filled_minutes(spark, sf_dir):
    """The load of every minute, those between two minutes up to an hour apart filled in."""
    view = minutes.speed_minutes(source.readings(spark, sf_dir))
    found = gaps.fill_gaps(view, "avg_global_active_power", "start_time", LONGEST_GAP)
    return rounded(naive(found, "start_time"), ["avg_global_active_power"], 9)


def sliding_load(spark, sf_dir):
    """The speed view of the fifteen minutes up to each minute with readings."""
    partials = minutes.minute_partials(source.readings(spark, sf_dir))
    found = panes.sliding(partials, SPEED_VIEW, minutes.parts_of(SPEED_VIEW), SLIDING)
    return rounded(naive(found, "start_time"), AVERAGES, 9)


def load_quantiles(spark, sf_dir):
    """A row per sensor: how many loads it has, and whether the quantiles of its month, merged from
    the sketches of its days, are off by at most one percent of ranks."""
    rows = source.readings(spark, sf_dir)
    days = sketches.quantile_sketches(
        rows.withColumn("day", F.to_date("timestamp")), "global_active_power", ["sensor_id", "day"])
    month = sketches.merge_sketches(days, ["sensor_id"])
    found = sketches.quantiles(month, SHARES)
    errors = sketches.rank_errors(rows, "global_active_power", found, ["sensor_id"], SHARES)
    near = reduce(lambda a, b: a & b, [F.col(f"{name}_error") <= 0.01 for name in SHARES])
    return errors.select("sensor_id", "n", near.alias("within_one_percent"))


def fleet_quantiles(spark, sf_dir):
    """The same over all sensors: their sketches merged by day, then by month."""
    rows = source.readings(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    rows = rows.withColumn("month", F.date_trunc("month", "day").cast("date"))
    each = sketches.quantile_sketches(rows, "global_active_power", ["sensor_id", "day", "month"])
    days = sketches.merge_sketches(each, ["day", "month"])
    found = sketches.quantiles(sketches.merge_sketches(days, ["month"]), SHARES)
    errors = sketches.rank_errors(rows, "global_active_power", found, ["month"], SHARES)
    near = reduce(lambda a, b: a & b, [F.col(f"{name}_error") <= 0.01 for name in SHARES])
    return errors.select("month", "n", near.alias("within_one_percent"))


def active_sensors(spark, sf_dir):
    """How many sensors sent per day, week and month; only the days are counted from readings."""
    rows = source.readings(spark, sf_dir).select(
        "sensor_id", F.to_date("timestamp").alias("day"))
    days = written(sketches.id_bitmaps(rows, "sensor_id", ["day"]), "active-days")
    spans = {
        "day": days.withColumnRenamed("day", "start"),
        **{unit: sketches.merge_bitmaps(
            days.withColumn("start", F.date_trunc(unit, "day").cast("date")), ["start"])
            for unit in ("week", "month")},
    }
    return reduce(lambda a, b: a.unionByName(b), [
        sketches.distinct_counts(bitmaps, ["start"], "sensors").select(
            F.lit(unit).alias("span"), "start", "sensors")
        for unit, bitmaps in spans.items()])


def checked_ranges(spark, sf_dir):
    """Report ranges as users give them: whether each is accepted, and how many readings it has."""
    rows = source.readings(spark, sf_dir).select("timestamp")
    counts, accepted = [], []
    for number, (start, end, length) in enumerate(RANGES):
        try:
            bounds = range_of(start, end, length)
        except ValueError:
            accepted.append(False)
            continue
        accepted.append(True)
        inside = time_range(rows, *bounds)
        counts.append(inside.agg(F.count("*").alias("readings")).select(
            F.lit(number).alias("number"), F.lit(start).alias("start"), F.lit(True).alias("accepted"),
            "readings"))
    refused = [(n, RANGES[n][0], False, 0) for n, good in enumerate(accepted) if not good]
    shape = "number int, start string, accepted boolean, readings long"
    return reduce(lambda a, b: a.unionByName(b), counts, spark.createDataFrame(refused, shape))


def timeless_minutes(spark, sf_dir):
    """The speed view of readings of which every seventh has no event time."""
    rows = source.readings(spark, sf_dir)
    known = F.when(F.col("event_id") % 7 != 0, F.col("timestamp"))
    view = minutes.speed_minutes(rows.withColumn("timestamp", known))
    return rounded(view, AVERAGES, 9)


QUERIES = {
    "asof_forecast": asof_forecast,
    "usage_sessions": usage_sessions,
    "filled_minutes": filled_minutes,
    "sliding_load": sliding_load,
    "load_quantiles": load_quantiles,
    "fleet_quantiles": fleet_quantiles,
    "active_sensors": active_sensors,
    "checked_ranges": checked_ranges,
    "timeless_minutes": timeless_minutes,
}
