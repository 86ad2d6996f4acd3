"""Forecast of the next minutes for all sensors in one job."""

from pyspark.sql import functions as F

from meterflow.functions.columns import rectify
from meterflow.operators.keyed import latest_n, latest_n_since, sensors
from meterflow.operators.ranges import BY_DATE, BY_MINUTE
from meterflow.schema import CALENDAR, FORECAST_INPUT, FORECAST_STEPS

PREDICTIONS = [f"prediction{step}" for step in range(1, FORECAST_STEPS + 1)]


def recent_load(minutes, ts, value, n=FORECAST_INPUT, order=None, since=None, known=None,
                partitions=None):
    """The ``n`` newest values of each sensor, ``rank`` 1 being the newest; minutes without a
    value do not count.

    A minute view has one row per sensor and minute, so no sensor is hot and no salt needed.
    With ``since``, a column bound, older rows are read only for sensors that need them;
    ``known`` is a frame of all sensors, taken from the view if not given. ``partitions`` tells
    how the view is partitioned, see ``ranges.between``.
    """
    order = order or [ts]
    parts = {BY_DATE: ["date"], BY_MINUTE: list(CALENDAR)}.get(partitions, [])
    columns = dict.fromkeys(["sensor_id", ts, value, *order, *parts])
    rows = minutes.select(*columns).filter(F.col(value).isNotNull())
    if since is None:
        return latest_n(rows, n, order=order, salts=1)
    known = sensors(rows) if known is None else known
    return latest_n_since(rows, n, since, known, order=order, salts=1, partitions=partitions)


def forecast_features(minutes, ts="start_time", value="avg_global_active_power",
                      n=FORECAST_INPUT, min_points=1, order=None, since=None, known=None,
                      partitions=None):
    """One vector of 32-bit floats per sensor, oldest value first, as long as the sensor has
    values, up to ``n``.

    Sensors with fewer than ``min_points`` values are left out. For ``since``, ``known`` and
    ``partitions`` see ``recent_load``.
    """
    recent = recent_load(minutes, ts, value, n, order, since, known, partitions)
    # At most n entries per sensor are collected.
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("rank")).alias("place"), value)))
    return (
        recent.groupBy("sensor_id")
        .agg(F.max(ts).alias("last_time"), ordered.alias("rows"))
        .filter(F.size("rows") >= min_points)
        .select(
            "sensor_id",
            "last_time",
            F.transform("rows", lambda row: row[value].cast("float")).alias("features"),
        )
    )


def forecast_trend(minutes, ts="start_time", value="avg_global_active_power",
                   n=FORECAST_INPUT, min_points=1, order=None, prediction_time=None,
                   since=None, known=None, partitions=None):
    """The built-in model: a least-squares line through the newest values, carried on.

    The newest value sits at place -1, so step ``h`` is the line at ``h - 1``. With too few
    points for a slope the line is flat; sensors with fewer than ``min_points`` values are left
    out. ``prediction_time`` is a column, by default the time of the newest value. For
    ``since``, ``known`` and ``partitions`` see ``recent_load``.
    """
    place, load = -F.col("rank"), F.col(value)
    fitted = (
        recent_load(minutes, ts, value, n, order, since, known, partitions)
        .groupBy("sensor_id")
        .agg(
            F.max(ts).alias("last_time"),
            F.count(value).alias("points"),
            F.regr_slope(load, place).alias("slope"),
            F.regr_intercept(load, place).alias("intercept"),
            F.avg(load).alias("mean"),
        )
        .filter(F.col("points") >= min_points)
    )
    slope = F.coalesce("slope", F.lit(0.0))
    level = F.coalesce("intercept", "mean")
    steps = [rectify(level + slope * step) for step in range(FORECAST_STEPS)]
    when = F.col("last_time") if prediction_time is None else prediction_time
    return fitted.select(
        "sensor_id",
        when.alias("prediction_time"),
        *[step.alias(name) for name, step in zip(PREDICTIONS, steps)],
    )


def windowed_trend(minutes, ts, value, size):
    """The built-in model over a whole history: for every sensor and window with values, the line
    through them, carried on from the window's end, which is the ``prediction_time``.

    The minute before the window's end sits at place -1, so step ``h`` is the line at ``h - 1``. A
    sensor with very many minutes is spread over its windows.
    """
    known = minutes.filter(F.col(value).isNotNull()).withColumn("_window", F.window(ts, size))
    end = F.col("_window.end")
    since = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(end.cast("timestamp"))
    rows = known.select("sensor_id", end.alias("prediction_time"), F.col(value).alias("_load"),
                        (since / 60_000_000).alias("_place"))
    fitted = rows.groupBy("sensor_id", "prediction_time").agg(
        F.regr_slope("_load", "_place").alias("slope"),
        F.regr_intercept("_load", "_place").alias("intercept"), F.avg("_load").alias("mean"))
    slope, level = F.coalesce("slope", F.lit(0.0)), F.coalesce("intercept", "mean")
    return fitted.select("sensor_id", "prediction_time", *[
        rectify(level + slope * step).alias(name) for step, name in enumerate(PREDICTIONS)])


def forecast_score(features, load_model, prediction_time=None):
    """Predictions of a user's model for every feature vector, negative ones set to zero.

    ``load_model()`` runs once per task and returns a function from ``float32[rows, n, 1]`` to
    ``[rows, 6]``. It gets vectors of one length at a time.
    """
    names = list(PREDICTIONS)

    def score(batches):
        import numpy as np
        import pandas as pd

        predict = load_model()
        for batch in batches:
            for _, same in batch.groupby(batch["features"].map(len), sort=False):
                vectors = np.stack(same["features"].to_numpy()).astype(np.float32)
                steps = np.asarray(predict(vectors[:, :, np.newaxis]), dtype=np.float64)
                yield pd.concat(
                    [same[["sensor_id", "prediction_time"]].reset_index(drop=True),
                     pd.DataFrame(steps, columns=names)], axis=1)

    when = F.col("last_time") if prediction_time is None else prediction_time
    inputs = features.select("sensor_id", when.alias("prediction_time"), "features")
    time_type = inputs.schema["prediction_time"].dataType.simpleString()
    sensor_type = inputs.schema["sensor_id"].dataType.simpleString()
    schema = ", ".join(
        [f"sensor_id {sensor_type}", f"prediction_time {time_type}"] + [f"{c} double" for c in names]
    )
    scored = inputs.mapInPandas(score, schema)
    return scored.select(
        "sensor_id", "prediction_time", *[rectify(F.col(c)).alias(c) for c in names]
    )
