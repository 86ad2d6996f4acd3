"""Tumbling event-time aggregates, directly and by way of mergeable partials.

A view is a list of (output column, function, measure) as in ``schema.SPEED_VIEW``.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StructField, StructType, TimestampType,
)

from meterflow.schema import BATCH_VIEW, SPEED_VIEW

SIZE = "1 minute"
MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}


def window_view(readings, view, keys=(), ts="timestamp", size=SIZE):
    """Aggregates per key and window, for stored and streaming readings.

    Readings without event time belong to no window. On a stream, set the watermark first.
    """
    aggregates = [FIRST[fn](measure).alias(name) for name, fn, measure in view]
    names = [name for name, _, _ in view]
    window = F.window(ts, size)
    if readings.isStreaming:
        # Only the window column itself tells the state store when a group is closed.
        bounds = [F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time")]
        return readings.groupBy(*keys, window).agg(*aggregates).select(*keys, *bounds, *names)
    # The start alone is the smaller key, and merging partials by it needs no second shuffle.
    measures = list(dict.fromkeys(measure for _, _, measure in view))
    rows = readings.select(*keys, *measures, window.start.alias("start_time"))
    end = F.window("start_time", size).end.alias("end_time")
    grouped = rows.groupBy(*keys, "start_time").agg(*aggregates)
    return grouped.select(*keys, "start_time", end, *names)


def speed_minutes(readings, ts="timestamp", size=SIZE):
    """The speed view: one row per sensor and window."""
    return window_view(readings, SPEED_VIEW, ["sensor_id"], ts, size)


def batch_minutes(readings, ts="timestamp", size=SIZE):
    """The batch view: one row per window over all sensors, stamped with its start."""
    view = window_view(readings, BATCH_VIEW, [], ts, size)
    return view.withColumnRenamed("start_time", "timestamp").drop("end_time")


def parts_of(view):
    """Partial columns a view is finished from, as {column: (function, measure)}."""
    parts = {}
    for _, fn, measure in view:
        for part in ("sum", "count") if fn == "avg" else (fn,):
            parts[f"{measure}_{part}"] = (part, measure)
    return parts


PARTS = parts_of(SPEED_VIEW + BATCH_VIEW)

# Columns of stored partials.
PARTIALS = StructType(
    [StructField("sensor_id", IntegerType()), StructField("start_time", TimestampType()),
     StructField("end_time", TimestampType())]
    + [StructField(name, LongType() if fn == "count" else DoubleType())
       for name, (fn, _) in PARTS.items()]
)


def minute_partials(readings, ts="timestamp", size=SIZE):
    """Sums, counts, minima and maxima per sensor and window.

    Partials of any split of the readings merge to the same view, so a window may arrive in
    several micro-batches.
    """
    parts = [(name, fn, measure) for name, (fn, measure) in PARTS.items()]
    return window_view(readings, parts, ["sensor_id"], ts, size)


def merge_partials(partials, keys=("sensor_id", "start_time", "end_time")):
    return partials.groupBy(*keys).agg(
        *[MERGE[fn](name).alias(name) for name, (fn, _) in PARTS.items()]
    )


def finish(merged, view, keys):
    """The columns of a view from merged partials; an average without readings is null."""
    def column(fn, measure):
        if fn == "avg":
            return F.try_divide(F.col(f"{measure}_sum"), F.col(f"{measure}_count"))
        return F.col(f"{measure}_{fn}")

    return merged.select(*keys, *[column(fn, m).alias(name) for name, fn, m in view])


def speed_from_partials(partials):
    keys = ["sensor_id", "start_time", "end_time"]
    return finish(merge_partials(partials, keys), SPEED_VIEW, keys)


def batch_from_partials(partials):
    """The batch view from per-sensor partials: sums over counts, not averages of averages."""
    merged = merge_partials(partials, ["start_time"])
    return finish(merged, BATCH_VIEW, ["start_time"]).withColumnRenamed(
        "start_time", "timestamp"
    )
