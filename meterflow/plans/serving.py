"""Serving layer: the stored views, and one view over the batch and the speed layer."""

from datetime import time, timedelta

from pyspark.sql import functions as F

from meterflow.operators.minutes import batch_from_partials, speed_from_partials
from meterflow.operators.ranges import BY_DATE, between, range_of, time_literal, time_range
from meterflow.sources.stores import read_partials, read_store
from meterflow.sources.tables import write_by_date


def stored_partials(spark, root, start=None, end=None):
    """Partials of the batch layer; with a range, only its date folders are read."""
    partials = read_partials(spark, root)
    if start is None and end is None:
        return partials
    return time_range(partials, *range_of(start, end), ts="start_time", partitions=BY_DATE)


def stored_batch_view(spark, root, start=None, end=None):
    """The batch view, one row per window over all sensors."""
    return batch_from_partials(stored_partials(spark, root, start, end))


def stored_sensor_view(spark, root, start=None, end=None):
    """The batch layer with the columns of the speed view, one row per sensor and window."""
    return speed_from_partials(stored_partials(spark, root, start, end))


def publish_batch_view(spark, root, path, start=None, end=None, by_sensor=False):
    """Write the batch view as a plain table by date for other readers.

    Days in the range are replaced, so both bounds have to be at midnight, UTC.
    """
    if start is not None or end is not None:
        for bound in range_of(start, end):
            offset = bound.utcoffset() or timedelta()
            if (bound - offset).time() != time():
                raise ValueError(f"publish replaces whole days; {bound} is not at midnight UTC")
    read, ts = (stored_sensor_view, "start_time") if by_sensor else (stored_batch_view, "timestamp")
    view = read(spark, root, start, end)
    write_by_date(view, path, ts, mode="overwrite", keep_other_days=True)


def merged_view(batch, speed, horizon, ts="start_time", partitions=None):
    """Batch rows before ``horizon``, speed rows from it on.

    ``horizon``, a time or a column, is the start of the first window the batch layer has not
    closed, so every window comes from one layer only, whatever both of them hold.
    ``partitions`` is that of the speed rows.
    """
    shared = [c for c in speed.columns if c in batch.columns]
    closed = between(batch, high=time_literal(batch, horizon, ts), ts=ts).select(*shared)
    live = between(speed, time_literal(speed, horizon, ts), ts=ts, partitions=partitions)
    return closed.unionByName(live.select(*shared))


def batch_horizon(spark, root, delay="1 minute"):
    """The start of the first window that the batch layer may still add to.

    That is ``delay`` before the newest window it has seen: readings arrive at most so late. Only
    the newest day is read. None for a store without rows.
    """
    rows = read_partials(spark, root)
    newest = rows.agg(F.max("date")).first()[0]
    if newest is None:
        return None
    last = F.max("start_time") - F.expr(f"INTERVAL {delay}")
    return rows.filter(F.col("date") == F.lit(newest)).agg(last).first()[0]


def merged_stored_view(spark, batch_root, speed_root, schema, delay="1 minute"):
    """One view over the stored layers: the batch layer up to its horizon, the speed layer from
    there on. ``schema`` is that of the speed view."""
    speed = read_store(spark, speed_root, schema)
    horizon = batch_horizon(spark, batch_root, delay)
    if horizon is None:
        return speed.drop("date")
    partials = between(
        read_partials(spark, batch_root), high=F.lit(horizon), ts="start_time", partitions=BY_DATE
    )
    live = between(speed, F.lit(horizon), ts="start_time", partitions=BY_DATE).drop("date")
    return speed_from_partials(partials).unionByName(live)
