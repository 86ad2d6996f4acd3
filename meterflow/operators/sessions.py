"""Sessions: runs of readings of one key without a long silence between them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators.chunks import UNIT, chunk_end, chunk_of, micros
from meterflow.session import written

# (column, how it is computed from readings, how partial sessions of it merge)
MEASURED = [
    ("start_time", lambda: F.min("timestamp"), F.min),
    ("last_time", lambda: F.max("timestamp"), F.max),
    ("readings", lambda: F.count("*"), F.sum),
    ("total_load", lambda: F.sum("global_active_power"), F.sum),
    ("max_load", lambda: F.max("global_active_power"), F.max),
]
NAMES = [name for name, _, _ in MEASURED]


def _numbered(rows, keys, begin, end, gap):
    """``rows`` with ``_number``, which grows by one where a silence is longer than the gap."""
    inside = Window.partitionBy(*keys).orderBy(begin, end)
    sofar = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    silence = micros(F.col(begin)) - micros(F.lag(end).over(inside))
    opens = F.when(silence > gap, 1).otherwise(0)
    return rows.withColumn("_opens", opens).withColumn(
        "_number", F.sum("_opens").over(sofar)).drop("_opens")


def sessions(readings, gap_seconds, keys=("sensor_id",), unit=UNIT):
    """One row per session, a silence of more than ``gap_seconds`` apart from the next.

    Sessions are built within key and chunk, so a key with very many readings is spread over its
    chunks. Only those that come within a gap of their chunk's border can go on beyond it; they, at
    most two for each key and chunk, are stitched in a second pass. Readings are shuffled once: the
    parts are written, as both passes read them. The gap may not be longer than a chunk. Readings without a time belong to no session; a null key is a key like any other.
    """
    keys, gap = list(keys), int(gap_seconds * 1_000_000)
    if gap > {"hour": 3600, "day": 86_400}[unit] * 1_000_000:
        raise ValueError(f"a gap of {gap_seconds} s is longer than a chunk, one {unit}")
    rows = readings.filter("timestamp IS NOT NULL").withColumn(
        "_chunk", chunk_of(F.col("timestamp"), unit))
    parts = _numbered(rows, [*keys, "_chunk"], "timestamp", "timestamp", gap).groupBy(
        *keys, "_chunk", "_number").agg(*[make().alias(name) for name, make, _ in MEASURED])
    parts = written(parts, "sessions")
    at_start = micros(F.col("start_time")) - micros(F.col("_chunk")) <= gap
    at_end = micros(chunk_end(F.col("_chunk"), unit)) - micros(F.col("last_time")) <= gap
    border = parts.filter(at_start | at_end).drop("_chunk", "_number")
    stitched = _numbered(border, keys, "start_time", "last_time", gap).groupBy(
        *keys, "_number").agg(*[merge(name).alias(name) for name, _, merge in MEASURED])
    columns = [*keys, *NAMES]
    return parts.filter(~(at_start | at_end)).select(*columns).unionByName(
        stitched.select(*columns))
