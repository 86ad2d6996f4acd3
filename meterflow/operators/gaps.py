"""Filling short gaps of a regular series by straight lines between its neighbours."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators.chunks import UNIT, chunk_of, micros

MINUTE = 60


def fill_gaps(rows, value, ts, longest_seconds, keys=("sensor_id",), step_seconds=MINUTE, unit=UNIT):
    """Rows of ``keys``, ``ts`` and ``value``, with those added that are missing between two rows at
    most ``longest_seconds`` apart, and ``filled``, true for these.

    There is one row per key and time on entry, all times a multiple of the step apart. A
    missing value lies on the line between its neighbours. Longer gaps stay as they are, and so do
    those next to a null value. Rows near the start of a chunk are seen by the chunk before too, so
    that its last row finds the next one and a key with very many rows is spread over its chunks;
    ``longest_seconds`` may not be longer than a chunk. Rows without a time are left out; a null key
    is a key like any other.
    """
    if longest_seconds > {"hour": 3600, "day": 86_400}[unit]:
        raise ValueError(f"gaps of {longest_seconds} s are longer than a chunk, one {unit}")
    keys, step = list(keys), step_seconds * 1_000_000
    own = chunk_of(F.col(ts), unit)
    before = F.timestamp_add(unit, F.lit(-1), own)
    near = micros(F.col(ts)) - micros(own) <= longest_seconds * 1_000_000
    plain = rows.filter(F.col(ts).isNotNull()).select(*keys, ts, value, F.explode(
        F.when(near, F.array(own, before)).otherwise(F.array(own))).alias("_chunk"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts)
    this = F.struct(F.col(ts).alias("at"), F.col(value).alias("v"))
    known = plain.withColumn("_next", F.lead(this).over(inside)).filter(F.col("_chunk") == own)

    span = micros(F.col("_next.at")) - micros(F.col(ts))
    short = (span <= longest_seconds * 1_000_000) & F.col("_next.v").isNotNull() & F.col(
        value).isNotNull()
    count = F.when(short, F.greatest(F.floor((span - 1) / step), F.lit(0))).otherwise(0)
    each = known.select("*", F.explode(F.sequence(F.lit(0).cast("long"), count)).alias("_k"))
    share = F.col("_k") * step / span
    line = F.col(value) + (F.col("_next.v") - F.col(value)) * share
    at = F.timestamp_add("MICROSECOND", (F.col("_k") * step).cast("long"), F.col(ts))
    return each.select(
        *keys, F.when(F.col("_k") == 0, F.col(ts)).otherwise(at).alias(ts),
        F.when(F.col("_k") == 0, F.col(value)).otherwise(line).alias(value),
        (F.col("_k") > 0).alias("filled"),
    )
