"""Time cut into chunks, so that no key is one task: what a row needs from another chunk of its key
is carried over in a second pass with one row per key and chunk."""

from pyspark.sql import Window
from pyspark.sql import functions as F

UNIT = "day"


def chunk_of(ts, unit=UNIT):
    """The start of the day (or other unit of ``date_trunc``) a time falls into."""
    return F.date_trunc(unit, ts)


def chunk_end(start, unit=UNIT):
    return F.timestamp_add(unit, F.lit(1), start)


def carry(edges, keys, chunk, value):
    """``edges``, one row per key and chunk, with ``carried``: the newest ``value`` that is not null
    of the chunks before."""
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return edges.withColumn("carried", F.last(value, ignorenulls=True).over(before))


def micros(ts):
    """A time as a number of microseconds, with or without zone."""
    return F.unix_micros(ts.cast("timestamp"))
