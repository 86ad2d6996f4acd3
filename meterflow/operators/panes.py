"""Sliding windows from panes: partial aggregates of a step are combined, not the readings."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators.chunks import UNIT, chunk_end, chunk_of, micros
from meterflow.operators.minutes import MERGE, finish


def sliding(partials, view, parts, size_seconds, keys=("sensor_id",), ts="start_time",
            step_seconds=60, unit=UNIT):
    """For every pane, the ``view`` of the ``size_seconds`` that end with it.

    ``partials`` has one row per key and pane of ``step_seconds``, as ``minutes.merge_partials``
    gives; ``parts`` are its columns, as {column: (function, measure)}. A reading is shuffled once,
    within its pane. Panes near the end of a chunk are handed to the next one too, so that a
    key with very many readings is spread over its chunks; the window may not be longer than one.
    """
    if size_seconds > {"hour": 3600, "day": 86_400}[unit]:
        raise ValueError(f"a window of {size_seconds} s is longer than a chunk, one {unit}")
    keys, reach = list(keys), (size_seconds - step_seconds) * 1_000_000
    own = chunk_of(F.col(ts), unit)
    following = chunk_end(own, unit)
    near = micros(following) - micros(F.col(ts)) <= reach
    panes = partials.select(*keys, ts, *parts, F.explode(F.when(
        near, F.array(own, following)).otherwise(F.array(own))).alias("_chunk"))
    order = micros(F.col(ts))
    trailing = Window.partitionBy(*keys, "_chunk").orderBy(order).rangeBetween(-reach, 0)
    summed = panes.select(
        *keys, ts, "_chunk",
        *[MERGE[fn](name).over(trailing).alias(name) for name, (fn, _) in parts.items()])
    whole = summed.filter(F.col("_chunk") == own)
    return finish(whole, view, [*keys, ts])
