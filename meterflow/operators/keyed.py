"""Keyed-table contracts: last write wins, newest first, retention, latest rows per key."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators.ranges import between
from meterflow.session import written


def dedupe_last_write(rows, keys, order):
    """The last written row of each key, ``order`` being the columns that tell write order.

    Spark limits each group to one row before the shuffle, so many copies of one key cost
    one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return (
        rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    )


def retain_recent(rows, seconds, anchor=None, ts="timestamp", partitions=None):
    """Rows newer than ``seconds`` before ``anchor``, by default the newest row.

    The default reads the whole table for its newest time; ``tables.newest_time`` reads one day
    of a table stored by date. For ``partitions`` see ``ranges.between``.
    """
    anchor = rows.agg(F.max(ts)).scalar() if anchor is None else F.lit(anchor)
    edge = anchor - F.make_dt_interval(secs=F.lit(seconds))
    return between(rows, edge, ts=ts, partitions=partitions, strict=True)


def latest_n(rows, n, keys=("sensor_id",), order=("timestamp",), salts=16, rank="rank"):
    """The ``n`` newest rows of each key, numbered from 1 for the newest.

    Within every map task Spark keeps ``n`` rows per key before it shuffles. A hot key then
    still has ``n`` rows from each of very many tasks. So a first pass groups the map tasks
    into ``salts`` groups and keeps ``n`` rows per key and group, and the second pass sees at
    most ``n * salts`` rows per key. Give 1 where no key has many more rows than others.
    """
    newest = [F.desc(c) for c in order]
    if salts > 1:
        salt = F.spark_partition_id() % salts
        spread = Window.partitionBy(*keys, "_salt").orderBy(*newest)
        rows = (
            rows.withColumn("_salt", salt)
            .withColumn(rank, F.row_number().over(spread))
            .filter(F.col(rank) <= n)
            .drop("_salt", rank)
        )
    within = Window.partitionBy(*keys).orderBy(*newest)
    return rows.withColumn(rank, F.row_number().over(within)).filter(F.col(rank) <= n)


def same_keys(keys, left, right):
    """A condition under which two aliased frames agree in all keys, null with null."""
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


def latest_n_since(rows, n, since, known, keys=("sensor_id",), order=("timestamp",), salts=16,
                   rank="rank", partitions=None):
    """As ``latest_n``, reading rows before ``since`` only where they are needed.

    ``order[0]`` is the time column (rows without a time are left out), ``since`` a column
    bound on it, and ``known`` a frame of all keys, such as a kept sensor dimension; a null key
    is a key like any other. Keys with ``n`` rows from ``since`` on are done. Older rows are
    read for the other keys alone: their list is written first, so Spark broadcasts it if its
    size allows, filters the older rows before any shuffle, and leaves the older scan out if the
    list is empty. For ``partitions`` see ``ranges.between``.
    """
    ts, keys = order[0], list(keys)
    newest = between(rows, since, ts=ts, partitions=partitions)
    recent = written(latest_n(newest, n, keys, order, salts, rank), "recent")
    done = recent.filter(F.col(rank) == n).select(*keys).alias("done")
    unfinished = known.select(*keys).distinct().alias("known").join(
        done, same_keys(keys, "known", "done"), "left_anti"
    )
    unfinished = written(unfinished, "unfinished").alias("open")
    older = between(rows, high=since, ts=ts, partitions=partitions).alias("rows").join(
        unfinished, same_keys(keys, "rows", "open"), "left_semi"
    )
    return latest_n(recent.drop(rank).unionByName(older), n, keys, order, salts, rank)


def sensors(rows):
    """The sensor dimension."""
    return rows.select("sensor_id").distinct()
