"""Parquet tables partitioned by date, or by the five calendar columns."""

from pyspark.sql import functions as F

from meterflow.functions.columns import calendar_parts, utc_day
from meterflow.schema import CALENDAR
from meterflow.sources import files as storage


def write_by_date(rows, path, ts="timestamp", order=None, mode="append", files=None,
                  spread=("sensor_id",), keep_other_days=False):
    """Append rows under one ``date`` folder per day in UTC, sorted within each file.

    The rebalance puts the rows of a day together; adaptive execution splits a day that is
    too large for one task and joins small ones. Where there is no adaptive execution, give
    ``files`` to spread the rows over so many tasks by the ``spread`` columns instead.
    ``order`` names sort columns, by default ``ts``, so that a range inside a day skips pages
    of the file. With ``mode="overwrite"`` and ``keep_other_days`` only the days among the
    rows are replaced.
    """
    dated = rows.withColumn("date", utc_day(F.col(ts), rows.schema[ts].dataType))
    dated = dated.repartition(files, *spread) if files else dated.hint("rebalance", "date")
    (
        dated.sortWithinPartitions("date", *(order or [ts]))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if keep_other_days else "static")
        .partitionBy("date").parquet(path)
    )


def append_to(rows, fmt, options=None):
    """Append rows to any sink: a topic, a keyed store, a table."""
    rows.write.format(fmt).options(**(options or {})).mode("append").save()


def write_by_minute(rows, path, ts="timestamp", mode="append"):
    """Append rows under year/month/day/hour/minute folders, in UTC.

    This layout costs at least one file per minute; use it only where other readers expect
    it, and ``write_by_date`` otherwise.
    """
    parts = list(CALENDAR)
    kind = rows.schema[ts].dataType
    # A task takes a whole day: with a folder for each minute, committing files is the cost.
    dated = rows.select("*", *calendar_parts(ts, kind)).hint("rebalance", *parts[:3])
    (
        dated.sortWithinPartitions(*parts)
        .write.mode(mode).partitionBy(*parts).parquet(path)
    )


def read_by_minute(spark, path, columns):
    """Read the five-level layout by path, partition columns as zero-padded text.

    ``columns`` is the DDL text of the stored columns.
    """
    parts = ", ".join(f"{part} STRING" for part in CALENDAR)
    return spark.read.schema(f"{columns}, {parts}").parquet(path)


def newest_first(rows, keys=("sensor_id",), ts="timestamp"):
    """Rows ordered newest first within each key of a partition, for writing."""
    return rows.sortWithinPartitions(*keys, F.desc(ts))


def declare_table(spark, name, path, columns, partitions):
    """Name an existing or future Parquet folder in the catalog.

    ``columns`` and ``partitions`` are {name: type}.
    """
    ddl = ", ".join(f"`{c}` {t}" for c, t in {**columns, **partitions}.items())
    by = ", ".join(f"`{c}`" for c in partitions)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
        f"PARTITIONED BY ({by}) LOCATION '{path}'"
    )


def repair_partitions(spark, name):
    """Make partitions written since the last call visible in the catalog table."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def partition_columns(spark, name):
    """Names of the columns a catalog table is partitioned by."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def drop_before(spark, name, first_kept):
    """Drop the ``date`` partitions of a catalog table before ``first_kept``, files included, so
    that looking for partitions does not bring them back.

    Only partition names come to the driver, one per day of the table.
    """
    days = [row.partition.split("=")[1] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    old = [day for day in days if day < str(first_kept)]
    if old:
        facts = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
        location = facts.first().data_type
        dropped = ", ".join(f"PARTITION (date = '{day}')" for day in old)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {dropped}")
        for day in old:
            storage.remove(spark, f"{location}/date={day}")
    return len(old)


def newest_day(spark, path):
    """The newest ``date`` folder of a stored table as text, None if there is none: one listing,
    no scan."""
    days = [name.split("=")[1] for name in storage.folders(spark, path) if name.startswith("date=")]
    return max((day for day in days if day[:1].isdigit()), default=None)


def newest_time(spark, path, ts="timestamp"):
    """The newest ``ts`` of a table stored by date, read from its newest day alone."""
    day = newest_day(spark, path)
    rows = spark.read.parquet(path)
    if day is not None:
        rows = rows.filter(F.col("date") == F.lit(day).cast("date"))
    return rows.agg(F.max(ts)).first()[0]
