"""Readings derived from the ``events`` table, for the registered queries."""

from pyspark.sql import functions as F

from meterflow.sources.messages import encode_readings, parse_readings


def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark, sf_dir):
    # As a pattern the path may be one file or a folder of files.
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def as_readings(rows, keep=()):
    """One reading per event, one sensor per user; ``keep`` names columns to carry along.

    ``props`` always has the form {"k": number}; a pattern finds the number in a quarter of
    the time a JSON parse takes.
    """
    k = F.regexp_extract("props", r'"k":\s*(-?\d+)', 1).try_cast("int")
    return rows.select(
        "event_id",
        *keep,
        F.col("user_id").cast("int").alias("sensor_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
        F.col("ts").alias("timestamp"),
        (F.col("value") / 50).alias("global_active_power"),
        (k / F.lit(100.0)).alias("global_reactive_power"),
        (F.lit(223.0) + k * F.lit(0.28)).alias("voltage"),
        (F.col("value") / 10).alias("global_intensity"),
        k.cast("double").alias("sub_metering_1"),
        (F.col("user_id") % 79).cast("double").alias("sub_metering_2"),
        (F.col("event_id") % 21).cast("double").alias("sub_metering_3"),
    )


def readings(spark, sf_dir):
    return as_readings(events(spark, sf_dir))


def as_records(rows):
    """Topic records of events, the event id standing for the topic offset."""
    return encode_readings(as_readings(rows).withColumnRenamed("event_id", "offset"), ["offset"])


def parse_records(records):
    sensor = F.col("key").cast("string").cast("int")
    return parse_readings(records, sensor, keep=["offset"])
