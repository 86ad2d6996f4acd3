"""Live views: changed windows, sessions, sensors that fall silent, and predictions met by readings."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterflow.operators.minutes import SIZE
from meterflow.operators.sessions import MEASURED
from meterflow.session import keep_state_off_heap
from meterflow.sources.stores import PARTS, batch_writer, create_store
from meterflow.streaming.jobs import DELAY, FILES, speed_stream

SILENCE = 300


# -- windows as they change


def start_live(readings, checkpoint, root, delay=DELAY, size=SIZE, trigger=None, files=FILES):
    """Store the windows that each micro-batch changed, open ones too. The folder belongs to one
    checkpoint, as micro-batch numbers tell which change is the last."""
    view = speed_stream(readings, delay, size)
    create_store(readings.sparkSession, root, view.schema)
    writer = view.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(batch_writer(root, files=files))
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_live(spark, root, schema, keys=("sensor_id", "start_time")):
    """The last change of every window; of a window's changes one per task is shuffled."""
    rows = spark.read.schema(StructType([*schema, *PARTS])).parquet(root)
    number = F.substring_index("batch", "-", -1).cast("long")
    others = [c for c in schema.names if c not in keys]
    last = F.max_by(F.struct(*others), number).alias("last")
    return rows.groupBy(*keys).agg(last).select(
        *[c if c in keys else F.col(f"last.{c}") for c in schema.names])


# -- sessions


def session_stream(readings, gap_seconds, delay=DELAY):
    """The columns of ``operators.sessions`` for closed sessions of a stream."""
    window = F.session_window("timestamp", f"{gap_seconds} seconds")
    live = readings.withWatermark("timestamp", delay)
    grouped = live.groupBy("sensor_id", window).agg(
        *[make().alias(name) for name, make, _ in MEASURED])
    return grouped.drop("session_window")


# -- sensors that fall silent

LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def silent_sensors(readings, silence_seconds=SILENCE, delay=DELAY):
    """A row for every time a sensor has been silent for so many seconds: ``sensor_id``, the
    ``first_time`` and ``last_time`` between which it had not been, and its last ``load``, of equal
    times the largest. It comes out once the watermark has passed the silence, so a reading that is
    not late can no longer end it.

    The spells between silences are session windows. Each task joins those of its readings before
    the shuffle, so a sensor that sends very often costs few rows. State is in RocksDB, which the
    session uses from here on.

    Readings without time or sensor are left out. How the stream is cut changes no row, but
    for readings later than ``delay``.
    """
    keep_state_off_heap(readings.sparkSession)
    readings.sparkSession.conf.set(LOCAL_MERGE, "true")
    rows = readings.filter("timestamp IS NOT NULL AND sensor_id IS NOT NULL").select(
        "sensor_id", "timestamp", F.col("global_active_power").alias("load"))
    spell = F.session_window("timestamp", f"{silence_seconds} seconds")
    last = F.max(F.struct("timestamp", "load")).alias("last")
    gone = rows.withWatermark("timestamp", delay).groupBy("sensor_id", spell).agg(
        F.min("timestamp").alias("first_time"), last)
    return gone.select(
        "sensor_id", "first_time", F.col("last.timestamp").alias("last_time"),
        F.col("last.load").alias("load"))


# -- predictions met by readings


def prediction_minutes(predictions, steps, ts="prediction_time"):
    """A row per predicted minute: ``sensor_id``, ``minute``, ``step`` from 1, ``predicted``."""
    each = F.array(*[F.struct(F.lit(i).alias("step"), F.col(name).alias("predicted"))
                     for i, name in enumerate(steps, 1)])
    rows = predictions.select("sensor_id", ts, F.inline(each))
    minute = F.col(ts) + F.make_dt_interval(mins=F.col("step") - 1)
    return rows.select("sensor_id", minute.alias("minute"), "step", "predicted")


def scored_stream(predicted, readings, delay=DELAY):
    """Predicted minutes with each reading of their sensor and minute, or with none once no such
    reading can come any more.

    Both sides are kept by sensor and minute, so a sensor with very many readings is spread over its
    minutes, and both are given up when the slower stream's watermark has passed the minute. State
    is in RocksDB, which the session uses from here on; start the stream within
    ``session.bounded_state`` where a micro-batch may be large.
    """
    keep_state_off_heap(readings.sparkSession)
    minute = F.date_trunc("minute", F.col("timestamp"))
    right = readings.select(
        F.col("sensor_id").alias("sensor"), minute.alias("at"), "time",
        F.col("global_active_power").alias("load")).withWatermark("at", delay)
    left = predicted.withWatermark("minute", delay)
    met = (F.col("sensor_id") == F.col("sensor")) & (F.col("minute") == F.col("at"))
    return left.join(right, met, "left").drop("sensor", "at")
