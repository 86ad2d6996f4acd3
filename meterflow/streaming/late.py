"""Late readings kept: a stream that routes what its windows would drop into a table of its own.

The stream records the newest time it has seen with every micro-batch, from which the watermark of a
later one follows. A reading is late if its window is already closed by that watermark, by the
rule that Spark's windows follow. Folders under the root:

``readings/late=L/date=D/batch=S-N``  readings of micro-batch N of stream S, late ones apart
``marks/batch=S-N``                   one row: what the stream has seen up to micro-batch N

A micro-batch that is run again reads only the marks before it and replaces its own folders.
"""

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StringType, StructField, StructType

from meterflow.functions.columns import utc_day
from meterflow.operators.minutes import SIZE
from meterflow.sources import files
from meterflow.sources.stores import stream_of
from meterflow.streaming.jobs import DELAY, start_batches

MARK = "newest long, watermark timestamp, readings long, late long"
PARTS = [StructField("late", BooleanType()), StructField("date", DateType()),
         StructField("batch", StringType())]
# Whether late rows go by the watermark of the micro-batch before, as they do by default.
MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"


def _newest(spark, root, stream, batch_id):
    """The newest time in microseconds that a stream had seen with a micro-batch, None if none."""
    path = f"{root}/marks/batch={stream}-{batch_id}"
    if batch_id < 0 or not files.exists(spark, path):
        return None
    return spark.read.schema(MARK).parquet(path).first().newest


def router(root, delay=DELAY, size=SIZE):
    """The ``foreachBatch`` function; it reads each micro-batch once."""
    def write(rows, batch_id):
        spark = rows.sparkSession
        stream = stream_of(spark)
        before = _newest(spark, root, stream, batch_id - 1)
        back = 2 if spark.conf.get(MULTIPLE, "true") == "true" else 1
        known = before if back == 1 else _newest(spark, root, stream, batch_id - back)
        watermark = F.lit(None).cast("timestamp")
        if known is not None:
            # Spark keeps whole milliseconds of the newest time.
            watermark = F.timestamp_millis(F.lit(known // 1000)) - F.expr(f"INTERVAL {delay}")
        # A reading without a time is in no window, and so not late.
        placed = F.coalesce("timestamp", F.timestamp_seconds(F.lit(0)))
        closed = F.window(placed, size).end <= watermark
        late = F.coalesce(F.col("timestamp").isNotNull() & closed, F.lit(False))
        seen = Observation()
        kind = rows.schema["timestamp"].dataType
        marked = rows.withColumn("late", late).observe(
            seen, F.max(F.unix_micros("timestamp")).alias("newest"), F.count("*").alias("readings"),
            F.count_if("late").alias("late"))
        (
            marked.select("*", utc_day(F.col("timestamp"), kind).alias("date"),
                          F.lit(f"{stream}-{batch_id}").alias("batch"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("late", "date", "batch").parquet(f"{root}/readings")
        )
        found = seen.get
        newest = max((t for t in (before, found["newest"]) if t is not None), default=None)
        mark = spark.range(1).select(
            F.lit(newest).cast("long").alias("newest"), watermark.alias("watermark"),
            F.lit(found["readings"]).cast("long").alias("readings"),
            F.lit(found["late"]).cast("long").alias("late"))
        mark.write.mode("overwrite").parquet(f"{root}/marks/batch={stream}-{batch_id}")

    return write


def start_routed(readings, checkpoint, root, delay=DELAY, size=SIZE, trigger=None, name=None):
    """Store raw readings, late ones apart; there is no shuffle and no state on the way."""
    nothing = readings.sparkSession.createDataFrame([], StructType([*readings.schema, *PARTS]))
    nothing.write.mode("ignore").partitionBy("late", "date", "batch").parquet(f"{root}/readings")
    return start_batches(readings, checkpoint, router(root, delay, size), trigger, name)


def read_routed(spark, root, schema, late=None):
    """Stored readings with ``late``; only one kind's folders are read if ``late`` is given."""
    rows = spark.read.schema(StructType([*schema, *PARTS])).parquet(f"{root}/readings")
    rows = rows.drop("date", "batch")
    return rows if late is None else rows.filter(F.col("late") == late)


def read_marks(spark, root):
    """One row per micro-batch: ``newest`` time seen so far, the ``watermark`` that decided, how many
    ``readings`` came and how many of them ``late``."""
    marks = spark.read.schema(f"{MARK}, batch string").parquet(f"{root}/marks")
    return marks.withColumn("newest", F.timestamp_micros("newest"))
