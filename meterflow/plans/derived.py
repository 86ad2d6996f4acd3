"""What the registered queries share: topics made of the given events, and columns made comparable."""

from pyspark.sql import functions as F

from meterflow.session import work_folder
from meterflow.sources import events as source
from meterflow.sources.messages import read_messages

ONCE = {"availableNow": True}


def rounded(rows, names, digits):
    """Sums of doubles depend on their order in the last bits; compare them rounded."""
    return rows.select(
        *[F.round(c, digits).alias(c) if c in names else F.col(c) for c in rows.columns]
    )


def naive(rows, *names):
    """Instants as plain timestamps, the way the tables hold them."""
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


def live_topic(spark, sf_dir, batches, copies=1):
    """Parsed readings of a topic that comes in so many micro-batches, each event that often."""
    topic = work_folder(spark, "topic")
    records = source.as_records(source.events(spark, sf_dir))
    parts = max(batches, records.rdd.getNumPartitions())
    if copies > 1:
        again = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
        records = records.select("*", again).drop("copy")
    records.repartition(parts).write.parquet(topic, mode="overwrite")
    options = {"path": topic, "maxFilesPerTrigger": -(-parts // batches)}
    return source.parse_records(read_messages(spark, "parquet", options, records.schema))


# Files of a slice: so many at least, and one for each so many rows.
SLICE_FILES, FILE_ROWS = 4, 250_000


def slice_files(rows, slices):
    """Files of each slice, so that a slice of a large table is written by many tasks."""
    return max(SLICE_FILES, -(-rows // slices // FILE_ROWS))


def write_slices(spark, sf_dir, slices=3, late=0):
    """Topic records of the events, in a folder for each slice of time, cut at minutes.

    With ``late`` every 50th event comes so many slices later, and every 7th comes twice, the second
    time so many slices later. Returns what ``read_slices`` needs.
    """
    topic = work_folder(spark, "topic")
    rows = source.events(spark, sf_dir)
    first, last, number = rows.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
    files = slice_files(number, slices)
    minute = F.unix_seconds(F.date_trunc("minute", F.col("ts").cast("timestamp")))
    span = max(1.0, (last - first).total_seconds())
    begin = F.unix_seconds(F.lit(first).cast("timestamp"))
    slot = F.least(F.floor((minute - begin) / F.lit(span) * slices), F.lit(slices - 1))
    slot = F.greatest(slot, F.lit(0))
    following = F.least(slot + late, F.lit(slices - 1))
    if late:
        own = F.when(F.col("event_id") % 50 == 0, following).otherwise(slot)
        slots = F.when(F.col("event_id") % 7 == 0, F.array(own, following)).otherwise(F.array(own))
    else:
        slots = F.array(slot)
    marked = rows.select("*", F.explode(slots).alias("slot"))
    for i in range(slices):
        # As many files in each slice, so that a slice is a micro-batch, later ones newer. Rows
        # are dealt before they become text, which is the larger part of the work.
        part = marked.filter(F.col("slot") == i).drop("slot").repartition(files)
        records = source.as_records(part)
        records.write.parquet(f"{topic}/{i}")
    return topic, slices, files, records.schema


def read_slices(spark, written, upto=None):
    """Parsed readings of a written topic, a micro-batch for each slice, or of its first ones."""
    topic, slices, files, schema = written
    names = ",".join(str(i) for i in range(slices if upto is None else upto))
    options = {"path": f"{topic}/{{{names}}}", "maxFilesPerTrigger": files}
    return source.parse_records(read_messages(spark, "parquet", options, schema))


def sliced_topic(spark, sf_dir, slices=3, late=0):
    """Parsed readings of a topic that comes in micro-batches ordered by time, see
    ``write_slices``."""
    return read_slices(spark, write_slices(spark, sf_dir, slices, late))
