"""Helpers of several operators: plain words, dense ranks, batch sizes."""

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.session import written

# Rows of one Arrow batch. A batch of texts has to fit into a Python worker, long ones included.
BATCH_ROWS = 256
# Rows of one key that a join takes in one part, and parts in which hot keys are looked up.
PART_ROWS = 1000
SALTS = 16
# Bytes of a word beyond which it is not among the frequent ones that go to the driver.
LONGEST_WORD = 64
WORD = r"[^\x20\x09-\x0D]+"


def small_batches(spark, rows=BATCH_ROWS):
    """Let Python functions over texts take few rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def word_count(text):
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plain_words(text):
    """The words of a text as bytes, A to Z in lower case; ``bytes`` know only those letters,
    and split at just the characters that ``WORD`` leaves out."""
    return text.encode().lower().split() if text else []


def ranked(rows, *order):
    """``rows`` with ``rank``, 0 for the first by ``order``; ties in any order.

    A range sort in a stored table gives each row its place inside its partition. What comes
    before a partition is a sum over one row per partition.
    """
    placed = written(
        rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "places"
    ).withColumn("part", F.shiftright("place", 33))
    sofar = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(sofar), F.lit(0)).alias("start")
    )
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, "part").withColumn("rank", F.col("start") + inside).drop(
        "part", "place", "start"
    )


def join_spread(rows, groups, keys, number):
    """``rows`` joined to ``groups``, a stored table with one row per ``keys`` and their rows
    ``n``; a key of over ``PART_ROWS`` rows is dealt to as many parts as it needs.

    The parts of a key are looked up by its hash on both sides. So two keys of one hash only
    share the number of parts, and the table of hot keys has two numbers a row, at most one for
    every ``PART_ROWS`` rows. Copies of ``groups`` are no more than that.
    """
    key, deal = F.xxhash64(*keys), F.xxhash64(number)
    hot = written(
        groups.filter(F.col("n") > PART_ROWS).groupBy(key.alias("key")).agg(
            F.max(F.ceil(F.col("n") / PART_ROWS)).alias("parts")
        ), "hot-keys",
    )
    if hot.isEmpty():
        return rows.join(groups, keys)
    salted = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumns(
        {"key": key, "salt": F.pmod(deal, F.lit(SALTS)).cast("int")}
    ).join(salted, ["key", "salt"], "left").withColumn(
        "salt", F.coalesce(F.pmod(deal, F.col("parts")), F.lit(0))
    )
    last = F.coalesce(F.col("parts"), F.lit(1)) - 1
    copies = groups.withColumn("key", key).join(hot, "key", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), last))
    )
    return dealt.drop("key", "parts").join(
        copies.drop("key", "parts"), [*keys, "salt"]
    ).drop("salt")


def frequent(counts, most):
    """The rows of ``counts`` (word, n) above the least count that at most ``most`` words reach,
    but for words of over ``LONGEST_WORD`` bytes: so the rows are bounded in bytes too.

    The counts are first summed up in steps of an eighth of a power of two, a few hundred rows at
    any size; None if no step has so few words.
    """
    counts = counts.filter(F.octet_length("word") <= LONGEST_WORD)
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    total, least = 0, None
    for row in steps:
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    return None if least is None else counts.filter(step >= least)


def ship(spark, path):
    """Give a file of the driver to every executor; returns its name there. The driver serves a
    copy for as long as it runs, so executors that come later get it too."""
    name = f"{uuid.uuid4().hex}-{os.path.basename(path)}"
    folder = tempfile.mkdtemp(prefix="meterflow-files-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addFile(shutil.copyfile(path, os.path.join(folder, name)))
    return name


def held_out(doc_id, folds):
    """Whether the crc32 of the id as text is 0 modulo ``folds``; so is a null id."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(remainder == 0, F.lit(True))
