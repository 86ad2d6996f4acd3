"""Exact dedup by distributed MSD radix partitioning.

Documents are split by their length, then by successive runs of bytes, each run eight times as
long as the one before. A group of one is settled, and so is a group whose texts have ended;
only the rest goes on. Bytes are compared as they are: no digest decides.

A round counts (group, bytes) pairs with map-side sums, so any number of copies leaves one row
per task, and joins the pairs that occur more than once back to their rows, those of a hot pair
dealt to several parts. No group of rows comes together in one task. Each round's membership is
a table in the shared folder.

Defined cases: null counts as the empty text, and both are equal. Of equal texts the row with
the largest ``doc_id`` stays (a null id is smaller than any); of several such rows one stays,
the same one in both functions for one run. An empty table gives no rows. Other columns may
have any name.
"""

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import join_spread
from meterflow.session import written

FIRST_RUN = 32
GROWTH = 8


def lower(text):
    """A to Z in lower case, everything else as it is. Of texts without other letters, whose
    characters are as many as their bytes, ``lower`` does the same and is much faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase)
    )


def lower_bytes(run):
    """A to Z in lower case, each byte of the run as the Latin-1 character of that number: no
    other byte of UTF-8 is one of these letters, and different bytes stay different."""
    return lower(F.decode(run, "ISO-8859-1"))


def lower_sha256(text):
    return F.sha2(lower(F.coalesce(text, F.lit(""))), 256)


def _numbered(docs, *extra):
    """The rows in a stored table, each with a number of its own."""
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("number"), F.struct("*").alias("row"),
            F.coalesce(F.octet_length("text"), F.lit(0)).alias("length"), *extra,
        ), "dedup-rows",
    )


def equal_groups(rows, first_run=FIRST_RUN):
    """``number`` and ``group`` of every row whose text occurs more than once.

    ``rows`` holds ``number``, ``row`` and ``length`` in a stored table.
    """
    body = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    open_rows = rows.select("number", F.col("length").cast("long").alias("group"))
    settled, start, run = [], 0, first_run
    while True:
        part = rows.filter(F.col("length") > start) if start else rows
        part = part.select("number", "length", F.substring(body, start + 1, run).alias("run"))
        # The open rows grow with the table, so neither side is ever broadcast.
        part = part.join(open_rows.hint("merge"), "number")
        part = written(part.withColumn("run", lower_bytes(F.col("run"))), "dedup-runs")
        same = written(
            part.groupBy("group", "run").agg(
                F.min("number").alias("first"), F.count("*").alias("n")
            ).filter("n > 1"), "dedup-pairs",
        )
        left = written(
            join_spread(part, same.hint("merge"), ["group", "run"], "number").select(
                "number", "length", F.col("first").alias("group")
            ), "dedup-groups",
        )
        start, run = start + run, run * GROWTH
        settled.append(left.filter(F.col("length") <= start).select("number", "group"))
        open_rows = left.filter(F.col("length") > start).select("number", "group")
        if open_rows.isEmpty():
            return reduce(DataFrame.unionByName, settled)


def _decided(rows):
    """For every row whose text occurs more than once: ``number``, ``keep``, ``group_size``."""
    members = rows.select("number", F.col("row.doc_id").alias("doc_id")).join(
        equal_groups(rows), "number"
    )
    members = written(members, "dedup-members")
    groups = written(
        members.groupBy("group").agg(
            F.max(F.struct("doc_id", "number")).alias("keep"), F.count("*").alias("n")
        ), "dedup-keepers",
    )
    return join_spread(members.select("number", "group"), groups, ["group"], "number").select(
        "number", "keep", F.col("n").alias("group_size")
    )


def exact_groups(docs):
    """One row per document, dropped ones too: ``doc_id``, the ``keep_id`` that stays for it,
    ``group_size``, ``kept``, and ``text_sha256`` of the text in lower case."""
    rows = _numbered(
        docs.select("doc_id", "text"), lower_sha256(F.col("text")).alias("text_sha256")
    )
    joined = rows.select("number", "row.doc_id", "text_sha256").join(
        _decided(rows), "number", "left"
    )
    alone = F.col("keep").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep.number") == F.col("number"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs):
    """The rows that stay, with every column of ``docs``."""
    rows = _numbered(docs)
    dropped = _decided(rows).filter(F.col("keep.number") != F.col("number")).select("number")
    return rows.join(written(dropped, "dedup-dropped"), "number", "left_anti").select("row.*")
