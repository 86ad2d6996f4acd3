"""Backfill of readings from delimited text files."""

from pyspark.sql import functions as F

from meterflow.functions.columns import measure_from_text, text_or_null, timestamp_from_text
from meterflow.schema import MEASURES

DAY_FIRST = "d/M/yyyy H:mm:ss"


def read_history(spark, path, sep=","):
    """Every column of the files as text, named by their header line.

    All files of a folder need the same header; one that orders its columns differently ends the
    job with its name, where positions alone would swap values.
    """
    return spark.read.csv(path, header=True, sep=sep, enforceSchema=False)


def typed_history(text, fmt=DAY_FIRST, strict=False):
    """Text columns turned into ``timestamp``, the measures, and any further columns.

    Column names match whatever their case; the result uses the lower-case names. With
    ``strict`` a date that does not fit ``fmt`` ends the job, otherwise it becomes null.
    """
    named = {c.lower(): F.col(f"`{c}`") for c in text.columns}
    extra = [c for c in named if c not in ("date", "time", *MEASURES)]
    stamp = timestamp_from_text(named["date"], named["time"], fmt, strict)
    return text.select(
        stamp.alias("timestamp"),
        *[measure_from_text(named[m]).alias(m) for m in MEASURES],
        *[text_or_null(named[c]).alias(c) for c in extra],
    )


def import_history(text, fmt=DAY_FIRST, strict=False):
    """Clean readings: a row with a null in any column is left out.

    The typed columns pass through an array of one struct, below which no filter is pushed, so
    every text is parsed once and not again for the null check.
    """
    typed = typed_history(text, fmt, strict)
    row = F.struct(*[F.col(f"`{c}`") for c in typed.columns])
    return typed.select(F.inline(F.array(row))).dropna("any")


def import_counts(text, fmt=DAY_FIRST):
    """One row telling how many rows were read, kept, and left out for which reason."""
    typed = typed_history(text, fmt)
    missing = F.lit(False)
    for name in typed.columns[1:]:
        missing = missing | F.col(f"`{name}`").isNull()
    bad_time = F.col("timestamp").isNull()
    return typed.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~bad_time & ~missing).alias("rows_kept"),
        F.count_if(bad_time).alias("bad_timestamp"),
        F.count_if(~bad_time & missing).alias("missing_value"),
    )
