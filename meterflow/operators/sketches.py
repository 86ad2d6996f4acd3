"""Summaries of a day that merge to those of longer spans without reading the day again."""

from pyspark.sql import functions as F

# Size of a quantile sketch; its rank error is about 0.3 % at this size, none for fewer values.
SIZE = 800


def quantile_sketches(rows, value, keys, size=SIZE):
    """One quantile sketch per key, as bytes: ``sketch``, and ``n`` values in it. Null values count
    for none."""
    known = rows.filter(F.col(value).isNotNull())
    return known.groupBy(*keys).agg(
        F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch"), F.count("*").alias("n"))


def merge_sketches(sketches, keys, size=SIZE):
    """Sketches of finer keys merged to those of ``keys``."""
    return sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"), F.sum("n").alias("n"))


def quantiles(sketches, shares):
    """The values that ``shares``, {column: share}, of a sketch's values do not exceed."""
    return sketches.select(
        *[c for c in sketches.columns if c != "sketch"],
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(name)
          for name, share in shares.items()],
    )


def rank_errors(rows, value, found, keys, shares):
    """``found``, quantiles per key, with ``<name>_error``: how far the share of values that each
    exceeds or equals is from the one asked for, by counting the values below and at it.

    The counts are taken before the shuffle, so a key with very many rows costs one row per task.
    """
    known = rows.filter(F.col(value).isNotNull()).join(found.drop("n"), list(keys))
    counts = [
        c for name in shares for c in (
            F.count_if(F.col(value) < F.col(name)).alias(f"{name}_below"),
            F.count_if(F.col(value) <= F.col(name)).alias(f"{name}_upto"))]
    counted = known.groupBy(*keys).agg(F.count("*").alias("n"), *counts)

    def error(name, share):
        wanted = F.col("n") * share
        return F.greatest(
            F.lit(0.0), F.col(f"{name}_below") - wanted, wanted - F.col(f"{name}_upto")
        ) / F.col("n")

    return counted.select(
        *keys, "n", *[error(name, share).alias(f"{name}_error") for name, share in shares.items()])


def id_bitmaps(rows, number, keys):
    """Which whole numbers from 0 occur, per key and block of numbers, as a bitmap."""
    known = rows.filter(F.col(number) >= 0)
    return known.groupBy(*keys, F.bitmap_bucket_number(number).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merge_bitmaps(bitmaps, keys):
    """Bitmaps of finer keys merged to those of ``keys``."""
    return bitmaps.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps, keys, name="n"):
    """How many numbers the bitmaps of each key hold."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
