"""Connected components of links between numbers, as joins and groups that shrink the paths."""

from pyspark.sql import functions as F

from meterflow.llm.common import join_spread
from meterflow.session import written


def components(links):
    """``node`` and ``root``, the smallest node it is linked to, for every node with a link.

    ``links`` has the columns ``a`` and ``b``; repeated links count once, and those of a node to
    itself or without a node not at all. Each round links the larger neighbours of every
    node to its smallest one, then the smaller ones; the links become stars around the roots
    after a number of rounds that grows with the logarithm of the nodes. A round's links are a
    table in the shared folder. A hub's links are never gathered: its smallest neighbour is a
    map-side minimum, and the join back deals them to several parts.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    pairs = written(links.filter("a <> b").select(high, low).distinct(), "links")
    seen = None

    def least(rows):
        smallest = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        return written(smallest, "smallest")

    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = join_spread(both, least(both), ["u"], "v").filter("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")
        )
        large = written(large.distinct(), "links")
        small = join_spread(large, least(large), ["u"], "v").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"),
        )
        pairs = written(small.distinct(), "links")
        mark = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
