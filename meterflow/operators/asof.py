"""As-of join: each row with the newest row of another table at or before its time."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators.chunks import UNIT, carry, chunk_of


def asof_join(left, right, keys, left_ts, right_ts, take, unit=UNIT, strict=False):
    """Every row of ``left`` with columns of the newest ``right`` row of its key that is not later,
    or earlier if ``strict``; null where there is none.

    ``take`` is {new column: column of right}. Of right rows with one key and time, the one with
    the largest taken columns, in their order, counts. Both tables are laid together and sorted by
    time within key and chunk, so no pair of rows is made, and a key with very many rows is spread
    over its chunks. The newest right row of each chunk then goes to the key's later chunks in a
    pass with one row per key and chunk. Keys and times that are null match nothing.
    """
    keys = list(keys)
    found = F.struct(*[F.col(column).alias(name) for name, column in take.items()])
    known = right.dropna(subset=[*keys, right_ts]).select(
        *keys, F.col(right_ts).alias("_at"), found.alias("_right"))
    # At one time the right row comes first, unless it has to be earlier.
    rows = left.select(
        *keys, F.col(left_ts).alias("_at"), F.lit(0 if strict else 1).alias("_kind"),
        F.struct(*left.columns).alias("_left"),
    ).unionByName(
        known.withColumn("_kind", F.lit(1 if strict else 0)), allowMissingColumns=True
    ).withColumn("_chunk", chunk_of(F.col("_at"), unit))

    sofar = Window.partitionBy(*keys, "_chunk").orderBy("_at", "_kind", "_right").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    here = F.last("_right", ignorenulls=True).over(sofar)
    placed = rows.withColumn("_here", here).filter("_left IS NOT NULL")

    newest = F.max(F.when(F.col("_right").isNotNull(), F.struct("_at", "_right")))["_right"]
    edges = rows.groupBy(*keys, "_chunk").agg(newest.alias("_newest"))
    edges = carry(edges, keys, "_chunk", "_newest").drop("_newest")
    joined = placed.join(edges, [*keys, "_chunk"], "left")
    best = F.coalesce("_here", "carried")
    return joined.select("_left.*", *[best[name].alias(name) for name in take])
