"""Mixing sources to target weights, with DataFrame functions only.

The words of every source are summed, a target is set for each, and a document comes out
``floor(rate)`` times, plus once more if a number drawn from its id is below the fraction that
is left, where ``rate`` is the target of its source over the source's words.

Defined cases: a null or blank text has no words and comes out as often as its source's rate
says. A null source is a source of its own, last in order. The rate of a source without any
word is 0. Rows with one ``doc_id`` share one draw; a row without id draws by its text. An
empty table gives an empty mix. Columns besides the three named ones are carried along under
any name.
"""

from pyspark.sql import functions as F

from meterflow.llm.common import ranked, word_count
from meterflow.session import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix"


def source_targets(sizes, weights=WEIGHTS, share=SHARE, most=MOST):
    """One row per source: ``source``, ``source_size``, ``target``, ``rate``.

    Sources in code point order, null last, take the weights in turn. Together they get
    ``share`` times all words; none gets more than ``most`` times its own, and what is left
    over goes to the others by weight. Each round is an aggregate over the sources and ends
    with one number, the words per unit of weight; it rises until no further source is full.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.col("rank") % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    sources = written(
        ranked(totals, F.col("source").asc_nulls_last()).select(
            "source", "source_size", weight.alias("weight"),
            (F.col("source_size") * F.lit(float(most))).alias("limit"),
        ), "mix-sources",
    )
    level = 0.0
    while True:
        full = F.col("limit") <= F.col("weight") * F.lit(level)
        found = sources.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(full, F.col("limit"))).alias("full"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if not found.words or not found.open:
            break
        higher = (share * found.words - (found.full or 0.0)) / found.open
        if higher <= level:
            break
        level = higher
    target = F.least("limit", F.col("weight") * F.lit(level))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return sources.select(
        "source", "source_size", target.alias("target"), rate.alias("rate")
    )


def draw(key, seed=SEED):
    """A number in [0, 1) that depends on the key and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(doc_id, text, rate, seed=SEED):
    """How often a document comes out."""
    key = F.coalesce(doc_id.cast("string"), F.md5(text), F.lit(""))
    whole = F.floor(rate)
    return whole + (draw(key, seed) < rate - whole).cast("long")


def _targets(docs, weights, share, most):
    """The targets, by one pass over the texts that keeps the sum of each source."""
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    return source_targets(sizes, weights, share, most)


def mix(docs, weights=WEIGHTS, share=SHARE, most=MOST, seed=SEED):
    """The mix itself: every column of ``docs``, each row as often as the mix takes it."""
    targets = written(_targets(docs, weights, share, most), "mix-targets")
    rows = docs.select(F.struct("*").alias("row")).alias("docs")
    joined = rows.join(targets.alias("t"), F.col("row.source").eqNullSafe(F.col("t.source")))
    times = copies(F.col("row.doc_id"), F.col("row.text"), F.col("rate"), seed)
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select(
        "row.*"
    )


def mix_counts(docs, weights=WEIGHTS, share=SHARE, most=MOST, seed=SEED):
    """One row per document: ``doc_id``, ``source``, its ``size``, the ``source_size`` and
    ``target`` of its source, its ``copies`` and the words they hold, ``taken``."""
    sizes = written(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            F.when(F.col("doc_id").isNull(), F.md5("text")).alias("text"),
        ), "mix-sizes",
    )
    targets = source_targets(sizes, weights, share, most)
    joined = sizes.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    )
    times = copies(F.col("doc_id"), F.col("text"), F.col("rate"), seed)
    return joined.withColumn("copies", times).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )
