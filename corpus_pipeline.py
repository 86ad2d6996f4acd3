"""A corpus from raw documents, stage by stage.

Toxic documents go; of exact copies the last one stays; of near copies the first one stays; the
rest is mixed to the target weights of the sources, some documents twice and some not at all;
and every text of the mix is encoded. All stages but the last return the columns of documents.
"""

import public_tokenizers

from meterflow.llm import bpe, exact_dedup, mixing, simhash, toxicity
from meterflow.session import written


def drop_toxic(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, labels)


def drop_exact_copies(spark, docs, sf_dir):
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    return simhash.drop_near_copies(docs)


def mix_sources(spark, docs, sf_dir):
    return mixing.mix(docs)


def encode(spark, docs, sf_dir):
    return bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# SQL can express neither the toxicity model nor the near-duplicate components.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each on the stored rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
