import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.llm import toxicity
from meterflow.llm.boosting import Isotonic, Trees

from .conftest import AWKWARD


def corpus(n=900, seed=1):
    """Toxic texts hold words with invented beginnings."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        words = ["".join(rng.choice(["ba", "do", "ki", "mu", "te"]) for _ in range(rng.randint(1, 4)))
                 for _ in range(60)]
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = "zorgak" + rng.choice(["a", "en", "ist", "um", "ot"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(make_docs, spark):
    rows, labels = corpus()
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_scored_right(tables):
    docs, labels = tables
    found = toxicity.score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert 100 < len(held) < 300
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_labels_of_held_out_rows_have_no_effect(tables):
    docs, labels = tables
    hidden = toxicity.held_out(F.col("doc_id"), 5)
    turned = labels.withColumn("toxic", F.when(hidden, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [dict(toxicity.score_documents(docs, some).select("doc_id", "score").collect())
              for some in (labels, turned)]
    assert scores[0] == scores[1]


def test_drop_toxic(tables, make_docs):
    docs, labels = tables
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.dtypes == docs.dtypes
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    assert len(ids & toxic) <= 3 and len(ids) >= docs.count() - len(toxic) - 10


def test_awkward_tables(awkward, empty, spark):
    labels = spark.createDataFrame(
        [(4, 1, 1), (4, 1, 0), (None, 1, 1), (6, None, None), (9, 0, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int")
    assert toxicity.score_documents(awkward, labels).count() == len(AWKWARD)
    none = labels.limit(0)
    rows = toxicity.score_documents(awkward, none).collect()
    assert {r.score for r in rows} == {0.0} and len(rows) == len(AWKWARD)
    assert toxicity.score_documents(empty, labels).count() == 0


def test_weight_alone_makes_the_lexicon(make_docs, spark):
    """Every token of three toxic texts and no clean one is in, however many there are."""
    toxic = " ".join(f"w{i}x" for i in range(25_000)) + " " + "z" * 70
    rows = [(i, toxic if i % 2 else "plain words here") for i in range(40)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)],
                                   "doc_id long, quality int, toxic int")
    weights = toxicity.fit(make_docs(rows), labels).weights
    assert {f"w{i}x".encode() for i in range(25_000)} <= weights.keys()
    assert b"z" * 70 not in weights and b"zzzzzz*" in weights


def test_features():
    plain = toxicity.features("You are an IDIOT, you id1ot! m.o.r.o.n", {})
    named = dict(zip(toxicity.NAMES, plain))
    assert named["insult_words"] == 1 and named["hidden_insults"] == 2
    assert named["near_address"] == 2 and named["exclamations"] > 0
    assert toxicity.features(None, {}) == toxicity.features("", {})


def test_trees_learn_a_corner():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = (x[:, 0] > 0.6) & (x[:, 2] < 0.5)
    raw = Trees().fit(x, y).raw(x)
    assert ((raw > 0) == y).mean() > 0.98
    assert np.isfinite(Trees().fit(x, y * 0).raw(x)).all()
    assert len(Trees().fit(np.zeros((0, 4)), np.zeros(0)).raw(x)) == 2000


def test_isotonic_is_the_pooled_mean():
    rng = np.random.default_rng(0)
    raw, y = rng.normal(size=400).round(1), rng.random(400) < 0.4
    fitted = Isotonic().fit(raw, y)
    shares = fitted.share(np.sort(raw))
    assert (np.diff(shares) >= -1e-12).all()
    assert shares.mean() == pytest.approx(y.mean())
    assert Isotonic().fit(np.zeros(0), np.zeros(0)).share(np.ones(2)).tolist() == [0, 0]
