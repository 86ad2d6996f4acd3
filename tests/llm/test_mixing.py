import math
import re

import pytest
from pyspark.sql import functions as F

from meterflow.llm import mixing

from .conftest import AWKWARD


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """{source: target} by sharing again and again what is above a limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def sizes_of(rows):
    sizes = {}
    for _, text, source in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sizes[source] = sizes.get(source, 0) + len(words)
    return sizes


def test_targets_and_sizes(awkward):
    rows = mixing.mix_counts(awkward).collect()
    assert len(rows) == len(AWKWARD)
    sizes = sizes_of(AWKWARD)
    wanted = brute_targets(sizes)
    for row in rows:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(wanted[row.source])
        assert 0 <= row.taken <= 2 * row["size"]
        rate = row.target / row.source_size if row.source_size else 0
        assert row.copies in (math.floor(rate), math.ceil(rate))


def test_many_sources_reach_their_limit_one_by_one(make_docs):
    rows = [(i, "w " * (3 ** (i % 9)), f"s{i % 9}") for i in range(90)]
    found = mixing.source_targets(
        make_docs(rows).select("source", mixing.word_count(F.col("text")).alias("size"))
    )
    wanted = brute_targets(sizes_of(rows))
    for row in found.collect():
        assert row.target == pytest.approx(wanted[row.source])


def test_taken_words_come_near_the_target(make_docs):
    rows = [(i, "word " * (1 + i % 7), "hot" if i % 3 == 0 else f"s{i % 8}") for i in range(6000)]
    docs = make_docs(rows)
    counts = mixing.mix_counts(docs)
    by_source = counts.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("t"))
    for row in by_source.collect():
        assert row.taken == pytest.approx(row.t, rel=0.1)
    again = mixing.mix_counts(docs.repartition(3))
    key = ["doc_id", "taken"]
    assert sorted(counts.select(key).collect()) == sorted(again.select(key).collect())


def test_mix_repeats_whole_rows(awkward, empty):
    mixed = mixing.mix(awkward)
    assert mixed.dtypes == awkward.dtypes
    times = {(r.doc_id, r.text): r.copies for r in mixing.mix_counts(awkward).join(
        awkward.select("doc_id", "text"), "doc_id").collect()}
    for row in mixed.groupBy("doc_id", "text").count().collect():
        if row.doc_id not in (None, 4):
            assert row["count"] == times[row.doc_id, row.text]
    assert mixing.mix(empty).count() == 0 and mixing.mix_counts(empty).count() == 0


def test_no_words_at_all(make_docs):
    docs = make_docs([(1, None, "a"), (2, " ", "b")])
    assert {(r.target, r.taken) for r in mixing.mix_counts(docs).collect()} == {(0.0, 0)}


def test_plan_is_native(awkward, plan):
    assert "Python" not in plan(mixing.mix_counts(awkward))
    assert "Python" not in plan(mixing.mix(awkward))
