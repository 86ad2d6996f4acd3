from collections import defaultdict
from hashlib import sha256

from meterflow.llm import common, exact_dedup

from .conftest import AWKWARD, LONG


def lower(text):
    return (text or "").encode().lower()


def test_groups_against_plain_comparison(make_docs, awkward):
    rows = AWKWARD + [(20 + i, LONG + "x" * (i % 2)) for i in range(6)]
    rows += [(40 + i, "É" * 50 + "abc"[i % 3]) for i in range(9)] + [(60, "É" * 50 + "A")]
    docs = make_docs(rows)
    groups = defaultdict(list)
    for row in rows:
        groups[lower(row[1])].append(row[0])
    found = exact_dedup.exact_groups(docs).collect()
    assert len(found) == len(rows)
    ids = {sha256(text).hexdigest(): members for text, members in groups.items()}
    kept = defaultdict(int)
    for row in found:
        members = ids[row.text_sha256]
        known = [m for m in members if m is not None]
        assert row.group_size == len(members)
        assert row.keep_id == (max(known) if known else None)
        assert not row.kept or row.doc_id == row.keep_id
        kept[row.text_sha256] += row.kept
    assert set(kept.values()) == {1}
    stay = exact_dedup.drop_exact_copies(docs)
    assert stay.dtypes == docs.dtypes
    assert sorted(lower(r.text) for r in stay.collect()) == sorted(groups)


def test_short_runs_make_many_rounds(make_docs):
    rows = [(i, f"prefix {'ab' * 20} {i % 4} suffix") for i in range(20)]
    numbered = exact_dedup._numbered(make_docs(rows))
    found = exact_dedup.equal_groups(numbered, first_run=1)
    assert found.count() == 20 and found.select("group").distinct().count() == 4


def test_empty_table(empty):
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_exact_copies(empty).count() == 0


def test_hot_groups_are_dealt_to_parts(make_docs, monkeypatch):
    monkeypatch.setattr(common, "PART_ROWS", 3)
    texts = ["Copied TEXT " * 30, "copied text " * 30, "copied text " * 29 + "copied tex. ", "É"]
    rows = [(i, texts[min(i % 5, 3)]) for i in range(100)]
    found = {r.doc_id: r for r in exact_dedup.exact_groups(make_docs(rows)).collect()}
    members = defaultdict(list)
    for i, text in rows:
        members[lower(text)].append(i)
    for i, text in rows:
        same = members[lower(text)]
        assert found[i][1:] == (max(same), len(same), i == max(same), sha256(lower(text)).hexdigest())


def test_digests_need_no_python(awkward, plan):
    digests = awkward.select(exact_dedup.lower_sha256(awkward.text))
    assert "Python" not in plan(digests) and "sha2(" in plan(digests)
