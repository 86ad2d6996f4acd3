import random

import pytest

from meterflow.llm import license_scan
from meterflow.llm.license_scan import TEMPLATES, align, matches, rising, templates

from .conftest import AWKWARD

KNOWN = templates()


def test_every_template_is_found_in_itself():
    for name, text in TEMPLATES:
        found = matches(f"Some words. {text} Other words.", KNOWN)
        assert [(m[0], m[3]) for m in found] == [(name, 1.0)]


@pytest.mark.parametrize("text, names", [
    ("Licensed under CC BY-NC 4.0.\nx y\nLicensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"] * 2),
    ("LICENSED UNDER CC BY 4.0", ["cc-by-4.0"]),
    ("Licensed under the new Apache License, Version 2.0", ["apache-2.0"]),
    ("a licensed driver went under the bridge", []),
    ("All of the rights were once reserved", []),
    (None, []), ("", []),
    ("This work is licensed under the GNU General Public License, version 2.", ["gpl-2.0"]),
    (TEMPLATES[4][1].replace("persons", "people").replace("merge, ", ""), ["mit"]),
])
def test_names(text, names):
    assert [m[0] for m in matches(text, KNOWN)] == names


def test_spans_are_code_points():
    text = "éé\n" * 50_000 + "All rights reserved. ß"
    assert matches(text, KNOWN) == [("all-rights-reserved", 150_000, 150_019, 1.0)]


def test_rising_is_longest():
    rng = random.Random(1)
    for _ in range(200):
        places = rng.sample(range(12), rng.randint(0, 9))
        best = [1] * len(places)
        for i in range(len(places)):
            best[i] += max((best[j] for j in range(i) if places[j] < places[i]), default=0)
        found = rising(list(enumerate(places)))
        assert len(found) == max(best, default=0)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(found, found[1:]))


def test_alignment_joins_equal_words_in_order():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 20))]
        b = [x for x in a if rng.random() < 0.8] + [rng.choice("xyz") for _ in range(rng.randint(0, 3))]
        pairs = align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(align(list("abcde"), list("abXde"))) == 4


def test_documents(make_docs, awkward, empty):
    docs = make_docs([(1, "x All rights reserved. Released under the MIT License."), (2, None)])
    found = {r.doc_id: r for r in license_scan.scan_documents(docs).collect()}
    assert found[1].licenses == "all-rights-reserved,mit" and found[1].n_matches == 2
    assert found[1].coverage == 1.0 and found[2].matches == ""
    assert license_scan.scan_documents(awkward).count() == len(AWKWARD)
    assert license_scan.scan_documents(empty).count() == 0


@pytest.mark.parametrize("text, names", [
    ("Released under the BSD License.", ["bsd"]),
    ("Licensed under the Apache License.", ["apache"]),
    ("Licensed under the Apache License v2.0", ["apache-2.0"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
     "License.", ["cc-by-nc-4.0"]),
    ("This work is licensed under a Creative Commons Attribution-Share Alike 3.0 Unported License.",
     ["cc-by-sa-3.0"]),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", ["lgpl-3.0"]),
    ("This work is licensed under the GNU Affero General Public License, version 3.", ["agpl-3.0"]),
    ("This work is licensed under the GNU Free Documentation License, version 3.", []),
    ("Licensed under the Eclipse Public License 2.0", ["epl-2.0"]),
    ("Released under the MIT License. " * 5, ["mit"] * 5),
    ("Licensed under CC BY 4.0. " * 4, ["cc-by-4.0"] * 4),
])
def test_names_of_other_licenses(text, names):
    assert [m[0] for m in matches(text, KNOWN)] == names


def test_full_texts():
    for name, text in license_scan._full():
        half = len(text) // 2
        for made in (text, text.replace("work", "job", 3), text[:half] + " one more " + text[half:]):
            found = matches(f"A readme of a program. {made} The end of it.", KNOWN)
            assert [m[0] for m in found] == [name]
            assert found[0][2] - found[0][1] > 0.95 * len(text.strip())
    affero = dict(license_scan._full())["gpl-3.0"].replace(
        "GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE", 1)
    affero = affero.replace("29 June", "19 November", 1)
    assert "gpl-3.0" not in [m[0] for m in matches(affero, KNOWN)][:1]


@pytest.mark.parametrize("text, names", [
    ("# SPDX-License-Identifier: Apache-2.0\nimport os", ["apache-2.0"]),
    ("// SPDX-License-Identifier: GPL-3.0-or-later", ["gpl-3.0"]),
    ("SPDX-License-Identifier: LGPL-2.1-only", ["lgpl-2.1"]),
    ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4.0"]),
    ("SPDX-License-Identifier: BSD-2-Clause and more", ["bsd-2-clause"]),
    ("It has the BSD 3-Clause license.", ["bsd-3-clause"]),
    ("Licensed under the 4-clause BSD license.", ["bsd-4-clause"]),
    ("This code is MIT licensed.", ["mit"]), ("Unlicense", ["unlicense"]),
    ("The MIT License (MIT)", ["mit"]),
    ("the identifier of a license", []), ("an MIT professor licensed it", []),
    ("BSD systems have three licenses", []), ("The license of MIT", []),
])
def test_short_forms(text, names):
    assert [m[0] for m in matches(text, KNOWN)] == names


def test_bsd_clauses_are_told_apart():
    for name, text in TEMPLATES:
        if name.startswith("bsd-") and len(text) > 200:
            changed = text.replace("above copyright notice", "copyright notice above", 1)
            assert [m[0] for m in matches(f"A. {changed} B.", KNOWN)] == [name]


def longest_common(a, b, a_from=0, a_to=None, b_from=0, b_to=None):
    """Places of a longest common subsequence, by the table of all pairs."""
    rows, cols = range(a_from, a_to), range(0, len(b))
    best = {}
    for i in reversed(rows):
        for j in reversed(cols):
            best[i, j] = (1 + best.get((i + 1, j + 1), 0) if a[i] == b[j]
                          else max(best.get((i + 1, j), 0), best.get((i, j + 1), 0)))
    pairs, i, j = [], a_from, 0
    while i < a_to and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best.get((i + 1, j), 0) >= best.get((i, j + 1), 0):
            i += 1
        else:
            j += 1
    return pairs


def test_against_a_plain_alignment_at_every_place(monkeypatch):
    """Notices between other words, some changed: what is found is what the longest common
    subsequence with every stretch of the text tells."""
    draw = random.Random(8)
    short = [(name, text) for name, text in TEMPLATES if len(text) < 90]
    others = "the of work version under public a in to general open free source terms".split()
    texts = []
    for _ in range(10):
        parts = []
        for name, text in draw.sample(short, 2):
            words = text.split()
            if draw.random() < 0.4 and len(words) > 5:
                words.insert(draw.randrange(1, len(words)), "new")
            parts += draw.choices(others, k=draw.randint(6, 9)) + words
        texts.append(" ".join(parts + draw.choices(others, k=6)))
    found = [[m[:3] for m in matches(text, KNOWN)] for text in texts]
    assert sum(map(len, found)) > 15
    small = [t for t in KNOWN if len(t.words) < 16]
    monkeypatch.setattr(license_scan, "align", longest_common)
    for text, got in zip(texts, found):
        words, spans = license_scan.words_of(text)
        best = []
        for template in small:
            if not template.required <= set(words):
                continue
            for start in range(len(words)):
                for end in (start + len(template.words), start + len(template.words) + template.slack):
                    match = template.match(words, start, end, license_scan.COVERAGE)
                    if match:
                        best.append((-match[0], -match[1], template.name, *match[2:]))
        taken, kept = set(), []
        for _, _, name, first, last in sorted(best):
            if not taken & set(range(first, last + 1)):
                taken |= set(range(first, last + 1))
                kept.append((name, spans[first][0], spans[last][1]))
        assert [m[0] for m in got] == [m[0] for m in sorted(kept, key=lambda m: m[1])], text
