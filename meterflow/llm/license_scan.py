"""License scans by patience alignment.

A template's words are aligned with the words of a text around each place where a telling word of
the template occurs. Words that occur once in both are anchors; their longest increasing
subsequence is kept, and the gaps between two anchors are aligned in the same way, where other
words may be unique. A gap without such words gives what its ends have in common. Coverage is the
share of the template's words that are aligned; a match has ``COVERAGE`` of them, and three
quarters of the text's words from the first to the last aligned one are among them. Words that
tell licenses apart, their names and version numbers, all have to be aligned, and a match holds no
such word of another license ("Lesser", "Affero", "NonCommercial", ...). Where notices follow each
other, the words around make none unique; there the alignment is tried at the template's own
extent. Of overlapping matches the one with more aligned words stays, less the missing ones and
those between, then the one with the higher coverage, then the first name.

The full texts of licenses lie in ``licenses``. They are aligned where five words in a row occur
that the full text has once.

Case, punctuation, line breaks, and a "v" or ".0" of a number do not count; positions are code
points, the end exclusive.

Defined cases: null counts as the empty text, which has no match. A license line that occurs
several times is found each time. Texts are scanned whole. Repeated rows each get their row. An
empty table gives no rows. Other columns may have any name.
"""

import pkgutil
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import product

import pandas as pd

from meterflow.llm.common import small_batches

COVERAGE = 0.8
DENSITY = 0.75

# Notices as their licenses word them.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not
        use this file except in compliance with the License. You may obtain a copy of the License
        at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
        to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
        for the specific language governing permissions and limitations under the License."""),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with
        or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies."""),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", """This program is free software; you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation;
        either version 2 of the License, or (at your option) any later version."""),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License,
        v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/."""),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
    ("cc-by-4.0", """This work is licensed under a Creative Commons Attribution 4.0 International
        License."""),
    ("cc0-1.0", """To the extent possible under law, the author has waived all copyright and related
        or neighboring rights to this work."""),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
    ("bsd", "Released under the BSD License."),
    ("bsd", "Licensed under the BSD License."),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met: 1.
        Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution."""),
    ("bsd-3-clause", """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met: 1.
        Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. 3. Neither the name of
        the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission."""),
    ("bsd-4-clause", """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met: 1.
        Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. 3. All advertising
        materials mentioning features or use of this software must display the following
        acknowledgement: This product includes software developed by the organization. 4. Neither
        the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission."""),
    ("lgpl-2.1", """This library is free software; you can redistribute it and/or modify it under
        the terms of the GNU Lesser General Public License as published by the Free Software
        Foundation; either version 2.1 of the License, or (at your option) any later version."""),
    ("lgpl-3.0", """This program is free software: you can redistribute it and/or modify it under
        the terms of the GNU Lesser General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("agpl-3.0", """This program is free software: you can redistribute it and/or modify it under
        the terms of the GNU Affero General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("agpl-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("epl-1.0", """All rights reserved. This program and the accompanying materials are made
        available under the terms of the Eclipse Public License v1.0 which accompanies this
        distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"""),
    ("epl-2.0", """This program and the accompanying materials are made available under the terms of
        the Eclipse Public License 2.0 which is available at
        https://www.eclipse.org/legal/epl-2.0/"""),
    ("epl-1.0", """Eclipse Public License - v 1.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE
        TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION OF
        THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT."""),
    ("epl-2.0", """Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE
        TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION OF
        THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT."""),
]
for _name, _title, _versions in (
    ("apache", "Apache License", ("2.0",)), ("mpl", "Mozilla Public License", ("1.1", "2.0")),
    ("gpl", "GNU General Public License", ("2.0", "3.0")),
    ("lgpl", "GNU Lesser General Public License", ("2.1", "3.0")),
    ("agpl", "GNU Affero General Public License", ("3.0",)),
    ("epl", "Eclipse Public License", ("1.0", "2.0")),
):
    TEMPLATES.append((_name, f"Licensed under the {_title}."))
    for _version in _versions:
        TEMPLATES += [
            (f"{_name}-{_version}", f"Licensed under the {_title} {_version}."),
            (f"{_name}-{_version}", f"This work is licensed under the {_title}, version {_version}."),
        ]
_NC = ("NonCommercial", "Non-Commercial")
_SA = ("ShareAlike", "Share Alike")
_ND = ("NoDerivatives", "NoDerivs", "No Derivatives")
for _version, (_name, _parts) in product(("4.0", "3.0"), (
    ("by", ()), ("by-nc", (_NC,)), ("by-sa", (_SA,)), ("by-nd", (_ND,)), ("by-nc-sa", (_NC, _SA)),
    ("by-nc-nd", (_NC, _ND)),
)):
    TEMPLATES.append((f"cc-{_name}-{_version}", f"Licensed under CC {_name} {_version}."))
    for _words in product(*_parts):
        TEMPLATES.append((f"cc-{_name}-{_version}", "This work is licensed under a Creative Commons "
                          f"{'-'.join(('Attribution', *_words))} {_version} International License."))
# Identifiers of the list of licenses of SPDX, and the names they have here.
SPDX = ["MIT", "ISC", "Unlicense", "Apache-2.0", "MPL-1.1", "MPL-2.0", "EPL-1.0", "EPL-2.0", "CC0-1.0",
        "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"]
SPDX += [f"{_id}{_end}" for _id in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
         for _end in ("", "-only", "-or-later")]
SPDX += [f"CC-{_id}-{_version}" for _id in ("BY", "BY-NC", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")
         for _version in ("3.0", "4.0")]
for _id in SPDX:
    _name = _id.lower().removesuffix("-only").removesuffix("-or-later")
    TEMPLATES.append((_name, f"SPDX-License-Identifier: {_id}"))
for _n in "234":
    TEMPLATES += [(f"bsd-{_n}-clause", f"BSD {_n}-Clause License"),
                  (f"bsd-{_n}-clause", f"{_n}-Clause BSD License")]
TEMPLATES += [("mit", "MIT licensed"), ("mit", "The MIT License"), ("unlicense", "Unlicense")]
FULL = ("apache-2.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "mpl-2.0", "cc0-1.0")

# Words that tell licenses apart beside numbers, and those of them that make another
# license of one they are added to.
NAMES = frozenset("""
apache mit bsd isc gnu general mozilla eclipse cc creative cc0 neither endorse spdx gpl lgpl agpl
mpl epl unlicense advertising
""".split())
ADDED = frozenset("""
lesser affero documentation nc sa nd noncommercial commercial sharealike alike noderivatives
noderivs derivatives derivs
""".split())
# Of a full text, only the title tells.
TITLE, SHINGLE, LONG = 8, 5, 300

# Words that tell of a license, at least one of them in every template.
TELLING = frozenset("""
license licensed licenses reserved granted redistribution redistribute mozilla copyright
unencumbered permission cc mit apache bsd eclipse unlicense
""".split())
SIGNS = (b"licen", b"reserved", b"granted", b"redistribut", b"copyright", b"unencumbered",
         b"permission")

WORD = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*", re.ASCII)
NUMBER = re.compile(r"v?([0-9]+(?:\.[1-9][0-9]*)*)(?:\.0)*", re.ASCII)


def _plain(word):
    number = NUMBER.fullmatch(word) if word[-1].isdigit() else None
    return number[1] if number else word


def words_of(text):
    """(words in lower case, their spans)."""
    found = list(WORD.finditer(text))
    return [_plain(m[0].lower()) for m in found], [m.span() for m in found]


class Template:
    def __init__(self, name, text):
        self.name, self.words = name, words_of(text)[0]
        self.slack = max(4, len(self.words) // 4)
        self.telling, self.shingles = defaultdict(list), {}
        self.title = TITLE if len(self.words) > LONG else len(self.words)
        self.required = {word for word in self.words[:self.title]
                         if word in NAMES or word in ADDED or NUMBER.fullmatch(word)}
        if len(self.words) > LONG:
            rows = [tuple(self.words[i:i + SHINGLE]) for i in range(len(self.words) - SHINGLE + 1)]
            once = Counter(rows)
            self.shingles = {row: i for i, row in enumerate(rows) if once[row] == 1}
            return
        for place, word in enumerate(self.words):
            if word in TELLING:
                self.telling[word].append(place)

    def match(self, words, start, end, coverage):
        """(aligned words less missing and added ones, coverage, first, last) in a stretch of a
        text's words, or None."""
        pairs = align(words, self.words, max(0, start), min(len(words), end))
        share = len(pairs) / len(self.words)
        if share < coverage:
            return None
        first, last = pairs[0][0], pairs[-1][0]
        aligned = {i for i, _ in pairs}
        if (len(pairs) < DENSITY * (last - first + 1)
                or not self.required <= {words[i] for i in aligned}
                or any(words[i] in ADDED and i not in aligned
                       for i in range(first, min(last + 1, first + self.title + self.slack
                                                 if self.title < len(self.words) else last + 1)))):
            return None
        missing, more = len(self.words) - len(pairs), last - first + 1 - len(pairs)
        return len(pairs) - missing - more, share, first, last


@lru_cache(maxsize=1)
def _full():
    return [(name, pkgutil.get_data("meterflow.llm", f"licenses/{name}.txt").decode())
            for name in FULL]


def templates(pairs=None):
    return [Template(name, text) for name, text in (TEMPLATES + _full() if pairs is None else pairs)]


def rising(pairs):
    """The longest subsequence of pairs, sorted by their first, whose second rises: piles by
    binary search, with a link from each pair to the top of the pile before."""
    tops, piles, links = [], [], []
    for i, (_, place) in enumerate(pairs):
        pile = bisect_left(tops, place)
        if pile == len(tops):
            tops.append(place)
            piles.append(i)
        else:
            tops[pile], piles[pile] = place, i
        links.append(piles[pile - 1] if pile else -1)
    chain, i = [], piles[-1] if piles else -1
    while i >= 0:
        chain.append(pairs[i])
        i = links[i]
    return chain[::-1]


def align(a, b, a_from=0, a_to=None, b_from=0, b_to=None):
    """Places (i, j) of a patience alignment of the words a and b, both rising."""
    aligned = []
    ranges = [(a_from, len(a) if a_to is None else a_to, b_from, len(b) if b_to is None else b_to)]
    while ranges:
        i, i_end, j, j_end = ranges.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            aligned.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            aligned.append((i_end, j_end))
        if i >= i_end or j >= j_end:
            continue
        counts_a, counts_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {b[k]: k for k in range(j, j_end) if counts_b[b[k]] == 1}
        anchors = rising([(k, place[a[k]]) for k in range(i, i_end)
                          if counts_a[a[k]] == 1 and a[k] in place])
        if not anchors:
            continue
        aligned += anchors
        for (k, m), (k_end, m_end) in zip([(i - 1, j - 1), *anchors], [*anchors, (i_end, j_end)]):
            ranges.append((k + 1, k_end, m + 1, m_end))
    return sorted(aligned)


def matches(text, known, coverage=COVERAGE):
    """(name, start, end, coverage) of the licenses in a text, by start."""
    text = text or ""
    low = text.encode().lower()
    if not any(sign in low for sign in SIGNS):
        return []
    words, spans = words_of(text)
    different = set(words)
    possible = [template for template in known if template.required <= different]
    found = []

    def add(template, match):
        if match:
            number, share, first, last = match
            found.append((-number, -share, template.name, first, last))

    telling = [(place, word) for place, word in enumerate(words) if word in TELLING]
    rows = None
    for template in possible:
        size, slack, seen = len(template.words), template.slack, set()
        if template.shingles:
            if rows is None:
                rows = list(zip(*[words[i:] for i in range(SHINGLE)]))
            for place, row in enumerate(rows):
                at = template.shingles.get(row)
                if at is None or (place - at) // (slack // 2) in seen:
                    continue
                seen.add((place - at) // (slack // 2))
                add(template, template.match(words, place - at - slack, place - at + size + slack,
                                             coverage))
            continue
        for place, word in telling:
            for at in template.telling.get(word, ()):
                start = place - at
                if start in seen:
                    continue
                seen.add(start)
                add(template, template.match(words, start - slack, start + size + slack, coverage)
                    or template.match(words, start, start + size, coverage))
    taken, kept = bytearray(len(words)), []
    for _, share, name, first, last in sorted(found):
        if not any(taken[first:last + 1]):
            taken[first:last + 1] = b"\1" * (last + 1 - first)
            kept.append((name, spans[first][0], spans[last][1], -share))
    return sorted(kept, key=lambda match: match[1])


def scan_documents(docs, coverage=COVERAGE):
    """One row per document: ``doc_id``, ``n_matches``, the different ``licenses``, comma-joined
    by name, the best ``coverage``, and all ``matches`` as name:start:end, comma-joined."""
    def rows(batches):
        known = templates()
        for batch in batches:
            made = []
            for text in batch["text"]:
                found = matches(text, known, coverage)
                made.append((
                    len(found), ",".join(sorted({name for name, *_ in found})),
                    max((share for *_, share in found), default=0.0),
                    ",".join(f"{name}:{start}:{end}" for name, start, end, _ in found),
                ))
            columns = ["n_matches", "licenses", "coverage", "matches"]
            yield pd.concat([batch[["doc_id"]], pd.DataFrame(made, columns=columns)], axis=1)

    small_batches(docs.sparkSession)
    doc_id = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        rows, f"doc_id {doc_id}, n_matches long, licenses string, coverage double, matches string"
    )
