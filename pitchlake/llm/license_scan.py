"""License scan by patience alignment against license texts.

Texts and templates are compared as words (0-9, a-z and non-ASCII runs, A-Z
lower-cased).  To align two word ranges, the words unique to both are
anchors; the longest increasing subsequence of their places is kept, and the
gaps between kept anchors are aligned in the same way.  A gap without
anchors is matched from both ends as far as the words agree.  Matched
template words over all template words is the coverage; a match needs
MIN_COVERAGE, and must fill MIN_DENSITY of the text range that it spans.

Notices of sibling licenses differ by the few words that name the license.
So each template has words that must be matched, and words of its siblings
that may not stand in the matched range (RULES): a notice whose naming words
no template has is not reported under another license's name.

Where to align: a match leaves out less than ``1 - MIN_COVERAGE`` of its
template, so of any set of template places that is larger than that, one is
matched.  Each template's key words are such a set, longest words first, or
the first of the words that must be matched.  A
document without any key word is done; otherwise each place of a key word
puts the template's start at a few text places, and the range around each is
aligned, left to right, going on behind a match.  So the scan reads whole
texts, and its cost follows the number of key words in them.

All work is per document and map-only.  Defined results: null, empty or
wordless texts match nothing and give no row; equal coverage at one place is
settled for the template with more words, then by name; repeated rows and a
null doc_id are scanned each.  Further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import in_slices, table, utf8_values
from pitchlake.llm.decontaminate import words_of

MIN_COVERAGE, MIN_DENSITY = 0.8, 0.6
FOREIGN = 0.5    # what a foreign word between matched ones costs

# Notices of public licenses, as their stewards publish them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."),
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."),
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "artistic-2.0-line": "This is free software, licensed under: The Artistic License 2.0.",
    "boost-1.0-line": "Distributed under the Boost Software License, Version 1.0.",
    "bsd-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."),
    "cc0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "cddl-notice": (
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the "
        "\"License\"). You may not use this file except in compliance with the License."),
    "epl-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0"),
    "eupl-1.2-line": "Licensed under the EUPL, Version 1.2.",
    "wtfpl-notice": (
        "This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can "
        "redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2, as "
        "published by Sam Hocevar."),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:"),
}

#: template -> words that must be matched; words or phrases, by commas, that may not stand in the matched range
RULES: dict[str, tuple[str, str]] = {
    "all-rights-reserved": ("reserved all rights", ""), "apache-2.0-notice": ("apache 2 0", ""), "apache-2.0-line": ("apache 2 0", ""),
    "bsd-conditions": ("redistributions", ""), "bsd-disclaimer": ("disclaimed", ""), "isc": ("granted fee", ""),
    "mit": ("sublicense", ""), "mit-line": ("mit", ""), "mpl-2.0-notice": ("mozilla 2 0", ""), "unlicense": ("unencumbered", ""),
    "artistic-2.0-line": ("artistic 2 0", ""), "boost-1.0-line": ("boost 1 0", ""), "bsd-endorsement": ("endorse neither", ""),
    "cc0-notice": ("waived neighboring", ""), "cddl-notice": ("development distribution", ""), "epl-2.0-notice": ("eclipse 2 0", ""),
    "eupl-1.2-line": ("eupl 1 2", ""), "wtfpl-notice": ("what want", ""), "zlib": ("alter freely", ""),
}

# License identifiers in source files.
for _id in ("0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
            "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0-only", "GPL-2.0-or-later",
            "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
            "MIT", "MPL-2.0", "Unlicense", "WTFPL", "Zlib"):
    TEMPLATES[f"spdx-{_id}"] = f"SPDX-License-Identifier: {_id}"
    RULES[f"spdx-{_id}"] = (f"spdx license identifier {_id.lower()}", "licensed")

# The GNU licenses: name, words before General, version, what it covers.
for _name, _kind, _version, _what in (
        ("gpl", "", "3", "program"), ("gpl-2", "", "2", "program"), ("agpl", "Affero ", "3", "program"),
        ("lgpl", "Lesser ", "3", "library"), ("lgpl-2.1", "Lesser ", "2.1", "library"), ("lgpl-2", "Library ", "2", "library")):
    TEMPLATES[f"{_name}-line"] = f"This work is licensed under the GNU {_kind}General Public License, version {_version}."
    TEMPLATES[f"{_name}-notice"] = (
        f"This {_what} is free software: you can redistribute it and/or modify it under the terms of the GNU {_kind}General Public "
        f"License as published by the Free Software Foundation, either version {_version} of the License, or (at your option) any "
        f"later version. This {_what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        f"even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {_kind}General Public "
        "License for more details.")
    _digits = _version.replace(".", " ")
    _others = {"affero", "lesser", "library general"} - {_kind.lower().strip(), f"{_kind.lower()}general"}
    RULES[f"{_name}-line"] = RULES[f"{_name}-notice"] = (f"{_kind.lower()}gnu general {_digits}", ", ".join(sorted(_others)))

# The Creative Commons licenses, by their parts and version; version 4.0 has no number in its name.
_PARTS = {"sa": "ShareAlike", "nc": "NonCommercial", "nd": "NoDerivatives"}
_OTHER_PARTS = {"sa": "sa, sharealike, share alike", "nc": "nc, noncommercial, non commercial",
                "nd": "nd, noderivatives, noderivs, no derivatives, no derivative"}
for _parts in ((), ("sa",), ("nd",), ("nc",), ("nc", "sa"), ("nc", "nd")):
    for _version in ("4.0", "3.0", "2.5", "2.0", "1.0"):
        _name = "-".join(["cc-by", *_parts, *([] if _version == "4.0" else [_version])])
        _long = "-".join(["Attribution", *(_PARTS[q] if _version == "4.0" or q != "nd" else "NoDerivs" for q in _parts)])
        _place = {"4.0": "International ", "3.0": "Unported "}.get(_version, "Generic ")
        _digits = _version.replace(".", " ")
        _others = ", ".join(v for q, v in _OTHER_PARTS.items() if q not in _parts)
        _long_name, _short_name = (f"{_name}-notice", f"{_name}-line") if _parts else (f"{_name}-line", f"{_name}-short-line")
        TEMPLATES[_long_name] = f"This work is licensed under a Creative Commons {_long} {_version} {_place}License."
        RULES[_long_name] = (f"creative commons {_long.lower().replace('-', ' ')} {_digits}", _others)
        TEMPLATES[_short_name] = f"Licensed under CC {'-'.join(['BY', *map(str.upper, _parts)])} {_version}."
        RULES[_short_name] = (f"cc by {' '.join(_parts)} {_digits}", _others)


def _increasing(places: Sequence[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence (patience piles)."""
    tops, pile, back = [], [], []
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        if k == len(tops):
            tops.append(p)
            pile.append(i)
        else:
            tops[k], pile[k] = p, i
        back.append(pile[k - 1] if k else -1)
    out, i = [], pile[-1] if pile else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: Sequence[bytes], template: Sequence[bytes]) -> list[tuple[int, int]]:
    """Matched (text place, template place) pairs, increasing in both.

    What stands before the first anchor is matched from the anchor backwards,
    and what follows the last one forwards: words at the far ends belong to
    what surrounds the notice."""
    pairs, todo = [], [(0, len(text), 0, len(template), True, True)]
    while todo:  # an explicit stack: gaps may nest as deep as the texts are long
        a, b, c, d, first, last = todo.pop()
        if a >= b or c >= d:
            continue
        seen, wanted = Counter(text[a:b]), Counter(template[c:d])
        at = {w: j for j, w in enumerate(template[c:d], c) if wanted[w] == 1 and seen.get(w) == 1}
        anchors = [(i, at[w]) for i, w in enumerate(text[a:b], a) if w in at]
        if anchors:
            kept = [anchors[k] for k in _increasing([j for _, j in anchors])]
            pairs += kept
            for n, ((i, j), (k, m)) in enumerate(zip([(a - 1, c - 1), *kept], [*kept, (b, d)])):
                todo.append((i + 1, k, j + 1, m, first and n == 0, last and n == len(kept)))
            continue
        while (not first or last) and a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while (not last or first) and a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
    return sorted(pairs)


def trimmed(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The run of pairs worth most, where a pair counts 1 and a foreign word
    between two pairs FOREIGN less: stray words at the ends, parted from the
    notice by other text, go."""
    best = total = 0.0
    start, span = 0, (0, 0)
    for k, (i, _) in enumerate(pairs):
        total -= FOREIGN * (i - pairs[k - 1][0] - 1) if k else 0
        if total <= 0:
            start, total = k, 0.0
        total += 1
        if total > best:
            best, span = total, (start, k + 1)
    return list(pairs[span[0]:span[1]])


@dataclass
class Template:
    name: str
    words: list[bytes]
    starts: dict[bytes, list[int]]  # key word -> its places
    required: frozenset[bytes] = frozenset()   # must be matched
    forbidden: tuple[list[bytes], ...] = ()    # phrases that may not stand in the matched range

    @classmethod
    def of(cls, name: str, text: str, coverage: float, required: str = "", forbidden: str = "") -> Template:
        words = words_of(text.encode())
        needs, bars = words_of(required.encode()), tuple(w for p in forbidden.split(",") if (w := words_of(p.encode())))
        if needs:
            return cls(name, words, {needs[0]: [i for i, x in enumerate(words) if x == needs[0]]}, frozenset(needs), bars)
        needed = int((1 - coverage) * len(words) + 1e-9) + 1
        starts: dict[bytes, list[int]] = {}
        held = 0
        for w in sorted(set(words), key=lambda w: (-len(w), w)):
            if held >= needed:
                break
            starts[w] = [i for i, x in enumerate(words) if x == w]
            held += len(starts[w])
        return cls(name, words, starts, forbidden=bars)


@dataclass
class Match:
    license: str
    coverage: float
    first: int
    last: int
    size: int


def _pieces(words: list[bytes], low: int, high: int, forbidden: Sequence[list[bytes]]) -> list[tuple[int, int]]:
    """The range cut at the first words of forbidden phrases."""
    cuts = sorted({i for p in forbidden for i in range(low, high) if words[i] == p[0] and words[i:i + len(p)] == p})
    return [(a, b) for a, b in zip([low, *(i + 1 for i in cuts)], [*cuts, high]) if a < b]


def _match(words: list[bytes], low: int, high: int, t: Template, coverage: float) -> Match | None:
    """The first match of a template within a range."""
    n = len(t.words)
    for a, b in _pieces(words, low, high, t.forbidden):
        if b - a < coverage * n - 1e-9:
            continue
        pairs = trimmed(align(words[a:b], t.words))
        if len(pairs) < coverage * n - 1e-9 or not t.required <= {t.words[j] for _, j in pairs}:
            continue
        first, end = a + pairs[0][0], a + pairs[-1][0]
        if len(pairs) >= MIN_DENSITY * (end - first + 1):
            return Match(t.name, len(pairs) / n, first, end, n)
    return None


def scan(words: list[bytes], templates: Sequence[Template], coverage: float = MIN_COVERAGE) -> list[Match]:
    """All matches in one text, best first where they overlap."""
    found: list[Match] = []
    places: dict[bytes, list[int]] = {}
    keys = {w for t in templates for w in t.starts}
    for i, w in enumerate(words):
        if w in keys:
            places.setdefault(w, []).append(i)
    for t in templates:
        n = len(t.words)
        slack = n // 4 + 2
        starts = sorted({max(0, p - o) for w, os in t.starts.items() for p in places.get(w, ()) for o in os})
        done = 0
        for s in starts:
            if s < done:
                continue
            low, high = max(done, s - slack), min(len(words), s + n + slack)
            if (m := _match(words, low, high, t, coverage)) is not None:
                found.append(m)
                done = m.last + 1
    found.sort(key=lambda m: (-m.coverage * m.size, -m.size, m.license))
    kept: list[Match] = []
    for m in found:
        if all(m.last < k.first or m.first > k.last for k in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: m.first)


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = MIN_COVERAGE,
                  rules: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, license, coverage, first_word, last_word), one row per match.

    ``rules``: per template, the words that must be matched and those that may
    not stand in the matched range (RULES for the given templates)."""
    given = dict(templates)
    ruled = dict(RULES if rules is None and templates is TEMPLATES else rules or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [Template.of(name, text, coverage, *ruled.get(name, ())) for name, text in sorted(given.items())]
        made = [t for t in made if t.words]
        keys = {w for t in made for w in t.starts}
        for b in in_slices(batches, "text"):
            rows = []
            for doc, raw in zip(b.column("doc_id").to_pylist(), utf8_values(b.column("text"))):
                words = words_of(raw)
                if not keys.isdisjoint(words):
                    rows += [(doc, m.license, m.coverage, m.first, m.last) for m in scan(words, made, coverage)]
            if rows:
                kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)],
                                                 ["doc_id", "license", "coverage", "first_word", "last_word"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, license string, coverage double, first_word bigint, last_word bigint")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in ``documents``."""
    return scan_licenses(table(spark, sf_dir, "documents"))
