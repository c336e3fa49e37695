import random
from collections import Counter

from pitchlake.llm import license_scan as x
from pitchlake.llm.decontaminate import words_of

FILLER = [f"word{i}" for i in range(300)]


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for w in a:
        last = 0
        for j, v in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if w == v else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_increasing_and_near_the_longest_common_subsequence():
    r = random.Random(8)
    for _ in range(60):
        t = words_of(x.TEMPLATES["mit"].encode())
        a = [w for w in t if r.random() > 0.1]
        for _ in range(8):
            a.insert(r.randrange(len(a)), r.choice(FILLER).encode())
        pairs = x.align(a, t)
        assert all(a[i] == t[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) >= 0.95 * brute_lcs(a, t) and len(pairs) <= brute_lcs(a, t)


def test_patience_piles():
    r = random.Random(9)
    for _ in range(100):
        v = r.sample(range(50), 12)
        kept = [v[i] for i in x._increasing(v)]
        best = max(bin(m).count("1") for m in range(1 << 12)
                   if all(a < b for s in [[v[i] for i in range(12) if m >> i & 1]] for a, b in zip(s, s[1:])))
        assert kept == sorted(kept) and len(kept) == best


def test_planted_notices_are_found(documents):
    r = random.Random(10)
    rows, want = [], set()
    for i in range(120):
        body = [r.choice(FILLER) for _ in range(r.randint(0, 200))]
        if r.random() < 0.6:
            name = r.choice(sorted(x.TEMPLATES))
            t = x.TEMPLATES[name].upper().split()
            t = [w for k, w in enumerate(t) if len(t) < 20 or k % 12]  # some words lost
            at = r.randint(0, len(body))
            body[at:at] = t
            want.add((i, name))
        rows.append((i, " ".join(body)))
    got = x.scan_licenses(documents(rows)).collect()
    found = {(m.doc_id, m.license) for m in got}
    # a notice may hold another one's line: the longer match stands
    assert want <= found and all(m.coverage >= x.MIN_COVERAGE for m in got)
    assert {d for d, _ in found} == {d for d, _ in want}


def test_two_notices_and_their_places(documents):
    text = "a b Released under the MIT License. c d e All rights reserved"
    got = sorted((m.license, m.coverage, m.first_word, m.last_word) for m in x.scan_licenses(documents([(1, text)])).collect())
    assert got == [("all-rights-reserved", 1.0, 10, 12), ("mit-line", 1.0, 2, 6)]


def test_edge_rows(documents):
    rows = [(1, None), (2, ""), (3, "licensed"), (4, "license " * 20_000), (None, "All rights reserved."), (5, "x " * 80_000 + "ALL RIGHTS RESERVED"),
            (6, "all rights reserved"), (6, "all rights reserved")]
    got = x.scan_licenses(documents(rows, extra=True)).collect()
    assert sorted(str(m.doc_id) for m in got) == ["5", "6", "6", "None"]
    assert x.scan_licenses(documents([]).limit(0)).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {m.doc_id for m in x.scan_licenses(docs).collect()}
    plain = {r.doc_id for r in docs.where("lower(text) rlike 'licensed under|under the mit license|all rights reserved'").collect()}
    assert got == plain  # every planted line, nothing else


def test_near_misses_are_named_by_their_own_license(documents):
    cc = "This work is licensed under a Creative Commons {} License."
    gpl = x.TEMPLATES["gpl-notice"]
    want = {
        "Licensed under CC BY 4.0.": ["cc-by-short-line"],
        "Licensed under CC BY-ND 4.0.": ["cc-by-nd-line"],
        "Licensed under CC BY-NC-SA 4.0.": ["cc-by-nc-sa-line"],
        "Licensed under CC BY-SA 3.0.": ["cc-by-sa-3.0-line"],
        "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.": ["cc-by-nc-line", "cc-by-short-line"],
        cc.format("Attribution 4.0 International"): ["cc-by-line"],
        cc.format("Attribution-ShareAlike 4.0 International"): ["cc-by-sa-notice"],
        cc.format("Attribution-NonCommercial-NoDerivatives 4.0 International"): ["cc-by-nc-nd-notice"],
        cc.format("Attribution-NoDerivs 3.0 Unported"): ["cc-by-nd-3.0-notice"],
        "This work is licensed under the GNU General Public License, version 2.": ["gpl-2-line"],
        "This work is licensed under the GNU Lesser General Public License, version 2.1": ["lgpl-2.1-line"],
        gpl: ["gpl-notice"],
        gpl.replace("General", "Affero General"): ["agpl-notice"],
        gpl.replace("General", "Lesser General"): ["lgpl-notice"],
        gpl.replace("version 3", "version 2"): ["gpl-2-notice"],
        x.TEMPLATES["gpl-notice"].replace("program", "library").replace("General", "Lesser General").replace("version 3", "version 2.1"): ["lgpl-2.1-notice"],
        gpl.replace("program", "library"): ["gpl-notice"],
        gpl.replace("General", "Library General").replace("version 3", "version 2"): ["lgpl-2-notice"],
        "Released under the BSD License.": [],
        "Licensed under the Educational Community License, Version 2.0.": [],
        x.TEMPLATES["apache-2.0-notice"].replace("Apache", "Educational Community").replace("www.apache.org", "opensource.org"): [],
    }
    got = {}
    for m in x.scan_licenses(documents(list(enumerate(want)))).collect():
        got.setdefault(m.doc_id, []).append((m.first_word, m.license))
    assert [[n for _, n in sorted(got.get(i, []))] for i in range(len(want))] == list(want.values())


def test_every_template_is_found_under_its_own_name(documents):
    names = sorted(x.TEMPLATES)
    got = x.scan_licenses(documents([(i, f"a b {x.TEMPLATES[n]} c d") for i, n in enumerate(names)])).collect()
    assert sorted((m.doc_id, m.license, m.coverage) for m in got) == [(i, n, 1.0) for i, n in enumerate(names)]


def _made():
    return [x.Template.of(n, t, x.MIN_COVERAGE, *x.RULES.get(n, ())) for n, t in sorted(x.TEMPLATES.items())]


def test_neighbouring_notices_are_both_found():
    """Ordered pairs of templates, one right after the other or with a few words between."""
    r, made = random.Random(12), _made()
    words = {n: words_of(t.encode()) for n, t in x.TEMPLATES.items()}
    names = [n for n in sorted(words) if not any(v in n for v in ("-1.0-", "-2.5", "nd", "gpl-2", "or-later", "spdx-LGPL"))]
    assert len(names) > 50
    for gap in (0, 3, 12):
        for a in names:
            for b in names if gap == 0 else r.sample(names, 15):
                text = [*words[a], *(r.choice(FILLER).encode() for _ in range(gap)), *words[b]]
                got = Counter(m.license for m in x.scan(text, made))
                assert not Counter([a, b]) - got, (gap, a, b, got)


def test_scan_equals_a_scan_of_every_start():
    r, made = random.Random(13), _made()
    names = sorted(x.TEMPLATES)

    def naive(words):
        found = []
        for t in made:
            n, done = len(t.words), 0
            slack = n // 4 + 2
            for s in range(len(words)):
                if s >= done and (m := x._match(words, max(done, s - slack), min(len(words), s + n + slack), t, x.MIN_COVERAGE)):
                    found.append(m)
                    done = m.last + 1
        found.sort(key=lambda m: (-m.coverage * m.size, -m.size, m.license))
        kept = []
        for m in found:
            if all(m.last < k.first or m.first > k.last for k in kept):
                kept.append(m)
        return sorted(k.license for k in kept)
    for _ in range(12):
        text = []
        for name in r.sample(names, 2):
            text += [w for w in words_of(x.TEMPLATES[name].encode()) if r.random() > 0.05] + [r.choice(FILLER).encode() for _ in range(r.randrange(20))]
        assert sorted(m.license for m in x.scan(text, made)) == naive(text)


def test_siblings_are_told_apart():
    made = _made()
    for text, want in (("SPDX-License-Identifier: BSD-3-Clause", "spdx-BSD-3-Clause"), ("// SPDX-License-Identifier: MIT */", "spdx-MIT"),
                       ("Distributed under the Boost Software License, Version 1.0. (See file)", "boost-1.0-line"),
                       ("Licensed under the EUPL, Version 1.2 or later", "eupl-1.2-line")):
        assert [m.license for m in x.scan(words_of(text.encode()), made)] == [want]
