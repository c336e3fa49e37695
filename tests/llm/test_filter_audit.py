"""Filter audit against a plain version; diagrams against direct counts."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from pitchlake.llm import filter_audit as A
from pitchlake.llm.decision_diagram import Diagram, all_orders, exchanges


@pytest.mark.parametrize("n", range(1, 7))
def test_exchanges_visit_every_order(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for level in exchanges(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.add(tuple(order))
    assert seen == set(permutations(range(n))) and len(list(exchanges(n))) == len(seen) - 1


def test_diagram_keeps_counts_in_every_order():
    rng = random.Random(1)
    masks = {m: (rng.randrange(5), rng.randrange(3)) for m in range(16) if rng.random() < 0.7}
    for d in all_orders("ABCD", masks):
        gone = set()
        for name, passed, failed in d.steps():
            bit = "ABCD".index(name)
            left = {m: w for m, w in masks.items() if not any(m >> g & 1 for g in gone)}
            total = lambda ms: tuple(map(sum, zip((0, 0), *ms)))
            assert failed == total(w for m, w in left.items() if m >> bit & 1)
            assert passed == total(w for m, w in left.items() if not m >> bit & 1)
            gone.add(bit)


def test_equal_subdiagrams_are_one_node():
    d = Diagram("ABC", {m: (1,) for m in range(8)})
    assert [len(level) for level in d.levels] == [1, 1, 1]
    d.swap(1)
    assert [len(level) for level in d.levels] == [1, 1, 1] and d.weights[d.root] == (8,)


def plain(rows, labels):
    texts, fails = {}, []
    for doc, text, source in rows:
        if doc is not None:
            texts.setdefault(text or "", set()).add(doc)
    for doc, text, source in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": doc is not None and min(texts[t]) < doc}
        fails.append((source or "", f, any(d == doc and q == 1 for d, q, _ in labels if d is not None), any(d == doc and x == 1 for d, _, x in labels if d is not None)))
    out = []
    for part in {x[0] for x in fails}:
        own = [x[1:] for x in fails if x[0] == part]
        steps, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = own
            for k, name in enumerate(order, 1):
                gone, left = [x for x in left if x[0][name]], [x for x in left if not x[0][name]]
                shapley[name] += len(gone)
                steps.append((part, "".join(order), k, len(left), len(gone), sum(x[0][name] for x in own) - len(gone),
                              sum(x[0][name] and sum(x[0].values()) == 1 for x in own), sum(x[1] for x in gone), sum(x[2] for x in gone), name))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def test_equals_plain_version(spark, documents):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)] + ["Üb", "ÄÖ", " "]
    texts = ["", None, "SHOUT " * 210, "a & b", "plain words only"]
    texts += [" ".join(rng.choice(words[:rng.choice([20, 400])]) for _ in range(rng.randrange(150, 260))) + rng.choice(["", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 4]) for _ in range(30)]
    rows = [(i if rng.random() < 0.95 else None, rng.choice(texts), rng.choice(["s1", "s2", None, ""])) for i in range(200)]
    rows += [rows[0], rows[1], (3, "under id 3 also", "s2"), (500, "\n", "s1")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 220, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    docs = documents([(d, t, "en", s) for d, t, s in rows], extra=True)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "'x' as text", "1 as mask", "2 as part")
    got = sorted(tuple(r) for r in A.interactions(docs, table).collect())
    assert got == plain(rows, labels)


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert A.interactions(documents([(1, "x")]).limit(0), labels).count() == 0
    assert A.interactions(documents([(1, "x")]), labels).count() == 600
