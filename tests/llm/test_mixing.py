import hashlib

import pytest

from pitchlake.llm import mixing as x


def brute_share(budget, children):
    """children: name -> (weight, supply)."""
    got, open_ = {n: 0.0 for n in children}, {n for n, (w, _) in children.items() if w > 0}
    while open_ and budget > 1e-9:
        total = sum(children[n][0] for n in open_)
        full = {n for n in open_ if children[n][1] - got[n] <= budget * children[n][0] / total + 1e-12}
        if not full:
            for n in open_:
                got[n] += budget * children[n][0] / total
            return got
        for n in full:
            budget -= children[n][1] - got[n]
            got[n] = children[n][1]
        open_ -= full
    return got


def test_sharing_moves_shortages_to_siblings_first(spark):
    rows = [("a", "l1", "s1", 100), ("a", "l1", "s2", 10), ("a", "l2", "s3", 40), ("b", "l1", "s4", 500), ("b", "l2", "s5", 5), ("c", "l1", "s6", 7)]
    weights = {("a",): 3.0, ("b",): 1.0, ("c",): 2.0, ("a", "l1"): 5.0, ("a", "l1", "s2"): 4.0}
    leaf = spark.createDataFrame(rows, "domain string, lang string, source string, available bigint")
    for budget in (1, 50, 150, 300, 662, 5000):
        got = {r.source: r.budget for r in x.budgets(leaf, float(budget), weights, 1).collect()}
        supply = lambda *p: sum(n for *q, n in rows if tuple(q[:len(p)]) == p)
        top = brute_share(budget, {d: (weights.get((d,), 1.0), supply(d)) for d in "abc"})
        want = {}
        for d in "abc":
            langs = sorted({q[1] for q in rows if q[0] == d})
            second = brute_share(top[d], {g: (weights.get((d, g), 1.0), supply(d, g)) for g in langs})
            for g in langs:
                leafs = [q for q in rows if q[:2] == (d, g)]
                want |= brute_share(second[g], {q[2]: (weights.get(q[:3], 1.0), q[3]) for q in leafs})
        assert set(got) <= set(want) and all(abs(got.get(s, 0) - want[s]) <= 1 for s in want), budget
        assert sum(got.values()) <= budget


def brute_select(docs, budget, seed):
    """docs: (id, leaf, tokens); whole epochs, then the prefix of the next."""
    out = []
    for leaf, b in budget.items():
        mine = [(i, t) for i, f, t in docs if f == leaf and t]
        total = sum(t for _, t in mine)
        for e in range(b // total):
            out += [(i, e) for i, _ in mine]
        left, e = b % total, b // total
        order = sorted(mine, key=lambda d: hashlib.md5(f"{seed}:{e}:{d[0]}".encode()).hexdigest())
        for i, t in order:
            if t > left:
                break
            left -= t
            out.append((i, e))
    return sorted(out)


@pytest.mark.parametrize("deep", [1, 3])
def test_prefixes_of_seeded_epochs(spark, deep, monkeypatch):
    monkeypatch.setattr(x, "DEEP", deep)
    docs = [(i, "xyz"[i % 7 % 3], (i * 37) % 50) for i in range(900)]
    df = spark.createDataFrame([(i, f, "l", f, t) for i, f, t in docs], "doc_id bigint, domain string, lang string, source string, tokens bigint")
    budget = {"x": 3000, "y": 20_000, "z": 7}
    total = {f: sum(t for _, g, t in docs if g == f) for f in "xyz"}
    plan = spark.createDataFrame([(f, "l", f, total[f], b) for f, b in budget.items()],
                                 "domain string, lang string, source string, available bigint, budget bigint")
    got = sorted((r.doc_id, r.epoch) for r in x.select_tokens(df, plan, 5).collect())
    assert got == brute_select(docs, budget, 5)


def test_edge_rows(documents):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "w " * 50_000, None, None), (None, "a b", "en", "b"), (4, "a b c", "de", "b"),
            (5, "d e", "de", "b"), (5, "d e", "de", "b")]
    df = documents(rows, extra=True)
    got = x.mix(df, share_of_tokens=1.0, weights={}).collect()
    assert all(r.tokens > 0 for r in got) and {r.doc_id for r in got} <= {3, None, 4, 5}
    assert {(r.lang, r.source) for r in got if r.doc_id == 3} <= {("unknown", "unknown")}
    assert sum(r.tokens for r in got) <= 50_009
    assert x.mix(documents([]).limit(0)).collect() == []


def test_weight_zero_gets_nothing(documents):
    rows = [(i, "some words here", "en", f"src{i % 5}") for i in range(50)]
    df = documents(rows)
    names = {r.domain for r in x.mix(df, weights={}).collect()}
    gone = sorted(names)[0]
    assert gone not in {r.domain for r in x.mix(df, weights={(gone,): 0.0}).collect()}


def test_plan_has_no_python(spark):
    plan = x.op7_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
