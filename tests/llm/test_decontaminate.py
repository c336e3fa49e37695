import hashlib
import random
import re

import pytest

from pitchlake.llm import decontaminate as x

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    out = []
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[j:j + n]), set()).add("null" if i is None else str(i))
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(k) for k in wins}:
            for p in range(len(w) - size + 1):
                if (ids := wins.get(tuple(w[p:p + size]))):
                    hit |= set(range(p, p + size))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def result(spark, df, items, **kw):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted([tuple(r) for r in x.contamination(df, bench, **kw).select(*COLUMNS).collect()], key=str)


def make(seed, vocabulary=6, docs=60, items=12):
    r = random.Random(seed)
    text = lambda n: " ".join(r.choice("abcdefghij"[:vocabulary]) for _ in range(n))
    bench = [(k, text(r.choice([1, 2, 3, 9, 10, 14, 25]))) for k in range(items)]
    rows = []
    for i in range(docs):
        t = text(r.randint(0, 40))
        if r.random() < 0.4:
            t += ". " + r.choice(bench)[1].upper() + "! " + text(5)
        rows.append((i, t))
    return rows, bench


@pytest.mark.parametrize("seed,vocabulary", [(1, 2), (2, 4), (3, 10)])
def test_random(spark, documents, seed, vocabulary):
    rows, bench = make(seed, vocabulary)
    assert result(spark, documents(rows), bench) == brute(rows, bench)


def test_blocks_give_the_same(spark, documents):
    rows, bench = make(4, 3)
    rows += [(5, rows[5][1]), (None, rows[7][1])]
    assert result(spark, documents(rows), bench, block_bytes=40) == brute(rows, bench)


def test_edge_rows(spark, documents):
    item = "One two, three four FIVE six seven eight nine ten eleven"
    rows = [(1, None), (2, ""), (3, "..."), (4, f"x {item.lower()} y"), (4, f"x {item.lower()} y"), (None, item), (5, "été naïf"),
            (6, "z " * 60_000 + item), (7, "ten eleven")]
    bench = [(10, item), (10, "été naïf"), (None, item), (11, None), (12, "")]
    assert result(spark, documents(rows, extra=True), bench) == brute(rows, bench)


def test_empty_tables(spark, documents):
    assert result(spark, documents([]).limit(0), [(1, "a b")]) == []
    assert result(spark, documents([(1, "a b")]), []) == brute([(1, "a b")], [])


def test_longest_match_and_place(spark, documents):
    item = " ".join(f"w{k}" for k in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    r = x.contamination(documents([(1, "a b " + " ".join(item.split()[3:17]) + " c")]), bench).first()
    assert (r.longest_match, r.longest_at) == (14, 2)


def test_removal_keeps_clean_rows_and_columns(spark, documents):
    rows, bench = make(6, 8)
    df = documents(rows, extra=True)
    got = x.remove_contaminated(df, spark.createDataFrame(bench, "item_id bigint, text string"), block_bytes=60)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [r[0] for r in sorted(brute(rows, bench)) if not r[5]]


def test_suffix_array_is_sorted():
    rows, _ = make(7, 3)
    shard = x.Shard([t.encode() for _, t in rows], 30)
    suffix = [tuple(shard.seq[a:a + 30]) for a in shard.array]
    assert suffix == sorted(suffix)


def test_a_text_of_millions_of_distinct_words():
    item = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"
    raw = (" ".join(f"{i:x}z" for i in range(2_100_000)) + f" {item} end").encode()
    queries = x.Queries([("7", x.words_of(item.encode()))], x.WINDOW)
    n, spans, items, best, at = queries.hits(x.Shard([raw, b"w3 w4"], queries.longest))
    assert list(n) == [2_100_013, 2] and spans == [[2_100_000, 2_100_012], []] and items == [["7"], []]
    assert (best[0], at[0]) == (12, 2_100_000)


@pytest.mark.parametrize("seed,vocabulary,block_bytes", [(11, 3, 1 << 20), (12, 8, 1 << 20), (13, 5, 60)])
def test_longest_matches_of_any_length_and_spans(spark, documents, seed, vocabulary, block_bytes):
    rows, bench = make(seed, vocabulary)
    rows += [(100, "nothing in common"), (101, None)]
    df = spark.createDataFrame(bench, "item_id bigint, text string")
    got = {r.doc_id: r for r in x.contamination(documents(rows), df, block_bytes=block_bytes).collect()}
    items = [words(t) for _, t in bench]
    below = 0
    for d, t in rows:
        w, best, at = words(t), 0, -1
        for p in range(len(w)):
            for i in items:
                for q in range(len(i)):
                    n = 0
                    while p + n < len(w) and q + n < len(i) and w[p + n] == i[q + n]:
                        n += 1
                    if n > best:
                        best, at = n, p
        assert (got[d].longest_match, got[d].longest_at) == (best, at), (d, t)
        assert sum(s.end - s.begin for s in got[d].spans) == got[d].n_hit
        below += 0 < best < x.WINDOW and not got[d].contaminated
    assert below or vocabulary < 8
