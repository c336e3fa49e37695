import hashlib
import random

import numpy as np

from pitchlake.llm import line_dedup as x
from pitchlake.llm.cuckoo import CuckooFilter, filled


def key_of(line):
    k = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in k)


def brute(rows, min_docs=3):
    held = {}
    for n, (i, t) in enumerate(rows):
        for k in {key_of(z) for z in (t or "").split("\n")}:
            if len(k) >= 20:
                held.setdefault(k, []).append(i if i is not None else -2 ** 63)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        at = i if i is not None else -2 ** 63
        kept = [z for z in lines if not (len(held.get(key_of(z), [])) >= min_docs and at < max(held[key_of(z)]))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in x.dedup_lines(df).collect()], key=str)


A, B, C = "this line is long enough to count", "Ünïcödé lines count by code points", "nineteen characters"


def test_edge_rows(documents):
    rows = [(1, A), (2, f"  {A.upper()}\t\nx"), (3, f"{A}\n{A}\n{C}"), (4, C), (5, C), (6, None), (7, ""), (8, B), (9, B), (10, f"{B}\n"),
            (None, A), (None, None), (11, "y\n" * 30_000 + A), (12, "dup row " + A), (12, "dup row " + A), (12, "dup row " + A)]
    assert result(documents(rows, extra=True)) == brute(rows)


def test_rows_without_an_id_lose_the_lines_of_their_own_text(documents):
    r = random.Random(6)
    pool = [f"common line number {k} with some length" for k in range(9)]
    rows = [(None if i % 3 == 0 else i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 4)))) for i in range(90)]
    assert result(documents(rows)) == brute(rows)
    drops = x.key_pairs(documents(rows), None).where(f"doc_id = {-2 ** 63}")
    assert drops.groupBy("doc_id", "text_id").agg({"key": "collect_set"}).selectExpr("max(size(`collect_set(key)`))").first()[0] <= 4


def test_empty_table(documents):
    assert result(documents([]).limit(0)) == []


def test_random_tables(documents):
    r = random.Random(5)
    pool = [f"common line number {k} with some length" for k in range(12)] + ["short", ""]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 6)))) for i in range(150)]
    assert result(documents(rows)) == brute(rows)


def test_without_broadcast_filters(documents, monkeypatch):
    monkeypatch.setattr(x, "HEAVY_FILTER_BYTES", -1)
    rows = [(i, A + f"\nown line of document number {i}") for i in range(20)]
    assert result(documents(rows)) == brute(rows)


def state(index):
    return sorted((bytes(r.key), r.n_docs, r.max_doc) for r in index.refs.collect())


def test_insert_and_delete_are_inverse(documents):
    r = random.Random(6)
    pool = [f"common line number {k} with some length" for k in range(30)]
    rows = [(i, "\n".join(r.sample(pool, 3))) for i in range(40)]
    old, new = documents(rows[:25]), documents(rows[25:])
    before = x.LineIndex.build(old, shards=4)
    both = before.insert(new)
    assert state(both) == state(x.LineIndex.build(documents(rows), shards=4))
    after = both.delete(new, old)
    assert state(after) == state(before)
    cleaned = sorted([tuple(r) for r in after.clean(old).collect()], key=str)
    assert cleaned == brute(rows[:25])


def test_filters_know_every_key(documents):
    rows = [(i, f"own line of document number {i}\n{A}") for i in range(60)]
    index = x.LineIndex.build(documents(rows[:30]), shards=2).insert(documents(rows[30:]))
    held = {f.shard: CuckooFilter.from_bytes(bytes(f.filter)) for f in index.filters.collect()}
    for k in index.refs.collect():
        a, b = x.split_keys(bytes(k.key))
        assert held[k.shard].contains(a, b).all()


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2 ** 63, (2, 20_000), dtype=np.uint64)
    f = filled(a, b)
    assert f.contains(a, b).all()
    c, d = rng.integers(0, 2 ** 63, (2, 20_000), dtype=np.uint64)
    assert f.contains(c, d).mean() < 0.01
    f = CuckooFilter.from_bytes(f.to_bytes())
    f.delete(a[:500], b[:500])
    assert f.contains(a[500:], b[500:]).all()
    assert f.contains(a[:500], b[:500]).mean() < 0.05
    f.delete(a[500:], b[500:])
    assert not f.slots.any()
