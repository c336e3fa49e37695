"""The pipeline against a plain version: lists, sets and dictionaries of one
process.  Only fixed values (labeller limits, weights, seeds) are imported."""

import hashlib
import math
import struct
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from pitchlake.llm import mixing, quality
from pitchlake.llm.common import cut

from .test_decontaminate import brute as brute_contamination
from .test_exact_dedup import brute as brute_exact
from .test_mixing import brute_select, brute_share
from .test_ngram_join import brute as brute_components

SF = "/root/testdata/sf0.001"


def statistics(text):
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return None
    n, letter = len(words), lambda b: b >= 128 or chr(b).isalpha()
    letters = sum(map(letter, raw))
    return {
        "words": n,
        "symbols": sum(b in quality.SYMBOLS for b in raw) / len(raw),
        "capitals": sum(65 <= b <= 90 for b in raw) / max(1, letters),
        "repeats": sum(a == b for a, b in zip(words, words[1:])) / max(1, n - 1),
        "variety": math.log(len(set(words)) + 1) / math.log(n + 1),
        "bare": sum(not any(letter(b) or 48 <= b <= 57 for b in w) for w in words) / n,
        "odd_ends": sum(w[-1] not in quality.PLAIN_ENDS for w in words) / n,
        "exclaim": raw.count(b"!") / n,
        "length": letters / n,
        "function": sum(w in quality.FUNCTION_WORDS for w in words) / n,
    }


def votes(s):
    out = []
    for _, what, bad, good, least in quality.LABELLERS:
        value = -s[what[1:]] if what.startswith("-") else s[what]
        out.append(None if s["words"] < least else "bad" if value >= bad else "good" if value <= good else None)
    return tuple(out)


def weak_labels(ballots):
    """Expectation-maximisation, document by document."""
    p = [0.1 if "bad" in b else 0.95 for b in ballots]
    for _ in range(quality.EM_ROUNDS):
        like = []
        for side in (False, True):
            w = [x if side else 1 - x for x in p]
            prior = math.log((sum(w) + 1) / (len(w) + 2))
            table = []
            for k in range(len(quality.LABELLERS)):
                says = {v: quality.SMOOTH + sum(x for x, b in zip(w, ballots) if b[k] == v) for v in ("bad", "good")}
                table.append({v: math.log(c / sum(says.values())) for v, c in says.items()})
            like.append([prior + sum(t[v] for t, v in zip(table, b) if v) for b in ballots])
        was, p = p, [1 / (1 + math.exp(max(-50, min(50, a - b)))) for a, b in zip(*like)]
        if max(abs(a - b) for a, b in zip(was, p)) < 1e-9:
            break
    return p


def shares(text):
    """Hashed bin -> its share of the words, pairs and character n-grams."""
    raw = text.encode()
    word = [crc32(w.lower()) for w in raw.split()]
    kinds = [word, [0 if a == b else a << 32 | b for a, b in zip(word, word[1:])],
             [int.from_bytes(raw[i:i + quality.GRAM], "big") for i in range(len(raw) - quality.GRAM + 1)]]
    out = Counter()
    for kind, values in enumerate(kinds, 1):
        for v in values:
            out[(v + kind) * 0x9E3779B97F4A7C15 % 2 ** 64 >> 64 - quality.BITS] += 1 / len(values)
    return out


def sampled(ids):
    """Per hash bin the id with the smallest hash."""
    best = {}
    for i in ids:
        h = xxhash.xxh64_intdigest(struct.pack("<i", 17), xxhash.xxh64_intdigest(struct.pack("<q", i), 42))
        signed = h - 2 ** 64 if h >= 2 ** 63 else h
        best[h % quality.SAMPLE] = min(best.get(h % quality.SAMPLE, (signed, i)), (signed, i))
    return {i for _, i in best.values()}


def sigmoid(v):
    return 1 / (1 + math.exp(-max(-50, min(50, v))))


def scorer(rows, y):
    good = sum(v > 0.5 for v in y)
    weight = [0.5 / max(1, good if v > 0.5 else len(y) - good) * len(y) for v in y]
    w, seen, b, seen_b = Counter(), {}, 0.0, 1e-8
    order = np.random.default_rng(5).permutation(len(rows)).tolist()
    for _ in range(quality.EPOCHS):
        for start in range(0, len(rows), quality.BATCH):
            batch = order[start:start + quality.BATCH]
            slope, bias = Counter({k: quality.PENALTY * v for k, v in w.items()}), 0.0
            for i in batch:
                error = weight[i] * (sigmoid(b + sum(w[k] * v for k, v in rows[i].items())) - y[i]) / len(batch)
                bias += error
                for k, v in rows[i].items():
                    slope[k] += error * v
            for k, g in slope.items():
                seen[k] = seen.get(k, 1e-8) + g * g
                w[k] -= quality.RATE * g / math.sqrt(seen[k])
            seen_b += bias ** 2
            b -= quality.RATE * bias / math.sqrt(seen_b)
    return lambda text: sigmoid(b + sum(w[k] * v for k, v in shares(text).items()))


def plain_quality(docs):
    told = [(r, statistics(r["text"])) for r in docs]
    told = [(r, s) for r, s in told if s]
    label = dict(zip((id(r) for r, _ in told), weak_labels([votes(s) for _, s in told])))
    drawn = sampled([r["doc_id"] for r in docs if r["doc_id"] is not None])
    learn = sorted((r for r, _ in told if r["doc_id"] in drawn), key=lambda r: r["doc_id"])
    score = scorer([shares(r["text"]) for r in learn], [label[id(r)] for r in learn])
    return [r for r, _ in told if score(r["text"]) >= quality.ACCEPT]


def plain_exact(docs):
    stay = {d for d, _, _, kept, _ in brute_exact([(r["doc_id"], r["text"]) for r in docs]) if kept}
    return [r for r in docs if r["doc_id"] in stay]


def plain_near(docs):
    stay = {d for d, _, root in brute_components([(r["doc_id"], r["text"]) for r in docs]) if d == root}
    return [r for r in docs if r["doc_id"] in stay]


def plain_clean(docs, items):
    stay = {row[0] for row in brute_contamination([(r["doc_id"], r["text"]) for r in docs], items) if not row[-1]}
    return [r for r in docs if r["doc_id"] in stay]


def plain_mixture(docs):
    rows = []
    for r in docs:
        digit = hashlib.md5((r["source"] or "").encode()).hexdigest()[-1]
        leaf = (f"domain{int(digit, 16) % mixing.DOMAINS}", r["lang"] or "unknown", r["source"] or "unknown")
        rows.append((r["doc_id"], leaf, len((r["text"] or "").encode().split())))
    supply = Counter()
    for _, leaf, n in rows:
        for depth in range(4):
            supply[leaf[:depth]] += n
    budget = {(): int(supply[()] * mixing.BUDGET_SHARE)}
    for depth in range(3):
        for node in [p for p in supply if len(p) == depth]:
            below = [p for p in supply if p[:depth] == node and len(p) == depth + 1 and supply[p]]
            budget |= brute_share(budget[node], {p: (mixing.WEIGHTS.get(p, 1.0), supply[p] * mixing.MAX_EPOCHS) for p in below})
    floors = {p: math.floor(n) for p, n in budget.items() if len(p) == 3 and n >= 1}
    named = [("null" if i is None else i, leaf, n) for i, leaf, n in rows]
    return sorted((str(i), e) for i, e in brute_select(named, floors, mixing.SEED))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Tables of sf0.001 with copies, near copies, benchmark passages and odd rows added."""
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    long = [r for r in docs if len((r["text"] or "").split()) > 150]
    new = iter(range(10_000, 20_000))
    add = [{**r, "doc_id": next(new), "text": r["text"].upper()} for r in long[:3]]
    add += [{**r, "doc_id": next(new), "text": f"{r['text']} and then it was over"} for r in long[3:9] for _ in range(2)]
    add += [{**r, "doc_id": next(new), "text": f"{r['text']} {items[k][1]} {long[k]['text']}"} for k, r in enumerate(long[9:13])]
    add += [{**long[13], "doc_id": None, "text": f"{long[13]['text']} {long[14]['text']} {long[15]['text']}"}]
    add += [{**docs[0], "doc_id": next(new), "text": t} for t in (None, "", " \n ", "BUY NOW!! $$$ " * 40, "word " * 300)]
    place = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame([tuple(r.values()) for r in docs + add], spark.read.parquet(f"{SF}/documents.parquet").schema) \
        .repartition(5).write.parquet(f"{place}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{place}/benchmark.parquet")
    return place, docs + add, items


def test_pipeline_equals_a_plain_version(spark, planted):
    place, rows, items = planted
    plain = [plain_quality, plain_exact, plain_near, lambda docs: plain_clean(docs, items)]
    ids = lambda found: sorted(str(r["doc_id"]) for r in found)
    docs = spark.read.parquet(f"{place}/documents.parquet")
    for (name, stage), version in zip(corpus_pipeline.STAGES, plain):
        docs, before, rows = cut(stage(spark, docs, place), "stage"), len(rows), version(rows)
        assert ids(docs.collect()) == ids(rows), name
        assert 0 < len(rows) < before, name
    want = plain_mixture(rows)
    assert want and sorted((str("null" if r.doc_id is None else r.doc_id), r.epoch)
                           for r in corpus_pipeline.run(spark, place).collect()) == want
