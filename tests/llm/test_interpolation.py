"""Deleted interpolation against a plain version with dictionaries."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pitchlake.llm import interpolation as I


def _tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def _fold(doc_id):
    crc = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    return I.TEST if crc % 10 == 0 else I.HELD if crc // 10 % 10 == 0 else I.KEPT


def _counts(rows, folds, order):
    c = Counter()
    for doc, text in rows:
        if _fold(doc) in folds:
            t = [b"\t"] * (order - 1) + _tokens(text)
            for i in range(order - 2 if order > 1 else 0, len(t)):
                for k in range(1, order + 1):
                    if i >= k - 1 and (k < order or i >= order - 1):
                        c[tuple(t[i - k + 1:i + 1])] += 1
    return c


def _chain(c, t, i, order):
    """Per order above 1: (bucket of the context, estimate); and the unigram count."""
    out = []
    for k in range(2, order + 1):
        context = c[tuple(t[i - k + 1:i])]
        out.append((int(I.bucket(np.array([context]))[0]), c[tuple(t[i - k + 1:i + 1])] / max(1, context)))
    return c[(t[i],)], out


def _round(x):
    return 2.0 ** (round(math.log2(x) * I.STEPS) / I.STEPS) if x else 0.0


def plain(rows, order):
    kept, every = _counts(rows, {I.KEPT}, order), _counts(rows, {I.KEPT, I.HELD}, order)
    words = {k: v for k, v in every.items() if len(k) == 1 and k != (b"\t",)}
    V, N = len(words), sum(words.values())
    kept_n = sum(v for k, v in kept.items() if len(k) == 1 and k != (b"\t",))
    events = Counter()
    for doc, text in rows:
        if _fold(doc) == I.HELD:
            t = [b"\t"] * (order - 1) + _tokens(text)
            for i in range(order - 1, len(t)):
                u, chain = _chain(kept, t, i, order)
                events[_round(u) / max(1, kept_n), tuple((b, _round(p)) for b, p in chain)] += 1
    w = [[0.5]] + [[0.0] + [0.5] * (I.BUCKETS - 1) for _ in range(order - 1)]
    met = [set() for _ in w]
    for _ in range(I.ROUNDS):
        taken, reached = [Counter() for _ in w], [Counter() for _ in w]
        for (p1, chain), n in events.items():
            left, parts = 1.0, []
            for k in range(order, 0, -1):
                b, p = (0, p1) if k == 1 else chain[k - 2]
                parts.append((k, b, left * w[k - 1][b] * p))
                left *= 1 - w[k - 1][b]
            total = sum(x for _, _, x in parts) + left / (V + 1)
            below = left / (V + 1)
            for k, b, x in reversed(parts):
                below += x
                taken[k - 1][b] += n * x / total
                reached[k - 1][b] += n * below / total
                met[k - 1].add(b)
        was, w = w, [[(taken[k][b] + I.PRIOR / 2) / (reached[k][b] + I.PRIOR) for b in range(len(w[k]))] for k in range(order)]
        for k in range(1, order):
            w[k][0] = 0.0
        if max(abs(x - y) for a, b in zip(was, w) for x, y in zip(a, b)) < I.SETTLED:
            break
    for k in range(1, order):
        for b in range(2, I.BUCKETS):
            if b not in met[k]:
                w[k][b] = w[k][b - 1]
    out = []
    for doc, text in rows:
        t, score, base = [b"\t"] * (order - 1) + _tokens(text), 0.0, 0.0
        for i in range(order - 1, len(t)):
            u, chain = _chain(every, t, i, order)
            p = w[0][0] * u / max(1, N) + (1 - w[0][0]) / (V + 1)
            for k, (b, x) in enumerate(chain, 1):
                p = w[k][b] * x + (1 - w[k][b]) * p
            score += math.log10(p) if N else 0.0
            base += math.log10((u + 0.1) / (N + 0.1 * (V + 1)))
        own = _tokens(text)
        out.append((doc, _fold(doc) == I.TEST, len(own), sum(every[(x,)] > 0 for x in own), N, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                   for r in df.collect()), key=str)


def _corpus(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{min(int(rng.paretovariate(0.7)), 300)}" for _ in range(4000)]
    rows = [(i, " ".join(words[(a := rng.randrange(3500)):a + rng.randrange(1, 90)]) + rng.choice(["", " Ünï Ärger", " X\n\nY"])) for i in range(n)]
    return rows + [(n + 1, None), (n + 2, ""), (n + 3, " \n\t "), (None, "some words of nobody"), (5, "again w1 w2"), (5, "again w1 w2")]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_plain_version(documents, order):
    rows = _corpus(150)
    assert _got(I.scored(documents(rows, extra=True), order, slice_bytes=3000, range_bytes=5000)) == plain(rows, order)


def test_long_texts_in_pieces(documents):
    rng = random.Random(4)
    rows = [*_corpus(40), (70, " ".join(f"w{rng.randrange(50)}" for _ in range(20000))), (71, "x" * 30000 + " tail w1")]
    assert _got(I.scored(documents(rows), slice_bytes=7000, range_bytes=9000)) == plain(rows, I.ORDER)


def test_no_training_documents(documents):
    rows = [(None, "only words of nobody"), (None, None)]
    assert _got(I.scored(documents(rows))) == plain(rows, I.ORDER)
    assert I.scored(documents(rows).limit(0)).count() == 0


def test_model_beats_base_on_held_out_documents(spark):
    rows = I.op11_lm_score(spark, "/root/testdata/sf0.001").where("held_out").collect()
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_packing():
    for x in ([], [0], [1, 2 ** 63, 7], list(range(1000))):
        assert I.unpack(I.pack(np.array(x, dtype=np.uint64))).tolist() == x


def test_token_numbers_are_packed_tighter_than_by_default():
    rng = np.random.default_rng(1)
    phrases = rng.integers(0, 3000, (500, 12)).astype(np.uint64)
    ids = phrases[np.minimum(rng.zipf(1.3, 20_000), 500) - 1].reshape(-1)
    packed = I.pack(ids)
    assert (I.unpack(packed) == ids).all()
    planes = np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 8)[:, :packed[8]].T).tobytes()
    assert len(packed) < 0.97 * len(pa.compress(planes, codec="zstd", asbytes=True))


def test_counts_of_one_thing_share_a_byte():
    rng = np.random.default_rng(2)
    kept = np.append(rng.geometric(0.7, 20_000) - 1, [15, 16, 2 ** 40, 0]).astype(np.uint64)
    held = np.append(rng.random(20_000) < 0.1, [0, 2 ** 33, 14, 15]).astype(np.uint64)
    blob = I.pack_counts(kept, held)
    assert [x.tolist() for x in I.unpack_counts(blob)] == [kept.tolist(), held.tolist()]
    assert len(blob) < 0.95 * len(I.packed([kept, held], I.QUICK))
    assert [x.tolist() for x in I.unpack_counts(I.pack_counts(kept[:0], held[:0]))] == [[], []]


def test_order_of_numbers_whose_last_bits_decide():
    rng = np.random.default_rng(3)
    for values in ([], [7], [0, 2 ** 64 - 1, 0], [2 ** 63 + 3, 2 ** 63 + 1, 5, 2 ** 63 + 2, 2 ** 63 + 1], rng.integers(0, 2 ** 62, 5000), rng.integers(0, 50, 5000)):
        values = np.array(values, dtype=np.uint64)
        order, inside = I.in_order(values)
        assert sorted(order.tolist()) == list(range(len(values))) and (values[order] == inside).all() and (inside == np.sort(values)).all()


def test_words_are_those_of_split():
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "bc", "é", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\xa0", "\0"]) for _ in range(rng.randrange(30))).encode()
             for _ in range(300)] + [b"", b" ", b"\xff\xfe x"]
    at, n, distinct = I.numbered_words(texts)
    assert [distinct[i] for i in at] == [w for t in texts for w in t.split()] and n.tolist() == [len(t.split()) for t in texts]
    assert len(set(distinct)) == len(distinct)
    assert [x.tolist() if hasattr(x, "tolist") else x for x in I.numbered_words([b"", b" "])] == [[], [0, 0], []]


def test_noise_is_packed_without_effort(monkeypatch):
    """Distances of hashes and counts, most of what is shuffled, are packed at the first level."""
    levels = []
    real = I.pack
    monkeypatch.setattr(I, "pack", lambda x, level=I.LEVEL: levels.append((level, len(x))) or real(x, level))
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "fold": i % 3, "text": t or ""} for i, t in _corpus(60)[:60]],
                                       schema=pa.schema([("doc_id", pa.int64()), ("fold", pa.int32()), ("text", pa.string())]))
    rows = pa.Table.from_batches(I._deal([50, 40, 40], 2, 1 << 20)(iter([batch])))
    assert {level for level, _ in levels} == {1}
    keys = sum(len(I.unpack(x.as_py())) for x in rows.column("a"))
    assert keys == sum(len(I.unpack_counts(x.as_py())[0]) for x in rows.column("b")) > 0
