"""Quality classifier: weak labels, expectation-maximisation, hashed scorer.

1. Nine heuristic labellers read a whole text and vote reject, accept or
   abstain (symbols, capitals, repeated neighbours, vocabulary, separators,
   word endings, exclamation, word length, function words).  They overlap and
   disagree.
2. The votes of all documents are counted by pattern (3^9 patterns at most).
   Expectation-maximisation on the counts estimates the share of good
   documents and, for each labeller, how it votes on good and on bad ones.
   A pattern's posterior is the weak label of the documents that show it.
3. Posterior labels train a linear scorer (logistic regression) on hashed
   text: words, pairs of neighbouring words and character n-grams in 2^18
   bins, each kind by its share of the text.  What the labellers measure is
   no input of it, so it judges by the text, also where all of them abstain.
   The training sample is at most SAMPLE documents, one per hash bin, in the
   order of their hash until they have SAMPLE_BINS distinct bins together (a
   text has 2^18 at most, so 64 documents or more whatever their length).  It
   reaches the driver as packed bins and shares.
4. Every document is scored whole; a score of at least ACCEPT is accepted.

Defined results: a text without words (null, empty, blank) scores 0 and is
rejected; a null doc_id is scored but not trained on; a score of exactly ACCEPT
is accepted and equal texts tie with equal scores; repeated rows are
scored each.  Further columns are ignored by ``quality_scores`` and kept by
``accepted_documents``.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.common import cut, in_slices, table, utf8_values
from pitchlake.llm.sampling import one_per_bin

REJECT, ACCEPT_VOTE, ABSTAIN = 0, 1, 2
SAMPLE, SAMPLE_BINS, BITS, ACCEPT = 4096, 1 << 24, 18, 0.5
GRAM = 4                     # characters (bytes) of a character n-gram
EM_ROUNDS, SMOOTH = 200, 0.5
EPOCHS, BATCH, RATE, PENALTY = 10, 64, 1.0, 1e-6

LETTERS = bytes(c for c in range(256) if chr(c).isalpha() and c < 128) + bytes(range(128, 256))
CAPITALS = bytes(range(0x41, 0x5B))
SYMBOLS = b"#$%&*|<>{}[]=_~^@\\`+"
DIGITS, BLANK = b"0123456789", b" \t\n\x0b\x0c\r"
PLAIN_ENDS = LETTERS + DIGITS + b".,;:?)\"'!-"


def _bytes_in(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_BLANK, _SPOKEN, _PLAIN = _bytes_in(BLANK), _bytes_in(LETTERS + DIGITS), _bytes_in(PLAIN_ENDS)


# Frequent function words of English, German, Spanish and French.
FUNCTION_WORDS = frozenset(w.encode() for w in (
    "the of and to in is that it for was on are with as be at by this from or an have not but they which "
    "der die das und ist in den von zu mit sich des auf für nicht ein eine dem es als auch an "
    "el la los las de que y en un una por con no para su al lo como del se "
    "le les et des est pour dans ce il qui ne sur pas par plus au du une").split())


def _share(raw: bytes, chars: bytes) -> float:
    return (len(raw) - len(raw.translate(None, chars))) / max(1, len(raw))


def statistics(raw: bytes, words: list[bytes]) -> dict[str, float]:
    """What the labellers look at; shares are between 0 and 1."""
    n = len(words)
    letters = len(raw) - len(raw.translate(None, LETTERS))
    data = np.frombuffer(raw, dtype=np.uint8)
    blank = np.concatenate([[True], _BLANK[data], [True]])
    begin, end = np.flatnonzero(blank[:-2] & ~blank[1:-1]), np.flatnonzero(~blank[1:-1] & blank[2:])
    return {
        "words": float(n),
        "letters": float(letters),
        "symbols": _share(raw, SYMBOLS),
        "capitals": (len(raw) - len(raw.translate(None, CAPITALS))) / max(1, letters),
        "repeats": sum(map(eq, words, words[1:])) / max(1, n - 1),
        "variety": float(np.log(len(set(words)) + 1) / np.log(n + 1)),
        "bare": float((np.add.reduceat(_SPOKEN[data].astype(np.int64), begin) == 0).mean()),  # words of marks alone
        "odd_ends": float((~_PLAIN[data[end]]).mean()),
        "exclaim": raw.count(b"!") / n,
        "length": letters / n,
        "function": sum(w in FUNCTION_WORDS for w in words) / n,
    }


#: name, statistic, reject from, accept up to, words needed to vote (fixed
#: values; a negative statistic turns "high is bad" into "low is bad")
LABELLERS = (
    ("symbols", "symbols", 0.06, 0.01, 4),
    ("capitals", "capitals", 0.5, 0.2, 8),
    ("repeats", "repeats", 0.25, 0.05, 8),
    ("variety", "-variety", -0.6, -0.75, 30),
    ("separators", "bare", 0.15, 0.02, 8),
    ("endings", "odd_ends", 0.3, 0.05, 8),
    ("exclaim", "exclaim", 0.3, 0.05, 8),
    ("length", "length", 16.0, 12.0, 8),
    ("function", "-function", -0.01, -0.08, 30),
)


def votes(s: dict[str, float]) -> str:
    out = []
    for _, what, bad, good, least in LABELLERS:
        x = -s[what[1:]] if what[0] == "-" else s[what]
        vote = ABSTAIN if s["words"] < least else REJECT if x >= bad else ACCEPT_VOTE if x <= good else ABSTAIN
        out.append(str(vote))
    return "".join(out)


def _read(raw: bytes | None) -> tuple[bytes, list[bytes]]:
    raw = raw or b""
    return raw, raw.split()


def pattern_counts(docs: DataFrame) -> dict[str, int]:
    """How many documents show each pattern of votes (at most 3^9 rows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for b in in_slices(batches, "text"):
            for value in utf8_values(b.column("text")):
                raw, words = _read(value)
                if words:
                    v = votes(statistics(raw, words))
                    seen[v] = seen.get(v, 0) + 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["votes", "n"])
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "votes string, n bigint")
    return {r.votes: r.n for r in rows.groupBy("votes").agg(F.sum("n").alias("n")).collect()}


def posteriors(counts: dict[str, int]) -> dict[str, float]:
    """Probability that a document with a pattern is good, by
    expectation-maximisation over the patterns of all documents."""
    if not counts:
        return {}
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], dtype=float)
    vote = np.array([[int(c) for c in p] for p in patterns])
    # pattern x labeller x (reject, accept): whether a labeller abstains (most
    # do on a short text) says nothing about quality
    shown = np.eye(3)[vote][:, :, :2]
    # a rejecting vote is the rarer and stronger sign: start from it
    good = np.where((vote == REJECT).any(axis=1), 0.1, 0.95)
    for _ in range(EM_ROUNDS):
        logs = []
        for q in (1 - good, good):
            w = q * n
            tally = np.einsum("p,plv->lv", w, shown) + SMOOTH
            logs.append(np.log((w.sum() + 1) / (n.sum() + 2)) + np.einsum("plv,lv->p", shown, np.log(tally / tally.sum(axis=1, keepdims=True))))
        was, good = good, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(good - was).max() < 1e-9:
            break
    return dict(zip(patterns, good.tolist()))


def bins(raw: bytes, words: list[bytes]) -> list[np.ndarray]:
    """Hashed bins of the words, of the pairs of neighbours, and of the
    character n-grams of a text."""
    lower = [w.lower() for w in words]   # bytes.lower() changes A-Z only
    word = np.fromiter(map(crc32, lower), dtype=np.uint64, count=len(lower))
    data = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64)
    gram = np.zeros(max(0, len(data) - GRAM + 1), dtype=np.uint64)
    for k in range(GRAM):
        gram = (gram << np.uint64(8)) | data[k:len(data) - GRAM + 1 + k]
    # a word and itself again is one and the same pair, whatever the word
    pair = np.where(word[:-1] == word[1:], np.uint64(0), (word[:-1] << np.uint64(32)) | word[1:])
    return [((x + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)
            for kind, x in ((1, word), (2, pair), (3, gram))]


def features(raw: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bins and their shares; each kind of bins shares one whole."""
    kinds = [k for k in bins(raw, words) if len(k)]
    at = np.concatenate(kinds)
    share = np.concatenate([np.full(len(k), 1 / len(k)) for k in kinds])
    order = np.argsort(at, kind="stable")
    at, share = at[order], share[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], np.add.reduceat(share, first)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, raw: bytes, words: list[bytes]) -> float:
        margin = self.bias + sum(float(self.weights[k].mean()) for k in bins(raw, words) if len(k))
        return float(1 / (1 + np.exp(-np.clip(margin, -50, 50))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> Scorer:
    """Logistic regression on soft labels, both classes with equal weight, by
    adaptive gradient steps over batches in a fixed order."""
    size = 1 << BITS
    weight = np.where(y > 0.5, 0.5 / max(1, (y > 0.5).sum()), 0.5 / max(1, (y <= 0.5).sum())) * len(y)
    w, b, seen, seen_b = np.zeros(size), 0.0, np.full(size, 1e-8), 1e-8
    order = np.random.default_rng(5).permutation(len(rows))
    for _ in range(EPOCHS):
        for start in range(0, len(rows), BATCH):
            batch = order[start:start + BATCH]
            at = np.concatenate([rows[i][0] for i in batch])
            share = np.concatenate([rows[i][1] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            margin = np.bincount(row, w[at] * share, minlength=len(batch)) + b
            error = weight[batch] * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y[batch]) / len(batch)
            slope = np.bincount(at, error[row] * share, minlength=size) + PENALTY * w
            seen += slope * slope
            w -= RATE * slope / np.sqrt(seen)
            seen_b += error.sum() ** 2
            b -= RATE * error.sum() / np.sqrt(seen_b)
    return Scorer(w.astype(np.float32), float(b))


def within(sample: DataFrame, bins: int) -> DataFrame:
    """The doc_ids of ``sample`` (at most SAMPLE rows), by hash, whose ``n`` sum
    to at most ``bins``."""
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    return sample.select("doc_id", F.sum("n").over(order).alias("reach")).where(F.col("reach") <= bins).select("doc_id")


def train(docs: DataFrame) -> Scorer | None:
    """Weak labels from all documents, scorer from a bounded sample of them."""
    good = posteriors(pattern_counts(docs))
    if not good:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "text"):
            for doc, value in zip(b.column("doc_id").to_pylist(), utf8_values(b.column("text"))):
                raw, words = _read(value)
                if words:
                    s = statistics(raw, words)
                    at, share = features(raw, words)
                    at = np.diff(at, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
                    packed = [pa.compress(x, codec="zstd", asbytes=True) for x in (at, share.astype("<f4").tobytes())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc]), pa.array([good.get(votes(s), 0.5)]), pa.array([len(share)]), pa.array([packed[0]]), pa.array([packed[1]])],
                        ["doc_id", "y", "n", "bins", "shares"])
    drawn = one_per_bin(docs.select("doc_id", "text"), SAMPLE)
    sample = cut(drawn.mapInArrow(run, "doc_id bigint, y double, n bigint, bins binary, shares binary"), "quality-sample")
    rows = sorted(sample.join(within(sample, SAMPLE_BINS), "doc_id", "left_semi").collect(), key=lambda r: r.doc_id)
    if not rows:
        return None

    def unpacked(r) -> tuple[np.ndarray, np.ndarray]:
        planes = np.frombuffer(pa.decompress(bytes(r.bins), 4 * r.n, codec="zstd", asbytes=True), dtype=np.uint8).reshape(4, r.n)
        at = np.cumsum(np.ascontiguousarray(planes.T).view("<u4").reshape(-1), dtype=np.int64)
        return at, np.frombuffer(pa.decompress(bytes(r.shares), 4 * r.n, codec="zstd", asbytes=True), dtype="<f4").astype(float)
    return fit([unpacked(r) for r in rows], np.array([r.y for r in rows]))


def _scored(texts: list[bytes | None], scorer: Scorer | None) -> list[float]:
    out = []
    for value in texts:
        raw, words = _read(value)
        out.append(scorer.score(raw, words) if words and scorer else 0.0)
    return out


def quality_scores(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """(doc_id, score, accepted) per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "text"):
            score = _scored(utf8_values(b.column("text")), sent.value)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score, pa.float64()),
                                              pa.array([x >= ACCEPT for x in score], pa.bool_())], ["doc_id", "score", "accepted"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double, accepted boolean")


def accepted_documents(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """``docs`` without the rejected ones; columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "text"):
            score = _scored(utf8_values(b.column("text")), sent.value)
            yield b.filter(pa.array([x >= ACCEPT for x in score], pa.bool_()))
    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, train(docs))
