"""Deleted interpolation: n-gram scores of documents.

The model of a token after its context is a chain of mixtures: the maximum-
likelihood estimate of the longest order, weighted by how often its context
was seen (buckets of powers of two), then the next shorter order, down to the
uniform distribution over the vocabulary and one unknown word.  The weights
are learned by expectation-maximisation on held-out counts: one tenth of the
training documents are the held-out events, predicted from the counts of the
rest.  The scores use the counts of all training documents with the learned
weights.

1. *Deal.*  A task reads a slice of texts, numbers its words and hashes its
   n-grams of every order; the distinct ones, with their counts in kept and
   held-out documents, go to hash ranges, packed and delta-coded, one row per
   slice, order and range.
2. *Count.*  A range adds up the counts of all slices and answers each slice
   for its n-grams.  Ranges are as many as the text's bytes ask for, so a
   range is bounded; a frequent n-gram is one entry per slice.  Rows are never
   more than entries: where ranges outnumber a slice's n-grams, a row holds
   a few or one of them.
3. *Gather.*  The texts are read and sliced once more and meet their answers.
   A slice writes the counts along its texts, and emits its held-out events,
   counted by buckets and by the counts' ratios (rounded to 1/STEPS octave).
   Slices are named by their content; if the table has changed between the
   readings, the job fails rather than score with foreign counts.
4. *Learn.*  Each round of expectation-maximisation is one aggregate over the
   event table.
5. *Score.*  The counts along the texts become scores; the parts of texts
   that were longer than a slice are added up.

N-grams are compared by hash.  The number of bits follows the size of the
input: for single words less than one collision is expected in the whole
table, for longer n-grams less than one n-gram in 500,000 shares its count.

Defined results: a null or blank text is one end token; a null doc_id counts
as the empty string (remainder 0), so such rows are held out; repeated rows
are scored, and counted, each.  Without training tokens every score is 0.
Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest as word_hash

from pitchlake.llm.common import cut, in_slices, session_conf, table, utf8_values

ORDER = 3
SLICE_BYTES, SLICE_DOCS = 12 << 20, 1 << 16
RANGE_BYTES = 8 << 20       # text per hash range
LEVEL, QUICK = 8, 1         # of compression: of token numbers, of the rest
MANY = 15                   # counts from here on are packed apart
BUCKETS, STEPS = 40, 4      # context buckets; roundings an octave
ROUNDS, SETTLED = 40, 1e-4  # rounds at most; change of a weight that ends them
PRIOR = 1.0                 # events a weight of one half is believed to rest on before any is seen
TEST, KEPT, HELD = 0, 1, 2  # folds: only scored, counted, held out of the first counts
BOS, END = 0, 1             # word numbers before those of words

# kinds of rows
GRAMS, TEXT, ANSWER, SLICE, EVENTS, STATS = range(6)
_SCHEMA = "home bigint, kind int, slice bigint, part int, key bigint, n bigint, a binary, b binary, c binary"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [[]] * len(_NAMES)
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(_NAMES, cols, _KINDS)})


def pack(values: np.ndarray, level: int = LEVEL) -> bytes:
    """Unsigned integers by byte plane, compressed; two header numbers."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(values).to_bytes(8, "little") + bytes([width]) + pa.Codec("zstd", compression_level=level).compress(planes, asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    n, width = int.from_bytes(blob[:8], "little"), blob[8]
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        planes = pa.decompress(blob[9:], n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, dtype=np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FIXED = [word_hash(b"\t"), word_hash(b"\n")]  # begin and end; no word holds a blank
_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")


def pieces(raw: bytes, size: int) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes that part no word."""
    if len(raw) <= size:
        yield raw
        return
    at = 0
    while at < len(raw):
        blank = _BLANK.search(raw, at + size)
        stop = blank.start() if blank else len(raw)
        yield raw[at:stop]
        at = stop


def packed(arrays: list[np.ndarray], level: int = LEVEL) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in (pack(x, level) for x in arrays))


def unpacked(blob: bytes) -> list[np.ndarray]:
    parts, at = [], 0
    while at < len(blob):
        size = int.from_bytes(blob[at:at + 8], "little")
        parts.append(unpack(blob[at + 8:at + 8 + size]))
        at += 8 + size
    return parts


def pack_counts(kept: np.ndarray, held: np.ndarray) -> bytes:
    """Two counts of the same things: a byte has both, as far as they are
    small, which they mostly are; the others follow."""
    both = np.minimum(kept, MANY).astype(np.uint8) << 4 | np.minimum(held, MANY).astype(np.uint8)
    return packed([both, kept[kept >= MANY], held[held >= MANY]], QUICK)


def unpack_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    both, *more = unpacked(blob)
    counts = both >> np.uint64(4), both & np.uint64(MANY)
    for x, large in zip(counts, more):
        x[x == MANY] = large
    return counts


def ranked(values: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Of the numbers ``values[at]`` the distinct ones, the most frequent
    first, and the place of each number among them: this packs better."""
    distinct = np.sort(values)
    distinct = distinct[_distinct(distinct)]
    place = np.searchsorted(distinct, values).astype(np.int32)
    by_use = np.argsort(-np.bincount(place[at], minlength=len(distinct)), kind="stable")
    rank = np.empty(len(distinct), dtype=np.int32)
    rank[by_use] = np.arange(len(distinct), dtype=np.int32)
    return [distinct[by_use], rank[place][at]]


def _distinct(key: np.ndarray) -> np.ndarray:
    """Where each run of equal sorted numbers begins, as booleans."""
    return np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=bool)


def in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of unsigned numbers in ascending order, and the sorted numbers.
    The numbers' leading bits are sorted with their places behind them, which
    is faster than ``argsort``; that decides where the bits left out matter."""
    if not len(values):
        return np.zeros(0, dtype=np.int64), values
    bits, low = int(len(values)).bit_length(), values.min()
    out = np.uint64(max(0, int(values.max() - low).bit_length() + bits - 64))
    coded = ((values - low) >> out) << np.uint64(bits)
    coded |= np.arange(len(values), dtype=np.uint64)
    coded.sort()
    coded &= np.uint64((1 << bits) - 1)
    order = coded.view(np.int64)
    inside = values[order]
    if out and (inside[1:] < inside[:-1]).any():
        order = np.argsort(values, kind="stable")
        inside = values[order]
    return order, inside


class Slice:
    """Token numbers of some texts (or pieces): every piece is led by the
    ``order - 1`` tokens before it.  ``bits`` has the hash bits per order."""

    def __init__(self, bits: list[int], ids: np.ndarray, n: np.ndarray, fold: np.ndarray, begins: np.ndarray, vocab: np.ndarray):
        self.order, self.bits, self.ids, self.n, self.fold, self.begins, self.vocab = len(bits), bits, ids, n, fold, begins, vocab
        lead = self.order - 1
        start = np.cumsum(n + lead) - (n + lead)
        self.piece = np.repeat(np.arange(len(n), dtype=np.int32), n + lead)
        self.leads = start + max(0, lead - 1)      # the last token before each piece
        is_lead = np.zeros(len(ids), dtype=bool)
        for k in range(lead):
            is_lead[start + k] = True
        self.real = np.flatnonzero(~is_lead)       # places of the tokens
        is_lead[self.leads] = not lead             # and with the leads: the places of their contexts
        self.context = np.flatnonzero(~is_lead) if lead else self.real

    def grams(self) -> Iterator[np.ndarray]:
        """Per order the hashes of the n-grams that end at its places."""
        h = state = self.vocab[self.ids]
        for k, b in enumerate(self.bits, 1):
            if k > 1:
                state = _mix(state + np.uint64(0x9E3779B97F4A7C15))
                state[k - 1:] += h[:1 - k]
            yield _mix(state[self.places(k)] + np.uint64(k)) >> np.uint64(64 - b)

    def places(self, k: int) -> np.ndarray:
        return self.real if k == self.order else self.context

    def counted(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per order: distinct hashes, counts in kept and in held-out texts."""
        code = self.fold.astype(np.uint8)[self.piece]
        if self.order > 1:  # what leads a later piece was counted in the piece before
            code[self.leads[~self.begins]] = TEST
        out = []
        for k, g in enumerate(self.grams(), 1):
            coded = (g << np.uint64(2)) | code[self.places(k)]
            coded.sort()
            key, fold = coded >> np.uint64(2), coded.astype(np.uint8) & 3
            first = np.flatnonzero(_distinct(key))
            sums = [np.add.reduceat((fold == f).astype(np.int32), first) if len(first) else first for f in (KEPT, HELD)]
            out.append((key[first], *sums))
        return out

    def numbered(self) -> list[tuple[int, np.ndarray]]:
        """Per order: how many distinct hashes, and which of them (in their
        sorted order) stands at each of the order's places."""
        out = []
        for g in self.grams():
            order, g = in_order(g)
            rank = np.cumsum(_distinct(g), dtype=np.int32) - 1
            at = np.empty(len(g), dtype=np.int32)
            at[order] = rank
            out.append((int(rank[-1]) + 1 if len(g) else 0, at))
        return out

    def name(self) -> int:
        """A number by which equal slices are known."""
        content = hashlib.blake2b(digest_size=8)
        for x in (np.array(self.bits), self.ids, self.n, self.fold, self.begins, self.vocab):
            content.update(len(x).to_bytes(8, "little"))
            content.update(np.ascontiguousarray(x))
        return int.from_bytes(content.digest(), "little") >> 1

    def packed(self) -> bytes:
        return packed([np.array(self.bits), self.ids, self.n, self.fold * 2 + self.begins, np.diff(self.vocab, prepend=np.uint64(0))])

    @classmethod
    def unpacked(cls, blob: bytes) -> Slice:
        bits, ids, n, flags, vocab = unpacked(blob)
        return cls(bits.astype(int).tolist(), ids.astype(np.int32), n.astype(np.int64), (flags >> np.uint64(1)).astype(np.int64),
                   (flags & np.uint64(1)).astype(bool), np.cumsum(vocab, dtype=np.uint64))


def numbered_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The words of all texts as places in the list of distinct words (in the
    order they come), how many words each text has, and that list."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)
    inside = (data != 32) & (data - np.uint8(9) > 4)
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # a blank begins and ends all, so words have both of theirs
    ends = np.concatenate([[0], np.cumsum(edges[1::2] - edges[::2])])
    words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]).dictionary_encode()
    stops = np.cumsum([len(t) + 1 for t in texts])
    _, at, flat = words.dictionary.buffers()
    at, flat = np.frombuffer(at, dtype=np.int64)[:len(words.dictionary) + 1].tolist(), flat.to_pybytes() if flat else b""
    return words.indices.to_numpy(), np.diff(np.searchsorted(edges[::2], stops), prepend=0), [flat[i:j] for i, j in zip(at, at[1:])]


class _Reader:
    """Collects pieces of texts and numbers the words of a slice of them."""

    def __init__(self, bits: list[int]):
        self.order, self.bits = len(bits), bits
        self.clear()

    def clear(self) -> None:
        self.texts, self.lead, self.fold, self.begins, self.ends, self.docs, self.bytes = [], [], [], [], [], [], 0

    def add(self, doc: tuple, text: bytes, fold: int, lead: list[bytes] | None, ends: bool) -> None:
        known = [w for w in lead or [] if w]
        self.texts.append(b" ".join([*known, text]))
        self.lead.append(len(known))
        self.fold.append(fold)
        self.begins.append(lead is None)
        self.ends.append(ends)
        self.docs.append(doc)
        self.bytes += len(text) + 16

    def slice(self) -> tuple[Slice, list[tuple]]:
        at, words, distinct = numbered_words(self.texts)
        lead, ends = np.array(self.lead), np.array(self.ends)
        hashes = np.array([*_FIXED, *map(word_hash, distinct)], dtype=np.uint64)
        # a piece: begin marks for what it lacks of a lead, its words, one end if its text ends
        marks = self.order - 1 - lead
        start = np.cumsum(marks + words + ends) - words - ends
        ids = np.full(start[-1] + words[-1] + ends[-1], BOS, dtype=np.int32)
        ids[np.repeat(start - np.cumsum(words) + words, words) + np.arange(len(at))] = at + 2
        ids[(start + words)[ends]] = END
        # the most frequent words get the smallest numbers, which pack best; so do hashes in order
        by_use = np.lexsort((hashes, -np.bincount(ids, minlength=len(hashes))))
        rank = np.empty(len(hashes), dtype=np.int32)
        rank[by_use] = np.arange(len(hashes), dtype=np.int32)
        out = Slice(self.bits, rank[ids], words - lead + ends, np.array(self.fold), np.array(self.begins), hashes[by_use])
        docs = self.docs
        self.clear()
        return out, docs


def _split(key: np.ndarray, ranges: int, bits: int) -> list[int]:
    """Where each of ``ranges`` equal hash ranges begins in sorted keys."""
    bounds = np.array([(i << bits) // ranges for i in range(ranges)] + [1 << bits], dtype=np.uint64)
    return np.searchsorted(key, bounds).tolist()


def _slices(batches: Iterator[pa.RecordBatch], bits: list[int], slice_bytes: int) -> Iterator[tuple[Slice, list[tuple]]]:
    """Slices of the texts with, per piece, its doc_id and the number of its
    row if that lies in several pieces (else -1)."""
    reader, order, row = _Reader(bits), len(bits), 0
    for b in in_slices(batches, "text", slice_bytes, SLICE_DOCS):
        for doc, fold, raw in zip(b.column("doc_id").to_pylist(), b.column("fold").to_pylist(), utf8_values(b.column("text"))):
            lead, at, row = None, 0, row + 1
            size = len(raw or b"")
            several = (TaskContext.get().partitionId() << 32 | row) if size > slice_bytes else -1
            for piece in pieces((raw or b"").lower(), slice_bytes):
                # pieces of one row share no slice with other rows
                if reader.docs and (reader.bytes + len(piece) > slice_bytes or len(reader.docs) >= SLICE_DOCS or several >= 0):
                    yield reader.slice()
                at += len(piece)
                reader.add((doc, several), piece, fold, lead, at == size)
                if at < size and order > 1:
                    lead = ([b""] * (order - 1) + (lead or []) + piece.rsplit(None, order - 1))[1 - order:]
            if several >= 0:
                yield reader.slice()
    if reader.docs:
        yield reader.slice()


def _deal(bits: list[int], ranges: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, _ in _slices(batches, bits, slice_bytes):
            name, rows = s.name(), []
            for k, (key, kept, held) in enumerate(s.counted()):
                at = _split(key, ranges, bits[k])
                for r, (i, j) in enumerate(zip(at, at[1:])):
                    if j > i:
                        part = k * ranges + r
                        # distances of hashes are nearly noise, which no level packs tighter
                        rows.append((part, GRAMS, name, part, None, None, pack(np.diff(key[i:j], prepend=np.uint64((r << bits[k]) // ranges)), QUICK),
                                     pack_counts(kept[i:j], held[i:j]), None))
            yield from _rows(rows).to_batches(max_chunksize=256)
    return run


def _texts(bits: list[int], slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, docs in _slices(batches, bits, slice_bytes):
            named = pa.record_batch([pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.int64())], ["doc_id", "row"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, named.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(named)
            yield from _rows([(None, TEXT, s.name(), 0, None, int(docs[0][1] >= 0), s.packed(), sink.getvalue().to_pybytes(), None)]).to_batches()
    return run


def _count(ranges: int, bits: list[int]):
    """One hash range: the sums of all slices, answered to each of them."""
    begin = _mix(np.array(_FIXED[:1], dtype=np.uint64) + np.uint64(1))[0] >> np.uint64(64 - bits[0])

    def run(rows: pa.Table) -> pa.Table:
        names, part = rows.column("slice").to_pylist(), rows.column("part")[0].as_py()
        start = np.uint64(((part % ranges) << bits[part // ranges]) // ranges)
        keys = [np.cumsum(unpack(x.as_py()), dtype=np.uint64) + start for x in rows.column("a")]
        ends = np.cumsum([len(key) for key in keys]).tolist()
        order, key = in_order(np.concatenate(keys))
        first = _distinct(key)
        at = np.empty(len(order), dtype=np.int64)
        at[order] = np.cumsum(first) - 1
        key, first = key[first], np.flatnonzero(first)
        del keys
        kept, held = (np.add.reduceat(np.concatenate(x)[order], first) for x in zip(*(unpack_counts(x.as_py()) for x in rows.column("b"))))
        out = [(None, ANSWER, name, part, None, None, pack_counts(kept[at[i:j]], held[at[i:j]]), None, None)
               for name, i, j in zip(names, [0, *ends], ends)]
        if part < ranges:  # single tokens: how many distinct ones and how many in all there are in training
            word = key != begin
            both = (kept + held)[word]
            out.append((None, STATS, -1 - part, part, int((both > 0).sum()), int(both.sum()), pack(kept[word].sum(keepdims=True)), None, None))
        return _rows(out)
    return run


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then one bucket per power of two."""
    return np.minimum(np.frexp(context.astype(float))[1], BUCKETS - 1).astype(np.int64)


RATIO_BITS = 10


def rounded(x: np.ndarray) -> np.ndarray:
    """Positive numbers as whole STEPS of an octave, from 1 up; 0 stays 0."""
    with np.errstate(divide="ignore"):
        return np.where(x > 0, np.rint(np.log2(x, where=x > 0, out=np.zeros(len(x))) * STEPS) + (1 << RATIO_BITS - 1), 0).astype(np.int64)


def _with_contexts(along: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """From the counts at an order's places: at each token the count of the
    n-gram of every order, and of the context of every order but the first."""
    if len(along) == 1:
        return along, []
    ends = np.cumsum(n + 1)     # a piece has a lead and its tokens
    token, before = np.ones(ends[-1], dtype=bool), np.ones(ends[-1], dtype=bool)
    token[ends - n - 1], before[ends - 1] = False, False
    return [*(x[token] for x in along[:-1]), along[-1]], [x[before] for x in along[:-1]]


def _events(s: Slice, along: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Held-out events by (rounded unigram count, then per longer order bucket
    and rounded estimate), each packed into one number, with how many."""
    counts, contexts = _with_contexts(along, s.n)
    held = s.fold[s.piece[s.real]] == HELD
    key = rounded(counts[0][held].astype(float))
    for n, of in zip(counts[1:], contexts):
        n, of = n[held], of[held]
        key = (key << (RATIO_BITS + 6)) | (bucket(of) << RATIO_BITS) | rounded(n / np.maximum(1, of))
    key = np.sort(key)
    first = np.flatnonzero(_distinct(key))
    return key[first], np.diff(np.append(first, len(key)))


def _gather(rows: pa.Table) -> pa.Table:
    """One slice with its answers; rows of statistics pass through."""
    got = [dict(zip(_NAMES, r)) for r in zip(*(rows.column(x).to_pylist() for x in _NAMES))]
    texts = [g for g in got if g["kind"] == TEXT]
    if not texts:
        if any(g["kind"] == ANSWER for g in got):
            raise ValueError("the documents changed between two readings; write them to a table first")
        return _rows([tuple(g.values()) for g in got])
    s = Slice.unpacked(texts[0]["a"])   # equal slices (repeated rows) share their name, content and answers
    answers = {g["part"]: g for g in got if g["kind"] == ANSWER}
    flat = [np.concatenate(x).astype(np.int64) for x in zip(*(unpack_counts(answers[p]["a"]) for p in sorted(answers)))] or [np.zeros(0, np.int64)] * 2
    numbered = s.numbered()
    if sum(size for size, _ in numbered) != len(flat[0]):
        raise ValueError("the documents changed between two readings; write them to a table first")
    kept, along, begin = [], [], 0
    for size, at in numbered:
        kept.append(flat[0][begin:begin + size][at])
        along += ranked(flat[0][begin:begin + size] + flat[1][begin:begin + size], at)
        begin += size
    key, n = _events(s, kept)
    counts = packed([s.n, s.fold, *along], QUICK)
    out = [(None, SLICE, t["slice"], 0, None, t["n"], counts, t["b"], None) for t in texts]
    return _rows([*out, *((None, EVENTS, None, 0, int(k), int(x) * len(texts), None, None, None) for k, x in zip(key, n))])


def _event_columns(key: Column, order: int) -> list[Column]:
    """Columns u (unigram count), then b2, p2 ... of an event's number."""
    def value(code: Column) -> Column:
        return F.when(code == 0, F.lit(0.0)).otherwise(F.pow(F.lit(2.0), (code - (1 << RATIO_BITS - 1)) / STEPS))
    out, shift = [], 0
    for k in range(order, 1, -1):
        out += [F.shiftright(key, shift + RATIO_BITS).bitwiseAND(63).alias(f"b{k}"),
                value(F.shiftright(key, shift).bitwiseAND((1 << RATIO_BITS) - 1)).alias(f"p{k}")]
        shift += RATIO_BITS + 6
    return [value(F.shiftright(key, shift)).alias("u"), *out]


def learn(events: DataFrame, order: int, kept_tokens: int, vocabulary: int) -> list[np.ndarray]:
    """Weights per order (index 0: order 1, one weight) and context bucket, by
    expectation-maximisation; each round is one aggregate over the events."""
    weights = [np.full(1 if k == 1 else BUCKETS, 0.5) for k in range(1, order + 1)]
    for w in weights[1:]:
        w[0] = 0.0  # a context never seen predicts nothing
    met = [np.ones(len(w), dtype=bool) for w in weights]
    flat = cut(events.groupBy("key").agg(F.sum("n").alias("n")).select(
        "n", *_event_columns(F.col("key"), order)), "held-out-events")
    flat = flat.withColumn("p1", F.col("u") / F.lit(float(max(1, kept_tokens))))
    for _ in range(ROUNDS):
        # a component's share of the prediction: its weight, and that no longer order was taken
        left, parts = F.lit(1.0), {}
        for k in range(order, 0, -1):
            w = F.lit(float(weights[0][0])) if k == 1 else F.element_at(F.array(*[F.lit(float(x)) for x in weights[k - 1]]), (F.col(f"b{k}") + 1).cast("int"))
            parts[k] = left * w * F.col(f"p{k}")
            left = left * (1 - w)
        parts[0] = left * F.lit(1.0 / (vocabulary + 1))
        shared = flat.select("n", *[f"b{k}" for k in range(2, order + 1)], *[p.alias(f"q{k}") for k, p in parts.items()])
        whole = sum((F.col(f"q{k}") for k in range(order + 1)), F.lit(0.0))
        found = shared.groupBy(*[f"b{k}" for k in range(2, order + 1)]).agg(
            *[F.sum(F.col("n") * F.col(f"q{k}") / whole).alias(f"s{k}") for k in range(order + 1)]).collect()  # at most BUCKETS^(order-1) rows
        was, weights = weights, [w.copy() for w in weights]
        for k in range(1, order + 1):
            taken, reached = np.zeros(len(weights[k - 1])), np.zeros(len(weights[k - 1]))
            for r in found:
                b = 0 if k == 1 else r[f"b{k}"]
                taken[b] += r[f"s{k}"]
                reached[b] += sum(r[f"s{j}"] for j in range(k + 1))
            weights[k - 1] = (taken + PRIOR / 2) / (reached + PRIOR)
            if k > 1:
                weights[k - 1][0] = 0.0
                met[k - 1] = reached > 0
        if max(np.abs(a - b).max() for a, b in zip(was, weights)) < SETTLED:
            break
    for w, seen in zip(weights[1:], met[1:]):  # a bucket without events takes its lower neighbour's weight
        for b in range(2, BUCKETS):
            if not seen[b]:
                w[b] = w[b - 1]
    return weights


def _score(weights: list[np.ndarray], tokens: int, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("a"), batch.column("b")):
                n, held_out, *along = (x.astype(np.int64) for x in unpacked(a.as_py()))
                along = [values[at] for values, at in zip(along[::2], along[1::2])]
                counts, contexts = _with_contexts(along, n)
                p = weights[0][0] * counts[0] / max(1, tokens) + (1 - weights[0][0]) / (vocabulary + 1)
                for w, c, of in zip(weights[1:], counts[1:], contexts):
                    w = w[bucket(of)]
                    p = w * c / np.maximum(1, of) + (1 - w) * p
                base = np.log10((counts[0] + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
                piece = np.repeat(np.arange(len(n)), n)
                known, base, score = (np.bincount(piece, x, minlength=len(n)) for x in (
                    (counts[0] > 0).astype(float), base, np.log10(p) if tokens else np.zeros(len(p))))
                docs = pa.ipc.open_stream(b.as_py()).read_next_batch()
                yield pa.RecordBatch.from_arrays(
                    [docs.column("doc_id"), docs.column("row"), pa.array(held_out == TEST), pa.array(n), pa.array(known.astype(np.int64)),
                     pa.array(base), pa.array(score)], ["doc_id", "row", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def fold(doc_id: str = "doc_id") -> Column:
    """TEST where crc32 of the id's text leaves no remainder by 10; of the rest
    one in ten (by the next digit) is held out when the weights are learned."""
    crc = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return (F.when(crc % 10 == 0, TEST).when((crc / 10).cast("bigint") % 10 == 0, HELD).otherwise(KEPT)).cast("int")


def scored(docs: DataFrame, order: int = ORDER, slice_bytes: int = SLICE_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (see the module docstring)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    wide, narrow = 2 * int(size).bit_length() - 4, int(size).bit_length() + 18
    bits = [min(62, max(40, wide if k == 1 else narrow)) for k in range(1, order + 1)]
    ranges = 1 + size // range_bytes
    texts = texts.withColumn("fold", fold())
    counted = texts.mapInArrow(_deal(bits, ranges, slice_bytes), _SCHEMA).groupBy("home").applyInArrow(_count(ranges, bits), _SCHEMA)
    again = texts.mapInArrow(_texts(bits, slice_bytes), _SCHEMA)
    with session_conf(spark, spark__sql__execution__arrow__maxBytesPerBatch="4m"):  # texts reach a task in small portions
        held = cut(again.unionByName(counted).groupBy("slice").applyInArrow(_gather, _SCHEMA), "scored-slices")
    stats = held.where(F.col("kind") == STATS).select("key", "n", "a").collect()  # one row per hash range
    vocabulary, tokens = sum(r.key for r in stats), sum(r.n for r in stats)
    kept_tokens = sum(int(unpack(bytes(r.a))[0]) for r in stats)
    weights = learn(held.where(F.col("kind") == EVENTS), order, kept_tokens, vocabulary)

    def score(in_pieces: int) -> DataFrame:
        rows = held.where((F.col("kind") == SLICE) & (F.col("n") == in_pieces)).select("a", "b")
        return rows.mapInArrow(_score(weights, tokens, vocabulary), "doc_id bigint, row bigint, held_out boolean, n_tokens bigint, "
                               "n_known bigint, base_score double, score double")
    sums = ["n_tokens", "n_known", "base_score", "score"]
    pieced = score(1).groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in sums])
    return score(0).unionByName(pieced).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
                                               "base_score", "score")


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document of ``documents``."""
    return scored(table(spark, sf_dir, "documents"))
