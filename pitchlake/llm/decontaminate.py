"""Benchmark decontamination with suffix arrays over the training text.

Documents are read in slices; the words of a slice form one shard.  A shard
gets a word-level suffix array: suffixes are sorted by their first three
words packed into one integer (two words if a shard has so many distinct
ones, about two million, that three do not fit), and groups that tie are
refined by prefix doubling up to the longest test item.  Every suffix of every test item is
then binary-searched in the shard, all of them at once: an interval of the
array is narrowed word by word.  The intervals of one depth are disjoint, and
those of the next lie inside them, so the number of intervals around a place
of the array is the longest verbatim match that starts there; a document's
longest match is the largest of its places, the first of them if several
are.  Intervals at the window depth (WINDOW words, or the whole of a shorter
item) mark document words as hit.  A document lies in one shard, so this needs no
shuffle.

The benchmark is the query set.  It is read in blocks of about BLOCK_BYTES
by item hash, and one block at a time is sent to the tasks.  With one block
the shards live only in their task.  With more, the sorted shards are written
once to the shared folder; each block reads them, is released before the
next one is sent, and the hits are merged per document.

Defined results: a text without words (null, empty) has no windows and is
never hit; a null item_id is listed as ``null``; rows that repeat an item_id
are one item with the windows of all; repeated documents are judged each on
its own, as is a null doc_id.  Further columns are ignored by
``contamination`` and kept by ``remove_contaminated``.  An empty benchmark
leaves every document clean.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.common import NO_ID, cut, in_slices, table, utf8_values

WINDOW, PACKED = 10, 3
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 8 << 20

# a word is a run of 0-9, a-z (A-Z lower-cased) and bytes of non-ASCII characters
_FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
              for c in range(256))

Block = list[tuple[str, list[bytes]]]


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_FOLD).split() if raw else []


class Shard:
    """Suffix array of the words of some documents."""

    def __init__(self, texts: list[bytes | None], longest_query: int):
        vocabulary: dict[bytes, int] = defaultdict()
        vocabulary.default_factory = lambda: len(vocabulary) + 1  # 0 ends a document
        flat: list[bytes] = []
        self.starts = np.zeros(len(texts) + 1, dtype=np.int64)  # of each document, with its end mark
        parts = []
        for i, raw in enumerate(texts):
            flat = words_of(raw)
            parts.append(np.fromiter(map(vocabulary.__getitem__, flat), dtype=np.int64, count=len(flat)))
            parts.append(np.zeros(1, dtype=np.int64))
            self.starts[i + 1] = self.starts[i] + len(flat) + 1
        vocabulary.default_factory = None
        self.ids = vocabulary
        self.n_words = np.diff(self.starts) - 1
        self.seq = np.concatenate([*parts, np.zeros(PACKED, dtype=np.int64)])
        self.base = len(vocabulary) + 1
        self.packed = PACKED  # words that fit one key: a long text of many distinct words takes fewer
        while self.base ** self.packed >= 2 ** 63:
            self.packed -= 1
        self._sort(longest_query)

    def _first_words(self) -> np.ndarray:
        """The first words of every suffix as one number."""
        n = len(self.seq) - PACKED
        key = np.zeros(n, dtype=np.int64)
        for d in range(self.packed):
            key = key * self.base + self.seq[d:n + d]
        return key

    def dump(self) -> list[bytes]:
        """The sorted shard as bytes, for ``load``."""
        numbers = [self.starts, self.seq.astype("<i4"), self.array.astype("<i4"), np.array([self.packed], dtype="<i8")]
        parts = [a.tobytes() for a in numbers] + [b" ".join(self.ids)]
        return [len(p).to_bytes(8, "little") + pa.compress(p, codec="zstd", asbytes=True) for p in parts]

    @classmethod
    def load(cls, parts: list[bytes]) -> Shard:
        starts, seq, array, packed, words = (pa.decompress(p[8:], int.from_bytes(p[:8], "little"), codec="zstd", asbytes=True) for p in parts)
        self = cls.__new__(cls)
        self.starts, self.packed = np.frombuffer(starts, dtype="<i8"), int.from_bytes(packed, "little")
        self.seq, self.array = np.frombuffer(seq, dtype="<i4").astype(np.int64), np.frombuffer(array, dtype="<i4").astype(np.int64)
        self.ids = {w: i for i, w in enumerate(words.split(), 1)}
        self.base, self.n_words = len(self.ids) + 1, np.diff(self.starts) - 1
        self.keys = self._first_words()[self.array]
        return self

    def _sort(self, longest_query: int) -> None:
        n = len(self.seq) - PACKED
        key = self._first_words()
        self.array = np.argsort(key, kind="stable")
        self.keys = key[self.array]
        depth = self.packed
        new = np.concatenate([[True], self.keys[1:] != self.keys[:-1]]) if n else np.zeros(0, dtype=bool)
        rank = np.empty(n + 1, dtype=np.int64)  # a suffix's group: the first place in the array that it may take
        rank[n] = -1
        rank[self.array] = np.flatnonzero(new)[np.cumsum(new) - 1] if n else []
        while depth < longest_query:
            tied = np.flatnonzero(~(new & np.append(new[1:], True)))  # places in groups of two or more
            if not len(tied):
                break
            at = self.array[tied]
            group, after = rank[at], rank[np.minimum(at + depth, n)]
            order = np.lexsort((after, group))
            at, group, after = at[order], group[order], after[order]
            self.array[tied] = at  # groups keep their places
            fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
            new[tied] = fresh
            rank[at] = tied[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
            depth *= 2

    def narrow(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Within intervals that share ``depth`` words, those whose next word is ``word``."""
        ends = []
        last = len(self.seq) - 1
        for side in (0, 1):  # first place whose next word is >= word, then > word
            a, b = lo.copy(), hi.copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                at = self.array[np.minimum(mid, len(self.array) - 1)]
                less = self.seq[np.minimum(at + depth, last)] < word + side
                a = np.where(open_ & less, mid + 1, a)
                b = np.where(open_ & ~less, mid, b)
            ends.append(a)
        return ends[0], ends[1]

    def search(self, query: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place of ``query`` (word numbers, at most 0 where there is
        no such word): the interval that matches its first ``need`` words (none
        if need is 0).  For each place of the array: the longest match there."""
        m = len(query) - PACKED
        lo, hi = np.zeros(m, np.int64), np.zeros(m, np.int64)
        deeper = np.zeros(len(self.array) + 1, np.int64)  # change of the longest match from place to place
        a, b = np.zeros(m, np.int64), np.full(m, len(self.array), np.int64)
        prefix, live = np.zeros(m, np.int64), np.arange(m)
        depth = 0
        while len(live):
            word = query[live + depth] if depth < self.packed else query[np.minimum(live + depth, len(query) - 1)]
            known = word > 0
            live, word = live[known], word[known]
            if depth < self.packed:
                prefix[live] = prefix[live] * self.base + word
                unit = self.base ** (self.packed - depth - 1)
                x = np.searchsorted(self.keys, prefix[live] * unit, "left")
                y = np.searchsorted(self.keys, (prefix[live] + 1) * unit, "left")
            else:
                x, y = self.narrow(a[live], b[live], depth, word)
            found = x < y
            live, depth = live[found], depth + 1
            a[live], b[live] = x[found], y[found]
            begin, one = np.unique(x[found], return_index=True)  # equal words of the test items share an interval
            deeper[begin] += 1
            deeper[y[found][one]] -= 1
            exact = live[need[live] == depth]
            lo[exact], hi[exact] = a[exact], b[exact]
        return lo, hi, np.cumsum(deeper[:-1])


class Queries:
    """The suffixes of a block of test items."""

    def __init__(self, block: Block, window: int):
        self.names = [name for name, _ in block]
        self.words = list({w for _, ws in block for w in ws})
        number = {w: i for i, w in enumerate(self.words)}
        flat, need, item = [], [], []
        for i, (_, ws) in enumerate(block):
            size = min(window, len(ws))
            for j, w in enumerate(ws):
                flat.append(number[w])
                need.append(size if j + size <= len(ws) else 0)
                item.append(i)
            flat.append(-1)
            need.append(0)
            item.append(i)
        self.flat = np.array([*flat, *[-1] * PACKED], dtype=np.int64)
        self.need, self.item = np.array(need, dtype=np.int64), np.array(item, dtype=np.int64)
        self.longest = max((len(ws) for _, ws in block), default=0)

    def hits(self, shard: Shard) -> tuple[np.ndarray, list[list[int]], list[list[str]], list[int], list[int]]:
        """Per text of the shard: number of words, merged hit spans, items,
        longest match and where it starts."""
        texts = len(shard.n_words)
        spans: list[list[int]] = [[] for _ in range(texts)]
        items: list[list[str]] = [[] for _ in range(texts)]
        best, best_at = [0] * texts, [-1] * texts
        if len(self.need):
            # numbers of the query words in this shard; -1 where it has no such word
            numbers = np.array([shard.ids.get(w, -1) for w in self.words] + [-1], dtype=np.int64)
            query = numbers[self.flat]
            lo, hi, matched = shard.search(query, self.need)
            length = np.zeros(len(shard.array), dtype=np.int64)  # by place in the text
            length[shard.array] = matched
            for d in np.unique(np.searchsorted(shard.starts, np.flatnonzero(length), "right") - 1).tolist():
                own = length[shard.starts[d]:shard.starts[d + 1]]
                best_at[d] = int(own.argmax())
                best[d] = int(own[best_at[d]])
            if found := np.flatnonzero(hi > lo).tolist():
                self._collect(shard, lo, hi, found, spans, items)
        return shard.n_words, spans, items, best, best_at

    def _collect(self, shard, lo, hi, found, spans, items) -> None:
        delta = np.zeros(len(shard.seq) + 1, dtype=np.int64)
        pairs = set()
        for q in found:
            at = shard.array[lo[q]:hi[q]]
            size = int(self.need[q])
            delta[at] += 1  # places of one window are distinct
            delta[at + size] -= 1
            docs = np.searchsorted(shard.starts, at, "right") - 1
            pairs.update((d, int(self.item[q])) for d in np.unique(docs).tolist())
        for d, i in pairs:
            items[d].append(self.names[i])
        hit = (np.cumsum(delta) > 0).astype(np.int8)
        edge = np.diff(np.concatenate([[0], hit, [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for d, x, y in zip((np.searchsorted(shard.starts, begin, "right") - 1).tolist(), begin.tolist(), end.tolist()):
            spans[d] += [int(x - shard.starts[d]), int(y - shard.starts[d])]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[int, int, Callable[[int], Block]]:
    """The test items in blocks of about ``block_bytes``, by item hash: how
    many blocks, a bound of the words of an item, and a function that reads one block."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total, longest = items.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    n = -(-(total or 0) // block_bytes) or 1

    def read(i: int) -> Block:
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        return [("null" if r.item_id is None else r.item_id, words_of((r.text or "").encode())) for r in rows]
    return n, (longest or 0) // 2 + 1, read


_HITS = ("doc_id bigint, text_key bigint, n_words bigint, spans array<bigint>, items array<string>, longest bigint, longest_at bigint")


def _hit_rows(ids: pa.Array, keys: pa.Array, hits: tuple) -> pa.RecordBatch:
    n, spans, items, best, at = hits
    return pa.RecordBatch.from_arrays(
        [ids, keys, pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())),
         pa.array(best, pa.int64()), pa.array(at, pa.int64())], [c.split()[0] for c in _HITS.split(", ")])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                       F.col("text").cast("string").alias("text"))


def _scan(docs: DataFrame, block: Block, window: int) -> DataFrame:
    """All documents against one block, in one pass."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(sent.value, window)
        for b in in_slices(batches, "text", SHARD_BYTES):
            shard = Shard(utf8_values(b.column("text")), queries.longest)
            yield _hit_rows(b.column("doc_id"), b.column("text_key"), queries.hits(shard))
    return _keyed(docs).mapInArrow(run, _HITS)


def sorted_shards(docs: DataFrame, longest_query: int) -> DataFrame:
    """The documents' shards, sorted and written once: (ids, text_keys, parts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "text", SHARD_BYTES):
            shard = Shard(utf8_values(b.column("text")), longest_query)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([b.column("text_key").to_pylist()], pa.list_(pa.int64())),
                 pa.array([shard.dump()], pa.list_(pa.binary()))], ["ids", "text_keys", "parts"])
    return cut(_keyed(docs).mapInArrow(run, "ids array<bigint>, text_keys array<bigint>, parts array<binary>"), "shards")


def _scan_shards(shards: DataFrame, block: Block, window: int) -> DataFrame:
    """All shards against one block; the block is released when they are done."""
    sent = shards.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(sent.value, window)
        for b in batches:
            for i in range(b.num_rows):
                shard = Shard.load(b.column("parts")[i].as_py())
                yield _hit_rows(b.column("ids")[i].values, b.column("text_keys")[i].values, queries.hits(shard))
    found = cut(shards.mapInArrow(run, _HITS), "contamination")
    sent.destroy()
    return found


def _all_hits(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """(doc_id, text_key, n_words, spans, items, longest, longest_at) per document."""
    n, longest, read = benchmark_blocks(benchmark, block_bytes)
    if n == 1:
        return _scan(docs, read(0), window)
    shards = sorted_shards(docs, longest)
    parts = [_scan_shards(shards, read(i), window) for i in range(n)]
    key: Column = F.coalesce("doc_id", F.lit(NO_ID))
    return (reduce(DataFrame.unionByName, parts).groupBy(key.alias("key"), "text_key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_set("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"),
        F.max(F.struct("longest", (-F.col("longest_at")).alias("back"))).alias("best"), (F.count("*") / n).cast("int").alias("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("doc_id", "text_key", "n_words", "spans", "items", "best.longest", (-F.col("best.back")).alias("longest_at")))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and digests from the spans and items of one or more blocks."""
    for b in batches:
        hit, n_items, sha, merged = [], [], [], []
        for spans, items in zip(b.column("spans").to_pylist(), b.column("items").to_pylist()):
            whole: list[dict[str, int]] = []
            for x, y in sorted(zip(spans[::2], spans[1::2])):
                if whole and x <= whole[-1]["end"]:
                    whole[-1]["end"] = max(whole[-1]["end"], y)
                else:
                    whole.append({"begin": x, "end": y})
            merged.append(whole)
            total = sum(s["end"] - s["begin"] for s in whole)
            names = sorted(set(items))
            hit.append(total)
            n_items.append(len(names))
            sha.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("n_words"), pa.array(hit, pa.int64()), pa.array(n_items, pa.int64()),
             pa.array(sha, pa.string()), pa.array([h > 0 for h in hit], pa.bool_()), b.column("longest"), b.column("longest_at"),
             pa.array(merged, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match", "longest_at", "spans"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, the
    longest verbatim match of any length (words, place of its first word or
    -1), and the spans of hit words (begin, end)."""
    return (_all_hits(docs, benchmark, window, block_bytes).select("doc_id", "n_words", "spans", "items", "longest", "longest_at")
            .mapInArrow(_merged, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
                                 "contaminated boolean, longest_match bigint, longest_at bigint, "
                                 "spans array<struct<begin:bigint,end:bigint>>"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents that hold a test window; columns unchanged."""
    n, _, read = benchmark_blocks(benchmark, block_bytes)
    if n > 1:
        hit = _all_hits(docs, benchmark, window, block_bytes).where(F.size("spans") > 0)
        hit = hit.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
        return docs.join(hit, (F.coalesce(docs["doc_id"], F.lit(NO_ID)) == hit["hit_id"]) & (F.xxhash64(docs["text"]) == hit["hit_key"]), "left_anti")
    sent = docs.sparkSession.sparkContext.broadcast(read(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(sent.value, window)
        for b in in_slices(batches, "text", SHARD_BYTES):
            spans = queries.hits(Shard(utf8_values(b.column("text")), queries.longest))[1]
            yield b.filter(pa.array([not s for s in spans], pa.bool_()))
    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` against the whole ``benchmark``."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[j:j + least(len(ws), 10) - 1], ' ') AS w
  FROM b, LATERAL (SELECT unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS j) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM win),
places AS (
  SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS w
  FROM d, sizes, LATERAL (SELECT unnest(range(1, len(ws) - size + 2)) AS i) WHERE len(ws) >= size),
occ AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN win USING (size, w)),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM occ, LATERAL (SELECT unnest(range(i, i + size)) AS k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
