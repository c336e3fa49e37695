"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

State of a ``LineIndex`` (three written tables, sharded by key hash):

* ``refs``  -- exact reference counts: key (128-bit digest of the normalised
  line), n_docs (documents holding it), max_doc (largest of them);
* ``filters`` -- per shard a cuckoo filter over its keys.  An inserted batch
  is probed first: keys the filter excludes are new and are appended without
  touching ``refs``; only the rest is joined with it.  Deleting documents
  takes keys whose count falls to zero out of both, so that the index after
  insert and delete equals the index before;
* ``heavy`` filters -- per shard a cuckoo filter over the keys with at least
  ``min_docs`` documents.  While they fit ``HEAVY_FILTER_BYTES`` they are
  broadcast, and a document's other lines never leave its task; beyond that
  all keys are shuffled, with the same result.

Counts are combined per slice of documents before the shuffle, so a line
that is in a third of all documents is one row per slice, not per document.
The reference table is joined with documents row by row; adaptive execution
splits a hot key there.

Rule: a key of at least ``min_chars`` code points found in ``min_docs``
documents loses all its lines but those in the largest doc_id holding it.
Defined results: null or empty text is one empty line; a null doc_id is
smaller than any other; a repeated row is a document of its own, and rows
tied on the largest doc_id all keep the line.  Further columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import NO_ID, cut, id_key, in_slices, table, utf8_values
from pitchlake.llm.cuckoo import CuckooFilter, filled, split_keys

MIN_CHARS, MIN_DOCS = 20, 3
HEAVY_FILTER_BYTES = 64 << 20
BLANK = b" \t\n\x0b\x0c\r"
KEY = pa.binary(16)


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Digest of a line's key, None if the key is too short to count."""
    key = line.strip(BLANK).lower()  # bytes.lower() changes A-Z only
    n = len(key)
    if n < min_chars or n < 4 * min_chars and not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def document_keys(raw: bytes | None, min_chars: int = MIN_CHARS) -> set[bytes]:
    keys = {line_key(x, min_chars) for x in (raw or b"").split(b"\n")}
    keys.discard(None)
    return keys


def _ids(batch: pa.RecordBatch) -> list[int]:
    return [NO_ID if x is None else x for x in batch.column("doc_id").to_pylist()]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns read; ``text_id`` parts rows without an id by their texts."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "text_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)))


def _by_shard(a: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys by shard, and the bounds of each shard in it."""
    shard = ((a >> np.uint64(16)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def batch_counts(docs: DataFrame, shards: int, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per slice of documents and shard: keys, counts and largest ids, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "text"):
            held: dict[bytes, list[int]] = {}
            for doc, raw in zip(_ids(b), utf8_values(b.column("text"))):
                for k in document_keys(raw, min_chars):
                    if (x := held.get(k)) is None:
                        held[k] = [1, doc]
                    else:
                        x[0] += 1
                        x[1] = max(x[1], doc)
            if not held:
                continue
            words = np.frombuffer(b"".join(held), dtype="<u8").reshape(-1, 2)
            count, largest = np.array(list(held.values()), dtype=np.int64).T
            order, at = _by_shard(words[:, 0], shards)
            words, count, largest = words[order], count[order].astype(np.int32), largest[order]
            rows = [(s, words[i:j].tobytes(), count[i:j].tobytes(), largest[i:j].tobytes())
                    for s, (i, j) in enumerate(zip(at, at[1:])) if j > i]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["shard", "keys", "counts", "largest"])
    return _documents(docs).mapInArrow(run, "shard bigint, keys binary, counts binary, largest binary")


def _merged(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a shard with summed counts and largest ids."""
    join = lambda c: b"".join(t.column(c).to_pylist())
    a, b = split_keys(join("keys"))
    count = np.frombuffer(join("counts"), dtype=np.int32).astype(np.int64)
    largest = np.frombuffer(join("largest"), dtype=np.int64)
    order = np.lexsort((b, a))
    a, b, count, largest = a[order], b[order], count[order], largest[order]
    if not len(a):
        return a, b, count, largest
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[start], b[start], np.add.reduceat(count, start), np.maximum.reduceat(largest, start)


def _key_array(a: np.ndarray, b: np.ndarray) -> pa.Array:
    data = np.column_stack([a, b]).astype("<u8").tobytes()
    return pa.Array.from_buffers(KEY, len(a), [None, pa.py_buffer(data)]).cast(pa.binary())


_SHARD_ROWS = "shard bigint, key binary, n_docs bigint, max_doc bigint, known boolean, filter binary"


def _shard_rows(shard: int, a, b, count, largest, known, blob: bytes | None) -> pa.Table:
    """Key rows, and one more row with the shard's filter."""
    n, extra = len(a), int(blob is not None)
    pad = lambda x, kind: pa.concat_arrays([pa.array(x, kind), pa.nulls(extra, kind)])
    return pa.table({"shard": pa.array(np.full(n + extra, shard)),
                     "key": pa.concat_arrays([_key_array(a, b), pa.nulls(extra, pa.binary())]),
                     "n_docs": pad(count, pa.int64()), "max_doc": pad(largest, pa.int64()), "known": pad(known, pa.bool_()),
                     "filter": pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([blob] * extra, pa.binary())])})


def _insert_shard(new: pa.Table, held: pa.Table) -> pa.Table:
    """Probe the shard's filter with a batch's keys, and add the new ones."""
    shard = (new if new.num_rows else held).column("shard")[0].as_py()
    blob = held.column("filter")[0].as_py() if held.num_rows else None
    a, b, count, largest = _merged(new)
    if blob is None:
        return _shard_rows(shard, a, b, count, largest, np.zeros(len(a), bool), filled(a, b).to_bytes())
    f = CuckooFilter.from_bytes(blob)
    known = f.contains(a, b)
    # a key that shares its fingerprint with another gets no second entry
    # here; growth and false positives are settled against the exact table
    grown = None if f.insert(a[~known], b[~known]) else b""
    return _shard_rows(shard, a, b, count, largest, known, f.to_bytes() if grown is None else grown)


def _rebuilt(refs: DataFrame) -> DataFrame:
    """Filters made anew from the exact table."""
    def run(t: pa.Table) -> pa.Table:
        a, b = split_keys(b"".join(t.column("key").to_pylist()))
        return pa.table({"shard": t.column("shard").slice(0, 1), "filter": pa.array([filled(a, b).to_bytes()], pa.binary())})
    return refs.select("shard", "key").groupBy("shard").applyInArrow(run, "shard bigint, filter binary")


@dataclass
class LineIndex:
    """Exact counts and filters; every operation returns a new index."""
    refs: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int = MIN_CHARS

    @classmethod
    def empty(cls, spark: SparkSession, shards: int | None = None, min_chars: int = MIN_CHARS) -> LineIndex:
        """``shards`` (default: four per shuffle partition) bounds what one
        task holds: about keys / shards times 28 bytes."""
        shards = shards or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(spark.createDataFrame([], "shard bigint, key binary, n_docs bigint, max_doc bigint"),
                   spark.createDataFrame([], "shard bigint, filter binary"), shards, min_chars)

    @classmethod
    def build(cls, docs: DataFrame, shards: int | None = None, min_chars: int = MIN_CHARS) -> LineIndex:
        """An empty index with ``docs`` inserted."""
        index = cls.empty(docs.sparkSession, shards, min_chars)
        rows = cut(batch_counts(docs, index.shards, min_chars).groupBy("shard")
                   .applyInArrow(lambda t: _insert_shard(t, t.slice(0, 0)), _SHARD_ROWS), "line-refs")
        return cls(rows.where("key is not null").select("shard", "key", "n_docs", "max_doc"),
                   rows.where("key is null").select("shard", "filter"), index.shards, min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        delta = batch_counts(docs, self.shards, self.min_chars)
        rows = cut(delta.groupBy("shard").cogroup(self.filters.groupBy("shard"))
                   .applyInArrow(_insert_shard, _SHARD_ROWS), "line-delta")
        fresh = rows.where("key is not null and not known").select("shard", "key", "n_docs", "max_doc")
        maybe = rows.where("known").select("shard", "key", F.col("n_docs").alias("more"), F.col("max_doc").alias("largest"))
        held = self.refs.join(maybe, ["shard", "key"], "full").select(
            "shard", "key", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"),
            F.greatest("max_doc", "largest").alias("max_doc"))
        refs = cut(held.unionByName(fresh), "line-refs")
        added = rows.where("key is null").select("shard", "filter")
        small = added.where(F.length("filter") == 0).select("shard")
        # false positives of the filter have no entry of their own yet
        missed = maybe.join(self.refs, ["shard", "key"], "left_anti").select("shard")
        redo = cut(small.union(missed).distinct(), "line-redo")
        filters = added.join(redo, "shard", "left_anti").unionByName(_rebuilt(refs.join(redo, "shard", "left_semi")))
        return LineIndex(refs, cut(filters, "line-filters"), self.shards, self.min_chars)

    def delete(self, gone: DataFrame, remaining: DataFrame) -> LineIndex:
        """Take the documents ``gone`` out; ``remaining`` are those still
        indexed (read only to find the new largest document of a key whose
        largest one went)."""
        def run(t: pa.Table) -> pa.Table:
            a, b, count, largest = _merged(t)
            return _shard_rows(t.column("shard")[0].as_py(), a, b, count, largest, np.ones(len(a), bool), None)
        less = cut(batch_counts(gone, self.shards, self.min_chars).groupBy("shard").applyInArrow(run, _SHARD_ROWS)
                   .select("shard", "key", F.col("n_docs").alias("less"), F.col("max_doc").alias("gone_doc")), "line-less")
        left = cut(self.refs.join(less, ["shard", "key"], "left")
                   .withColumn("n_docs", F.col("n_docs") - F.coalesce("less", F.lit(0))), "line-left")
        stale = left.where("n_docs > 0 and gone_doc >= max_doc").select("key")
        largest = (key_pairs(remaining, None, self.min_chars).join(stale, "key", "left_semi")
                   .groupBy("key").agg(F.max("doc_id").alias("new_max")))
        refs = cut(left.where("n_docs > 0").join(largest, "key", "left")
                   .select("shard", "key", "n_docs", F.coalesce("new_max", "max_doc").alias("max_doc")), "line-refs")
        dead = left.where("n_docs <= 0").select("shard", "key")

        def drop(keys: pa.Table, held: pa.Table) -> pa.Table:
            out = held.select(["shard", "filter"])
            if held.num_rows and keys.num_rows:
                f = CuckooFilter.from_bytes(held.column("filter")[0].as_py())
                f.delete(*split_keys(b"".join(keys.column("key").to_pylist())))
                out = pa.table({"shard": held.column("shard"), "filter": pa.array([f.to_bytes()], pa.binary())})
            return out
        filters = dead.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(drop, "shard bigint, filter binary")
        return LineIndex(refs, cut(filters, "line-filters"), self.shards, self.min_chars)

    def clean(self, docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
        """(doc_id, text, n_lines, n_dropped, kept_sha256) per row of ``docs``."""
        heavy = cut(self.refs.where(F.col("n_docs") >= min_docs).select("shard", "key", "max_doc"), "line-heavy")
        filters = cut(_rebuilt(heavy), "line-heavy-filters")
        size = filters.agg(F.sum(F.length("filter"))).first()[0] or 0
        held = {r.shard: bytes(r.filter) for r in filters.collect()} if size <= HEAVY_FILTER_BYTES else None
        pairs = key_pairs(docs, held, self.min_chars, self.shards)
        drops = (pairs.join(heavy.select("key", "max_doc"), "key").where(F.col("doc_id") < F.col("max_doc"))
                 .groupBy(F.col("doc_id").alias("id"), "text_id").agg(F.collect_set("key").alias("drop")))
        rows = _documents(docs).withColumn("id", id_key()).join(drops.hint("shuffle_hash"), ["id", "text_id"], "left")
        min_chars = self.min_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in in_slices(batches, "text"):
                texts, lines, lost, sha = [], [], [], []
                for raw, drop in zip(utf8_values(b.column("text")), b.column("drop").to_pylist()):
                    raw = raw or b""
                    n, kept = raw.count(b"\n") + 1, raw
                    m = n
                    if drop:
                        gone = set(drop)
                        rest = [x for x in raw.split(b"\n") if line_key(x, min_chars) not in gone]
                        m, kept = len(rest), b"\n".join(rest)
                    texts.append(kept)
                    lines.append(n)
                    lost.append(n - m)
                    sha.append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()),
                     pa.array(lost, pa.int64()), pa.array(sha, pa.string())],
                    ["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"])
        return rows.select("doc_id", "text", "drop").mapInArrow(
            run, "doc_id bigint, text string, n_lines bigint, n_dropped bigint, kept_sha256 string")


def key_pairs(docs: DataFrame, filters: dict[int, bytes] | None, min_chars: int = MIN_CHARS, shards: int = 1) -> DataFrame:
    """(doc_id, text_id, key) of the lines that count; given filters leave out
    keys that are certainly not theirs."""
    sent = docs.sparkSession.sparkContext.broadcast(filters) if filters is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = {s: CuckooFilter.from_bytes(f) for s, f in sent.value.items()} if sent else {}
        for b in in_slices(batches, "text"):
            keys, counts = [], []
            for raw in utf8_values(b.column("text")):
                found = document_keys(raw, min_chars)
                keys += found
                counts.append(len(found))
            if not keys:
                continue
            words = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
            ids = np.repeat(np.array([_ids(b), b.column("text_id").to_pylist()], dtype=np.int64), counts, axis=1)
            if sent is not None:
                order, at = _by_shard(words[:, 0], shards)
                words, ids = words[order], ids[:, order]
                keep = np.zeros(len(words), dtype=bool)
                for s, (i, j) in enumerate(zip(at, at[1:])):
                    if j > i and s in loaded:
                        keep[i:j] = loaded[s].contains(words[i:j, 0], words[i:j, 1])
                words, ids = words[keep], ids[:, keep]
            yield pa.RecordBatch.from_arrays([*map(pa.array, ids), _key_array(words[:, 0], words[:, 1])], ["doc_id", "text_id", "key"])
    return _documents(docs).mapInArrow(run, "doc_id bigint, text_id bigint, key binary")


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Index all documents, then drop their repeated lines."""
    return LineIndex.build(docs, min_chars=min_chars).clean(docs, min_docs)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` without its repeated lines."""
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


OP6_SQL = r"""
WITH l AS (
  SELECT doc_id, u.line, u.pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) d,
       LATERAL (SELECT unnest(d.lines) AS line, generate_subscripts(d.lines, 1) AS pos) u),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
heavy AS (
  SELECT key, max(doc_id) AS max_doc FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, (heavy.key IS NOT NULL AND k.doc_id < heavy.max_doc) AS dropped FROM k LEFT JOIN heavy USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
