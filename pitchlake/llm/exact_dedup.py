"""Exact dedup by composable polynomial fingerprints.

A text is normalised (A-Z lower-cased, UTF-8) and cut into chunks.  A chunk
``c`` of ``n`` bytes has the fingerprint ``(n, H(c), B^n)`` with
``H(c) = sum c[i] * B^(n-1-i) mod p`` for two 31-bit primes.  Fingerprints
compose: ``H(xy) = H(x) * B^|y| + H(y)``, so the chunks of a huge document
are hashed independently, a block of equal-sized chunks in one vector
operation, and folded with length-shifted arithmetic.  No step holds more
than one slice of a text besides the text itself.

Equal fingerprints only nominate.  Every nominated text is compared chunk
by chunk with its group's representative in Spark: chunks are joined on
(group, chunk number, salt), where a group of copies is dealt over
``ceil(size / COPIES_PER_SALT)`` salts, so that a group with a third of all
rows is spread over the cluster.  Texts that differ from the representative
(a collision) form the next round's groups until none is left.

Defined results: a null text counts as empty; all empty texts form one
group.  The unit is the row: repeated rows are members of one group and
only one of the rows tied on the largest doc_id stays.  A null doc_id is
smaller than any other; in a group without ids one row stays and keep_id is
null.  Rows that share a doc_id but not a text are separate documents.
Further columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import NO_ID, ascii_lower, cut, id_key, in_slices, session_conf, table, unused, utf8_values

PRIMES = (2 ** 31 - 1, 2 ** 31 - 19)
BASES = (1_000_003, 1_073_741_789)
CHUNK = 1 << 14          # bytes hashed as one unit
COMPARE_CHARS = 1 << 15  # code points compared as one unit
COPIES_PER_SALT = 256

Fingerprint = tuple[int, tuple[int, int], tuple[int, int]]
EMPTY: Fingerprint = (0, (0, 0), (1, 1))


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod prime by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:n]


_DESCENDING = [np.ascontiguousarray(_powers(b, p, CHUNK)[::-1]) for b, p in zip(BASES, PRIMES)]


def combine(x: Fingerprint, y: Fingerprint) -> Fingerprint:
    """Fingerprint of the concatenation: x shifted by the length of y, plus y."""
    return (x[0] + y[0],
            tuple((hx * sy + hy) % p for hx, sy, hy, p in zip(x[1], y[2], y[1], PRIMES)),
            tuple(sx * sy % p for sx, sy, p in zip(x[2], y[2], PRIMES)))


def chunk_fingerprints(data: bytes) -> list[Fingerprint]:
    """One fingerprint per chunk; whole chunks are hashed as one matrix."""
    raw, out = np.frombuffer(data, dtype=np.uint8), []
    whole = len(raw) // CHUNK
    step = 64  # chunks a matrix product takes at once
    for start in range(0, whole, step):
        block = raw[start * CHUNK:min(start + step, whole) * CHUNK].reshape(-1, CHUNK).astype(np.uint64)
        hs = [block @ d % np.uint64(p) for d, p in zip(_DESCENDING, PRIMES)]
        shift = tuple(pow(b, CHUNK, p) for b, p in zip(BASES, PRIMES))
        out += [(CHUNK, (int(a), int(b)), shift) for a, b in zip(*hs)]
    if rest := len(raw) - whole * CHUNK:
        tail = raw[whole * CHUNK:].astype(np.uint64)
        out.append((rest, tuple(int(tail @ d[CHUNK - rest:] % np.uint64(p)) for d, p in zip(_DESCENDING, PRIMES)),
                    tuple(pow(b, rest, p) for b, p in zip(BASES, PRIMES))))
    return out


def fingerprint(data: bytes) -> Fingerprint:
    return reduce(combine, chunk_fingerprints(data), EMPTY)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in in_slices(batches, "text"):
        n, fp, sha = [], [], []
        for raw in utf8_values(b.column("text")):
            data = (raw or b"").lower()  # bytes.lower() changes A-Z only
            size, (h1, h2), _ = fingerprint(data)
            n.append(size)
            fp.append(h1 << 31 | h2)
            sha.append(hashlib.sha256(data).digest())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("text_key"), pa.array(n, pa.int64()), pa.array(fp, pa.int64()),
             pa.array(sha, pa.binary())], ["doc_id", "text_key", "n_bytes", "fp", "sha"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_bytes, fp, sha) per row; text_key tells apart
    different texts under one doc_id."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.withColumn("text_key", F.xxhash64("text"))
            .mapInArrow(_fingerprint_batches, "doc_id bigint, text_key bigint, n_bytes bigint, fp bigint, sha binary"))


GROUP = ["fp", "n_bytes", "round"]


def _group(members: DataFrame) -> DataFrame:
    return members.groupBy(*GROUP).agg(F.max(id_key()).alias("rep_id"), F.max_by("text_key", id_key()).alias("rep_key"),
                                       F.sum("copies").alias("size"))


def pieces(text: str) -> Column:
    """A text cut into pieces of COMPARE_CHARS code points, in one walk over it."""
    return F.when(F.col(text) == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{COMPARE_CHARS}}}+"), F.lit(0)))  # possessive: a loop, no recursion


def _differing(docs: DataFrame, members: DataFrame, groups: DataFrame) -> DataFrame:
    """Chunkwise comparison: the (doc_id key, text_key) of members whose text
    is not their representative's."""
    spark = docs.sparkSession
    many = groups.where(F.col("size") > 1)
    nominated = cut(members.join(many, GROUP).select(
        id_key().alias("id"), "text_key", *GROUP, "rep_id", "rep_key", "size"), "nominated")
    texts = docs.select(id_key().alias("id"), F.xxhash64("text").alias("text_key"),
                        F.coalesce("text", F.lit("")).alias("text"))
    # the nominated side is hashed, the texts are streamed past it unsorted;
    # a runtime Bloom filter keeps texts that are not nominated off the shuffle
    with session_conf(spark, spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="16MB"):
        chunks = cut(
            texts.join(nominated.where(F.col("size") > 1).hint("shuffle_hash"), ["id", "text_key"])
            .withColumn("salts", F.ceil(F.col("size") / COPIES_PER_SALT).cast("int"))
            .withColumn("is_rep", (F.col("id") == F.col("rep_id")) & (F.col("text_key") == F.col("rep_key")))
            .select("id", "text_key", *GROUP, "salts", "is_rep", F.posexplode(pieces("text")).alias("no", "chunk"))
            .withColumn("chunk", ascii_lower(F.col("chunk"))),
            "chunks")
    at = [*GROUP, "no", "salt"]
    first = (chunks.where("is_rep").dropDuplicates([*GROUP, "no"])
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
             .select(*at, F.col("chunk").alias("rep_chunk")))
    rest = chunks.where(~F.col("is_rep")).withColumn("salt", F.pmod(F.xxhash64("id", "text_key"), "salts").cast("int"))
    return (rest.join(first, at, "left").where(~F.col("chunk").eqNullSafe(F.col("rep_chunk")))
            .select("id", "text_key").distinct())


def _resolved(docs: DataFrame) -> DataFrame:
    """Members (rows that agree in id and text, with their number ``copies``)
    and the verified group each belongs to."""
    members = cut(fingerprints(docs).groupBy("doc_id", "text_key", "n_bytes", "fp", "sha")
                  .agg(F.count("*").alias("copies")).withColumn("round", F.lit(0)), "members")
    groups = cut(_group(members), "groups")
    todo, current, step = members, groups, 0
    while not (odd := cut(_differing(docs, todo, current), "differing")).isEmpty():
        step += 1  # collisions: what differs from its representative forms new groups
        key = [id_key() == F.col("id"), members.text_key == odd.text_key]
        members = cut(members.join(odd, key, "left").select(
            "doc_id", members.text_key, "n_bytes", "fp", "sha", "copies",
            F.when(F.col("id").isNotNull(), F.lit(step)).otherwise(F.col("round")).alias("round")), "members")
        groups = cut(_group(members), "groups")
        todo, current = members.where(F.col("round") == step), groups.where(F.col("round") == step)
    return members.join(groups, GROUP)


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256 (see the module docstring for ties and nulls)."""
    rows = _resolved(docs).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    keep = F.when(F.col("rep_id") != F.lit(NO_ID), F.col("rep_id"))
    return rows.select(
        "doc_id", keep.alias("keep_id"), F.col("size").alias("group_size"),
        ((id_key() == F.col("rep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row left of every group of equal texts (the one with
    the largest doc_id); columns unchanged."""
    stay = cut(_resolved(docs).where(id_key() == F.col("rep_id")).select(
        F.col("rep_id").alias("keep_key"), F.col("text_key").alias("keep_text"), *GROUP, "copies"), "stay")
    # one text under one id may be spelt in several ways that differ in case
    spelt = stay.groupBy("keep_key", *GROUP).agg(F.min("keep_text").alias("keep_text"), F.sum("copies").alias("copies"))
    stay = cut(spelt, "stay")
    same = (id_key() == stay["keep_key"]) & (F.xxhash64("text") == stay["keep_text"])
    out = docs.join(stay.hint("shuffle_hash"), same, "left_semi")
    if stay.where("copies > 1").isEmpty():
        return out
    key, text = unused(docs, "key"), unused(docs, "text_hash")
    return out.withColumns({key: id_key(), text: F.xxhash64("text")}).dropDuplicates([key, text]).select(*docs.columns)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with the copy that stays."""
    return exact_groups(table(spark, sf_dir, "documents"))


OP9_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, g.text_sha256
FROM n JOIN g USING (t)
"""
