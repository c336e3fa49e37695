"""Language identification with a string kernel.

Two texts are compared by the character n-grams they contain, of 1 to SPAN
characters together (blended spectrum, presence only):
``k(x, z) = |G(x) and G(z)| / sqrt(|G(x)| |G(z)|)``.  N-grams are hashed to
BINS bins, so that a text is a row of bits.  The Nystroem method replaces
the kernel by its values at LANDMARKS training texts, whitened by the
inverse root of the landmarks' own kernel matrix; on these features one
ridge regression per language is fitted against the rest, classes weighted
alike.  A batch of documents is scored by two matrix products:
presence x landmarks, then kernel values x weights.

Training texts are a documented sample: per language at most PER_LANGUAGE
(fewer if there are so many languages that MAX_TRAINING would be exceeded),
drawn by hash from the documents that are not held out.  They are turned
into bits by the tasks; the driver receives MAX_TRAINING * BINS / 8 bytes at
most.  Each prediction uses the whole text and nothing but the text.

Defined results: a text that is null or has no letter is ``und`` with score
0, as is every text if there is nothing to learn from; ties go to the first
language by name; a null doc_id is hashed as the empty string (held out) and
never learned from; repeated rows are predicted each.  Further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import in_slices, table
from pitchlake.llm.sampling import one_per_bin

SPAN, BINS = 4, 1 << 15
PER_LANGUAGE, MAX_TRAINING, LANDMARKS = 192, 1024, 64
RIDGE, FOLDS, BATCH, PIECE = 1e-2, 5, 128, 1 << 20


def _letter(c: int) -> int:
    """Lower-case form of a character, a space if it is no letter."""
    if not chr(c).isalpha():
        return 32
    low = chr(c).lower()
    return ord(low) if len(low) == 1 else c


@cache
def _letters() -> np.ndarray:
    """Lower-case form of every character of the basic plane, a space for
    all that is no letter."""
    return np.array([_letter(c) for c in range(1 << 16)], dtype=np.uint32)


def presence(text: str | None) -> np.ndarray | None:
    """The n-gram bins that a text has; None if it has no letter."""
    row, any_letter = np.zeros(BINS, dtype=bool), False
    text = text or ""
    for start in range(0, len(text), PIECE):  # pieces overlap by an n-gram
        piece = text[max(0, start - SPAN):start + PIECE]
        c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        beyond = c >= 1 << 16  # few distinct ones: looked up one by one
        high, which = np.unique(c[beyond], return_inverse=True)
        c = _letters()[np.minimum(c, (1 << 16) - 1)]
        c[beyond] = np.array([_letter(int(v)) for v in high], dtype=np.uint32)[which]
        blank = c == 32
        if blank.all():
            continue
        any_letter = True
        c = c[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint64)
        gram = np.zeros(len(c), dtype=np.uint64)
        for n in range(SPAN):
            gram = gram[:len(c) - n] * np.uint64(0x100000001B3) + c[n:] + np.uint64(1)
            row[((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)] = True
    return row if any_letter else None


def kernel(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Kernel values of presence rows, by one matrix product."""
    common = x.astype(np.float32) @ z.T.astype(np.float32)
    return common / np.sqrt(np.maximum(np.outer(x.sum(axis=1), z.sum(axis=1)), 1)).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # bits, packed
    weights: np.ndarray    # (landmarks + 1) x languages, the last row is the bias

    def decide(self, x: np.ndarray) -> np.ndarray:
        z = np.unpackbits(self.landmarks, axis=1).astype(bool)
        return kernel(x, z) @ self.weights[:-1] + self.weights[-1]


def fit(x: np.ndarray, language: list[str]) -> Model:
    """Ridge regressions, one language against the rest, on Nystroem features."""
    names = sorted(set(language))
    of = np.array([names.index(v) for v in language])
    per = max(1, LANDMARKS // len(names))
    chosen = np.concatenate([np.flatnonzero(of == k)[:per] for k in range(len(names))])
    z = x[chosen]
    value, vector = np.linalg.eigh(kernel(z, z).astype(np.float64))
    keep = value > 1e-6 * value.max()
    whiten = vector[:, keep] / np.sqrt(value[keep])
    phi = np.column_stack([np.vstack([kernel(x[i:i + BATCH], z) for i in range(0, len(x), BATCH)]) @ whiten, np.ones(len(x))])
    weight = 1.0 / np.bincount(of)[of]
    target = np.where(of[:, None] == np.arange(len(names)), 1.0, -1.0)
    ridge = RIDGE * np.eye(phi.shape[1])
    ridge[-1, -1] = 1e-9
    w = np.linalg.solve(phi.T @ (phi * weight[:, None]) + ridge, phi.T @ (target * weight[:, None]))
    return Model(names, np.packbits(z, axis=1), np.vstack([whiten @ w[:-1], w[-1:]]).astype(np.float32))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(docs: DataFrame) -> Model | None:
    """Fit on the documents that are not held out and have a language."""
    usable = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null").where(~held_out())
    languages = usable.select("lang").distinct().count()
    if not languages:
        return None
    sample = one_per_bin(usable, max(1, min(PER_LANGUAGE, MAX_TRAINING // languages)), [F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "text"):
            rows = [(lang, doc, np.packbits(row).tobytes())
                    for lang, doc, t in zip(*(b.column(c).to_pylist() for c in ("lang", "doc_id", "text")))
                    if (row := presence(t)) is not None]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["lang", "doc_id", "bits"])
    bits = sample.select("lang", "doc_id", "text").mapInArrow(run, "lang string, doc_id bigint, bits binary")
    rows = sorted(bits.limit(MAX_TRAINING + languages).collect(), key=lambda r: (r.lang, r.doc_id))
    if not rows:
        return None
    x = np.unpackbits(np.frombuffer(b"".join(bytes(r.bits) for r in rows), dtype=np.uint8).reshape(len(rows), -1), axis=1)
    return fit(x.astype(bool), [r.lang for r in rows])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in in_slices(batches, "text", max_rows=BATCH):
            names, scores = ["und"] * b.num_rows, [0.0] * b.num_rows
            found = [(i, row) for i, t in enumerate(b.column("text").to_pylist()) if (row := presence(t)) is not None]
            if model and found:
                f = model.decide(np.array([row for _, row in found]))
                for (i, _), k, value in zip(found, f.argmax(axis=1), f.max(axis=1)):
                    names[i], scores[i] = model.languages[k], float(min(1.0, max(0.0, (value + 1) / 2)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs))
