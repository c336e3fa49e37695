"""Fill-in-middle: cut a text twice at random token boundaries, reorder it.

A text's tokens are ``blank* nonblank+`` or a blank tail.  All its boundaries
go into a piecewise-linear rank index (``rank_index``): error-bounded
segments predict the offset of a cut, a stored residual corrects it exactly.
Randomness is a hash of the seed and doc_id alone, so a document is cut alike
in every run, partitioning and retry.

``transform`` returns the reordered texts; ``restore`` is its exact inverse.
A text that holds one of the sentinels stays plain, so the first occurrence
of a sentinel in an output is the one that was put there (no sentinel can
overlap another or itself).

Work is one pass without a shuffle; a task holds a slice of texts and, of
the one text it is cutting, a byte per token.

Defined results: a null text counts as empty, and an empty text is plain with
no tokens; a null doc_id is hashed as the empty string; repeated rows and
equal ids are cut alike.  Further columns are ignored by ``fim_rows`` and kept
by ``transform``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.common import in_slices, table, unused, utf8_values
from pitchlake.llm.rank_index import boundaries, fit

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
_CONTINUATION = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Cut:
    form: str
    n: int
    output: bytes
    prefix: bytes | None = None
    middle: bytes | None = None


def code_points(data: bytes) -> int:
    return len(data.translate(None, _CONTINUATION))


def _draws(doc_id, seed: int) -> tuple[int, ...]:
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    return struct.unpack(">4I", hashlib.sha256(key).digest()[:16])


def cut_text(doc_id, data: bytes, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> Cut:
    """One text's form and output; ``fim`` and ``spm`` are percentages."""
    index = fit(boundaries(data))
    h1, h2, h3, h4 = _draws(doc_id, seed)
    if not data or h3 % 100 >= fim or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)):
        return Cut("plain", index.n, data)
    first, second = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    i, j = index.offset(first), index.offset(second)
    prefix, middle, suffix = data[:i], data[i:j], data[j:]
    if h4 % 100 < spm:
        return Cut("spm", index.n, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)), prefix, middle)
    return Cut("psm", index.n, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)), prefix, middle)


def restore(form: str, output: bytes) -> bytes:
    """The text from which ``output`` was made."""
    if form == "plain":
        return output
    opening, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output[len(opening):].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return two + middle + one if form == "spm" else one + middle + two


def fim_rows(docs: DataFrame, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars and the
    digests of its output and of the text restored from that output."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "text"):
            rows = []
            for doc, raw in zip(b.column("doc_id").to_pylist(), utf8_values(b.column("text"))):
                c = cut_text(doc, raw or b"", seed, fim, spm)
                cut = c.prefix is not None
                rows.append((doc, c.n, c.form, code_points(c.prefix) if cut else None, code_points(c.middle) if cut else None,
                             hashlib.sha256(c.output).hexdigest(), hashlib.sha256(restore(c.form, c.output)).hexdigest()))
            names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                                "output_sha256 string, restored_sha256 string")


def transform(docs: DataFrame, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """``docs`` with its texts transformed and their form in a further column
    (``form``, or the first free name that starts so)."""
    at, form = docs.columns.index("text"), unused(docs, "form")
    out = T.StructType([*docs.schema.fields, T.StructField(form, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "text"):
            cuts = [cut_text(doc, raw or b"", seed, fim, spm)
                    for doc, raw in zip(b.column("doc_id").to_pylist(), utf8_values(b.column("text")))]
            columns = list(b.columns)
            columns[at] = pa.array([c.output for c in cuts], pa.binary()).cast(b.column("text").type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array([c.form for c in cuts], pa.string())], out.names)
    return docs.mapInArrow(run, out)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` transformed and restored."""
    return fim_rows(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
d AS (
  SELECT *, CAST(len(tokens) AS BIGINT) AS n,
         CAST(('0x' || h[1:8]) AS BIGINT) AS h1, CAST(('0x' || h[9:16]) AS BIGINT) AS h2,
         CAST(('0x' || h[17:24]) AS BIGINT) AS h3, CAST(('0x' || h[25:32]) AS BIGINT) AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, coalesce(array_to_string(tokens[1:a], ''), '') AS prefix, coalesce(array_to_string(tokens[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(tokens[b + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
