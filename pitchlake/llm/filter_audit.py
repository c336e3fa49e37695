"""Filter interaction audit: what each filter removes, in every order.

Five filters judge a document (A few words, B little variety, C capitals, D
marks, E copy of an earlier text).  Every document gets its mask of failed
filters; documents are counted by part and mask, which leaves at most 32 rows
a part however large the part is.  From these counts each part builds a
count-weighted decision diagram (``decision_diagram``) and reorders it by
adjacent level swaps through all orders of the filters; the path of an
order on which everything passes yields its steps.

Filter E needs the whole table: per text (SHA-256) the smallest doc_id is
found by an aggregate that combines before its shuffle, and is joined back on
(text, doc_id), so that a text with a third of all rows is spread over the
cluster by its doc_ids.

Defined results: a null text counts as empty; a null source is the part
``''``; documents without a label are neither good nor toxic, and several
labels of one doc_id count if any says so; a row without doc_id has no label,
passes E and makes no other row fail it; rows that share doc_id and text pass
or fail E together.  Each row counts.  Further columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import in_slices, table, utf8_values
from pitchlake.llm.decision_diagram import all_orders
from pitchlake.llm.fill_in_middle import code_points

FILTERS = "ABCDE"
MIN_WORDS, MIN_VARIETY, MAX_CAPITALS = 200, 50, 2   # words; percent of words; percent of characters
MARKS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_mask(raw: bytes) -> int:
    """Bits 0 to 3: whether the text fails A, B, C, D."""
    words = raw.split()     # parts bytes at exactly x20 and x09 to x0D
    few = len(words) < MIN_WORDS
    dull = 100 * len(set(words)) < MIN_VARIETY * len(words)
    loud = 100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MAX_CAPITALS * code_points(raw)
    marked = len(raw.translate(None, MARKS)) < len(raw)
    return few | dull << 1 | loud << 2 | marked << 3


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, sha) per row; the mask lacks E."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "text"):
            texts = [x or b"" for x in utf8_values(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array([text_mask(x) for x in texts], pa.int32()),
                 pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary())], ["doc_id", "part", "mask", "sha"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, part string, mask int, sha binary")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and full failure mask."""
    rows = judged(docs)
    firsts = rows.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (rows.join(firsts, ["sha", "doc_id"], "left").select("doc_id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))
            .join(said, "doc_id", "left").groupBy("part", "mask")
            .agg(F.count("*").alias("n"), F.count_if("is_good").alias("good"), F.count_if("is_toxic").alias("toxic")))


_STEPS = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
          "good_lost bigint, toxic_lost bigint, shapley bigint")


def _part_steps(rows: pa.Table) -> pa.Table:
    """All steps of all orders, from the at most 32 masks of one part."""
    part = rows.column("part")[0].as_py()
    masks = {m: (n, g, t) for m, n, g, t in zip(*(rows.column(c).to_pylist() for c in ("mask", "n", "good", "toxic")))}
    failing = {f: sum(w[0] for m, w in masks.items() if m >> i & 1) for i, f in enumerate(FILTERS)}
    alone = {f: masks.get(1 << i, (0,))[0] for i, f in enumerate(FILTERS)}
    shapley: Counter[str] = Counter()
    out = []
    for diagram in all_orders(FILTERS, masks):
        order = "".join(diagram.order)
        for k, (f, passed, failed) in enumerate(diagram.steps(), 1):
            shapley[f] += failed[0]
            out.append([part, order, k, passed[0], failed[0], failing[f] - failed[0], alone[f], failed[1], failed[2], f])
    names = [c.split()[0] for c in _STEPS.split(", ")]
    columns = list(zip(*([*row[:-1], shapley[row[-1]]] for row in out)))
    kinds = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    return mask_counts(docs, labels).groupBy("part").applyInArrow(_part_steps, _STEPS)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of ``documents`` with ``labels``."""
    return interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (
  SELECT d.*, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1) AS toxic FROM d),
m AS (
  SELECT part, [a, b, c, d, e] AS fails, a::INT + b::INT + c::INT + d::INT + e::INT AS n_fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY ALL),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (
  SELECT [x1.i, x2.i, x3.i, x4.i, x5.i] AS o FROM x x1, x x2, x x3, x x4, x x5
  WHERE len(list_distinct([x1.i, x2.i, x3.i, x4.i, x5.i])) = 5),
-- the step at which an order removes a mask (6: never)
g AS (
  SELECT part, o, n, good, toxic, fails, n_fails,
         CASE WHEN fails[o[1]] THEN 1 WHEN fails[o[2]] THEN 2 WHEN fails[o[3]] THEN 3 WHEN fails[o[4]] THEN 4
              WHEN fails[o[5]] THEN 5 ELSE 6 END AS gone FROM m, o),
s AS (
  SELECT part, o, x.i AS step, o[x.i] AS filter,
         sum(n) FILTER (gone > x.i) AS kept, sum(n) FILTER (gone = x.i) AS removed,
         sum(n) FILTER (gone < x.i AND fails[o[x.i]]) AS redundant,
         sum(n) FILTER (fails[o[x.i]] AND n_fails = 1) AS unique_fails,
         sum(good) FILTER (gone = x.i) AS good_lost, sum(toxic) FILTER (gone = x.i) AS toxic_lost
  FROM g, x GROUP BY ALL)
SELECT part, translate(array_to_string(o, ''), '12345', 'ABCDE') AS filter_order, step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, filter), 0) AS BIGINT) AS shapley
FROM s
"""
