"""Training-corpus pipeline: five operators, one after the other.

``STAGES`` names the stages; a stage takes the documents that its
predecessor kept and returns those it keeps, with the columns of
``documents`` (the last one returns what is trained on, with its epoch).
Each stage's result is written as Parquet to the shared checkpoint folder
and reread, so that a lost executor costs no more than a part of a stage.

Stages rely on doc_id to name a document: rows that share a doc_id but
not a text are kept or dropped as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import decontaminate, exact_dedup, mixing, ngram_join, quality
from pitchlake.llm.common import cut, id_key, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained scorer accepts."""
    return quality.accepted_documents(docs, quality.train(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    return ngram_join.drop_near_copies(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def target_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The selected documents, one row per epoch in which a document is read."""
    chosen = cut(mixing.mix(docs).select(id_key().alias("key"), "domain", "tokens", "epoch").distinct(), "mix-chosen")
    added = ["domain", "tokens", "epoch"]
    return docs.join(chosen, id_key() == chosen["key"]).select(
        *[docs[c] for c in docs.columns if c.lower() not in added], *[chosen[c] for c in added])


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources to target weights", target_mixture),
]

#: The classifier and the similarity join cannot be put in SQL here.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
