"""Bounded, deterministic training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import cut


def one_per_bin(docs: DataFrame, bins: int, by: list[Column] | None = None, seed: int = 17) -> DataFrame:
    """Rows of ``docs``: per stratum (the values of ``by``) and hash bin the
    document with the smallest hash, so at most ``bins`` documents a stratum.

    Ids are chosen by an aggregate that combines before its shuffle; only
    the chosen documents' texts are then read out, by a join with the ids.
    Rows without a doc_id are not drawn.
    """
    strata = {f"stratum{i}": c for i, c in enumerate(by or [])}
    hashed = docs.where("doc_id is not null").withColumn("h", F.xxhash64("doc_id", F.lit(seed)))
    chosen = cut(hashed.groupBy(*[c.alias(k) for k, c in strata.items()], F.pmod("h", F.lit(bins)).alias("bin"))
                 .agg(F.min(F.struct("h", "doc_id")).alias("x")).select(F.col("x.doc_id").alias("drawn")).distinct(), "sample")
    return docs.join(chosen, docs.doc_id == chosen.drawn, "left_semi").dropDuplicates(["doc_id"])
