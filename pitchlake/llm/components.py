"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import cut


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable over ``links`` (a, b).

    Each round passes labels along the links (messages to one node are
    combined before the shuffle), then follows every label to its own label,
    which halves the remaining distance.  State is written to the shared
    checkpoint folder after each round; nothing is collected.
    """
    edges = cut(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-edges")
    state = cut(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), name)
    while True:
        offers = (edges.join(state.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node"))
                  .agg(F.min("root").alias("offer")))
        better = cut(state.join(offers, "node", "left").select(
            "node", F.least("root", "offer").alias("root"), F.col("root").alias("was")), f"{name}-passed")
        jump = better.select(F.col("node").alias("root"), F.col("root").alias("next"))
        state = cut(better.join(jump, "root").select("node", F.least("root", "next").alias("root"), "was"), name)
        if state.where("root <> was").isEmpty():
            return state.select("node", "root")
