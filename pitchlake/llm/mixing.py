"""Mixing sources to target weights by hierarchical budgeting.

Documents are leaves of a tree domain > language > source.  A token budget
is handed down from the root: a node's budget is shared among its children
by their weights, but no child gets more than its subtree can supply
(available tokens times ``max_epochs``).  What a full child leaves is shared
among its siblings by weight; only what all siblings can't take was already
kept by the parent's siblings, since the parent's own supply bounds its
share.  So shortages move to siblings before they move to ancestors.

Sharing with caps has a closed form: with children ordered by supply per
weight, child i is full exactly if the budget left after the supplies of the
children before it, divided by their remaining weight, is at least its
supply per weight.  That is two running sums over the children of a node:
window functions over the leaf table, which has one row per (domain,
language, source), never over documents.

A leaf's budget is filled from epochs.  An epoch is an order of the leaf's
documents by ``md5(seed, epoch, doc_id)``; whole epochs are taken while they
fit, then the prefix of the next one whose tokens do not exceed what is
left (the first document that would is where it ends).  The prefix is found
without sorting a leaf: tokens are summed per hash bin (256 bins, combined
before the shuffle), a running sum over them finds the bin where the budget
ends, and that bin is split in the same way; after DEEP splits a bin has one
in 16 million of a leaf's documents, and only these are ordered.  Documents
up to the hash found are in.

All steps are DataFrame expressions.  Defined results: a null domain,
language or source is a node of its own, named ``unknown``; a document without words has no tokens and is never selected; a null
doc_id is hashed as ``null`` and repeated rows tie in the order: rows that
share an id are taken together or not at all (their tokens count together).
Weights default to equal shares; negative weights count as zero.  A leaf of
weight zero gets nothing.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import cut, table

LEVELS = ("domain", "lang", "source")
HEX, DEEP = 2, 3  # hash digits that split a bin, and how often
SEED, MAX_EPOCHS, BUDGET_SHARE = 20, 3, 0.5
DOMAINS = 4

#: Production weights of the top level; other nodes share equally.
WEIGHTS = {("domain0",): 4.0, ("domain1",): 3.0, ("domain2",): 2.0, ("domain3",): 1.0}


def token_count(text: str = "text") -> Column:
    """Runs of characters other than white space (a null text has none)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def domain_of_source(source: str = "source") -> Column:
    """A domain for tables that have none: sources dealt over DOMAINS by hash."""
    return F.expr(f"concat('domain', (instr('0123456789abcdef', right(md5(coalesce({source}, '')), 1)) - 1) % {DOMAINS})")


def leaves(docs: DataFrame) -> DataFrame:
    """One row per leaf: its path and available tokens."""
    return docs.groupBy(*LEVELS).agg(F.sum("tokens").alias("available")).where("available > 0")


def _weight(depth: int, weights: Mapping[tuple[str, ...], float]) -> Column:
    out = F.lit(1.0)
    for path, w in weights.items():
        if len(path) == depth + 1:
            fits = F.lit(True)
            for level, value in zip(LEVELS, path):
                fits = fits & (F.col(level) == value)
            out = F.when(fits, F.lit(max(0.0, float(w)))).otherwise(out)
    return out


def share(children: DataFrame, parent: list[str], by: str) -> DataFrame:
    """``children`` (weight, supply, budget of the parent as ``given``) with
    ``granted``: the parent's budget by weight, no more than the supply."""
    able = children.where("weight > 0").withColumn("ratio", F.col("supply") / F.col("weight"))
    order = Window.partitionBy(*parent).orderBy("ratio", by)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("given") - F.coalesce(F.sum("supply").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(after)
    full = able.withColumn("level", level).withColumn("full", F.col("level") >= F.col("ratio"))
    whole = Window.partitionBy(*parent)
    # the first child that is not full sets the level of all that follow
    rest = F.min(F.when(~F.col("full"), F.struct("ratio", by, "level"))).over(whole)
    return full.withColumn("rest", rest["level"]).withColumn(
        "granted", F.when(F.col("full"), F.col("supply")).otherwise(F.greatest(F.lit(0.0), F.least("supply", F.col("weight") * F.col("rest")))))


def budgets(found: DataFrame, budget: float | Column, weights: Mapping[tuple[str, ...], float],
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``found`` (leaves) with ``budget``, whole tokens, summing to at most the total."""
    found = found.withColumn("supply", F.col("available").cast("double") * max_epochs)
    given = found.withColumn("given", F.lit(budget).cast("double") if not isinstance(budget, Column) else budget.cast("double"))
    for depth, level in enumerate(LEVELS):
        parent, path = list(LEVELS[:depth]), list(LEVELS[:depth + 1])
        nodes = given.groupBy(*path).agg(F.sum("supply").alias("supply"), F.first("given").alias("given"))
        nodes = share(nodes.withColumn("weight", _weight(depth, weights)), parent, level)
        given = given.drop("given").join(nodes.select(*path, F.col("granted").alias("given")), path)
    return given.select(*LEVELS, "available", F.floor("given").cast("bigint").alias("budget"))


def epoch_hash(seed: int, epoch: str = "epoch", doc_id: str = "doc_id") -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(epoch).cast("string"),
                             F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary"))


def prefix_ends(part: DataFrame) -> DataFrame:
    """(path, cutoff): a leaf's prefix is its documents with ``h <= cutoff``.

    ``part``: path, left_over, h, tokens.  The hash bin in which the budget
    ends is split again DEEP times before single documents are ordered."""
    path = list(LEVELS)
    at = part.withColumns({"edge": F.lit(""), "before": F.lit(0).cast("bigint")})
    edges = None
    for depth in range(DEEP):
        digits = HEX * (depth + 1)
        if edges is not None:
            at = part.join(edges, path).where(F.col("h").startswith(F.col("edge")))
        bins = at.groupBy(*path, "left_over", "before", F.expr(f"left(h, {digits})").alias("bin")).agg(F.sum("tokens").alias("held"))
        lower = Window.partitionBy(*path).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        reach = bins.withColumn("base", F.col("before") + F.coalesce(F.sum("held").over(lower), F.lit(0)))
        edges = cut(reach.where("base <= left_over and base + held > left_over")
                    .select(*path, F.col("bin").alias("edge"), F.col("base").alias("before")), "mix-edges")
    last = (part.join(edges, path).where(F.col("h").startswith(F.col("edge")))
            .groupBy(*path, "left_over", "before", "edge", "h").agg(F.sum("tokens").alias("held")))
    upto = Window.partitionBy(*path).orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = last.withColumn("fits", F.col("before") + F.sum("held").over(upto) <= F.col("left_over"))
    # the bin's own name sorts behind all lower bins and before its documents
    return fits.groupBy(*path, "edge").agg(F.max(F.when(F.col("fits"), F.col("h"))).alias("taken")).select(
        *path, F.coalesce("taken", "edge").alias("cutoff"))


def select_tokens(docs: DataFrame, budget: DataFrame, seed: int = SEED) -> DataFrame:
    """(docs' columns, epoch): each leaf's whole epochs, then the prefix of
    the next.  ``docs`` must have the levels, doc_id and tokens."""
    path = list(LEVELS)
    plan = cut(budget.where("budget > 0").withColumns({
        "full_epochs": F.floor(F.col("budget") / F.col("available")).cast("int"),
        "left_over": F.col("budget") % F.col("available")}).select(*path, "full_epochs", "left_over"), "mix-plan")
    rows = docs.where("tokens > 0").join(plan, path)
    whole = rows.withColumn("epoch", F.explode(F.expr("if(full_epochs > 0, sequence(0, full_epochs - 1), cast(array() as array<int>))")))
    part = rows.where("left_over > 0").withColumn("epoch", F.col("full_epochs")).withColumn("h", epoch_hash(seed))
    ends = cut(prefix_ends(part.select(*path, "left_over", "h", "tokens")), "mix-ends")
    prefix = part.join(ends, path).where("h <= cutoff")
    columns = [*docs.columns, "epoch"]
    return whole.select(*columns).unionByName(prefix.select(*columns))


def mix(docs: DataFrame, weights: Mapping[tuple[str, ...], float] = WEIGHTS, share_of_tokens: float = BUDGET_SHARE,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, domain: Column | None = None) -> DataFrame:
    """One row per selected document and epoch: doc_id, the node names
    (domain, lang, source), its tokens and the epoch; further columns of
    ``docs`` are not returned.  The total budget is a share of all tokens."""
    named = docs.withColumns({
        "domain": F.coalesce(domain if domain is not None else domain_of_source(), F.lit("unknown")),
        "lang": F.coalesce(F.col("lang").cast("string"), F.lit("unknown")),
        "source": F.coalesce(F.col("source").cast("string"), F.lit("unknown"))})
    sized = cut(named.select("doc_id", *LEVELS, token_count().alias("tokens")), "mix-tokens")
    found = cut(leaves(sized), "mix-leaves")
    total = found.agg(F.sum("available")).first()[0] or 0
    return select_tokens(sized, budgets(found, float(int(total * share_of_tokens)), weights, max_epochs), seed)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``documents`` selected for the production mixture."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", *LEVELS, "tokens", "epoch")


def _share_sql(name: str, source: str, parent: str, level: str, weight: str) -> str:
    """One level of budgets: the children of each node, fullest first."""
    path = ", ".join(filter(None, (parent, level)))
    over = f"PARTITION BY {parent} " if parent else ""
    given = f"JOIN {source} USING ({parent})" if parent else f"CROSS JOIN {source}"
    return f"""
{name}_n AS (SELECT {path}, sum(supply) AS supply, {weight} AS weight FROM leaf GROUP BY {path}),
{name}_l AS (
  SELECT n.*, (given - coalesce(sum(supply) OVER ({over}ORDER BY supply / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER ({over}ORDER BY supply / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM (SELECT m.*, given FROM {name}_n m {given} WHERE weight > 0) n),
{name} AS (
  SELECT {path}, CASE WHEN lev >= supply / weight THEN supply
    ELSE greatest(0, least(supply, weight * first_value(lev) OVER ({over}ORDER BY lev >= supply / weight, supply / weight, {level}))) END AS given
  FROM {name}_l)"""


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, 'domain' || ((instr('0123456789abcdef', right(md5(coalesce(source, '')), 1)) - 1) % {DOMAINS}) AS domain,
         coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM documents),
leaf AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS available, sum(tokens)::DOUBLE * {MAX_EPOCHS} AS supply
  FROM d GROUP BY ALL HAVING sum(tokens) > 0),
total AS (SELECT floor(sum(available) * {BUDGET_SHARE})::DOUBLE AS given FROM leaf),
{_share_sql("g1", "total", "", "domain", "CASE domain " + " ".join(f"WHEN '{k[0]}' THEN {w}::DOUBLE" for k, w in WEIGHTS.items()) + " ELSE 1::DOUBLE END")},
{_share_sql("g2", "g1", "domain", "lang", "1::DOUBLE")},
{_share_sql("g3", "g2", "domain, lang", "source", "1::DOUBLE")},
b AS (SELECT leaf.*, floor(given)::BIGINT AS budget FROM leaf JOIN g3 USING (domain, lang, source)),
p AS (SELECT d.*, available, budget, budget // available AS full_epochs, budget % available AS left_over
      FROM d JOIN b USING (domain, lang, source) WHERE tokens > 0),
part AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
                              ORDER BY md5('{SEED}:' || full_epochs || ':' || coalesce(doc_id::VARCHAR, 'null'))) AS reach
  FROM p)
SELECT doc_id, domain, lang, source, tokens, e::INTEGER AS epoch FROM p, LATERAL (SELECT unnest(range(0, full_epochs)) AS e)
UNION ALL
SELECT doc_id, domain, lang, source, tokens, full_epochs::INTEGER FROM part WHERE reach <= left_over AND left_over > 0
"""
