"""URL filter: rules first, character language models for the rest.

Two variable-order Markov models over the characters of ``host + path`` are
counted from the URLs that the rules accept and reject.  A model
interpolates all orders from ORDER down to a uniform one (Witten-Bell): a
context never seen passes its mass to the next shorter context.  A URL that
no rule fits gets the log-likelihood difference of the two models divided by
its number of characters.  The difference is calibrated on rule-labelled
URLs kept out of the counts (one in FOLDS by URL hash): two normal densities
with a pooled variance turn it into the probability of acceptance, and 0.5
decides.  If those kept out lack one class, every labelled URL is scored by
counts without its own fold, and all of them calibrate.

Everything is DataFrame expressions and aggregates.  N-grams are counted
with map-side combination; lower orders are summed from the table of the
highest.  The table of per-n-gram differences is broadcast only while it has
at most BROADCAST_GRAMS rows and is joined by shuffle beyond that.  A URL's
n-grams are summed inside the task that made them, and equal URLs are
scored once.

Defined results: a null URL or one without ``://`` has an empty host and
path, fits no rule and is scored as the empty string; repeated rows are
returned as often as they come; if the rules label no URL of one class,
every other URL is allowed.  Further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import ascii_lower, cut, table

ORDER, FOLDS, ALPHABET = 4, 5, 256
BROADCAST_GRAMS = 400_000

#: Production rules: (host/path, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (host, path), and its verdict; null if none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # the longest is asked first
        at = text.index("/")
        fits = (((F.col("host") == text[:at]) | F.col("host").endswith("." + text[:at]))
                & F.col("path").startswith(text[at:]))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def grams(text: str) -> Column:
    """All (ORDER + 1)-grams of a padded text, as an array."""
    padded = f"concat(repeat('\u0002', {ORDER}), {text}, '\u0003')"
    return F.expr(f"transform(sequence(1, length({text}) + 1), i -> substring({padded}, i, {ORDER + 1}))")


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(gram, yes, no): how often accepted and rejected URLs have a gram."""
    return (labelled.select("accepted", F.explode(grams("text")).alias("gram")).groupBy("gram")
            .agg(F.sum(F.col("accepted").cast("bigint")).alias("yes"), F.sum((~F.col("accepted")).cast("bigint")).alias("no")))


def differences(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, diff): log p_accepted - log p_rejected of the last character
    after the others, for each wanted gram."""
    out = wanted.withColumns({"p_yes": F.lit(1.0 / ALPHABET), "p_no": F.lit(1.0 / ALPHABET)})
    for order in range(ORDER + 1):
        seen = (counts.withColumn("g", F.expr(f"right(gram, {order + 1})")).groupBy("g")
                .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")))
        context = (seen.withColumn("c", F.expr(f"left(g, {order})")).groupBy("c")
                   .agg(*[F.sum(k).alias(f"n_{k}") for k in ("yes", "no")],
                        *[F.sum((F.col(k) > 0).cast("bigint")).alias(f"t_{k}") for k in ("yes", "no")]))
        out = (out.withColumns({"g": F.expr(f"right(gram, {order + 1})"),
                                "c": F.expr(f"left(right(gram, {order + 1}), {order})")})
               .join(seen, "g", "left").join(context, "c", "left"))
        for k in ("yes", "no"):
            n, t, own = (F.coalesce(F.col(x), F.lit(0)) for x in (f"n_{k}", f"t_{k}", k))
            p = F.col(f"p_{k}")
            out = out.withColumn(f"p_{k}", F.when(n + t > 0, (own + t * p) / (n + t)).otherwise(p))
        out = out.select("gram", "p_yes", "p_no")
    return out.select("gram", (F.log("p_yes") - F.log("p_no")).alias("diff"))


def gram_scores(texts: DataFrame, labelled: DataFrame) -> DataFrame:
    """(u1, u2, accepted, score) of texts under the counts of labelled ones."""
    counts = cut(gram_counts(labelled), "url-grams")
    wanted = texts.select(F.explode(F.array_distinct(grams("text"))).alias("gram")).distinct()
    diffs = cut(differences(counts, wanted), "url-differences")
    if diffs.count() <= BROADCAST_GRAMS:
        diffs = F.broadcast(diffs)
    return cut(texts.select("u1", "u2", "accepted", F.explode(grams("text")).alias("gram")).join(diffs, "gram")
               .groupBy("u1", "u2", "accepted").agg(F.avg("diff").alias("score")), "url-scores")


def _classes(scores: DataFrame) -> dict[bool, Row]:
    """Number, mean and variance of the scores of each class (two rows at most)."""
    return {r.accepted: r for r in scores.groupBy("accepted")
            .agg(F.count("*").alias("n"), F.avg("score").alias("mean"), F.coalesce(F.var_pop("score"), F.lit(0.0)).alias("var"))
            .collect()}


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, p_allow) per row of ``pages``."""
    rule, says = longest_rule(rules)
    rows = (pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
            .withColumn("rule", rule).withColumn("says", says)
            .withColumn("text", F.concat("host", "path"))
            # 96 bits name a text, so that n-gram rows need not carry it
            .withColumns({"u1": F.xxhash64("text"), "u2": F.hash("text")}))
    texts = cut(rows.groupBy("u1", "u2").agg(F.first("text").alias("text"), F.max(F.col("says") == "allow").alias("accepted")),
                "url-texts")
    fold = F.pmod("u1", F.lit(FOLDS))
    known = F.col("accepted").isNotNull()
    scores = gram_scores(texts, texts.where(known & (fold != 0)))
    of = _classes(scores.where(known & (fold == 0)))
    if len(of) < 2 and texts.where(known).select("accepted").distinct().count() == 2:
        of = _classes(reduce(DataFrame.unionByName, [gram_scores(texts.where(known & (fold == f)), texts.where(known & (fold != f)))
                                                     for f in range(FOLDS)]))
    if len(of) == 2:
        yes, no = of[True], of[False]
        spread = max((yes.n * yes.var + no.n * no.var) / (yes.n + no.n), 1e-6)
        slope = (yes.mean - no.mean) / spread
        shift = (no.mean ** 2 - yes.mean ** 2) / (2 * spread) + math.log(yes.n / no.n)
        p_allow = 1 / (1 + F.exp(-(F.lit(slope) * F.col("score") + F.lit(shift))))
    else:
        p_allow = F.lit(1.0)
    out = rows.join(scores.select("u1", "u2", "score", p_allow.alias("p_allow")), ["u1", "u2"])
    verdict = F.coalesce("says", F.when(F.col("p_allow") >= 0.5, "allow").otherwise("block"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", "p_allow")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every URL of ``pages``."""
    return judge_urls(table(spark, sf_dir, "pages"))
