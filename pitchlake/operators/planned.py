"""Operators specified in the project's planning notes.

They are not part of the original code path; each is a small DataFrame
job in the same style: aggregate per key, join small per-group tables,
evaluate column expressions.  No pairwise self-joins, no driver loops.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake import schema as S
from pitchlake.functions.exprs import count_if


# ----------------------------------------------------------------- P1
def period_monotonic(stats: DataFrame, cols: Sequence[str], first: str = S.FIRST_HALF,
                     second: str = S.SECOND_HALF) -> DataFrame:
    """If second-half statistics are cumulative, a first-half value may
    not exceed the second-half value.  One aggregation per (fixture, team)
    pivots the two periods side by side; rows with any violation are
    returned with the offending statistic names."""
    aggs = []
    for c in cols:
        aggs += [F.max(F.when(F.col("period") == first, F.col(c))).alias(f"{c}_1"),
                 F.max(F.when(F.col("period") == second, F.col(c))).alias(f"{c}_2")]
    per = stats.filter(F.col("period").isin(first, second)).groupBy("fixture_id", "team_id").agg(*aggs)
    bad = F.array_compact(F.array(*[F.when(F.col(f"{c}_1") > F.col(f"{c}_2"), F.lit(c)) for c in cols]))
    return per.select("fixture_id", "team_id", bad.alias("decreasing")).filter(F.size("decreasing") > 0) \
        .select("fixture_id", "team_id", F.array_join("decreasing", ",").alias("decreasing"))


# ----------------------------------------------------------------- P2
def league_zscore(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """Z-score of ``cols`` within ``group`` (per-group mean and sample sd
    from one aggregation).  The per-group table has one row per group, a
    league here, and is broadcast, so the rows are not shuffled by league."""
    stats = df.groupBy(group).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                                  *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    j = df.join(F.broadcast(stats), group)
    out = [F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")).alias(f"z_{c}") for c in cols]
    return j.select(*df.columns, *out)


# ----------------------------------------------------------------- P3
def handicap_settlement(df: DataFrame, margin: str, lines: Sequence[float] = (-1.0, -1.5, 1.0, 1.5)) -> DataFrame:
    """Settle each row at every handicap line: win if margin + line > 0,
    push if it is 0 (integer lines), lose otherwise."""
    ex = df.withColumn("line", F.explode(F.array(*[F.lit(float(x)) for x in lines])))
    adj = F.col(margin) + F.col("line")
    return ex.withColumn("outcome", F.when(adj > 0, "win").when(adj == 0, "push").otherwise("lose"))


# ----------------------------------------------------------------- P4
def walk_forward_folds(df: DataFrame, time_col: str, window: int | None = None) -> DataFrame:
    """Walk-forward folds by year, one for every year of the data but
    the first: fold ``y`` tests on year y and trains on all earlier years,
    or on the last ``window`` of them.  Each row is emitted once per fold it
    takes part in (one per year, or ``window + 1``), tagged ``role``."""
    yr = F.year(time_col)
    first, last = df.select(F.min(yr)).scalar(), df.select(F.max(yr)).scalar()
    until = F.least(last, yr + window) if window else last
    ex = df.filter(F.col(time_col).isNotNull()).select("*", F.explode(F.sequence(yr, until)).alias("fold"))
    role = F.when(yr < F.col("fold"), "train").otherwise("test")
    return ex.filter(F.col("fold") > first).withColumn("role", role)


def temporal_split(df: DataFrame, time_col: str, cutoff: str) -> DataFrame:
    """Rows before ``cutoff`` train, the others test (no row of the
    future in training); rows without a time take no part."""
    t = F.lit(cutoff).cast("timestamp_ntz")
    return df.filter(F.col(time_col).isNotNull()).withColumn(
        "role", F.when(F.col(time_col) < t, "train").otherwise("test"))


# ----------------------------------------------------------------- P5
def calibration(pred: DataFrame, prob: str = "p1", label: str = "label", bins: int = 10) -> DataFrame:
    """P5: reliability table over equal-width probability bins."""
    b = F.least(F.floor(F.col(prob) * bins) + 1, F.lit(bins)).cast("long")
    return pred.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(prob).alias("mean_prob"),
                                            F.avg(F.col(label).cast("double")).alias("observed_rate"))


def brier(pred: DataFrame, prob: str = "p1", label: str = "label") -> DataFrame:
    """P5: Brier score (mean squared probability error)."""
    return pred.agg(F.avg(F.pow(F.col(prob) - F.col(label), 2)).alias("brier"))


# ----------------------------------------------------------------- P6
def value_bets(pred: DataFrame, prob: str, odds: str, min_edge: float = 0.05, kelly_fraction: float = 0.25,
               cap: float = 0.05) -> DataFrame:
    """Bets where p * odds - 1 exceeds ``min_edge``; stake = fractional
    Kelly, capped."""
    edge = F.col(prob) * F.col(odds) - 1
    kelly = F.try_divide(edge, F.col(odds) - 1)
    return (pred.withColumn("edge", edge).filter(F.col("edge") > min_edge)
            .withColumn("stake", F.least(F.lit(cap), F.greatest(F.lit(0.0), kelly * kelly_fraction))))


# ----------------------------------------------------------------- P7
def backtest(bets: DataFrame, odds: str, won: str) -> DataFrame:
    """Profit, ROI on stakes, mean profit per bet and its Sharpe ratio."""
    profit = F.when(F.col(won) == 1, F.col("stake") * (F.col(odds) - 1)).otherwise(-F.col("stake"))
    b = bets.withColumn("profit", profit)
    return b.agg(F.count(F.lit(1)).alias("bets"), F.sum("stake").alias("staked"), F.sum("profit").alias("profit"),
                 F.try_divide(F.sum("profit"), F.sum("stake")).alias("roi"),
                 F.try_divide(F.avg("profit"), F.stddev_samp("profit")).alias("sharpe"))


# ----------------------------------------------------------------- P8
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every feature pair from one aggregate,
    long format (feature_a, feature_b, corr), a < b by list order."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (`feature_a`, `feature_b`, `corr`)")


# ----------------------------------------------------------------- P9
def population_stability(df: DataFrame, col: str, is_reference: Column, bins: int = 10,
                         eps: float = 1e-6) -> DataFrame:
    """Population stability index of ``col`` between the reference rows
    and the rest, over equal-width bins of the reference range.  One
    aggregate finds the range (a scalar subquery), one counts the bins; the
    totals are windows over the bins.  Returns per-bin shares and the total PSI."""
    value = F.when(is_reference, F.col(col).cast("double"))
    edge = df.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = edge["lo"], edge["hi"]
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(1)).otherwise(F.least(F.greatest(F.floor((F.col(col) - lo) / width) + 1, F.lit(1)),
                                                     F.lit(bins))).cast("long")
    tagged = df.filter(F.col(col).isNotNull()).select(b.alias("bin"), is_reference.alias("_ref"))
    per = tagged.groupBy("bin").agg(count_if(F.col("_ref")).alias("ref_n"), count_if(~F.col("_ref")).alias("cur_n"))
    every = Window.partitionBy()    # over at most ``bins`` rows
    e = F.greatest(F.col("ref_n") / F.sum("ref_n").over(every), F.lit(eps))
    a = F.greatest(F.col("cur_n") / F.sum("cur_n").over(every), F.lit(eps))
    out = per.select("bin", e.alias("ref_share"), a.alias("cur_share")).withColumn(
        "psi", (F.col("cur_share") - F.col("ref_share")) * F.ln(F.col("cur_share") / F.col("ref_share")))
    return out.withColumn("total_psi", F.sum("psi").over(every))


# ---------------------------------------------------------------- P10
def ratio_anomalies(df: DataFrame, group: str, num: str, den: str, z: float = 3.0) -> DataFrame:
    """P10: rows whose ``num/den`` ratio lies more than ``z`` sample sds
    from its group mean."""
    r = df.withColumn("ratio", F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")))
    g = r.groupBy(group).agg(F.avg("ratio").alias("_m"), F.stddev_samp("ratio").alias("_s"))
    # one row per group (league): broadcast, the rows are not shuffled by group
    j = r.join(F.broadcast(g), group).withColumn("z", F.try_divide(F.col("ratio") - F.col("_m"), F.col("_s")))
    return j.filter(F.abs(F.col("z")) > z).drop("_m", "_s")


# ---------------------------------------------------------------- P11
def totals_mismatch(left: DataFrame, right: DataFrame, key: str, left_val: Column, right_val: Column,
                    tol: float = 0.0) -> DataFrame:
    """Per key, a total from one table against a total from another
    (each aggregated before the join); keys where they differ by more than
    ``tol`` or exist on one side only."""
    lt = left.groupBy(key).agg(F.sum(left_val).alias("left_total"))
    rt = right.groupBy(key).agg(F.sum(right_val).alias("right_total"))
    j = lt.join(rt, key, "full")
    return j.filter(F.col("left_total").isNull() | F.col("right_total").isNull()
                    | (F.abs(F.col("left_total") - F.col("right_total")) > tol))
