"""Data-quality audit jobs.

Generic kernels take DataFrames and column names; the football bindings
(``fixture_stats`` / ``schedules`` / ``leagues`` / ``seasons`` / ``teams``)
are thin wrappers.  Design rules used throughout:

* aggregate the fact table to one row per fixture *before* joining
  dimensions (no COUNT(DISTINCT) over fan-out joins);
* replace multi-query scans with one pass + flags + ``stack`` (F13, F28,
  F41, F48);
* global scalars (bin edges, mean + sd, totals) are scalar subqueries
  (``DataFrame.scalar()``), computed once and inlined as literals — no
  cross join and no driver round trip;
* top-k reports are ``orderBy(...).limit(k)`` with a unique tie-break,
  which Spark runs as a bounded per-task heap (TakeOrderedAndProject).
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake import schema as S
from pitchlake.functions.exprs import all_null, count_if, distinct_count_small, non_null_count, pct
from pitchlake.operators.quantiles import exact_quantiles
from pitchlake.operators.worklist import with_rank

FH = S.FIRST_HALF


def _stack(df: DataFrame, names: Sequence[str], value_cols: Sequence[Sequence[str]],
           key: str, out_cols: Sequence[str]) -> DataFrame:
    """Wide 1-row (or few-row) frame -> long rows, one per name."""
    parts = []
    for n, cols in zip(names, value_cols):
        parts.append(f"'{n}'")
        parts += [f"`{c}`" for c in cols]
    aliases = ", ".join(f"`{c}`" for c in [key, *out_cols])
    expr = f"stack({len(names)}, {', '.join(parts)}) as ({aliases})"
    keep = [c for c in df.columns if all(c not in cs for cs in value_cols)]
    return df.selectExpr(*[f"`{c}`" for c in keep], expr)


# ------------------------------------------------------------------- F0
def table_overview(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """rows, columns and key columns per table (one aggregate per table)."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.lit(",".join(keys.get(name, []))).alias("key_columns"))
        for name, df in tables.items()]
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- F1–F4
def group_counts(schedules: DataFrame, leagues: DataFrame, seasons: DataFrame) -> DataFrame:
    """fixtures per (season, league name, season name).

    Counts are taken per (season_id, league_id) first, so only the
    aggregated rows meet the dimension joins."""
    per = schedules.groupBy("season_id", "league_id").agg(F.count(F.lit(1)).alias("n"))
    named = (per.join(leagues.select("league_id", F.col("name").alias("league_name")), "league_id", "left")
             .join(seasons.select("season_id", F.col("name").alias("season_name")), "season_id", "left"))
    return (named.groupBy("season_id", "league_name", "season_name")
            .agg(F.sum("n").alias("fixture_count")))


def summary(df: DataFrame, c: str) -> DataFrame:
    """total, mean and exact median of a count column."""
    return df.agg(F.sum(c).cast("long").alias("total"), F.avg(c).alias("mean"),
                  F.median(c).cast("double").alias("median"))


def histogram(df: DataFrame, c: str, bins: int = 20) -> DataFrame:
    """fixed-width histogram between the column's min and max; the last
    bin is closed on the right.  Edges are scalar subqueries."""
    lo = df.select(F.min(F.col(c).cast("double"))).scalar()
    hi = df.select(F.max(F.col(c).cast("double"))).scalar()
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((F.col(c) - lo) / width) + 1, F.lit(bins)))
    return (df.filter(F.col(c).isNotNull()).groupBy(b.cast("long").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
                    (lo + F.col("bin") * width).alias("bin_hi"), "n"))


def small_groups(counts: DataFrame, min_n: int = 30, count_col: str = "fixture_count",
                 name_col: str = "league_name") -> DataFrame:
    """groups under ``min_n`` rows whose name is known."""
    return counts.filter((F.col(count_col) < min_n) & F.col(name_col).isNotNull())


# ---------------------------------------------------------------- F5–F10
def _names(df: DataFrame, leagues: DataFrame | None, seasons: DataFrame | None,
           teams: DataFrame | None) -> DataFrame:
    # whether a dimension is broadcast is left to the planner and its size checks
    if leagues is not None:
        df = df.join(leagues.select("league_id", F.col("name").alias("league_name")),
                     "league_id", "left")
    if seasons is not None:
        df = df.join(seasons.select("season_id", F.col("name").alias("season_name")),
                     "season_id", "left")
    if teams is not None:
        t = teams.select("team_id", "name")
        df = (df.join(t.select(F.col("team_id").alias("home_team_id"), F.col("name").alias("home_team")),
                      "home_team_id", "left")
              .join(t.select(F.col("team_id").alias("away_team_id"), F.col("name").alias("away_team")),
                    "away_team_id", "left"))
    return df


def missing_children(schedules: DataFrame, stats: DataFrame, leagues=None, seasons=None, teams=None,
                     statuses: Sequence[str] = tuple(S.FINISHED_STATS)) -> DataFrame:
    """finished fixtures with no statistics rows, with names."""
    fx = schedules.filter(F.col("status").isin(*statuses)).join(
        stats.select("fixture_id").distinct(), "fixture_id", "left_anti")
    out = _names(fx.select("fixture_id", "league_id", "season_id", "home_team_id", "away_team_id",
                           "start_time", "status"), leagues, seasons, teams)
    cols = ["fixture_id", "league_id", "league_name", "season_id", "season_name",
            "home_team_id", "home_team", "away_team_id", "away_team", "start_time", "status"]
    return out.select(*[c for c in cols if c in out.columns])


def _fixture_flags(stats: DataFrame) -> DataFrame:
    """One row per fixture that has statistics, with a first-half flag."""
    return stats.groupBy("fixture_id").agg(
        F.max(F.col("period") == FH).alias("has_first_half"))


def missing_rate(schedules: DataFrame, stats: DataFrame,
                 statuses: Sequence[str] = tuple(S.FINISHED_STATS)) -> DataFrame:
    """finished fixtures, how many lack statistics, and the percentage."""
    fx = schedules.filter(F.col("status").isin(*statuses)).select("fixture_id")
    j = fx.join(_fixture_flags(stats), "fixture_id", "left")
    return (j.agg(F.count(F.lit(1)).alias("total_finished"),
                  count_if(F.col("has_first_half").isNull()).alias("missing_stats"))
            .withColumn("missing_pct", pct("missing_stats", "total_finished")))


def missing_by(df: DataFrame, by: str = "league_name", top: int = 10) -> DataFrame:
    """offenders per group (NULL groups dropped), largest first, top k."""
    return (df.dropna(subset=[by]).groupBy(by).agg(F.count(F.lit(1)).alias("missing"))
            .orderBy(F.desc("missing"), F.asc(by)).limit(top))


def missing_category(stats: DataFrame, schedules: DataFrame, leagues: DataFrame,
                     required: str = FH) -> DataFrame:
    """F8: fixtures that have statistics but no ``required`` period, with the
    periods they do have (sorted, comma separated).  One pass replaces the
    NOT IN sub-select."""
    per = stats.groupBy("fixture_id").agg(
        F.max(F.col("period") == required).alias("has"),
        F.array_join(F.array_sort(F.collect_set("period")), ",").alias("available_periods"))
    per = per.filter(~F.col("has")).drop("has")
    out = per.join(schedules.select("fixture_id", "league_id", "status"), "fixture_id")
    out = out.join(leagues.select("league_id", F.col("name").alias("league_name")), "league_id", "left")
    return out.select("fixture_id", "league_id", "league_name", "status", "available_periods")


def distinct_rate(stats: DataFrame, required: str = FH) -> DataFrame:
    """fixtures with any statistics, how many lack ``required``, and %."""
    f = _fixture_flags(stats)
    return (f.agg(F.count(F.lit(1)).alias("fixtures_with_stats"),
                  count_if(~F.col("has_first_half")).alias("missing_first_half"))
            .withColumn("missing_pct", pct("missing_first_half", "fixtures_with_stats")))


def combo_counts(df: DataFrame, c: str = "available_periods") -> DataFrame:
    """distribution of a combination column (NULL dropped)."""
    return df.dropna(subset=[c]).groupBy(c).agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------- F11–F16
def member_count_violations(stats: DataFrame, expected: int = 2, period: str = FH,
                            key: str = "fixture_id", member: str = "team_id") -> DataFrame:
    """keys whose ``period`` rows cover a member count other than ``expected``."""
    return (stats.filter(F.col("period") == period).groupBy(key)
            .agg(distinct_count_small(member).alias("team_count"))
            .filter(F.col("team_count") != expected))


def member_count_rate(stats: DataFrame, expected: int = 2, period: str = FH) -> DataFrame:
    """F11 rate: offenders over fixtures with ``period`` rows."""
    per = (stats.filter(F.col("period") == period).groupBy("fixture_id")
           .agg(distinct_count_small("team_id").alias("team_count")))
    return (per.agg(F.count(F.lit(1)).alias("fixtures_with_period"),
                    count_if(F.col("team_count") != expected).alias("incomplete"))
            .withColumn("incomplete_pct", pct("incomplete", "fixtures_with_period")))


def drill_down(stats: DataFrame, schedules: DataFrame, teams: DataFrame, offenders: DataFrame,
               k: int = 5, order: Sequence[str] = ("team_count", "fixture_id")) -> DataFrame:
    """every statistics row of the first ``k`` offenders."""
    first = offenders.orderBy(*order).limit(k).select("fixture_id")
    rows = stats.join(first, "fixture_id", "left_semi").select("fixture_id", "team_id", "period")
    out = rows.join(schedules.select("fixture_id", "home_team_id", "away_team_id"), "fixture_id")
    out = out.join(teams.select("team_id", F.col("name").alias("team_name")), "team_id", "left")
    return out.select("fixture_id", "team_id", "team_name", "period", "home_team_id", "away_team_id")


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count and % per column from one aggregate, returned long,
    ranked from the most often missing."""
    aggs = [F.count(F.lit(1)).alias("total_records")]
    for c in cols:
        aggs.append(count_if(F.col(c).isNull()).alias(f"{c}__n"))
    wide = df.agg(*aggs)
    for c in cols:
        wide = wide.withColumn(f"{c}__p", pct(f"{c}__n", "total_records"))
    out = _stack(wide, cols, [[f"{c}__n", f"{c}__p"] for c in cols], "statistic", ["null_count", "null_percent"])
    # a window over one row per profiled column
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("null_percent"), "statistic")).cast("long"))


def all_null_rows(stats: DataFrame, schedules: DataFrame, teams: DataFrame, cols: Sequence[str],
                  period: str = FH) -> DataFrame:
    """``period`` rows where every column in ``cols`` is NULL, with names."""
    rows = stats.filter((F.col("period") == period) & all_null(cols)).select("fixture_id", "team_id")
    out = rows.join(schedules.select("fixture_id", "home_team_id", "away_team_id", "start_time", "status"),
                    "fixture_id")
    out = _names(out, None, None, teams)
    out = out.join(teams.select("team_id", F.col("name").alias("team_name")), "team_id", "left")
    return out.select("fixture_id", "home_team_id", "home_team", "away_team_id", "away_team",
                      "start_time", "status", "team_id", "team_name")


def side_balance(schedules: DataFrame, seasons: DataFrame, teams: DataFrame,
                 min_n: int = 10) -> DataFrame:
    """home/away balance per team and season (>= ``min_n`` matches).

    Each fixture is exploded into its distinct participants, so the
    disjunctive ``team = home OR team = away`` join (a nested-loop join)
    becomes an equi-aggregation; teams and seasons are joined after."""
    t = F.explode(F.array_distinct(F.array("home_team_id", "away_team_id")))
    ex = schedules.select("season_id", "home_team_id", "away_team_id", t.alias("team_id"))
    per = ex.groupBy("season_id", "team_id").agg(
        count_if(F.col("home_team_id") == F.col("team_id")).alias("home_matches"),
        count_if(F.col("away_team_id") == F.col("team_id")).alias("away_matches"),
        F.count(F.lit(1)).alias("total_matches"))
    per = per.filter(F.col("total_matches") >= min_n)
    out = per.join(teams.select("team_id", F.col("name").alias("team_name")), "team_id")
    out = out.join(seasons.select("season_id", F.col("name").alias("season_name")), "season_id", "left")
    return out.select("season_id", "season_name", "team_id", "team_name", "home_matches",
                      "away_matches", "total_matches",
                      F.abs(F.col("home_matches") - F.col("away_matches")).alias("balance_diff"))


def balance_summary(df: DataFrame, c: str = "balance_diff") -> DataFrame:
    """F16: mean/median/max imbalance, share perfectly balanced, share <= 2."""
    return (df.agg(F.count(F.lit(1)).alias("team_seasons"), F.avg(c).alias("avg_diff"),
                   F.median(c).cast("double").alias("median_diff"), F.max(c).alias("max_diff"),
                   count_if(F.col(c) == 0).alias("perfect"), count_if(F.col(c) <= 2).alias("minor"))
            .withColumn("perfect_pct", pct("perfect", "team_seasons"))
            .withColumn("minor_pct", pct("minor", "team_seasons")))


# --------------------------------------------------------------- F17–F24
def orphans(children: Mapping[str, DataFrame], parent: DataFrame, key: str = "fixture_id") -> DataFrame:
    """per child table, distinct keys and how many have no parent row."""
    p = parent.select(key).distinct().withColumn("_hit", F.lit(True))
    frames = []
    for name, child in children.items():
        ids = child.select(key).distinct().join(p, key, "left")
        frames.append(ids.agg(F.count(F.lit(1)).alias("unique_ids"),
                              count_if(F.col("_hit").isNull()).alias("orphaned_ids"))
                      .select(F.lit(name).alias("table_name"), "unique_ids", "orphaned_ids",
                              pct("orphaned_ids", "unique_ids").alias("orphaned_percent")))
    return reduce(DataFrame.unionByName, frames)


def _not_member(stats: DataFrame, schedules: DataFrame) -> DataFrame:
    j = stats.select("fixture_id", "team_id").join(
        schedules.select("fixture_id", "home_team_id", "away_team_id"), "fixture_id")
    return j.withColumn("_bad", (F.col("team_id") != F.col("home_team_id"))
                        & (F.col("team_id") != F.col("away_team_id")))


def non_member(stats: DataFrame, schedules: DataFrame) -> DataFrame:
    """statistics rows whose team is neither side of the fixture."""
    j = _not_member(stats, schedules)
    return (j.agg(F.countDistinct("fixture_id").alias("fixtures_checked"),
                  count_if(F.col("_bad")).alias("inconsistent_team_ids"),
                  F.count(F.lit(1)).alias("rows_checked"))
            .select("fixtures_checked", "inconsistent_team_ids",
                    pct("inconsistent_team_ids", "rows_checked").alias("inconsistent_percent")))


def non_member_examples(stats: DataFrame, schedules: DataFrame, teams: DataFrame, k: int = 10) -> DataFrame:
    """F18 examples: first ``k`` offending rows by (fixture, team), with names."""
    bad = _not_member(stats, schedules).filter(F.col("_bad")).select(
        "fixture_id", F.col("team_id").alias("stats_team_id"), "home_team_id", "away_team_id")
    bad = bad.orderBy("fixture_id", "stats_team_id").limit(k)
    t = teams.select("team_id", "name")
    for c, n in (("stats_team_id", "stats_team_name"), ("home_team_id", "home_team_name"),
                 ("away_team_id", "away_team_name")):
        bad = bad.join(t.select(F.col("team_id").alias(c), F.col("name").alias(n)), c, "left")
    return bad.select("fixture_id", "stats_team_id", "stats_team_name", "home_team_id",
                      "home_team_name", "away_team_id", "away_team_name")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """natural keys occurring more than once (NULL keys group together)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
            .filter(F.col("duplicate_count") > 1))


def duplicate_drill(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """F19 drill-down: all rows of the most repeated key (ties by key)."""
    top = (duplicates(df, keys).orderBy(F.desc("duplicate_count"), *keys).limit(1)
           .select(*[F.col(k).alias(f"_top_{k}") for k in keys]))
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(top[f"_top_{k}"]) for k in keys])
    return df.join(F.broadcast(top), cond, "left_semi")


def conformance(df: DataFrame, expected: Mapping[str, str], table: str) -> DataFrame:
    """per expected column: present or missing, actual type, non-NULL
    values, and values that do not cast to the declared type; columns not
    expected are listed as extra.  One scan and one aggregate for all counts,
    which one ``inline`` turns into rows."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    present = [c for c in expected if c in actual]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in present:
        aggs += [F.count(c).alias(f"{c}__nn"),
                 count_if(F.col(c).isNotNull() & F.col(c).try_cast(expected[c]).isNull()).alias(f"{c}__bad")]
    def line(c, status, expected_type, actual_type, non_null, bad):
        return F.struct(F.lit(c).alias("column_name"), F.lit(status).alias("status"), F.lit(expected_type).cast("string").alias("expected_type"),
                        F.lit(actual_type).cast("string").alias("actual_type"), non_null.cast("long").alias("non_null"),
                        bad.cast("long").alias("not_castable"))
    none = F.lit(None)
    lines = [line(c, "present", t, actual[c], F.col(f"{c}__nn"), F.col(f"{c}__bad")) if c in actual
             else line(c, "missing", t, None, none, none) for c, t in expected.items()]
    lines += [line(c, "extra", None, actual[c], none, none) for c in actual if c not in expected]
    return df.agg(*aggs).select(F.inline(F.array(*lines))).select(F.lit(table).alias("table_name"), "*")


def audit_times(tables: Mapping[str, DataFrame], created: str = "created_at",
                updated: str = "updated_at") -> DataFrame:
    """per table NULL audit stamps, updated-before-created rows, ranges."""
    frames = []
    for name, df in tables.items():
        frames.append(df.agg(
            F.count(F.lit(1)).alias("total_rows"), count_if(F.col(created).isNull()).alias("null_created_at"),
            count_if(F.col(updated).isNull()).alias("null_updated_at"),
            count_if(F.col(updated) < F.col(created)).alias("illogical_timestamps"),
            F.min(created).alias("earliest_created"), F.max(created).alias("latest_created"),
            F.min(updated).alias("earliest_updated"), F.max(updated).alias("latest_updated"))
            .select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, frames)


def time_range(df: DataFrame, c: str) -> DataFrame:
    """rows, NULL timestamps, earliest and latest."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), count_if(F.col(c).isNull()).alias("null_timestamps"),
                  F.min(c).alias("earliest_timestamp"), F.max(c).alias("latest_timestamp"))


def per_day(df: DataFrame, c: str) -> DataFrame:
    """records per calendar day."""
    return (df.filter(F.col(c).isNotNull()).groupBy(F.to_date(c).alias("date"))
            .agg(F.count(F.lit(1)).alias("records_count")))


# --------------------------------------------------------------- F25–F30
def describe_wide(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """count, min, max, range, mean, sample sd, quartiles per column.

    One aggregate computes every column but the quartiles; these are found
    by rank selection (``quantiles``: linear interpolation, like pandas), or
    with ``exact=False`` by one ``percentile_approx`` sketch per column.  The
    result, one row per column, is a local table."""
    fields = ["count", "min", "max", "mean", "std"]
    aggs = [f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols)
            for n, f in zip(fields, (F.count, F.min, F.max, F.avg, F.stddev_samp))]
    row = df.agg(*aggs).first()
    known = {c: (row[f"count{i}"], row[f"min{i}"], row[f"max{i}"]) for i, c in enumerate(cols)}
    quartiles = _quartile_values(df, cols, exact, known)
    rows = []
    for i, c in enumerate(cols):
        n, low, high, mean, std = (row[f"{x}{i}"] for x in fields)
        rows.append((c, n, low, high, None if low is None else high - low, mean, std, *quartiles[c]))
    numbers = ", ".join(f"`{x}` double" for x in ("min", "max", "range", "mean", "std", "p25", "p50", "p75"))
    return df.sparkSession.createDataFrame(rows, f"`column` string, `count` bigint, {numbers}")


def _quartile_values(df: DataFrame, cols: Sequence[str], exact: bool, known: dict | None = None) -> dict[str, list]:
    """The three quartiles per column: exact, or from a sketch per column."""
    fractions = [0.25, 0.5, 0.75]
    if exact:
        return exact_quantiles(df, cols, fractions, known)
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), fractions, 10000).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"q{i}"] or [None] * 3 for i, c in enumerate(cols)}


def _quartiles(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """(column, q1, median, q3): one row per column."""
    values = _quartile_values(df, cols, exact)
    return df.sparkSession.createDataFrame([(c, *values[c]) for c in cols], "`column` string, q1 double, median double, q3 double")


def _long(df: DataFrame, ids: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.select(*ids, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("_kv")
    ).select(*ids, "_kv.column", "_kv.value")


def iqr_outliers(df: DataFrame, ids: Sequence[str], cols: Sequence[str], k: float = 3.0,
                 exact: bool = True) -> DataFrame:
    """values outside [q1 - k*iqr, q3 + k*iqr], long format with bounds.

    The quartile table has one row per column (size bounded by the column
    list), so it is broadcast to the unpivoted data."""
    q = _quartiles(df, cols, exact).select("column", (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower_bound"),
                                    (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper_bound"))
    lng = _long(df, ids, cols).join(F.broadcast(q), "column")
    return lng.filter((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound")))


def box_stats(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """quartiles, IQR and whiskers (extreme values within 1.5 IQR)."""
    q = _quartiles(df, cols, exact)
    lng = _long(df, [], cols).join(F.broadcast(q), "column")
    iqr = F.col("q3") - F.col("q1")
    return lng.groupBy("column", "q1", "median", "q3").agg(
        F.min(F.when(F.col("value") >= F.col("q1") - 1.5 * iqr, F.col("value"))).alias("lower_whisker"),
        F.max(F.when(F.col("value") <= F.col("q3") + 1.5 * iqr, F.col("value"))).alias("upper_whisker")
    ).withColumn("iqr", F.col("q3") - F.col("q1"))


# FIXED VALUES: impossible-value rules {stat: (min, max)}; None = unbounded.
IMPOSSIBLE_VALUES = {
    "ball_possession": (0, 100),
    "shots_on_target": (0, None),
    "shots_total": (0, None),
    "goals": (0, None),
    "red_cards": (0, 11),
    "passes": (0, None),
}


def range_violations(stats: DataFrame, teams: DataFrame, bounds: Mapping[str, tuple] = IMPOSSIBLE_VALUES,
                     period: str = FH) -> DataFrame:
    """values outside per-column bounds, one pass over the rows."""
    cols = list(bounds)
    _require(stats, cols, "range rules")
    lng = _long(stats.filter(F.col("period") == period), ["fixture_id", "team_id", "period"], cols)
    cond = F.lit(False)
    for c in cols:
        lo, hi = bounds[c]
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (F.col("value") < lo)
        if hi is not None:
            bad = bad | (F.col("value") > hi)
        cond = cond | ((F.col("column") == c) & bad)
    out = lng.filter(cond).withColumnRenamed("column", "stat")
    out = out.join(teams.select("team_id", F.col("name").alias("team_name")), "team_id", "left")
    return out.select("fixture_id", "team_id", "team_name", "period", "stat", "value")


# FIXED VALUES: logical rules (name, violation predicate as SQL).
LOGICAL_RULES = [
    ("shots_total >= shots_on_target", "shots_total < shots_on_target"),
    ("goals <= shots_on_target", "goals > shots_on_target"),
    ("shots_total >= shots_insidebox", "shots_total < shots_insidebox"),
    ("shots_on_target + shots_off_target + shots_blocked <= shots_total",
     "shots_on_target + shots_off_target + shots_blocked > shots_total"),
]
RULE_REQUIRED = ["shots_total", "shots_on_target", "shots_insidebox", "goals"]


def _require(df: DataFrame, columns, what: str) -> None:
    """A rule that cannot be evaluated is an error, never left out."""
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"{what} need columns that the table lacks: {', '.join(missing)}")


def _rule_columns(rules) -> set[str]:
    import re
    return {w for _, p in rules for w in re.findall(r"[a-z_]+", p)}


def rule_violations(stats: DataFrame, rules=LOGICAL_RULES, required: Sequence[str] = tuple(RULE_REQUIRED),
                    k: int = 10, period: str = FH) -> DataFrame:
    """F29 counts: violations per rule over complete rows (one pass)."""
    base = stats.filter((F.col("period") == period) & reduce(lambda a, b: a & b,
                                                              [F.col(c).isNotNull() for c in required]))
    _require(stats, _rule_columns(rules), "logical rules")
    aggs = [count_if(F.coalesce(F.expr(p), F.lit(False))).alias(f"r{i}") for i, (n, p) in enumerate(rules)]
    wide = base.agg(*aggs)
    return _stack(wide, [n for n, _ in rules], [[f"r{i}"] for i in range(len(rules))], "rule", ["violations"])


def rule_examples(stats: DataFrame, teams: DataFrame, rules=LOGICAL_RULES, required: Sequence[str] = tuple(RULE_REQUIRED),
                  k: int = 10, period: str = FH) -> DataFrame:
    """F29 examples: up to ``k`` offending rows per rule (lowest fixture, team).

    Each rule is a bounded top-k (TakeOrderedAndProject), never a window
    that would sort all of a rule's violations in one task."""
    base = stats.filter((F.col("period") == period) & reduce(lambda a, b: a & b,
                                                              [F.col(c).isNotNull() for c in required]))
    _require(stats, _rule_columns(rules), "logical rules")
    cols = ["shots_total", "shots_on_target", "shots_off_target", "shots_blocked", "shots_insidebox", "goals"]
    frames = [base.filter(F.expr(p)).select(F.lit(n).alias("rule"), "fixture_id", "team_id", "period", *cols)
              .orderBy("fixture_id", "team_id").limit(k) for n, p in rules]
    names = teams.select("team_id", F.col("name").alias("team_name"))
    return reduce(DataFrame.unionByName, frames).join(names, "team_id", "left").select(
        "rule", "fixture_id", "team_id", "team_name", "period", *cols)


def pair_sum(stats: DataFrame, c: str = "ball_possession", period: str = FH) -> DataFrame:
    """Per fixture with two or more teams reporting ``c``: the number of
    teams, the values of the first and the last (by id), and the sum over
    all.  A fixture with three teams is a finding, so it stays: its
    ``team_count`` says so.  An aggregation per fixture, not a self-join: a
    fixture with many rows can never fan out into all of its pairs."""
    rows = stats.filter((F.col("period") == period) & F.col(c).isNotNull())
    per = rows.groupBy("fixture_id").agg(
        distinct_count_small("team_id").alias("team_count"),
        F.min("team_id").alias("team1_id"), F.max("team_id").alias("team2_id"),
        F.min_by(c, "team_id").alias("team1_value"), F.max_by(c, "team_id").alias("team2_value"),
        F.sum(c).alias("value_sum"))
    return per.filter(F.col("team_count") >= 2)


def pair_sum_check(stats: DataFrame, teams: DataFrame, c: str = "ball_possession", target: float = 100,
                   top: int = 20, period: str = FH) -> DataFrame:
    """the ``top`` fixtures whose two shares sum furthest from ``target``."""
    p = pair_sum(stats, c, period).withColumn("diff_from_target", F.abs(F.col("value_sum") - target))
    p = p.orderBy(F.desc("diff_from_target"), "fixture_id").limit(top)
    t = teams.select("team_id", "name")
    p = (p.join(t.select(F.col("team_id").alias("team1_id"), F.col("name").alias("team1_name")), "team1_id", "left")
         .join(t.select(F.col("team_id").alias("team2_id"), F.col("name").alias("team2_name")), "team2_id", "left"))
    return p.select("fixture_id", "team_count", "team1_id", "team1_name", "team1_value", "team2_id", "team2_name",
                    "team2_value", "value_sum", "diff_from_target")


# --------------------------------------------------------------- F31–F37
def stat_goals(stats: DataFrame, schedules: DataFrame, period: str = S.SECOND_HALF) -> DataFrame:
    """Per fixture: goals by side from ``period`` statistics (NULL goals
    skipped).  Rows are summed per team before the join, so that a fixture
    with very many rows is combined map-side."""
    rows = (stats.filter((F.col("period") == period) & F.col("goals").isNotNull())
            .groupBy("fixture_id", "team_id").agg(F.sum("goals").alias("goals")))
    j = rows.join(schedules.select("fixture_id", "home_team_id", "away_team_id", "home_score", "away_score"),
                  "fixture_id")
    return j.groupBy("fixture_id", "home_score", "away_score").agg(
        F.sum(F.when(F.col("team_id") == F.col("home_team_id"), F.col("goals")).otherwise(0)).alias("home_goals_from_stats"),
        F.sum(F.when(F.col("team_id") == F.col("away_team_id"), F.col("goals")).otherwise(0)).alias("away_goals_from_stats"))


def detail_vs_summary(stats: DataFrame, schedules: DataFrame, period: str = S.SECOND_HALF, numbered: bool = False) -> DataFrame:
    """fixtures whose ``period`` goals disagree with the schedule score,
    the largest difference first (``numbered``: with their place as ``rank``)."""
    g = stat_goals(stats, schedules, period)
    g = g.filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull()
                 & ((F.col("home_score") != F.col("home_goals_from_stats"))
                    | (F.col("away_score") != F.col("away_goals_from_stats"))))
    g = g.select("fixture_id", F.col("home_score").alias("home_goals_schedules"), "home_goals_from_stats",
                    (F.col("home_score") - F.col("home_goals_from_stats")).alias("home_diff"),
                    F.col("away_score").alias("away_goals_schedules"), "away_goals_from_stats",
                    (F.col("away_score") - F.col("away_goals_from_stats")).alias("away_diff"))
    size = F.abs("home_diff") + F.abs("away_diff")
    if numbered:
        g = with_rank(g, size, [F.desc(size), F.asc("fixture_id")], descending=True)
    return g.orderBy(F.desc(size), "fixture_id")


def mismatch_summary(stats: DataFrame, schedules: DataFrame, period: str = S.SECOND_HALF) -> DataFrame:
    """F32: mismatch count and rate, mean offsets, sign counts."""
    g = stat_goals(stats, schedules, period)
    bad = (F.col("home_score").isNotNull() & F.col("away_score").isNotNull()
           & ((F.col("home_score") != F.col("home_goals_from_stats"))
              | (F.col("away_score") != F.col("away_goals_from_stats"))))
    hd = F.col("home_score") - F.col("home_goals_from_stats")
    ad = F.col("away_score") - F.col("away_goals_from_stats")
    return (g.agg(F.count(F.lit(1)).alias("fixtures_with_period_goals"), count_if(bad).alias("mismatches"),
                  F.avg(F.when(bad, hd)).alias("avg_home_diff"), F.avg(F.when(bad, ad)).alias("avg_away_diff"),
                  count_if(bad & (hd > 0)).alias("home_positive"), count_if(bad & (hd < 0)).alias("home_negative"),
                  count_if(bad & (ad > 0)).alias("away_positive"), count_if(bad & (ad < 0)).alias("away_negative"))
            .withColumn("mismatch_pct", pct("mismatches", "fixtures_with_period_goals")))


def _per_fixture_coverage(schedules: DataFrame, stats: DataFrame) -> DataFrame:
    """Schedules with has-any / has-first-half flags (one row per fixture)."""
    return schedules.join(_fixture_flags(stats), "fixture_id", "left").withColumn(
        "has_stats", F.col("has_first_half").isNotNull()).withColumn(
        "has_first_half", F.coalesce(F.col("has_first_half"), F.lit(False)))


def coverage_by_league(schedules: DataFrame, stats: DataFrame, leagues: DataFrame) -> DataFrame:
    """per league fixtures, finished, with any stats / first half, and %."""
    cov = _per_fixture_coverage(schedules, stats)
    per = cov.groupBy("league_id").agg(
        F.count(F.lit(1)).alias("total_fixtures"), count_if(F.col("status") == "FT").alias("finished_fixtures"),
        count_if(F.col("has_stats")).alias("fixtures_with_stats"),
        count_if(F.col("has_first_half")).alias("fixtures_with_first_half"))
    per = per.join(leagues.select("league_id", F.col("name").alias("league_name")), "league_id")
    per = per.filter(F.col("finished_fixtures") > 0)
    return per.select("league_id", "league_name", "total_fixtures", "finished_fixtures", "fixtures_with_stats",
                      "fixtures_with_first_half",
                      pct("fixtures_with_stats", "finished_fixtures").alias("stats_coverage_pct"),
                      pct("fixtures_with_first_half", "finished_fixtures").alias("first_half_coverage_pct"))


def coverage_overall(by_league: DataFrame) -> DataFrame:
    """F33 overall: first-half coverage weighted by finished fixtures."""
    return by_league.agg(F.sum("fixtures_with_first_half").alias("with_first_half"),
                         F.sum("finished_fixtures").alias("finished")).select(
        pct("with_first_half", "finished", None).alias("weighted_first_half_coverage_pct"))


def means_by_league(stats: DataFrame, schedules: DataFrame, leagues: DataFrame,
                    cols: Sequence[str] = ("goals", "shots_total", "ball_possession", "passes"),
                    names: Sequence[str] = ("avg_goals", "avg_shots", "avg_possession", "avg_passes"),
                    required: Sequence[str] = ("goals", "shots_total", "ball_possession"),
                    min_n: int = 20) -> DataFrame:
    """per-league means over first-half rows that have the ``required``
    statistics (>= ``min_n`` fixtures)."""
    rows = stats.filter((F.col("period") == FH) & reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))
    j = rows.select("fixture_id", *cols).join(schedules.select("fixture_id", "league_id"), "fixture_id")
    per = j.groupBy("league_id").agg(F.countDistinct("fixture_id").alias("fixtures_counted"),
                                     *[F.round(F.avg(c), 2).alias(n) for c, n in zip(cols, names)])
    per = per.filter(F.col("fixtures_counted") >= min_n)
    per = per.join(leagues.select("league_id", F.col("name").alias("league_name")), "league_id")
    return per.select("league_id", "league_name", "fixtures_counted", *names)


def trend(df: DataFrame, x: str = "fixtures_counted", y: str = "avg_goals") -> DataFrame:
    """least-squares slope/intercept of ``y`` on ``x``, mean and sd of y."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"))


def above_mean_sd(df: DataFrame, y: str = "avg_goals") -> DataFrame:
    """F35 high: rows with ``y`` above mean + 1 sample sd (scalar subquery)."""
    thr = df.select(F.avg(y) + F.stddev_samp(y)).scalar()
    return df.filter(F.col(y) > thr)


def side_bias(stats: DataFrame, schedules: DataFrame,
              cols: Sequence[str] = ("goals", "shots_total", "shots_on_target", "ball_possession", "fouls", "corners",
                                     "passes")) -> DataFrame:
    """first-half rows by Home/Away/Unknown: availability % and means."""
    j = stats.filter(F.col("period") == FH).join(
        schedules.select("fixture_id", "home_team_id", "away_team_id"), "fixture_id")
    loc = (F.when(F.col("team_id") == F.col("home_team_id"), "Home")
           .when(F.col("team_id") == F.col("away_team_id"), "Away").otherwise("Unknown"))
    avail = {"goals": "goals_availability", "shots_total": "shots_availability",
             "ball_possession": "possession_availability"}
    aggs = [F.count(F.lit(1)).alias("records")]
    for c, n in avail.items():
        aggs.append(F.round(F.avg(F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0)) * 100, 2).alias(n))
    for c in cols:
        aggs.append(F.round(F.avg(c), 2).alias(f"avg_{c}"))
    return j.groupBy(loc.alias("location")).agg(*aggs)


def side_comparison(bias: DataFrame) -> DataFrame:
    """Home vs Away per metric: difference and relative difference %."""
    metrics = [c for c in bias.columns if c not in ("location", "records")]
    lng = bias.select("location", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("kv")
    ).select("location", "kv.metric", "kv.v")
    piv = lng.groupBy("metric").agg(F.max(F.when(F.col("location") == "Home", F.col("v"))).alias("home"),
                                    F.max(F.when(F.col("location") == "Away", F.col("v"))).alias("away"))
    return (piv.withColumn("difference", F.col("home") - F.col("away"))
            .withColumn("relative_difference_pct", F.round(F.try_divide(F.col("difference"), F.col("away")) * 100, 2)))


# --------------------------------------------------------------- F38–F42
def coverage_by_month(schedules: DataFrame, stats: DataFrame) -> DataFrame:
    """monthly fixtures, finished, with stats / first half, and %."""
    cov = _per_fixture_coverage(schedules.filter(F.col("start_time").isNotNull()), stats)
    per = cov.groupBy(F.date_format("start_time", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("total_fixtures"), count_if(F.col("status") == "FT").alias("finished_fixtures"),
        count_if(F.col("has_stats")).alias("fixtures_with_stats"),
        count_if(F.col("has_first_half")).alias("fixtures_with_first_half"))
    per = per.filter(F.col("finished_fixtures") > 0)
    return per.select("month", "total_fixtures", "finished_fixtures", "fixtures_with_stats", "fixtures_with_first_half",
                      pct("fixtures_with_stats", "finished_fixtures").alias("stats_coverage_pct"),
                      pct("fixtures_with_first_half", "finished_fixtures").alias("first_half_coverage_pct"))


def _first_half_sums(stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per fixture: first-half row count and (sum, non-NULL count) per column,
    so means over team rows survive aggregation to fixture level."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        aggs += [F.sum(F.col(c).cast("double")).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")]
    return stats.filter(F.col("period") == FH).groupBy("fixture_id").agg(*aggs)


def _coverage_by(schedules: DataFrame, stats: DataFrame, bucket: Column, name: str,
                 cols: Sequence[str], names: Sequence[str], order: Column | None = None) -> DataFrame:
    fx = schedules.filter((F.col("status") == "FT") & F.col("start_time").isNotNull())
    j = fx.select("fixture_id", "start_time").join(_first_half_sums(stats, cols), "fixture_id", "left")
    keys = [bucket.alias(name)] + ([order.alias("_order")] if order is not None else [])
    aggs = [F.count(F.lit(1)).alias("finished_fixtures"),
            count_if(F.col("_rows").isNotNull()).alias("fixtures_with_first_half")]
    for c, n in zip(cols, names):
        aggs.append(F.round(F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}").cast("double")), 2).alias(n))
    out = j.groupBy(*keys).agg(*aggs)
    out = out.withColumn("coverage_pct", pct("fixtures_with_first_half", "finished_fixtures"))
    out = out.select(*[c for c in ("_order", name) if c in out.columns], "finished_fixtures", "fixtures_with_first_half",
                     "coverage_pct", *names)
    return out if order is None else out.withColumnRenamed("_order", f"{name}_index").orderBy(f"{name}_index")


def coverage_by_weekday(schedules: DataFrame, stats: DataFrame) -> DataFrame:
    """finished fixtures per weekday (Monday first), first-half coverage
    and means over first-half team rows."""
    return _coverage_by(schedules, stats, F.date_format("start_time", "EEEE"), "day_of_week",
                        ["goals", "shots_total", "ball_possession"], ["avg_goals", "avg_shots", "avg_possession"],
                        order=F.weekday("start_time"))


def coverage_by_hour(schedules: DataFrame, stats: DataFrame) -> DataFrame:
    """the same per kick-off hour ('00'..'23')."""
    return _coverage_by(schedules, stats, F.date_format("start_time", "HH"), "hour_of_day",
                        ["goals", "shots_total"], ["avg_goals", "avg_shots"])


# FIXED VALUES: scenario names, in report order.
SCENARIOS = ["High-scoring (5+ goals)", "Red Card Issued", "Abandoned/Cancelled", "Penalty Shootout",
             "Extra Time", "Regular Match"]


def scenario_coverage(schedules: DataFrame, stats: DataFrame) -> DataFrame:
    """six scenarios in one pass over fixtures; every scenario row is
    emitted, zero counts included."""
    per = stats.groupBy("fixture_id").agg(F.max(F.coalesce(F.col("red_cards") > 0, F.lit(False))).alias("red"))
    j = schedules.join(per, "fixture_id", "left")
    has = F.col("red").isNotNull()
    red = F.coalesce(F.col("red"), F.lit(False))
    goals = F.col("home_score") + F.col("away_score")
    st = F.col("status")
    conds = [(st == "FT") & (goals >= 5), (st == "FT") & red, st.isin("ABD", "CANC", "INT"),
             st == "FT_PEN", st == "AET", (st == "FT") & (goals < 5) & ~red]
    aggs = []
    for i, c in enumerate(conds):
        c = F.coalesce(c, F.lit(False))
        aggs += [count_if(c).alias(f"n{i}"), count_if(c & has).alias(f"s{i}")]
    wide = j.agg(*aggs)
    out = _stack(wide, SCENARIOS, [[f"n{i}", f"s{i}"] for i in range(len(SCENARIOS))], "scenario",
                 ["fixture_count", "fixtures_with_stats"])
    return out.withColumn("stats_coverage_pct", pct("fixtures_with_stats", "fixture_count"))


def unplayed_with_stats(schedules: DataFrame, stats: DataFrame, teams: DataFrame,
                        statuses: Sequence[str] = ("POST", "CANC", "INT", "ABD")) -> DataFrame:
    """non-played fixtures that nevertheless have statistics rows."""
    per = stats.groupBy("fixture_id").agg(
        F.count(F.lit(1)).alias("stat_records"),
        F.array_join(F.array_sort(F.collect_set("period")), ",").alias("periods"))
    fx = schedules.filter(F.col("status").isin(*statuses)).select(
        "fixture_id", "status", "start_time", "home_team_id", "away_team_id")
    out = _names(fx.join(per, "fixture_id"), None, None, teams)
    return out.select("fixture_id", "status", "start_time", "home_team", "away_team", "stat_records", "periods")


# --------------------------------------------------------------- F43–F50
def quality_score(stats: DataFrame, schedules: DataFrame, leagues: DataFrame, seasons: DataFrame,
                  cols: Sequence[str] = tuple(S.REQUIRED_HT_STATS), period: str = FH) -> DataFrame:
    """share of non-NULL required statistics per fixture and category.

    Aggregated per fixture first; dimension names are joined afterwards."""
    per = stats.filter(F.col("period") == period).groupBy("fixture_id").agg(
        distinct_count_small("team_id").alias("team_count"),
        F.sum(non_null_count(cols)).cast("long").alias("non_null_counts"))
    per = per.withColumn("total_possible", (F.col("team_count") * len(cols)).cast("long"))
    j = per.join(schedules.select("fixture_id", "league_id", "season_id", "start_time"), "fixture_id")
    j = _names(j, leagues, seasons, None)
    r = F.try_divide(F.col("non_null_counts") * 100.0, F.col("total_possible").cast("double"))
    cat = (F.when(F.col("team_count") < 2, S.Q_CRIT_TEAM).when(F.col("non_null_counts") == 0, S.Q_CRIT_NULL)
           .when(r < 50, S.Q_POOR).when(r < 80, S.Q_FAIR).when(r < 100, S.Q_GOOD).otherwise(S.Q_EXCELLENT))
    return j.select("fixture_id", "league_id", "league_name", "season_id", "season_name", "start_time",
                    "team_count", "non_null_counts", "total_possible",
                    F.round(F.try_divide(F.col("non_null_counts") * 100.0,
                                         F.when(F.col("total_possible") != 0, F.col("total_possible"))), 2)
                    .alias("quality_score"), cat.alias("quality_category"))


def category_share(q: DataFrame, c: str = "quality_category") -> DataFrame:
    """fixtures per category and % of all scored fixtures."""
    total = q.select(F.count(F.lit(1))).scalar()
    return (q.dropna(subset=[c]).groupBy(c).agg(F.count(F.lit(1)).alias("fixture_count"))
            .withColumn("percentage", F.round(F.col("fixture_count") * 100.0 / total, 2)))


def league_quality(q: DataFrame) -> DataFrame:
    """per league counts per category, mean score, % excellent,
    % good-or-better (NULL league ids/names dropped)."""
    c = F.col("quality_category")
    per = q.dropna(subset=["league_id", "league_name"]).groupBy("league_id", "league_name").agg(
        F.count(F.lit(1)).alias("fixture_count"), F.avg("quality_score").alias("avg_quality_score"),
        count_if(c == S.Q_EXCELLENT).alias("excellent_fixture_count"),
        count_if(c == S.Q_GOOD).alias("good_fixture_count"), count_if(c == S.Q_FAIR).alias("fair_fixture_count"),
        count_if(c == S.Q_POOR).alias("poor_fixture_count"),
        count_if(c.startswith("CRITICAL")).alias("critical_fixture_count"))
    return (per.withColumn("excellent_pct", pct("excellent_fixture_count", "fixture_count"))
            .withColumn("good_or_better_pct",
                        pct(F.col("excellent_fixture_count") + F.col("good_fixture_count"), "fixture_count")))


def quality_report(q: DataFrame, leagues_q: DataFrame, top: int = 5) -> DataFrame:
    """overall figures plus top/bottom ``top`` leagues, long format
    (section, rank, league_name, metric, value)."""
    cat = F.col("quality_category")
    overall = q.agg(F.count(F.lit(1)).cast("double").alias("total_fixtures"),
                    F.avg("quality_score").alias("avg_quality_score"),
                    pct(count_if(cat.isin(S.Q_EXCELLENT, S.Q_GOOD)), F.count(F.lit(1))).alias("good_or_better_percentage"),
                    pct(count_if(cat.isin(S.Q_CRIT_TEAM, S.Q_CRIT_NULL, S.Q_POOR)), F.count(F.lit(1)))
                    .alias("problem_percentage"))
    metrics = ["total_fixtures", "avg_quality_score", "good_or_better_percentage", "problem_percentage"]
    ov = _stack(overall, metrics, [[m] for m in metrics], "metric", ["value"]).select(
        F.lit("overall").alias("section"), F.lit(None).cast("long").alias("rank"),
        F.lit(None).cast("string").alias("league_name"), "metric", "value")
    frames = [ov]
    for section, order in (("top_leagues", [F.desc("good_or_better_pct"), F.asc("league_id")]),
                           ("problem_leagues", [F.asc("good_or_better_pct"), F.desc("league_id")])):
        best = leagues_q.orderBy(*order).limit(top)
        # rank within k rows: a window over at most ``top`` rows is bounded
        ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
        for m in ("avg_quality_score", "good_or_better_pct"):
            frames.append(ranked.select(F.lit(section).alias("section"), "rank", "league_name",
                                        F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")))
    return reduce(DataFrame.unionByName, frames)


def badge(score: Column) -> Column:
    """EXCELLENT >= 90, GOOD >= 80, FAIR >= 50, else POOR."""
    return (F.when(score >= 90, S.BADGES[0]).when(score >= 80, S.BADGES[1])
            .when(score >= 50, S.BADGES[2]).otherwise(S.BADGES[3]))


def league_badges(leagues_q: DataFrame) -> DataFrame:
    """F47 binding: league quality with its badge."""
    return leagues_q.select("league_id", "league_name", "avg_quality_score",
                            badge(F.col("avg_quality_score")).alias("quality_badge"))


# FIXED VALUES: error-pattern names and descriptions.
ERROR_PATTERNS = [
    ("Missing first-half data", "Fixtures with stats but missing first-half period data"),
    ("Incomplete team coverage", "First-half entries with fewer than 2 teams represented"),
    ("Missing ball possession", "First-half entries with NULL ball_possession"),
    ("Inconsistent scores", "Fixtures where goals in fixture_stats differ from scores in schedules"),
    ("Irregular possession sum", "Team pairs in first-half where possession sums outside 95-105%"),
    ("Irregular possession teams", "Fixtures where other than two teams report first-half possession"),
    ("Impossible statistics", "Entries with goals > shots_on_target or shots_total < shots_on_target"),
]


def error_register(stats: DataFrame, schedules: DataFrame) -> DataFrame:
    """the named error counts, most frequent first.  Statistics are
    reduced to (fixture, team) before they meet the schedules, then to the
    fixture; both steps shuffle on fixture_id only after combining."""
    fh = F.col("period") == FH
    sh = (F.col("period") == S.SECOND_HALF) & F.col("goals").isNotNull()
    poss = F.col("ball_possession")
    imp = fh & (((F.col("goals") > F.col("shots_on_target")) & F.col("goals").isNotNull()
                 & F.col("shots_on_target").isNotNull())
                | ((F.col("shots_total") < F.col("shots_on_target")) & F.col("shots_total").isNotNull()
                   & F.col("shots_on_target").isNotNull()))
    team = stats.groupBy("fixture_id", "team_id").agg(
        F.max(fh).alias("fh"), count_if(fh & poss.isNull()).alias("fh_no_poss"), count_if(imp).alias("impossible"),
        F.max(sh).alias("sh"), F.sum(F.when(sh, F.col("goals"))).alias("sh_goals"),
        F.max(fh & poss.isNotNull()).alias("has_poss"), F.sum(F.when(fh, poss)).alias("poss"))
    j = team.join(schedules.select("fixture_id", "home_team_id", "away_team_id", "home_score", "away_score"),
                  "fixture_id", "left")
    known = F.col("team_id").isNotNull()
    side = lambda c: F.sum(F.when(F.col("sh") & (F.col("team_id") == F.col(c)), F.col("sh_goals")).otherwise(0))
    per = j.groupBy("fixture_id", "home_score", "away_score").agg(
        F.max("fh").alias("has_fh"), count_if(F.col("fh") & known).alias("fh_teams"),
        F.sum("fh_no_poss").alias("fh_no_poss"), F.sum("impossible").alias("impossible"),
        F.max(F.col("sh") & F.col("home_team_id").isNotNull()).alias("has_sh"),
        side("home_team_id").alias("sh_home"), side("away_team_id").alias("sh_away"),
        count_if(F.col("has_poss") & known).alias("poss_teams"), F.sum("poss").alias("poss_sum"))
    score_bad = (F.col("has_sh") & F.col("home_score").isNotNull() & F.col("away_score").isNotNull()
                 & ((F.col("home_score") != F.col("sh_home")) | (F.col("away_score") != F.col("sh_away"))))
    sum_bad = (F.col("poss_teams") >= 2) & ((F.col("poss_sum") < 95) | (F.col("poss_sum") > 105))
    wide = per.agg(count_if(~F.col("has_fh")).alias("c0"),
                   count_if(F.col("has_fh") & (F.col("fh_teams") < 2)).alias("c1"),
                   F.sum("fh_no_poss").cast("long").alias("c2"),
                   count_if(F.coalesce(score_bad, F.lit(False))).alias("c3"), count_if(sum_bad).alias("c4"),
                   count_if((F.col("poss_teams") > 0) & (F.col("poss_teams") != 2)).alias("c5"),
                   F.sum("impossible").cast("long").alias("c6"))
    names = [n for n, _ in ERROR_PATTERNS]
    out = _stack(wide, names, [[f"c{i}"] for i in range(len(names))], "name", ["count"])
    desc = F.create_map(*[x for n, d in ERROR_PATTERNS for x in (F.lit(n), F.lit(d))])
    ranked = F.row_number().over(Window.orderBy(F.desc("count"), "name"))  # a window over the few named patterns
    return out.select(ranked.cast("long").alias("rank"), "name", desc[F.col("name")].alias("description"), "count")


def incomplete_fixtures(stats: DataFrame, cols: Sequence[str] = tuple(S.REQUIRED_HT_STATS),
                        period: str = FH) -> DataFrame:
    """fixtures with an all-NULL ``period`` row OR fewer than two teams
    in ``period`` (one aggregation replaces UNION of two scans)."""
    per = stats.filter(F.col("period") == period).groupBy("fixture_id").agg(
        F.max(all_null(cols)).alias("_all_null"), distinct_count_small("team_id").alias("_teams"))
    return per.filter(F.col("_all_null") | (F.col("_teams") < 2)).select("fixture_id")


# FIXED VALUES: recommendation texts of the validation summary.
RECOMMENDATIONS = {
    "stats_coverage": "Focus on improving stats coverage for finished fixtures, especially for more recent matches",
    "team_coverage": "Investigate fixtures with incomplete team coverage; both teams' stats are essential for modeling",
    "league_coverage": "Prioritize standardizing stats coverage across leagues; many top leagues have inconsistent coverage",
    "decreasing_stats": "Investigate decreasing stat values between periods, which may indicate data quality issues",
    "period_meaning": "Clarify whether API periods represent cumulative or period-specific stats",
    "null_rates": "Address high NULL rates for key stats",
    "score_consistency": "Resolve score inconsistencies between fixture_stats and schedules tables",
    "monitoring": "Implement regular automated quality monitoring focusing on stats completeness and consistency",
    "modeling_filter": "For Asian handicap modeling, filter fixtures to include only those with quality scores above 80%",
    "league_registry": "Create and maintain a league quality registry to inform modeling decisions",
}


def validation_summary(quality: DataFrame, leagues_q: DataFrame, missing: DataFrame, team_rate: DataFrame,
                       nulls: DataFrame, member: DataFrame, dup_keys: DataFrame, mismatch: DataFrame,
                       coverage: DataFrame, decreasing: DataFrame, both_periods: DataFrame, errors: DataFrame) -> DataFrame:
    """headline metrics, findings, triggered recommendations, the
    league ranking and data gaps as ``(section, metric, value, detail)``
    rows, assembled from the other audit results (one-row aggregates and
    short rankings; no printing, no driver state).

    ``coverage``: F33; ``decreasing``: P1; ``both_periods``: the (fixture,
    team) rows that P1 could compare; ``errors``: F48."""
    def rows(df, *lines):
        """Several lines (section, metric, value, detail, condition) of a one-row frame."""
        made = [F.when(F.lit(True) if cond is None else cond, F.struct(
            F.lit(section).alias("section"), F.lit(metric).alias("metric"), value.cast("double").alias("value"),
            (F.lit(None) if detail is None else detail).cast("string").alias("detail"))) for section, metric, value, detail, cond in lines]
        return df.select(F.inline(F.filter(F.array(*made), lambda x: x.isNotNull())))

    def advice(metric, cond=None):
        return ("recommendation", metric, F.lit(1), F.lit(RECOMMENDATIONS[metric]), cond)
    cat = F.col("quality_category")
    q1 = quality.agg(F.count(F.lit(1)).alias("n"), F.avg("quality_score").alias("avg"),
                     count_if(cat.isin(S.Q_EXCELLENT, S.Q_GOOD)).alias("good"))
    worst = nulls.orderBy(F.desc("null_percent"), "statistic").limit(1)
    poor = leagues_q.agg(count_if(F.col("avg_quality_score") < 50).alias("poor"))
    dups = dup_keys.agg(F.count(F.lit(1)).alias("n"))
    covered, fell, compared = (d.agg(F.count(F.lit(1)).alias("n")) for d in (coverage, decreasing, both_periods))
    by_quality = [F.desc("good_or_better_pct"), F.asc("league_id")]

    def ranked(df, section, order, k, value, detail):
        top = df.orderBy(*order).limit(k)  # a window over at most k rows
        place = F.row_number().over(Window.orderBy(*order)).cast("string")
        return top.select(F.lit(section).alias("section"), place.alias("metric"), value.cast("double").alias("value"),
                          detail.cast("string").alias("detail"))
    n = F.col("n")
    parts = [
        rows(q1, ("overall", "total_fixtures", n, None, None), ("overall", "avg_quality_score", F.col("avg"), None, None),
             ("overall", "good_or_better_pct", pct("good", "n"), None, None),
             advice("monitoring"), advice("modeling_filter"), advice("league_registry")),
        rows(missing, ("findings", "missing_stats_pct", F.col("missing_pct"), None, None), advice("stats_coverage", F.col("missing_stats") > 0)),
        rows(team_rate, ("findings", "incomplete_team_pct", F.col("incomplete_pct"), None, None), advice("team_coverage", F.col("incomplete") > 0)),
        rows(worst, ("findings", "worst_null_stat_pct", F.col("null_percent"), F.col("statistic"), None),
             advice("null_rates", F.col("null_percent") > 20)),
        rows(member, ("findings", "team_id_inconsistency_pct", F.col("inconsistent_percent"), None, None)),
        rows(dups, ("findings", "duplicate_keys", n, None, None)),
        rows(mismatch, ("findings", "score_inconsistency_pct", F.col("mismatch_pct"), None, None),
             advice("score_consistency", F.col("mismatches") > 0)),
        rows(fell, ("findings", "decreasing_stats", n, None, None), advice("decreasing_stats", n > 0)),
        rows(poor, ("gaps", "poor_leagues", F.col("poor"), None, None)),
        ranked(leagues_q, "league_ranking", by_quality, 5, F.col("avg_quality_score"), F.col("league_name")),
        ranked(leagues_q.filter(F.col("avg_quality_score") < 50), "poor_league", by_quality, 3, F.col("avg_quality_score"),
               F.col("league_name")),
        ranked(errors, "error_pattern", [F.asc("rank")], 3, F.col("count"), F.col("name")),
        rows(covered, advice("league_coverage", n > 0)),
        rows(compared, advice("period_meaning", n > 0)),
    ]
    return reduce(DataFrame.unionByName, parts)
