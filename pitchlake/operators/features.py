"""Feature datasets (D1–D25): does the betting favourite win the second half?

Both datasets are single logical plans keyed on ``fixture_id``.  Every
input (schedules, per-team statistics, odds, pressure) is reduced to one
row per fixture by an aggregation *on fixture_id*, so the joins that
follow are co-partitioned and Spark shuffles each input once:

* team rows are attached to home/away sides by conditional aggregation
  over ``fixture ⋈ stats`` instead of two extra joins on
  (fixture_id, team_id) (which would re-shuffle on a composite key);
* 1x2 odds are pivoted once (one aggregation, three labels) instead of
  three self-joins.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake import schema as S
from pitchlake.functions.exprs import all_not_null, count_if, distinct_count_small

TARGET_LINE = -0.5


def target_name(line: float = TARGET_LINE) -> str:
    """Column name encoding the handicap line: -0.5 -> target_fav_covers_ah_neg0_5_2H."""
    return f"target_fav_covers_ah_{str(line).replace('.', '_').replace('-', 'neg')}_2H"


# --------------------------------------------------------------------- D1
def valid_fixtures(stats: DataFrame, period: str = S.FIRST_HALF, n_teams: int = 2) -> DataFrame:
    """Fixtures whose ``period`` rows cover exactly ``n_teams`` distinct teams."""
    return (stats.filter(F.col("period") == period).groupBy("fixture_id")
            .agg(distinct_count_small("team_id").alias("team_count"))
            .filter(F.col("team_count") == n_teams).select("fixture_id"))


# --------------------------------------------------------------- D14 / D2
def pivot_odds(odds: DataFrame, market: int = S.MATCH_WINNER_MARKET,
               bookmaker: int = S.DEFAULT_BOOKMAKER, labels: Sequence[str] = tuple(S.ONE_X_TWO),
               rule: str = "latest", names: Sequence[str] | None = None) -> DataFrame:
    """Long odds -> one row per fixture with one price column per label.

    ``rule="latest"`` (dataset 1): of repeated prices for a label keep the
    most recent ``latest_bookmaker_update``, ties to the higher price.
    ``rule="mean"`` (D14, dataset 2): average the repeats.
    Both are single aggregations with map-side combine.
    """
    names = list(names or [f"odds_{l.lower()}" for l in labels])
    o = odds.filter((F.col("market_id") == market) & (F.col("bookmaker_id") == bookmaker)
                    & F.col("label").isin(*labels))
    aggs = []
    for lab, name in zip(labels, names):
        hit = F.col("label") == lab
        if rule == "mean":
            aggs.append(F.avg(F.when(hit, F.col("value"))).alias(name))
        else:
            pick = F.max(F.when(hit, F.struct(F.col("latest_bookmaker_update"), F.col("value"))))
            aggs.append(pick.getField("value").alias(name))
    return o.groupBy("fixture_id").agg(*aggs)


# ------------------------------------------------------------ D17 / D25
def attach_sides(fixtures: DataFrame, team_rows: DataFrame, cols: Sequence[str],
                 home_prefix: str, away_prefix: str, how: str = "first",
                 fill=None, team_count: bool = False) -> DataFrame:
    """Attach per-team values to the home and away side of each fixture.

    ``fixtures`` has one row per fixture with ``home_team_id``/``away_team_id``;
    ``team_rows`` has (fixture_id, team_id, *cols).  ``how="sum"`` adds up
    repeated team rows (D16/D17), ``how="first"`` expects one row per team.
    ``fill`` replaces a missing side (D17: 0).  ``team_count`` also returns
    the number of distinct teams in ``team_rows`` per fixture (D1).
    """
    keys = fixtures.columns
    # one row per (fixture, team) before the join: combined map-side, so a
    # fixture with a huge number of rows shrinks to its few teams before it
    # meets the left join (whose right side AQE cannot split)
    per_team = team_rows.groupBy("fixture_id", "team_id").agg(
        *[(F.sum(c) if how == "sum" else F.max(c)).alias(c) for c in cols])
    j = fixtures.join(per_team.withColumnRenamed("team_id", "_team"), "fixture_id", "left")
    aggs = []
    for side, prefix in (("home_team_id", home_prefix), ("away_team_id", away_prefix)):
        mine = F.col("_team") == F.col(side)
        for c in cols:
            e = F.max(F.when(mine, F.col(c)))
            if fill is not None:
                e = F.coalesce(e, F.lit(fill))
            aggs.append(e.alias(prefix + c))
    if team_count:
        aggs.append(distinct_count_small("_team").alias("team_count"))
    return j.groupBy(*keys).agg(*aggs)


# -------------------------------------------------------------- dataset 1
def base_rows(schedules: DataFrame, stats: DataFrame, odds: DataFrame,
              statuses: Sequence[str] = tuple(S.FINISHED_PRESSURE), period: str = S.FIRST_HALF,
              stat_cols: Sequence[str] = tuple(S.REQUIRED_HT_STATS)) -> DataFrame:
    """D1 + D2: finished fixtures with exactly two teams in ``period``, both
    sides' statistics, final scores and the latest 1x2 prices."""
    sched = (schedules.filter(F.col("status").isin(*statuses) & F.col("home_score").isNotNull()
                              & F.col("away_score").isNotNull())
             .select("fixture_id", "home_team_id", "away_team_id", "home_score", "away_score"))
    rows = stats.filter(F.col("period") == period).select("fixture_id", "team_id", *stat_cols)
    sided = attach_sides(sched, rows, stat_cols, "ht_home_", "ht_away_", team_count=True)
    sided = sided.filter((F.col("team_count") == 2) & F.col("ht_home_goals").isNotNull()
                         & F.col("ht_away_goals").isNotNull()).drop("team_count")
    return sided.join(pivot_odds(odds), "fixture_id", "left")


def require_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D3: coerce to double and drop rows missing any of ``cols`` (a text
    that is no number counts as missing)."""
    for c in cols:
        df = df.withColumn(c, F.col(c).try_cast("double"))
    return df.dropna(subset=list(cols))


def odds_features(df: DataFrame) -> DataFrame:
    """Implied probabilities, book margin and home/away price ratio."""
    inv = {k: F.try_divide(F.lit(1.0), F.col(f"odds_{k}")) for k in ("home", "draw", "away")}
    return (df.withColumn("implied_prob_home", inv["home"])
            .withColumn("implied_prob_draw", inv["draw"])
            .withColumn("implied_prob_away", inv["away"])
            .withColumn("prob_margin", F.col("implied_prob_home") + F.col("implied_prob_draw")
                        + F.col("implied_prob_away") - 1)
            .withColumn("odds_ratio_hw", F.try_divide(F.col("odds_home"), F.col("odds_away"))))


def favourite_three_way(df: DataFrame) -> DataFrame:
    """Home favourite if its price is the lowest (ties to home); away
    if strictly lowest; otherwise no favourite (NULL)."""
    h, d, a = F.col("odds_home"), F.col("odds_draw"), F.col("odds_away")
    loc = F.when((h <= d) & (h <= a), F.lit("home")).when((a < d) & (a < h), F.lit("away"))
    is_home = F.col("favorite_location") == "home"
    return (df.withColumn("favorite_location", loc)
            .withColumn("favorite_team_id", F.when(F.col("favorite_location") == "home", F.col("home_team_id"))
                        .when(F.col("favorite_location") == "away", F.col("away_team_id")))
            .withColumn("odds_fav", F.when(is_home, h).otherwise(a))
            .withColumn("odds_und", F.when(is_home, a).otherwise(h)))


def second_half_goals(df: DataFrame, home_ft="home_score", away_ft="away_score",
                      home_ht="ht_home_goals", away_ht="ht_away_goals") -> DataFrame:
    """Second-half goals = full time - half time."""
    return (df.withColumn("sh_home_goals", F.col(home_ft) - F.col(home_ht))
            .withColumn("sh_away_goals", F.col(away_ft) - F.col(away_ht)))


def favourite_margin(location: Column, home: Column, away: Column) -> Column:
    return F.when(location == "home", home - away).when(location == "away", away - home)


def cover_target(df: DataFrame, line: float = TARGET_LINE, location: str = "favorite_location",
                 name: str | None = None) -> DataFrame:
    """1 when the favourite's second-half margin beats the handicap
    ``line`` (margin + line > 0), 0 otherwise; rows without a favourite are
    dropped."""
    name = name or target_name(line)
    m = favourite_margin(F.lower(F.col(location)), F.col("sh_home_goals"), F.col("sh_away_goals"))
    t = F.when(m.isNull(), F.lit(None)).when(m + F.lit(line) > 0, 1).otherwise(0)
    return df.withColumn(name, t.cast("int")).filter(F.col(name).isNotNull())


def target_balance(df: DataFrame, target: str | None = None) -> DataFrame:
    """Rows with a target, how many covered, how many did not."""
    target = target or target_name()
    return df.agg(F.count(target).alias("valid_targets"),
                  count_if(F.col(target) == 1).alias("covers"),
                  count_if(F.col(target) == 0).alias("no_covers"))


def impute_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> 0 for ``cols`` (the rows affected are counted by
    ``rows_with_missing``)."""
    return df.fillna(0, subset=list(cols)).fillna(0.0, subset=list(cols))


def rows_with_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D10 report: rows with at least one NULL among ``cols`` / all rows."""
    anyn = F.lit(False)
    for c in cols:
        anyn = anyn | F.col(c).isNull()
    return df.agg(count_if(anyn).alias("rows_with_missing"), F.count(F.lit(1)).alias("rows"))


def diffs(df: DataFrame, stats: Sequence[str], orient: str = "fav",
          home_fmt: str = "ht_home_{}", away_fmt: str = "ht_away_{}",
          out_fmt: str = "ht_diff_{}") -> DataFrame:
    """Per-stat differentials; ``orient='fav'`` is favourite minus
    underdog, ``orient='home'`` is home minus away."""
    for s in stats:
        h, a = F.col(home_fmt.format(s)), F.col(away_fmt.format(s))
        if orient == "fav":
            e = F.when(F.col("favorite_location") == "home", h - a).otherwise(a - h)
        else:
            e = h - a
        df = df.withColumn(out_fmt.format(s), e)
    return df


def select_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Final projection; raises on a missing column instead of
    silently dropping it."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df.select(*cols)


DS1_ODDS_FEATURES = ["odds_home", "odds_draw", "odds_away", "implied_prob_home",
                     "implied_prob_draw", "implied_prob_away", "prob_margin", "odds_ratio_hw",
                     "odds_fav", "odds_und"]


# the training job uses the 11 differentials plus the home/away price ratio
DS1_TRAIN_FEATURES = [f"ht_diff_{s}" for s in S.REQUIRED_HT_STATS if s != "goals"] + ["ht_diff_goals",
                                                                                     "odds_ratio_hw"]


def ds1_feature_names() -> list[str]:
    stats = [s for s in S.REQUIRED_HT_STATS if s != "goals"]
    return [f"ht_diff_{s}" for s in stats] + ["ht_diff_goals"] + DS1_ODDS_FEATURES


def dataset_one(schedules: DataFrame, stats: DataFrame, odds: DataFrame,
                line: float = TARGET_LINE) -> DataFrame:
    """fixture_id, 11 favourite-oriented half-time differentials,
    10 odds features and the second-half handicap target."""
    df = base_rows(schedules, stats, odds)
    df = require_numeric(df, ["odds_home", "odds_draw", "odds_away"])
    df = favourite_three_way(odds_features(df))
    df = require_numeric(df, ["home_score", "away_score", "ht_home_goals", "ht_away_goals"])
    df = cover_target(second_half_goals(df), line)
    rest = [s for s in S.REQUIRED_HT_STATS if s != "goals"]
    df = impute_zero(df, [f"ht_{side}_{s}" for s in rest for side in ("home", "away")])
    df = diffs(df, rest + ["goals"])
    cols = ds1_feature_names()
    out = select_features(df, ["fixture_id", *cols, target_name(line)])
    return out.select("fixture_id", *[F.col(c).cast("double").alias(c) for c in cols],
                      target_name(line))


# -------------------------------------------------------------- dataset 2
DS2_STATS = ["goals", "fouls", "tackles", "shots_total"]
DS2_FEATURES = ["odds_ratio", "avg_pressure_index_1st_half", "ht_goals_diff", "ht_fouls_diff",
                "ht_tackles_diff", "ht_shots_total_diff"]


def with_timeline(df: DataFrame, timeline: DataFrame) -> DataFrame:
    """Keep rows whose fixture has timeline rows (a semi join, not an
    id list shipped through the driver)."""
    # distinct first: duplicates of a hot fixture are combined map-side
    return df.join(timeline.select("fixture_id").distinct(), "fixture_id", "left_semi")


def ft_scores(schedules: DataFrame, statuses: Sequence[str] = tuple(S.FINISHED_STATS)) -> DataFrame:
    """Full-time scores of finished fixtures, integer, not NULL."""
    return (schedules.filter(F.col("status").isin(*statuses))
            .select("fixture_id", "home_team_id", "away_team_id",
                    F.col("home_score").try_cast("int").alias("ft_home_score"),
                    F.col("away_score").try_cast("int").alias("ft_away_score"))
            .dropna(subset=["ft_home_score", "ft_away_score"]))


def ht_team_rows(stats: DataFrame, cols: Sequence[str] = tuple(DS2_STATS),
                 period: str = S.FIRST_HALF) -> DataFrame:
    """D16 input: (fixture, team) rows of ``period`` with NULL -> 0."""
    return stats.filter(F.col("period") == period).select(
        "fixture_id", "team_id",
        *[F.coalesce(F.col(c).try_cast("int"), F.lit(0)).alias(c) for c in cols])


def ht_team_totals(stats: DataFrame, cols: Sequence[str] = tuple(DS2_STATS),
                   period: str = S.FIRST_HALF) -> DataFrame:
    """Per (fixture, team) totals of ``period`` statistics, NULL -> 0."""
    return (ht_team_rows(stats, cols, period).groupBy("fixture_id", "team_id")
            .agg(*[F.sum(c).alias(c) for c in cols]))


def avg_pressure(timeline: DataFrame, max_minute: int = 45,
                 name: str = "avg_pressure_index_1st_half") -> DataFrame:
    """Mean pressure per fixture up to ``max_minute`` (all teams and
    event types; NULL pressure ignored)."""
    return (timeline.filter(F.col("minute") <= max_minute).groupBy("fixture_id")
            .agg(F.avg("pressure_index").alias(name)))


def favourite_two_way(df: DataFrame, home="Home", away="Away") -> DataFrame:
    """Lower of home/away price; equal or missing prices -> 'Draw'."""
    h, a = F.col(home), F.col(away)
    fav = (F.when(h.isNull() | a.isNull(), "Draw").when(h == a, "Draw")
           .when(h < a, "Home").otherwise("Away"))
    return df.withColumn("favorite", fav)


def odds_ratio(df: DataFrame, home="Home", away="Away") -> DataFrame:
    """favourite/other price; NULL unless both prices > 0; 1.0 for a tie."""
    h, a = F.col(home), F.col(away)
    ok = h.isNotNull() & a.isNotNull() & (h > 0) & (a > 0)
    r = (F.when(~ok, F.lit(None)).when(F.col("favorite") == "Home", F.try_divide(h, a))
         .when(F.col("favorite") == "Away", F.try_divide(a, h)).otherwise(F.lit(1.0)))
    return df.withColumn("odds_ratio", r.cast("double"))


def two_way_target(df: DataFrame) -> DataFrame:
    """1 if the favourite's second-half margin exceeds 0.5, else 0;
    NULL for 'Draw' favourites or missing scores."""
    sh_h = F.col("ft_home_score") - F.col("ht_home_goals")
    sh_a = F.col("ft_away_score") - F.col("ht_away_goals")
    fav = F.col("favorite")
    t = (F.when(fav.isNull() | (fav == "Draw"), F.lit(None))
         .when(fav == "Home", F.when(sh_h - sh_a > 0.5, 1).otherwise(0))
         .when(fav == "Away", F.when(sh_a - sh_h > 0.5, 1).otherwise(0)))
    return df.withColumn("target", t.cast("int"))


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``cols``."""
    return df.filter(all_not_null(cols))


def dataset_two(schedules: DataFrame, stats: DataFrame, odds: DataFrame,
                timeline: DataFrame) -> DataFrame:
    """Odds ratio, first-half mean pressure and home-minus-away
    first-half differences; target = favourite wins the second half."""
    pressure = avg_pressure(timeline)  # D18 (implies D13 for every input below)
    prices = pivot_odds(odds, rule="mean", names=["Home", "Draw", "Away"])  # D14
    prices = prices.dropna(subset=["Home", "Away"])
    scores = ft_scores(schedules)  # D15
    sided = attach_sides(scores, ht_team_rows(stats), DS2_STATS, "ht_home_", "ht_away_",
                         how="sum", fill=0)  # D16 + D17
    df = prices.join(pressure, "fixture_id").join(sided, "fixture_id")  # D19
    df = odds_ratio(favourite_two_way(df))  # D20, D21
    df = diffs(df, DS2_STATS, orient="home", out_fmt="ht_{}_diff")  # D22
    df = complete_cases(two_way_target(df), ["target", *DS2_FEATURES])  # D23, D24
    return df.select("fixture_id", *[F.col(c).cast("double").alias(c) for c in DS2_FEATURES],
                     "target")


def fixture_with_stats(schedules: DataFrame, stats: DataFrame, cols: Sequence[str],
                       period: str = S.SECOND_HALF) -> DataFrame:
    """Every fixture with its home and away ``period`` statistics
    (NULL where a side has none)."""
    fx = schedules.select("fixture_id", "home_team_id", "away_team_id", "start_time", "status")
    rows = stats.filter(F.col("period") == period).select("fixture_id", "team_id", *cols)
    return attach_sides(fx, rows, cols, "home_", "away_")
