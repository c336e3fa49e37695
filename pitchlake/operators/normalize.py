"""Normalisation jobs (B1–B14): nested landed JSON -> curated rows.

Each job is a set of column expressions over the whole landed dataset:
``inline``/``explode`` for the nesting, higher-order functions
(``filter``/``get``) for searches inside arrays, one aggregation for the
code -> column pivot.  Rows failing a required-field rule are not dropped
silently: ``split_valid`` returns them with a reason.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake import schema as S
from pitchlake.functions.exprs import coerce, coerce_variant, first_by, map_period, map_status


# ---------------------------------------------------------------- B14
def truthy(c: Column) -> Column:
    """Python truthiness of a scalar cell: not NULL, not 0, not ''."""
    return F.coalesce(c.isNotNull() & (c.cast("string") != "0") & (c.cast("string") != "")
                      & (c.cast("string") != "false"), F.lit(False))


def split_valid(df: DataFrame, required: Sequence[str], rule: str = "truthy") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows + ``reject_reason``).

    ``rule='truthy'`` rejects NULL, 0 and '' (the original ``not value``
    test); ``rule='not_null'`` only NULL (0 is a valid minute/pressure)."""
    checks = [(c, truthy(F.col(c)) if rule == "truthy" else F.col(c).isNotNull()) for c in required]
    reason = F.concat_ws(",", *[F.when(~ok, F.lit(f"missing:{c}")) for c, ok in checks])
    ok_all = reduce(lambda a, b: a & b, [ok for _, ok in checks])
    return df.filter(ok_all), df.filter(~ok_all).withColumn("reject_reason", reason)


# ------------------------------------------------------------- B1–B3
def normalize_leagues(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B1: league rows; ``currentseason.id`` lifted to ``current_season_id``."""
    df = raw.select(F.col("id").alias("league_id"), "sport_id", "country_id", "name", "active", "short_code",
                    "image_path", "type", "sub_type", "last_played_at", "category",
                    F.col("currentseason.id").alias("current_season_id"))
    return split_valid(df, ["league_id", "name"])


def normalize_seasons(raw_leagues: DataFrame, order: Sequence[str] = ("league_id",)) -> tuple[DataFrame, DataFrame]:
    """B2: the nested current season of each league, one row per season
    (first by ``order`` wins).  ``league_name`` is filled from the parent
    league (left NULL by the original loader)."""
    df = raw_leagues.filter(F.col("currentseason").isNotNull()).select(
        F.col("currentseason.id").alias("season_id"), F.col("currentseason.league_id").alias("league_id"),
        F.col("name").alias("league_name"), F.col("currentseason.sport_id").alias("sport_id"),
        F.col("currentseason.name").alias("name"), F.col("currentseason.is_current").alias("is_current"),
        F.col("currentseason.finished").alias("finished"), F.col("currentseason.pending").alias("pending"),
        F.col("currentseason.starting_at").alias("starting_at"), F.col("currentseason.ending_at").alias("ending_at"),
        F.col("currentseason.standings_recalculated_at").alias("standings_recalculated_at"))
    ok, bad = split_valid(df, ["season_id", "league_id", "name"])
    cols = ok.columns
    return first_by(ok, ["season_id"], list(order)).select(*cols), bad


def normalize_teams(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Team rows; ``image_path`` -> ``logo_url``; national_team defaults false."""
    df = raw.select(F.col("id").alias("team_id"), "name", "short_code", "country_id",
                    F.col("image_path").alias("logo_url"), "venue_id", "founded", "type",
                    F.coalesce(F.col("national_team"), F.lit(False)).alias("national_team"))
    return split_valid(df, ["team_id", "name"])


# ------------------------------------------------------------ B4–B8
def home_away(participants: Column) -> tuple[Column, Column, Column, Column, Column]:
    """(ok, home_id, away_id, home_winner, away_winner) from
    ``participants[].meta.location``; needs exactly two participants, and
    the last entry per side wins, as in the original loop."""
    def side(loc):
        hits = F.filter(participants, lambda p: (p["meta"]["location"] == loc) & truthy(p["id"]))
        last = F.get(hits, F.size(hits) - 1)
        return last["id"], last["meta"]["winner"]
    h_id, h_win = side("home")
    a_id, a_win = side("away")
    ok = F.coalesce((F.size(participants) == 2) & truthy(h_id) & truthy(a_id), F.lit(False))
    return ok, h_id, a_id, h_win, a_win


def resolve_scores(scores: Column, home_id: Column, away_id: Column,
                   preference: Sequence[str] = tuple(S.SCORE_PREFERENCE)) -> tuple[Column, Column]:
    """Per side, the first non-NULL goals by description preference,
    then array order; both sides or neither."""
    def matcher(desc, pid):
        # one-argument lambda: a second parameter would be bound to the array index
        return lambda s: ((s["description"] == F.lit(desc)) & (s["participant_id"] == pid)
                          & s["score"]["goals"].isNotNull())

    def first_goal(pid):
        parts = [F.filter(scores, matcher(d, pid)) for d in preference]
        return F.get(F.concat(*parts), 0)["score"]["goals"]
    h, a = first_goal(home_id), first_goal(away_id)
    both = h.isNotNull() & a.isNotNull()
    return F.when(both, h), F.when(both, a)


def derive_result(home: Column, away: Column, status: Column, home_win: Column, away_win: Column) -> Column:
    """H/D/A from scores; without scores, from winner flags for
    finished statuses."""
    by_flags = (F.when(home_win.eqNullSafe(F.lit(True)) & away_win.eqNullSafe(F.lit(False)), "H")
                .when(away_win.eqNullSafe(F.lit(True)) & home_win.eqNullSafe(F.lit(False)), "A")
                .when(home_win.eqNullSafe(F.lit(False)) & away_win.eqNullSafe(F.lit(False)), "D"))
    return (F.when(home.isNotNull() & away.isNotNull(),
                   F.when(home > away, "H").when(away > home, "A").otherwise("D"))
            .when(status.isin(*S.RESULT_FALLBACK_STATUSES), by_flags))


def normalize_schedules(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stage -> round -> fixture flatten; round fields pushed down
    to each fixture; status, sides, final score and result derived."""
    st = raw.select("fetch_timestamp", F.explode("schedule_data.data").alias("stage"))
    rd = st.select("fetch_timestamp", F.explode("stage.rounds").alias("r"))
    fx = rd.select("fetch_timestamp", F.col("r.id").alias("round_id"), F.col("r.season_id").alias("season_id"),
                   F.coalesce(F.col("r.finished"), F.lit(False)).alias("round_finished"),
                   F.explode("r.fixtures").alias("f"))
    # each array search runs once per fixture and later steps refer to its
    # result column; from a generator, as the final checks would be pushed
    # through a projection, and its searches repeated for every mention
    ok, h_id, a_id, h_win, a_win = home_away(F.col("f.participants"))
    found = F.struct(ok.alias("_ok"), h_id.alias("_h"), a_id.alias("_a"), h_win.alias("_hw"), a_win.alias("_aw"))
    sides = fx.select("fetch_timestamp", "round_id", "season_id", "round_finished", "f", F.inline(F.array(found)),
                      map_status(F.col("f.state_id")).alias("status"))
    hs, as_ = resolve_scores(F.col("f.scores"), F.col("_h"), F.col("_a"))
    scored = sides.select("*", F.when(F.col("_ok"), hs).alias("home_score"), F.when(F.col("_ok"), as_).alias("away_score"))
    df = scored.select(
        F.col("f.id").alias("fixture_id"), "season_id", F.col("f.league_id").alias("league_id"), "round_id",
        F.when(F.col("_ok"), F.col("_h")).alias("home_team_id"), F.when(F.col("_ok"), F.col("_a")).alias("away_team_id"),
        F.try_to_timestamp(F.col("f.starting_at"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("start_time"),
        "status", "home_score", "away_score",
        derive_result(F.col("home_score"), F.col("away_score"), F.col("status"), F.col("_hw"), F.col("_aw")).alias("result"),
        F.col("f.result_info").alias("result_info"), "round_finished", "fetch_timestamp")
    # fixtures of a round without ids, and without a readable kick-off, are
    # rejected with the reason, not dropped
    return split_valid(df, ["fixture_id", "round_id", "season_id", "home_team_id", "away_team_id", "start_time"])


# ---------------------------------------------------------- B9–B11
def normalize_stats(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per (document, fixture, period, team) with the 35
    statistic columns.

    Periods without an id or with an empty description are rejected.
    Statistic items need a type, a data object and a participant; items
    with an unknown code or NULL value still create the team's row (so a
    team with only unusable statistics yields an all-NULL row).  When a
    code repeats, the last value wins.  Values are coerced per column type
    from VARIANT (B11)."""
    # each document (and each period entry inside it) yields its own rows;
    # the document id is a content hash unless the reader supplied one
    doc_id = F.col("_doc_id") if "_doc_id" in raw.columns else F.xxhash64(
        F.to_json(F.struct("fetch_timestamp", "fixture_data_with_stats")))
    docs = raw.select(doc_id.alias("_doc"), "fetch_timestamp",
                      F.col("fixture_data_with_stats.data.id").alias("fixture_id"),
                      F.posexplode("fixture_data_with_stats.data.periods").alias("_ppos", "p"))
    docs = docs.filter(truthy(F.col("fixture_id")))
    per = docs.select("_doc", "_ppos", "fetch_timestamp", "fixture_id", F.col("p.id").alias("period_id"),
                      map_period(F.col("p.description")).alias("period"), F.col("p.statistics").alias("st"))
    good_p, bad_p = split_valid(per, ["period_id", "period"])
    items = good_p.select("_doc", "_ppos", "fetch_timestamp", "fixture_id", "period",
                          F.posexplode("st").alias("pos", "s"))
    items = items.filter(F.col("s.type").isNotNull() & F.col("s.data").isNotNull()
                         & truthy(F.col("s.participant_id")))
    items = items.select("_doc", "_ppos", "fetch_timestamp", "fixture_id", "period", "pos",
                         F.col("s.participant_id").alias("team_id"), F.col("s.type.code").alias("code"),
                         F.col("s.data.value").alias("v"))
    # coerce each item once (as int and as double); the pivot below only
    # picks the already-coerced value
    usable = F.col("code").isNotNull() & F.col("v").isNotNull() & ~F.is_variant_null(F.col("v"))
    is_float = F.col("code").isin(*[k for k, v in S.STAT_CODE_TO_COLUMN.items() if v in S.FLOAT_STATS])
    # the column of a code is looked up once per item, as a number
    number = F.create_map(*[F.lit(x) for i, code in enumerate(S.STAT_CODE_TO_COLUMN) for x in (code, i)])
    items = items.select("_doc", "_ppos", "fetch_timestamp", "fixture_id", "period", "team_id",
                         F.when(usable, F.try_element_at(number, F.col("code"))).alias("number"), "pos",
                         F.when(~is_float, coerce_variant(F.col("v"), "int")).alias("iv"),
                         F.when(is_float, coerce_variant(F.col("v"), "double")).alias("dv"))
    aggs = []
    for i, column in enumerate(S.STAT_CODE_TO_COLUMN.values()):
        hit = F.col("number") == i
        val = F.col("dv") if column in S.FLOAT_STATS else F.col("iv")
        aggs.append(F.max_by(F.when(hit, val), F.when(hit, F.col("pos"))).alias(column))
    rows = items.groupBy("_doc", "_ppos", "fetch_timestamp", "fixture_id", "period", "team_id").agg(*aggs)
    # wall-clock fetch time (independent of the session time zone)
    rows = rows.withColumn("timestamp", F.try_to_timestamp("fetch_timestamp").cast("timestamp_ntz")) \
        .drop("_doc", "_ppos")
    return rows, bad_p.drop("st", "_doc", "_ppos")


def coercion_failures(raw: DataFrame) -> DataFrame:
    """B11 report: per statistic column, values present but not coercible."""
    items = raw.select(F.explode("fixture_data_with_stats.data.periods").alias("p")).select(
        F.explode("p.statistics").alias("s")).select(F.col("s.type.code").alias("code"), F.col("s.data.value").alias("v"))
    col_of = F.create_map(*[x for k, v in S.STAT_CODE_TO_COLUMN.items() for x in (F.lit(k), F.lit(v))])
    items = items.withColumn("column", F.try_element_at(col_of, F.col("code"))).filter(
        F.col("column").isNotNull() & F.col("v").isNotNull() & ~F.is_variant_null("v"))
    dbl = F.col("column").isin(*S.FLOAT_STATS)
    failed = F.when(dbl, coerce_variant(F.col("v"), "double").isNull()).otherwise(
        coerce_variant(F.col("v"), "int").isNull())
    return items.groupBy("column").agg(F.count(F.lit(1)).alias("values"),
                                       F.sum(failed.cast("int")).cast("long").alias("failed"))


def empty_documents(raw: DataFrame) -> DataFrame:
    """Statistics documents without a single statistic in any period."""
    full = F.filter("fixture_data_with_stats.data.periods", lambda p: F.size(p["statistics"]) > 0)
    return raw.filter(F.coalesce(F.size(full), F.lit(0)) <= 0)


# ---------------------------------------------------------------- B12
def normalize_odds(raw: DataFrame, markets: Sequence[int] = tuple(S.ALLOWED_MARKETS),
                   bookmakers: Sequence[int] = tuple(S.ALLOWED_BOOKMAKERS)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pre-match odds kept for the allowed markets x bookmakers.

    Returns (rows, rejected rows, filtered-out rows).  Prices and
    probabilities accept numbers or text (``'54.64%'``); flags accept
    booleans, 0/1 or words."""
    o = raw.select("fetch_timestamp", F.explode("prematch_odds_data.data").alias("o")).select("fetch_timestamp", "o.*")
    allowed = F.col("market_id").isin(*markets) & F.col("bookmaker_id").isin(*bookmakers)
    filtered = o.filter(~F.coalesce(allowed, F.lit(False)))
    o = o.filter(allowed)
    df = o.select("fixture_id", F.col("market_id").cast("int").alias("market_id"),
                  F.col("bookmaker_id").cast("int").alias("bookmaker_id"), "label",
                  coerce_variant(F.col("value"), "double").alias("value"), "name", "market_description",
                  coerce_variant(F.col("probability"), "double").alias("probability"), "dp3", "fractional", "american",
                  coerce_variant(F.col("winning"), "boolean").alias("winning"),
                  coerce_variant(F.col("stopped"), "boolean").alias("stopped"),
                  coerce_variant(F.col("total"), "double").alias("total"),
                  coerce_variant(F.col("handicap"), "double").alias("handicap"), "participants",
                  F.col("created_at").alias("api_created_at"), "original_label", "latest_bookmaker_update",
                  "fetch_timestamp")
    ok, bad = split_valid(df, ["fixture_id", "market_id", "bookmaker_id", "label"])
    return ok, bad, filtered


# ---------------------------------------------------------------- B13
def normalize_pressure(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Minute-by-minute pressure rows (``event_type='pressure'``).
    Minute and pressure may be 0.  A rejected row names every cause:
    ``missing:`` a NULL field, or ``unreadable:`` a value that does not
    coerce to the column's type."""
    p = raw.select("fetch_timestamp", F.col("fixture_data_with_pressure.data.id").alias("fixture_id"),
                   F.explode("fixture_data_with_pressure.data.pressure").alias("x"))
    present = lambda c: F.col(c).isNotNull() & ~F.is_variant_null(F.col(c))
    p = p.select("fetch_timestamp", "fixture_id", F.col("x.id").alias("id_v"), F.col("x.minute").alias("minute_v"),
                 F.col("x.participant_id").alias("participant_v"), F.col("x.pressure").alias("pressure_v"))
    df = p.select("fetch_timestamp", "fixture_id",
                  coerce_variant(F.col("minute_v"), "int").alias("minute"),
                  coerce_variant(F.col("participant_v"), "long").alias("participant_id"),
                  coerce_variant(F.col("pressure_v"), "double").alias("pressure_index"),
                  F.lit("pressure").alias("event_type"),
                  coerce_variant(F.col("id_v"), "long").alias("api_event_id"),
                  F.lit(None).cast("timestamp").alias("timestamp"),
                  *[present(v).alias(f"_{v}") for v in ("minute_v", "participant_v", "pressure_v")])
    reason = F.concat_ws(",", F.when(~truthy(F.col("fixture_id")), "missing:fixture_id"), *[
        F.when(~F.col(f"_{v}"), f"missing:{c}").when(F.col(c).isNull(), f"unreadable:{c}")
        for v, c in (("minute_v", "minute"), ("participant_v", "participant_id"), ("pressure_v", "pressure_index"))])
    df = df.withColumn("reject_reason", reason).drop("_minute_v", "_participant_v", "_pressure_v")
    return df.filter("reject_reason = ''").drop("reject_reason"), df.filter("reject_reason <> ''")
