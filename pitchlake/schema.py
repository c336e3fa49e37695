"""Curated-table schemas and the fixed lookup values of the data model.

Everything under "FIXED VALUES" must equal the provider's codes and the
curated column names for results to line up; they are data, not logic.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (provider codes, curated column names, category labels)
# ---------------------------------------------------------------------------

# Provider state id -> status code.  Unknown ids map to UNKNOWN_STATUS.
STATE_ID_TO_STATUS = {
    1: "NS", 2: "LIVE", 3: "HT", 4: "ET", 5: "FT", 6: "FT_PEN", 7: "POST",
    8: "CANC", 9: "ABD", 10: "AWD", 11: "INT", 17: "TBA", 18: "DEL",
}
UNKNOWN_STATUS = "UNKNOWN"

# Score descriptions, most preferred first, when resolving the final score.
SCORE_PREFERENCE = ["CURRENT", "PENALTIES", "AET", "2ND_HALF", "1ST_HALF"]

# Statuses for which the winner flags may stand in for missing scores.
RESULT_FALLBACK_STATUSES = ["FT", "AET", "FT_PEN", "AWD"]

# Provider statistic code -> curated column.
STAT_CODE_TO_COLUMN = {
    "shots-insidebox": "shots_insidebox",
    "shots-on-target": "shots_on_target",
    "shots-blocked": "shots_blocked",
    "shots-total": "shots_total",
    "successful-dribbles": "successful_dribbles",
    "goals": "goals",
    "successful-dribbles-percentage": "successful_dribbles_percentage",
    "successful-passes": "successful_passes",
    "successful-passes-percentage": "successful_passes_percentage",
    "ball-possession": "ball_possession",
    "redcards": "red_cards",
    "tackles": "tackles",
    "substitutions": "substitutions",
    "interceptions": "interceptions",
    "shots-outsidebox": "shots_outsidebox",
    "dribble-attempts": "dribble_attempts",
    "yellowcards": "yellow_cards",
    "throwins": "throwins",
    "assists": "assists",
    "accurate-crosses": "accurate_crosses",
    "corners": "corners",
    "saves": "saves",
    "fouls": "fouls",
    "total-crosses": "total_crosses",
    "hit-woodwork": "hit_woodwork",
    "long-passes": "long_passes",
    "penalties": "penalties",
    "passes": "passes",
    "shots-off-target": "shots_off_target",
    "attacks": "attacks",
    "key-passes": "key_passes",
    "offsides": "offsides",
    "challenges": "challenges",
    "goals-kicks": "goal_kicks",
    "dangerous-attacks": "dangerous_attacks",
}

# Curated statistic columns stored as floating point (percentages);
# every other statistic column is an integer count.
FLOAT_STATS = ["successful_dribbles_percentage", "successful_passes_percentage", "ball_possession"]

# Half-time statistics the feature datasets and quality audits require.
REQUIRED_HT_STATS = [
    "goals", "fouls", "red_cards", "tackles", "shots_blocked",
    "successful_passes_percentage", "ball_possession", "saves",
    "attacks", "shots_total", "shots_insidebox",
]

# Odds kept at ingest.
ALLOWED_MARKETS = [1, 269, 6]
ALLOWED_BOOKMAKERS = [20, 29]
MATCH_WINNER_MARKET = 1
DEFAULT_BOOKMAKER = 20
ONE_X_TWO = ["Home", "Draw", "Away"]

# Finished-status sets used by the different jobs.
FINISHED_STATS = ["FT"]
FINISHED_ODDS = ["FT", "FT_PEN", "AET", "AWD", "ABD", "CANC"]
FINISHED_PRESSURE = ["FT", "AET", "FT_PEN"]

# Period labels.
FIRST_HALF, SECOND_HALF = "first_half", "second_half"

# Boolean words accepted by coercion.
TRUE_WORDS = ["true", "1", "yes", "t"]
FALSE_WORDS = ["false", "0", "no", "f"]

# Fixture quality categories, in rule order.
Q_CRIT_TEAM = "CRITICAL: Missing team data"
Q_CRIT_NULL = "CRITICAL: All stats NULL"
Q_POOR = "POOR: <50% stats available"
Q_FAIR = "FAIR: 50-79% stats available"
Q_GOOD = "GOOD: 80-99% stats available"
Q_EXCELLENT = "EXCELLENT: All stats available"

# League badges (>= 90, >= 80, >= 50, else).
BADGES = ["EXCELLENT", "GOOD", "FAIR", "POOR"]

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------

STAT_COLUMNS = list(STAT_CODE_TO_COLUMN.values())


def stat_type(col: str) -> T.DataType:
    return T.DoubleType() if col in FLOAT_STATS else T.IntegerType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


L, I, S, D, B = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType()
TS_NTZ, TS = T.TimestampNTZType(), T.TimestampType()

AUDIT = [_f("created_at", TS), _f("updated_at", TS)]

LEAGUES = T.StructType([
    _f("league_id", L, False), _f("sport_id", L), _f("country_id", L), _f("name", S, False),
    _f("active", B), _f("short_code", S), _f("image_path", S), _f("type", S), _f("sub_type", S),
    _f("last_played_at", S), _f("category", I), _f("current_season_id", L)])

SEASONS = T.StructType([
    _f("season_id", L, False), _f("league_id", L, False), _f("league_name", S), _f("sport_id", L),
    _f("name", S, False), _f("is_current", B), _f("finished", B), _f("pending", B),
    _f("starting_at", S), _f("ending_at", S), _f("standings_recalculated_at", S)])

TEAMS = T.StructType([
    _f("team_id", L, False), _f("name", S, False), _f("short_code", S), _f("country_id", L),
    _f("logo_url", S), _f("venue_id", L), _f("founded", I), _f("type", S), _f("national_team", B)])

SCHEDULES = T.StructType([
    _f("fixture_id", L, False), _f("season_id", L, False), _f("league_id", L), _f("round_id", L),
    _f("home_team_id", L, False), _f("away_team_id", L, False), _f("start_time", TS_NTZ, False),
    _f("status", S), _f("home_score", I), _f("away_score", I), _f("result", S),
    _f("result_info", S), _f("round_finished", B)])

FIXTURE_STATS = T.StructType(
    [_f("fixture_id", L, False), _f("team_id", L, False), _f("period", S, False)]
    + [_f(c, stat_type(c)) for c in STAT_COLUMNS] + [_f("timestamp", TS_NTZ)])

FIXTURE_ODDS = T.StructType([
    _f("fixture_id", L, False), _f("market_id", I, False), _f("bookmaker_id", I, False),
    _f("label", S, False), _f("value", D), _f("name", S), _f("market_description", S),
    _f("probability", D), _f("dp3", S), _f("fractional", S), _f("american", S),
    _f("winning", B), _f("stopped", B), _f("total", D), _f("handicap", D),
    _f("participants", S), _f("api_created_at", S), _f("original_label", S),
    _f("latest_bookmaker_update", S)])

FIXTURE_TIMELINE = T.StructType([
    _f("fixture_id", L, False), _f("minute", I, False), _f("participant_id", L),
    _f("event_type", S), _f("pressure_index", D), _f("api_event_id", L), _f("timestamp", TS)])

TABLES = {
    "leagues": LEAGUES, "seasons": SEASONS, "teams": TEAMS, "schedules": SCHEDULES,
    "fixture_stats": FIXTURE_STATS, "fixture_odds": FIXTURE_ODDS,
    "fixture_timeline": FIXTURE_TIMELINE,
}

# Natural keys (uniqueness) per curated table.
KEYS = {
    "leagues": ["league_id"],
    "seasons": ["season_id"],
    "teams": ["team_id"],
    "schedules": ["fixture_id"],
    "fixture_stats": ["fixture_id", "team_id", "period"],
    "fixture_odds": ["fixture_id", "market_id", "bookmaker_id", "label", "handicap", "total"],
    "fixture_timeline": ["fixture_id", "minute", "participant_id", "event_type"],
}
