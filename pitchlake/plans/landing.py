"""Landed JSON documents derived from the test-bed tables.

Each document is built from ONE table row with column expressions
(``to_json(struct(...))``, or the same text put together member by member
where values are numbers or strings) — no grouping — so document building
scales like a projection.  Documents mimic the provider payloads the ingest jobs
accept, including the awkward parts: stat values as JSON numbers *or*
strings (``"12"``, ``"45%"``), flags as 0/1, NULL values, ids of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake import schema as S
from pitchlake.sources.tables import Testbed

TS_FMT = "yyyy-MM-dd HH:mm:ss"
# statistics carried by the test bed, with how each is encoded in JSON
STAT_ENCODING = {"goals": "number", "fouls": "text", "red_cards": "number", "tackles": "number",
                 "shots_blocked": "number", "successful_passes_percentage": "number", "ball_possession": "percent",
                 "saves": "number", "attacks": "number", "shots_total": "number", "shots_insidebox": "number",
                 "shots_on_target": "number", "shots_off_target": "number", "passes": "text", "corners": "number",
                 "yellow_cards": "number", "challenges": "number"}
COLUMN_TO_CODE = {v: k for k, v in S.STAT_CODE_TO_COLUMN.items()}
STATUS_TO_STATE = {v: k for k, v in S.STATE_ID_TO_STATUS.items()}
PERIOD_TEXT = {"first_half": "1st-half", "second_half": "2nd-half", "extra_time": "Extra-Time",
               "penalties": "Penalties"}


def _number(df: DataFrame, c: str) -> Column:
    """JSON text of a number as VARIANT writes it; integers need no VARIANT for that."""
    text = F.col(c).cast("string")
    return text if isinstance(df.schema[c].dataType, T.IntegralType) else F.to_json(F.parse_json(text))


def _quoted(*parts: Column) -> Column:
    """JSON text of a string that needs no escapes."""
    return F.concat(F.lit('"'), *parts, F.lit('"'))


def _object(**members: Column) -> Column:
    """JSON text of an object; members whose text is NULL are left out, as ``to_json`` does."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in members.items()]), F.lit("}"))


def _array(items: list[Column]) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def stats_documents(t: Testbed, spoiled: bool = False, gaps: bool = False) -> DataFrame:
    """Statistics documents; ``spoiled``: some values are no numbers;
    ``gaps``: some periods have no description, some no statistics."""
    r = t.stats_raw

    def item(c, how):
        """JSON text of one statistic, without what all of them begin and end with."""
        text, before, after = F.col(c).cast("string"), '"value":', ""
        if how == "number":
            text = _number(r, c)
        else:
            before, after = before + '"', ("%" if how == "percent" else "") + '"'
        head = f'"type":{{"code":"{COLUMN_TO_CODE[c]}"}},"data":{{'
        v = F.coalesce(F.concat(F.lit(head + before), text, *[F.lit(after)] * bool(after)), F.lit(head))
        if not spoiled or c not in ("fouls", "ball_possession"):
            return v
        return F.when(F.col(c).isNotNull() & (F.col("src_a") % 97 == 5), head + '"value":"n/a"').otherwise(v)
    period, fixture = F.col("period"), F.col("fixture_id").cast("string")
    desc = F.create_map(*[x for k, v in PERIOD_TEXT.items() for x in (F.lit(k), F.lit(v))])[period]
    pid = F.col("fixture_id") * 10 + F.when(period == "first_half", 1).when(period == "second_half", 2) \
        .when(period == "extra_time", 3).otherwise(4)
    team = F.coalesce(F.concat(F.lit('"participant_id":'), F.col("team_id").cast("string"), F.lit(",")), F.lit(""))
    # what the statistics share is part of the separator: written out for each of
    # them, Spark's code for it is above 8,000 bytes, which the JVM only interprets
    first = F.concat(F.lit("{"), F.col("_team"))
    listed = F.concat(F.lit("["), first, F.call_function("concat_ws", F.concat(F.lit("}},"), first),
                                                         *[item(c, how) for c, how in STAT_ENCODING.items()]), F.lit("}}]"))
    if gaps:
        desc = F.when(F.col("src_a") % 89 == 3, "").otherwise(desc)
        listed = F.when(F.col("src_a") % 83 == 7, "[]").otherwise(listed)
    entry = _object(id=pid.cast("string"), description=_quoted(desc), statistics=listed)
    doc = _object(fetch_timestamp=_quoted(F.date_format("api_ts", TS_FMT)), fixture_id=fixture,
                  fixture_data_with_stats=_object(data=_object(id=fixture, periods=_array([entry]))))
    return r.withColumn("_team", team).select(doc.alias("doc"))


def schedule_documents(t: Testbed, spoiled: bool = False) -> DataFrame:
    """Schedule documents; ``spoiled``: some kick-offs are unreadable."""
    s = t.schedules
    st = F.col("status")
    state = F.create_map(*[x for k, v in STATUS_TO_STATE.items() for x in (F.lit(k), F.lit(v))])[st]
    played = st.isin("FT", "FT_PEN")
    def score(desc, pid, goals):
        return F.struct(F.lit(desc).alias("description"), pid.alias("participant_id"),
                        F.struct(goals.cast("int").alias("goals")).alias("score"))
    half = [score("1ST_HALF", F.col("home_team_id"), F.lit(0)), score("1ST_HALF", F.col("away_team_id"), F.lit(0))]
    full = half + [score("CURRENT", F.col("home_team_id"), F.col("home_score")),
                   score("CURRENT", F.col("away_team_id"), F.col("away_score"))]
    scores = F.when(played, F.array(*full)).when(st == "NS", F.array().cast("array<struct<description:string,"
                                                                             "participant_id:bigint,score:struct<goals:int>>>")) \
        .otherwise(F.array(*half))
    part = lambda pid, loc, win: F.struct(pid.alias("id"), F.struct(F.lit(loc).alias("location"),
                                                                   win.alias("winner")).alias("meta"))
    fixture = F.struct(F.col("fixture_id").alias("id"), F.col("league_id").cast("long").alias("league_id"),
                       (F.when(F.col("fixture_id") % 50 == 7, "soon") if spoiled else F.when(F.lit(False), ""))
                       .otherwise(F.date_format("start_time", TS_FMT)).alias("starting_at"), state.alias("state_id"),
                       F.array(part(F.col("home_team_id"), "home", F.col("home_score") > F.col("away_score")),
                               part(F.col("away_team_id"), "away", F.col("away_score") > F.col("home_score")))
                       .alias("participants"), scores.alias("scores"))
    rnd = F.struct((F.col("season_id") * 100 + F.month("start_time")).cast("long").alias("id"),
                   F.col("season_id").cast("long").alias("season_id"), (st == "FT").alias("finished"),
                   F.array(fixture).alias("fixtures"))
    doc = F.struct(F.date_format("start_time", TS_FMT).alias("fetch_timestamp"),
                   F.col("season_id").cast("long").alias("season_id"),
                   F.struct(F.array(F.struct(F.lit(1).cast("long").alias("id"), F.array(rnd).alias("rounds"))).alias("data"))
                   .alias("schedule_data"))
    return s.select(F.to_json(doc).alias("doc"))


def odds_documents(t: Testbed, spoiled: bool = False) -> DataFrame:
    """Odds documents; ``spoiled``: some lack their label or their fixture."""
    o = t.odds
    if spoiled:
        o = o.withColumns({"label": F.when(F.col("fixture_id") % 29 != 3, F.col("label")),
                           "fixture_id": F.when(F.col("fixture_id") % 31 != 5, F.col("fixture_id"))})
    ts, label = _quoted(F.date_format("latest_bookmaker_update", TS_FMT)), _quoted(F.col("label"))
    share = F.round(F.lit(100.0) / F.col("value"), 2).cast("string")

    def odd(bookmaker):
        return _object(
            fixture_id=F.col("fixture_id").cast("string"), market_id=F.col("market_id").cast("string"),
            bookmaker_id=bookmaker.cast("string"), label=label, value=F.col("_value"), name=label,
            market_description=F.when(F.col("market_id") == 1, '"Match Winner"').otherwise('"Other"'),
            probability=_quoted(share, F.lit("%")), winning=F.when(F.col("label") == "Home", "1").otherwise("0"),
            stopped=F.lit("false"), created_at=ts, original_label=label, latest_bookmaker_update=ts)
    doc = _object(fetch_timestamp=ts, fixture_id=F.col("fixture_id").cast("string"),
                  prematch_odds_data=_object(data=_array([odd(F.col("bookmaker_id")), odd(F.lit(99))])))
    return o.withColumn("_value", _number(o, "value")).select(doc.alias("doc"))


def pressure_documents(t: Testbed, spoiled: bool = False) -> DataFrame:
    """Pressure documents; ``spoiled``: some minutes are missing, some no
    numbers, and some items lack their pressure or their participant."""
    li = t.raw("lineitem").filter(F.col("l_orderkey") % 4 != 0)
    part = F.col("l_partkey")

    def spoil(json, **cases):
        for what, bad in cases.items() if spoiled else ():
            json = F.when(bad, F.lit({"null": "null", "text": '"late"'}[what])).otherwise(json)
        return json
    fixture = F.col("l_orderkey").cast("string")
    item = _object(id=(F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string"),
                   minute=spoil((F.col("l_quantity").cast("int") * 2).cast("string"), null=part % 37 == 1, text=part % 41 == 2),
                   participant_id=spoil((F.col("l_linenumber") % 2).cast("string"), null=part % 43 == 3),
                   pressure=spoil(F.col("_pressure"), null=part % 37 == 1, text=part % 47 == 4))
    doc = _object(fetch_timestamp=_quoted(F.date_format("l_shipdate", TS_FMT)), fixture_id=fixture,
                  fixture_data_with_pressure=_object(data=_object(id=fixture, pressure=_array([item]))))
    thousands = li.withColumn("_pressure", F.col("l_extendedprice") / 1000)
    return thousands.withColumn("_pressure", _number(thousands, "_pressure")).select(doc.alias("doc"))


def league_documents(t: Testbed) -> DataFrame:
    latest = t.raw("orders").select(F.max(F.year("o_orderdate"))).scalar()
    n = t.raw("nation")
    season = F.struct((F.col("n_nationkey").cast("long") * 10000 + latest).alias("id"),
                      F.col("n_nationkey").cast("long").alias("league_id"), F.lit(1).cast("long").alias("sport_id"),
                      latest.cast("string").alias("name"), F.lit(True).alias("is_current"),
                      F.lit(False).alias("finished"), F.lit(False).alias("pending"))
    doc = F.struct(F.col("n_nationkey").cast("long").alias("id"), F.lit(1).cast("long").alias("sport_id"),
                   F.col("n_regionkey").cast("long").alias("country_id"), F.col("n_name").alias("name"),
                   F.lit(True).alias("active"), F.substring("n_name", 1, 3).alias("short_code"),
                   F.lit("league").alias("type"), F.lit("domestic").alias("sub_type"),
                   F.lit(1).alias("category"), season.alias("currentseason"))
    return n.select(F.to_json(doc).alias("doc"))


def team_documents(t: Testbed) -> DataFrame:
    c = t.raw("customer")
    doc = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                   F.col("c_nationkey").cast("long").alias("country_id"),
                   F.concat(F.lit("teams/"), F.col("c_custkey").cast("string"), F.lit(".png")).alias("image_path"),
                   F.lit("domestic").alias("type"),
                   F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(True)).alias("national_team"))
    return c.select(F.to_json(doc).alias("doc"))
