"""ANSI-SQL oracles (DuckDB dialect) for the registered queries.

Every oracle starts from the same test-bed CTEs (``FX_SQL``) over the raw
driver tables and states the operator's semantics directly in SQL, the way
the original audit queries are written (joins with fan-out, NOT IN,
EXISTS, window dedupe).  Integer outputs are cast to BIGINT and doubles
whose last bits depend on summation order are rounded to 6 places, as the
Spark side does.
"""

from __future__ import annotations

from pitchlake import schema as S
from pitchlake.sources.tables import with_fx

ORACLE: dict[str, str] = {}

HT11 = list(S.REQUIRED_HT_STATS)
INT_STATS = {"goals", "fouls", "red_cards", "tackles", "shots_blocked", "saves", "attacks", "shots_total",
             "shots_insidebox", "shots_on_target"}


def P(n: str, d: str, digits: int | None = 2) -> str:
    v = f"(cast({n} as double) * 100.0 / nullif(cast({d} as double), 0))"
    return f"round({v}, {digits})" if digits is not None else v


def B(x: str) -> str:
    return f"cast({x} as bigint)"


def stat(alias: str, c: str, out: str) -> str:
    e = f"{alias}.{c}"
    return f"{B(e) if c in INT_STATS else e} as {out}"


def oracle(name: str, body: str):
    ORACLE[name] = with_fx(body)


LATEST_ODDS = """
odds_latest AS (
  select fixture_id, label, value from (
    select fixture_id, label, value, row_number() over (partition by fixture_id, label
      order by latest_bookmaker_update desc nulls last, value desc nulls last) as rn
    from fx_odds where market_id = 1 and bookmaker_id = 20 and label in ('Home','Draw','Away')) t
  where rn = 1)"""

VALID = """
valid AS (select fixture_id from fx_stats where period = 'first_half'
          group by fixture_id having count(distinct team_id) = 2)"""

BASE = f""",{LATEST_ODDS},{VALID},
sched AS (select fixture_id, home_team_id, away_team_id, home_score, away_score from fx_schedules
          where status in ('FT','AET','FT_PEN') and home_score is not null and away_score is not null),
base AS (
  select s.fixture_id, s.home_team_id, s.away_team_id, s.home_score, s.away_score,
    {', '.join(stat('h', c, 'ht_home_' + c) for c in HT11)},
    {', '.join(stat('a', c, 'ht_away_' + c) for c in HT11)},
    oh.value as odds_home, od.value as odds_draw, oa.value as odds_away
  from sched s join valid v on v.fixture_id = s.fixture_id
  left join fx_stats h on h.fixture_id = s.fixture_id and h.team_id = s.home_team_id and h.period = 'first_half'
  left join fx_stats a on a.fixture_id = s.fixture_id and a.team_id = s.away_team_id and a.period = 'first_half'
  left join odds_latest oh on oh.fixture_id = s.fixture_id and oh.label = 'Home'
  left join odds_latest od on od.fixture_id = s.fixture_id and od.label = 'Draw'
  left join odds_latest oa on oa.fixture_id = s.fixture_id and oa.label = 'Away'
  where h.goals is not null and a.goals is not null)"""

REST10 = [s for s in HT11 if s != "goals"]
TARGET = "target_fav_covers_ah_neg0_5_2H"

DS1 = BASE + f""",
f1 AS (
  select *, 1 / odds_home as implied_prob_home, 1 / odds_draw as implied_prob_draw, 1 / odds_away as implied_prob_away,
    case when odds_home <= odds_draw and odds_home <= odds_away then 'home'
         when odds_away < odds_draw and odds_away < odds_home then 'away' end as favorite_location
  from base where odds_home is not null and odds_draw is not null and odds_away is not null),
f2 AS (
  select *, implied_prob_home + implied_prob_draw + implied_prob_away - 1 as prob_margin,
    odds_home / odds_away as odds_ratio_hw,
    case when favorite_location = 'home' then odds_home else odds_away end as odds_fav,
    case when favorite_location = 'home' then odds_away else odds_home end as odds_und,
    home_score - ht_home_goals as sh_home_goals, away_score - ht_away_goals as sh_away_goals
  from f1),
f3 AS (
  select *, case when favorite_location = 'home' then (case when sh_home_goals > sh_away_goals then 1 else 0 end)
                 when favorite_location = 'away' then (case when sh_away_goals > sh_home_goals then 1 else 0 end)
            end as {TARGET}
  from f2 where favorite_location is not null),
ds1 AS (
  select fixture_id,
    {', '.join(f"cast(case when favorite_location = 'home' then coalesce(ht_home_{s}, 0) - coalesce(ht_away_{s}, 0) else coalesce(ht_away_{s}, 0) - coalesce(ht_home_{s}, 0) end as double) as ht_diff_{s}" for s in REST10)},
    cast(case when favorite_location = 'home' then ht_home_goals - ht_away_goals else ht_away_goals - ht_home_goals end as double) as ht_diff_goals,
    odds_home, odds_draw, odds_away, implied_prob_home, implied_prob_draw, implied_prob_away, prob_margin,
    odds_ratio_hw, odds_fav, odds_und, {B(TARGET)} as {TARGET}
  from f3)"""

oracle("d01_valid_fixtures", f",{VALID} select fixture_id from valid")
oracle("d02_base_rows", BASE + " select * from base")
oracle("d12_dataset_one", DS1 + " select * from ds1")
oracle("d09_target_balance", DS1 + f"""
 select count({TARGET}) as valid_targets, {B(f'sum(case when {TARGET} = 1 then 1 else 0 end)')} as covers,
   {B(f'sum(case when {TARGET} = 0 then 1 else 0 end)')} as no_covers from ds1""")
oracle("d10_rows_with_missing_stats", BASE + f"""
 select {B('sum(case when ' + ' or '.join(f'ht_{side}_{s} is null' for s in REST10 for side in ('home', 'away')) + ' then 1 else 0 end)')} as rows_with_missing,
   count(*) as rows
 from base where odds_home is not null and odds_draw is not null and odds_away is not null""")

TL = "timeline_fixtures AS (select distinct fixture_id from fx_timeline)"
oracle("d13_fixtures_with_timeline", f""", {TL}
 select fixture_id, status from fx_schedules where fixture_id in (select fixture_id from timeline_fixtures)""")

PIVOT_MEAN = """
pivot_mean AS (
  select fixture_id, avg(case when label = 'Home' then value end) as "Home",
    avg(case when label = 'Draw' then value end) as "Draw", avg(case when label = 'Away' then value end) as "Away"
  from fx_odds where market_id = 1 and bookmaker_id = 20 and label in ('Home','Draw','Away')
  group by fixture_id having avg(case when label = 'Home' then value end) is not null
     and avg(case when label = 'Away' then value end) is not null)"""
oracle("d14_pivot_odds_mean", f",{PIVOT_MEAN} select * from pivot_mean")

FT_SCORES = """
ft AS (select fixture_id, home_team_id, away_team_id, cast(home_score as bigint) as ft_home_score,
         cast(away_score as bigint) as ft_away_score
       from fx_schedules where status = 'FT' and home_score is not null and away_score is not null)"""
oracle("d15_ft_scores", f",{FT_SCORES} select * from ft")

DS2_STATS = ["goals", "fouls", "tackles", "shots_total"]
HT_TOT = f"""
ht_tot AS (
  select fixture_id, team_id, {', '.join(f'{B(f"sum(coalesce(cast({c} as integer), 0))")} as {c}' for c in DS2_STATS)}
  from fx_stats where period = 'first_half' group by fixture_id, team_id)"""
oracle("d16_ht_team_totals", f",{HT_TOT} select * from ht_tot")

SIDED = f""",{FT_SCORES},{HT_TOT},
sided AS (
  select ft.*, {', '.join(f'coalesce(h.{c}, 0) as ht_home_{c}' for c in DS2_STATS)},
    {', '.join(f'coalesce(a.{c}, 0) as ht_away_{c}' for c in DS2_STATS)}
  from ft left join ht_tot h on h.fixture_id = ft.fixture_id and h.team_id = ft.home_team_id
  left join ht_tot a on a.fixture_id = ft.fixture_id and a.team_id = ft.away_team_id)"""
oracle("d17_attach_sides", SIDED + " select * from sided")

AVG_P = """
avg_p AS (select fixture_id, avg(pressure_index) as avg_pressure_index_1st_half
          from fx_timeline where minute <= 45 group by fixture_id)"""
oracle("d18_avg_pressure", f""",{AVG_P}
 select fixture_id, round(avg_pressure_index_1st_half, 9) as avg_pressure_index_1st_half from avg_p""")

oracle("d24_dataset_two", SIDED + f""",{PIVOT_MEAN},{AVG_P},
m AS (select p."Home" as home_o, p."Away" as away_o, ap.avg_pressure_index_1st_half, sd.*
      from pivot_mean p join avg_p ap on ap.fixture_id = p.fixture_id join sided sd on sd.fixture_id = p.fixture_id),
fav AS (select *, case when home_o is null or away_o is null then 'Draw' when home_o = away_o then 'Draw'
                       when home_o < away_o then 'Home' else 'Away' end as favorite from m),
feat AS (
  select fixture_id,
    cast(case when not (home_o > 0 and away_o > 0) or home_o is null or away_o is null then null
              when favorite = 'Home' then home_o / away_o when favorite = 'Away' then away_o / home_o else 1.0 end as double) as odds_ratio,
    round(avg_pressure_index_1st_half, 9) as avg_pressure_index_1st_half,
    cast(ht_home_goals - ht_away_goals as double) as ht_goals_diff,
    cast(ht_home_fouls - ht_away_fouls as double) as ht_fouls_diff,
    cast(ht_home_tackles - ht_away_tackles as double) as ht_tackles_diff,
    cast(ht_home_shots_total - ht_away_shots_total as double) as ht_shots_total_diff,
    case when favorite = 'Draw' then null
         when favorite = 'Home' then (case when (ft_home_score - ht_home_goals) - (ft_away_score - ht_away_goals) > 0.5 then 1 else 0 end)
         when favorite = 'Away' then (case when (ft_away_score - ht_away_goals) - (ft_home_score - ht_home_goals) > 0.5 then 1 else 0 end)
    end as target
  from fav)
 select fixture_id, odds_ratio, avg_pressure_index_1st_half, ht_goals_diff, ht_fouls_diff, ht_tackles_diff,
   ht_shots_total_diff, cast(target as bigint) as target
 from feat where target is not null and odds_ratio is not null and avg_pressure_index_1st_half is not null""")

oracle("d25_fixture_with_stats", """
 select s.fixture_id, s.home_team_id, s.away_team_id, s.start_time, s.status,
   cast(h.goals as bigint) as home_goals, cast(h.shots_total as bigint) as home_shots_total, h.ball_possession as home_ball_possession,
   cast(a.goals as bigint) as away_goals, cast(a.shots_total as bigint) as away_shots_total, a.ball_possession as away_ball_possession
 from fx_schedules s
 left join fx_stats h on h.fixture_id = s.fixture_id and h.team_id = s.home_team_id and h.period = 'second_half'
 left join fx_stats a on a.fixture_id = s.fixture_id and a.team_id = s.away_team_id and a.period = 'second_half'""")

# ------------------------------------------------------------- work lists
oracle("c01_open_seasons", """
, flags AS (select season_id, season_id = (select max(season_id) from fx_seasons) as is_current,
                   season_id < (select max(season_id) from fx_seasons) as finished from fx_seasons)
 select season_id from flags where finished = false or is_current = true""")
oracle("c02_pending_stats", """
 select fixture_id, start_time, row_number() over (order by fixture_id) as rank from (
 select distinct s.fixture_id, s.start_time from fx_schedules s left join fx_stats fs on s.fixture_id = fs.fixture_id
 where s.status = 'FT' and fs.fixture_id is null) u""")
oracle("c03_pending_odds", """
 select fixture_id, start_time, row_number() over (order by start_time desc, fixture_id) as rank from (
 select distinct s.fixture_id, s.start_time from fx_schedules s
 left join (select fixture_id from fx_odds where fixture_id % 17 <> 5) fo on s.fixture_id = fo.fixture_id
 where s.status in ('FT','FT_PEN','AET','AWD','ABD','CANC') and fo.fixture_id is null) u""")
oracle("c04_pending_pressure", """
 select fixture_id, start_time, row_number() over (order by start_time desc, fixture_id) as rank from (
 select distinct s.fixture_id, s.start_time from fx_schedules s
 left join (select distinct fixture_id from fx_timeline where event_type = 'pressure') pt on s.fixture_id = pt.fixture_id
 where s.status in ('FT','AET','FT_PEN') and pt.fixture_id is null) u""")
oracle("c05_pending_without_done", """
 select fixture_id, start_time, row_number() over (order by start_time desc, fixture_id) as rank
 from fx_schedules where status in ('FT','AET','FT_PEN')""")


# ----------------------------------------------------------------- ingest
oracle("b01_normalize_leagues", """
 select cast(n_nationkey as bigint) as league_id, cast(1 as bigint) as sport_id, cast(n_regionkey as bigint) as country_id,
   n_name as name, true as active, substr(n_name, 1, 3) as short_code, cast(null as varchar) as image_path,
   'league' as type, 'domestic' as sub_type, cast(null as varchar) as last_played_at, cast(1 as bigint) as category,
   cast(n_nationkey as bigint) * 10000 + (select max(year(o_orderdate)) from orders) as current_season_id
 from nation where n_nationkey <> 0 and n_name is not null and n_name <> ''""")
oracle("b01_rejected_leagues", """
 select cast(n_nationkey as bigint) as league_id, n_name as name,
   concat_ws(',', case when n_nationkey = 0 then 'missing:league_id' end,
             case when n_name is null or n_name = '' then 'missing:name' end) as reject_reason
 from nation where n_nationkey = 0 or n_name is null or n_name = ''""")
oracle("b02_normalize_seasons", """
 select cast(n_nationkey as bigint) * 10000 + (select max(year(o_orderdate)) from orders) as season_id,
   cast(n_nationkey as bigint) as league_id, n_name as league_name, cast(1 as bigint) as sport_id,
   cast((select max(year(o_orderdate)) from orders) as varchar) as name, true as is_current, false as finished,
   false as pending, cast(null as varchar) as starting_at, cast(null as varchar) as ending_at,
   cast(null as varchar) as standings_recalculated_at
 from nation where n_nationkey <> 0""")
oracle("b03_normalize_teams", """
 select c_custkey as team_id, c_name as name, cast(null as varchar) as short_code, cast(c_nationkey as bigint) as country_id,
   'teams/' || cast(c_custkey as varchar) || '.png' as logo_url, cast(null as bigint) as venue_id,
   cast(null as bigint) as founded, 'domestic' as type, coalesce(c_mktsegment = 'AUTOMOBILE', false) as national_team
 from customer where c_custkey <> 0 and c_name is not null and c_name <> ''""")

SCHED_NORM = """
sched_norm AS (
  select fixture_id, cast(season_id as bigint) as season_id, cast(league_id as bigint) as league_id,
    cast(season_id * 100 + month(start_time) as bigint) as round_id, home_team_id, away_team_id, start_time, status,
    case when status in ('FT', 'FT_PEN') then cast(home_score as bigint) when status = 'NS' then null else cast(0 as bigint) end as home_score,
    case when status in ('FT', 'FT_PEN') then cast(away_score as bigint) when status = 'NS' then null else cast(0 as bigint) end as away_score,
    cast(null as varchar) as result_info, status = 'FT' as round_finished
  from fx_schedules where fixture_id <> 0 and home_team_id <> 0 and away_team_id <> 0),
sched_res AS (
  select *, case when home_score is null or away_score is null then null when home_score > away_score then 'H'
                 when away_score > home_score then 'A' else 'D' end as result
  from sched_norm)"""
oracle("b04_normalize_schedules", f", {SCHED_NORM} select * from sched_res")
oracle("a06_upsert_schedules", f""", {SCHED_NORM}
 select fixture_id, season_id, league_id, round_id, home_team_id, away_team_id, start_time,
   case when status = 'NS' then 'FT' else status end as status,
   case when status = 'NS' then cast(1 as bigint) else home_score end as home_score,
   case when status = 'NS' then cast(0 as bigint) else away_score end as away_score,
   case when status = 'NS' then 'H' else result end as result, result_info, round_finished
 from sched_res""")

PRESENT = ["goals", "fouls", "red_cards", "tackles", "shots_blocked", "successful_passes_percentage",
           "ball_possession", "saves", "attacks", "shots_total", "shots_insidebox", "shots_on_target", "shots_off_target",
           "passes", "corners", "yellow_cards", "challenges"]
STAT_ORDER = [c for c in S.STAT_COLUMNS if c in PRESENT]


def _stat_out(c: str) -> str:
    if c in PRESENT:
        return (f"cast({c} as double) as {c}" if c in S.FLOAT_STATS else f"cast({c} as bigint) as {c}")
    return f"cast(null as {'double' if c in S.FLOAT_STATS else 'bigint'}) as {c}"


oracle("b10_normalize_load_stats", f"""
, docs AS (select fixture_id, team_id, period, strftime(api_ts, '%Y-%m-%d %H:%M:%S') as fetch_timestamp,
             {', '.join(PRESENT)} from fx_stats_raw where fixture_id <> 0 and team_id <> 0),
ranked AS (select *, row_number() over (partition by fixture_id, team_id, period
             order by fetch_timestamp nulls first, {', '.join(c + ' nulls first' for c in STAT_ORDER)}) as rn from docs)
 select fixture_id, team_id, period, {', '.join(_stat_out(c) for c in S.STAT_COLUMNS)},
   cast(fetch_timestamp as timestamp) as timestamp
 from ranked where rn = 1""")
oracle("b11_coercion_failures", "\n union all\n ".join(
    f"select '{c}' as \"column\", count({c}) as values, "
    + (f"count({c}) filter (src_a % 97 = 5)" if c in ("fouls", "ball_possession") else "count(case when false then 1 end)")
    + " as failed from fx_stats_raw" for c in PRESENT))
oracle("b04_rejected_schedules", """
 select fixture_id, season_id, concat_ws(',', case when fixture_id = 0 then 'missing:fixture_id' end,
   case when home_team_id = 0 then 'missing:home_team_id,missing:away_team_id' end,
   case when fixture_id % 50 = 7 then 'missing:start_time' end) as reject_reason
 from fx_schedules where fixture_id = 0 or home_team_id = 0 or fixture_id % 50 = 7""")
oracle("b12_normalize_load_odds", """
, ranked AS (select *, row_number() over (partition by fixture_id, market_id, bookmaker_id, label
               order by strftime(latest_bookmaker_update, '%Y-%m-%d %H:%M:%S') nulls first, value nulls first) as rn
             from fx_odds where fixture_id <> 0)
 select fixture_id, cast(market_id as bigint) as market_id, cast(bookmaker_id as bigint) as bookmaker_id, label, value,
   label as name, case when market_id = 1 then 'Match Winner' else 'Other' end as market_description,
   round(100.0e0 / value, 2) as probability, cast(null as varchar) as dp3, cast(null as varchar) as fractional,
   cast(null as varchar) as american, label = 'Home' as winning, false as stopped, cast(null as double) as total,
   cast(null as double) as handicap, cast(null as varchar) as participants,
   strftime(latest_bookmaker_update, '%Y-%m-%d %H:%M:%S') as api_created_at, label as original_label,
   strftime(latest_bookmaker_update, '%Y-%m-%d %H:%M:%S') as latest_bookmaker_update
 from ranked where rn = 1""")
oracle("b12_filtered_odds", "select cast(99 as bigint) as bookmaker_id, count(*) as filtered from fx_odds")
oracle("b13_normalize_load_pressure", """
, p AS (select l_orderkey as fixture_id, cast(cast(l_quantity as int) * 2 as bigint) as minute,
          cast(l_linenumber % 2 as bigint) as participant_id, l_extendedprice / 1000 as pressure_index,
          'pressure' as event_type, l_orderkey * 8 + l_linenumber as api_event_id,
          strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as fetch_timestamp
        from lineitem where l_orderkey % 4 <> 0),
ranked AS (select *, row_number() over (partition by fixture_id, minute, participant_id, event_type
             order by fetch_timestamp nulls first, api_event_id nulls first) as rn from p)
 select fixture_id, minute, participant_id, event_type, pressure_index, api_event_id,
   cast(null as timestamp) as timestamp from ranked where rn = 1""")
oracle("a09_load_report_stats", """
 select (select count(*) from fx_stats_raw) as items,
   (select count(*) from (select distinct fixture_id, team_id, period from fx_stats_raw
     where fixture_id <> 0 and team_id <> 0 and src_a % 89 <> 3 and src_a % 83 <> 7) d) as rows_stored,
   (select count(*) from fx_stats_raw where fixture_id <> 0 and src_a % 89 = 3) as rows_rejected,
   (select count(*) from fx_stats_raw where src_a % 83 = 7) as empty_items""")
oracle("b12_rejected_odds", """
, o AS (select case when fixture_id % 31 <> 5 then fixture_id end as fixture_id, cast(market_id as bigint) as market_id,
          cast(bookmaker_id as bigint) as bookmaker_id, case when fixture_id % 29 <> 3 then label end as label, value from fx_odds)
 select *, concat_ws(',', case when coalesce(fixture_id, 0) = 0 then 'missing:fixture_id' end,
   case when label is null then 'missing:label' end) as reject_reason
 from o where coalesce(fixture_id, 0) = 0 or label is null""")
oracle("b13_rejected_pressure", """
, p AS (select l_orderkey as fixture_id, l_orderkey * 8 + l_linenumber as api_event_id,
     l_partkey % 37 = 1 and l_partkey % 41 <> 2 as no_minute, l_partkey % 41 = 2 as odd_minute, l_partkey % 43 = 3 as no_participant,
     l_partkey % 37 = 1 and l_partkey % 47 <> 4 as no_pressure, l_partkey % 47 = 4 as odd_pressure,
     cast(cast(l_quantity as int) * 2 as bigint) as minute, cast(l_linenumber % 2 as bigint) as participant_id,
     l_extendedprice / 1000 as pressure_index from lineitem where l_orderkey % 4 <> 0)
 select fixture_id, api_event_id, case when not (no_minute or odd_minute) then minute end as minute,
   case when not no_participant then participant_id end as participant_id,
   case when not (no_pressure or odd_pressure) then pressure_index end as pressure_index,
   concat_ws(',', case when fixture_id = 0 then 'missing:fixture_id' end,
     case when no_minute then 'missing:minute' when odd_minute then 'unreadable:minute' end,
     case when no_participant then 'missing:participant_id' end,
     case when no_pressure then 'missing:pressure_index' when odd_pressure then 'unreadable:pressure_index' end) as reject_reason
 from p where fixture_id = 0 or no_minute or odd_minute or no_participant or no_pressure or odd_pressure""")


# ------------------------------------------------------------------ model
from pitchlake.operators.features import ds1_feature_names  # noqa: E402

oracle("e01_clean_features_report", DS1 + "\n " + "\n union all\n ".join(
    f"select '{c}' as feature, cast(sum(case when {c} is null or isnan({c}) or isinf({c}) then 1 else 0 end) as bigint) "
    f"as replaced from ds1" for c in ds1_feature_names()))
oracle("e02_class_share", DS1 + f"""
 select cast({TARGET} as bigint) as {TARGET}, count(*) as n, count(*) / (select count(*) from ds1) as share
 from ds1 group by {TARGET}""")
BASE_SCORED = DS1 + f""",
scored AS (select fixture_id, {TARGET} as label,
             (1 / odds_fav) / (implied_prob_home + implied_prob_draw + implied_prob_away) as p1 from ds1),
pred AS (select *, case when p1 >= 0.5 then 1 else 0 end as prediction from scored)"""
oracle("e07_baseline_metrics", BASE_SCORED + """
 select count(*) as n, sum(case when label = prediction then 1 else 0 end) / count(*) as accuracy,
   coalesce(sum(case when label = 1 and prediction = 1 then 1 else 0 end)
     / nullif(sum(case when prediction = 1 then 1 else 0 end), 0), 0.0) as precision,
   coalesce(sum(case when label = 1 and prediction = 1 then 1 else 0 end)
     / nullif(sum(case when label = 1 then 1 else 0 end), 0), 0.0) as recall,
   round(avg(-(label * ln(least(greatest(p1, 1e-15), 1 - 1e-15))
               + (1 - label) * ln(1 - least(greatest(p1, 1e-15), 1 - 1e-15)))), 9) as log_loss
 from pred""")
oracle("e10_baseline_confusion", BASE_SCORED + """
 select cast(label as bigint) as actual, cast(sum(case when prediction = 0 then 1 else 0 end) as bigint) as pred_0,
   cast(sum(case when prediction = 1 then 1 else 0 end) as bigint) as pred_1 from pred group by label""")
oracle("e11_baseline_class_report", BASE_SCORED + """,
per AS (
  select c.name as class,
    coalesce(sum(case when p.label = c.k and p.prediction = c.k then 1 else 0 end)
      / nullif(sum(case when p.prediction = c.k then 1 else 0 end), 0), 0.0) as precision,
    coalesce(sum(case when p.label = c.k and p.prediction = c.k then 1 else 0 end)
      / nullif(sum(case when p.label = c.k then 1 else 0 end), 0), 0.0) as recall,
    cast(sum(case when p.label = c.k then 1 else 0 end) as bigint) as support
  from pred p, (select 0 as k, 'Did not cover' as name union all select 1, 'Covered') c group by c.name),
per2 AS (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) as f1 from per),
allr AS (
  select class, precision, recall, f1, support from per2
  union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from per2
  union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) from per2)
 select class, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1,
   cast(support as bigint) as support from allr""")

# -------------------------------------------------------------- streaming
oracle("h1_stream_dedupe_events", """
 select event_id, ts, user_id, event_type, value from (
   select *, row_number() over (partition by event_id order by ts) as rn from events) t where rn = 1""")
# the repetition of all events: too late up to a day (in whole milliseconds) before the last event
oracle("h1_stream_dedupe_counts", """
, w AS (select epoch_ms(max(ts)) - 86400000 as mark from events),
n AS (select count(*) as n, count(distinct event_id) as kept, count(*) filter (epoch_us(ts) <= mark * 1000) as late from events, w)
 select 2 * n as landed, kept, 2 * n - kept - late as duplicates, late, kept as stored from n""")
oracle("h2_stream_window_mean", """
, w AS (select time_bucket(interval '15 minutes', ts) as window_start, event_type, count(*) as n, avg(value) as avg_value
        from events group by 1, 2)
 select window_start, window_start + interval '15 minutes' as window_end, event_type, n, round(avg_value, 9) as avg_value
 from w where window_start + interval '15 minutes' <= (select max(ts) from events) - interval '1 hour'""")
oracle("h3_stream_first_wins_sink", """
 select user_id, event_type, ts, event_id, value from (
   select *, row_number() over (partition by user_id, event_type order by ts, event_id) as rn from events) t
 where rn = 1""")
oracle("h4_stream_quality_monitor", """
, w AS (select time_bucket(interval '1 day', ts) as window_start, count(*) as rows,
          cast(sum(case when user_id is null then 1 else 0 end) as bigint) as null_user_id,
          cast(sum(case when value is null then 1 else 0 end) as bigint) as null_value,
          cast(sum(case when props is null then 1 else 0 end) as bigint) as null_props,
          count(*) filter (value > 100 or value < 0) as rule_odd_value
        from events group by 1)
 select window_start, window_start + interval '1 day' as window_end, rows, null_user_id, null_value, null_props, rule_odd_value,
   round(greatest(null_user_id / rows, null_value / rows, null_props / rows), 9) as max_null_rate,
   greatest(null_user_id / rows, null_value / rows, null_props / rows) > 0 or rule_odd_value > 0 as breach
 from w where window_start + interval '1 day' <= (select max(ts) from events) - interval '1 day'""")
