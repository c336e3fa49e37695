"""SQL oracles for the audit queries (F0–F50), written the way the audit
questions are naturally asked in SQL: joins with fan-out and COUNT
DISTINCT, NOT IN / EXISTS sub-selects, UNION ALL of one query per rule.
The Spark side answers the same questions with one-pass rewrites."""

from __future__ import annotations

from pitchlake import schema as S
from pitchlake.operators.audit import ERROR_PATTERNS
from pitchlake.plans.oracle import INT_STATS, P, oracle

HT11 = list(S.REQUIRED_HT_STATS)
KEYS = S.KEYS


def num(c: str, alias: str = "") -> str:
    e = f"{alias}{c}"
    return f"cast({e} as bigint)" if c in INT_STATS else e


def union(parts) -> str:
    return "\n union all\n ".join(parts)


# F0 -- column counts are schema facts of the test bed (Spark derives them from df.schema)
COLS = {"leagues": 2, "seasons": 2, "teams": 3, "schedules": 9, "fixture_stats": 24, "fixture_odds": 6,
        "fixture_timeline": 5}
SRC = {"leagues": "fx_leagues", "seasons": "fx_seasons", "teams": "fx_teams", "schedules": "fx_schedules",
       "fixture_stats": "fx_stats", "fixture_odds": "fx_odds", "fixture_timeline": "fx_timeline"}
oracle("f00_table_overview", union(
    f"select '{n}' as table_name, count(*) as row_count, cast({COLS[n]} as bigint) as column_count, "
    f"'{','.join(KEYS[n])}' as key_columns from {SRC[n]}" for n in SRC))

F1 = """
f1 AS (select s.season_id, l.name as league_name, se.name as season_name, count(*) as fixture_count
       from fx_schedules s left join fx_leagues l on s.league_id = l.league_id
       left join fx_seasons se on s.season_id = se.season_id
       group by s.season_id, l.name, se.name)"""
oracle("f01_group_counts", f",{F1} select * from f1")
oracle("f02_count_summary", f""",{F1}
 select cast(sum(fixture_count) as bigint) as total, avg(fixture_count) as mean,
   cast(median(fixture_count) as double) as median from f1""")
oracle("f03_histogram", """
, b AS (select min(cast(l_extendedprice as double)) as lo, max(cast(l_extendedprice as double)) as hi from lineitem),
h AS (select case when b.hi = b.lo then 1 else least(floor((l_extendedprice - b.lo) / ((b.hi - b.lo) / 20)) + 1, 20) end as bin,
        count(*) as n
      from lineitem, b where l_extendedprice is not null group by 1)
 select cast(h.bin as bigint) as bin, b.lo + (h.bin - 1) * ((b.hi - b.lo) / 20) as bin_lo,
   b.lo + h.bin * ((b.hi - b.lo) / 20) as bin_hi, h.n from h, b""")
oracle("f04_small_groups", f",{F1} select * from f1 where fixture_count < 80 and league_name is not null")

F5 = """
f5 AS (select s.fixture_id, cast(s.league_id as bigint) as league_id, l.name as league_name, s.season_id,
         se.name as season_name, s.home_team_id, ht.name as home_team, s.away_team_id, awt.name as away_team,
         s.start_time, s.status
       from fx_schedules s left join fx_stats fs on s.fixture_id = fs.fixture_id
       left join fx_leagues l on s.league_id = l.league_id left join fx_seasons se on s.season_id = se.season_id
       left join fx_teams ht on s.home_team_id = ht.team_id left join fx_teams awt on s.away_team_id = awt.team_id
       where s.status = 'FT' and fs.fixture_id is null)"""
oracle("f05_missing_stats", f",{F5} select * from f5")
oracle("f06_missing_rate", f"""
 select count(*) as total_finished,
   cast(sum(case when fs.fixture_id is null then 1 else 0 end) as bigint) as missing_stats,
   {P('sum(case when fs.fixture_id is null then 1 else 0 end)', 'count(*)')} as missing_pct
 from fx_schedules s left join (select distinct fixture_id from fx_stats) fs on s.fixture_id = fs.fixture_id
 where s.status = 'FT'""")
oracle("f07_missing_by_league", f""",{F5}
 select league_name, count(*) as missing from f5 where league_name is not null group by league_name
 order by missing desc, league_name limit 10""")

F8 = """
f8 AS (select fs.fixture_id, cast(s.league_id as bigint) as league_id, l.name as league_name, s.status,
         string_agg(distinct fs.period, ',' order by fs.period) as available_periods
       from fx_stats fs join fx_schedules s on fs.fixture_id = s.fixture_id
       left join fx_leagues l on s.league_id = l.league_id
       where fs.fixture_id not in (select distinct fixture_id from fx_stats where period = 'first_half')
       group by fs.fixture_id, s.league_id, l.name, s.status)"""
oracle("f08_missing_first_half", f",{F8} select * from f8")
oracle("f09_first_half_rate", f"""
, per AS (select fixture_id, max(case when period = 'first_half' then 1 else 0 end) as has from fx_stats group by fixture_id)
 select count(*) as fixtures_with_stats, cast(sum(case when has = 0 then 1 else 0 end) as bigint) as missing_first_half,
   {P('sum(case when has = 0 then 1 else 0 end)', 'count(*)')} as missing_pct from per""")
oracle("f10_period_combinations", f",{F8} select available_periods, count(*) as n from f8 group by available_periods")

F11 = """
f11 AS (select fixture_id, count(distinct team_id) as team_count from fx_stats where period = 'first_half'
        group by fixture_id having count(distinct team_id) != 2)"""
oracle("f11_team_count_violations", f",{F11} select * from f11")
oracle("f11_team_count_rate", f"""
, per AS (select fixture_id, count(distinct team_id) as team_count from fx_stats where period = 'first_half' group by fixture_id)
 select count(*) as fixtures_with_period, cast(sum(case when team_count != 2 then 1 else 0 end) as bigint) as incomplete,
   {P('sum(case when team_count != 2 then 1 else 0 end)', 'count(*)')} as incomplete_pct from per""")
oracle("f12_drill_down", f""",{F11}
 select fs.fixture_id, fs.team_id, t.name as team_name, fs.period, s.home_team_id, s.away_team_id
 from fx_stats fs join fx_schedules s on fs.fixture_id = s.fixture_id left join fx_teams t on fs.team_id = t.team_id
 where fs.fixture_id in (select fixture_id from f11 order by team_count, fixture_id limit 5)""")

oracle("f13_null_profile", ", fh AS (select * from fx_stats where period = 'first_half'), n AS (" + union(
    f"select '{c}' as statistic, cast(sum(case when {c} is null then 1 else 0 end) as bigint) as null_count, "
    f"{P(f'sum(case when {c} is null then 1 else 0 end)', 'count(*)')} as null_percent, count(*) as total_records from fh"
    for c in HT11) + ") select *, row_number() over (order by null_percent desc, statistic) as rank from n")
oracle("f14_all_null_rows", f"""
 select fs.fixture_id, s.home_team_id, ht.name as home_team, s.away_team_id, awt.name as away_team, s.start_time, s.status,
   fs.team_id, t.name as team_name
 from fx_stats fs join fx_schedules s on fs.fixture_id = s.fixture_id
 left join fx_teams ht on s.home_team_id = ht.team_id left join fx_teams awt on s.away_team_id = awt.team_id
 left join fx_teams t on fs.team_id = t.team_id
 where fs.period = 'first_half' and {' and '.join(f'fs.{c} is null' for c in HT11)}""")

F15 = """
f15 AS (select s.season_id, se.name as season_name, t.team_id, t.name as team_name,
          cast(sum(case when s.home_team_id = t.team_id then 1 else 0 end) as bigint) as home_matches,
          cast(sum(case when s.away_team_id = t.team_id then 1 else 0 end) as bigint) as away_matches,
          count(*) as total_matches,
          cast(abs(sum(case when s.home_team_id = t.team_id then 1 else 0 end)
                 - sum(case when s.away_team_id = t.team_id then 1 else 0 end)) as bigint) as balance_diff
        from fx_schedules s join fx_teams t on (t.team_id = s.home_team_id or t.team_id = s.away_team_id)
        left join fx_seasons se on s.season_id = se.season_id
        group by s.season_id, se.name, t.team_id, t.name having count(*) >= 10)"""
oracle("f15_side_balance", f",{F15} select * from f15")
oracle("f16_balance_summary", f""",{F15}
 select count(*) as team_seasons, avg(balance_diff) as avg_diff, cast(median(balance_diff) as double) as median_diff,
   max(balance_diff) as max_diff, cast(sum(case when balance_diff = 0 then 1 else 0 end) as bigint) as perfect,
   cast(sum(case when balance_diff <= 2 then 1 else 0 end) as bigint) as minor,
   {P('sum(case when balance_diff = 0 then 1 else 0 end)', 'count(*)')} as perfect_pct,
   {P('sum(case when balance_diff <= 2 then 1 else 0 end)', 'count(*)')} as minor_pct from f15""")

oracle("f17_orphans", union(
    f"select '{n}' as table_name, count(distinct c.fixture_id) as unique_ids, "
    f"cast(sum(case when s.fixture_id is null then 1 else 0 end) as bigint) as orphaned_ids, "
    f"{P('sum(case when s.fixture_id is null then 1 else 0 end)', 'count(distinct c.fixture_id)')} as orphaned_percent "
    f"from (select distinct fixture_id from {t}) c left join fx_schedules s on c.fixture_id = s.fixture_id"
    for n, t in (("fixture_stats", "fx_stats"), ("fixture_odds", "fx_odds"), ("fixture_timeline", "fx_timeline"))))

BAD = "fs.team_id != s.home_team_id and fs.team_id != s.away_team_id"
oracle("f18_non_member", f"""
 select count(distinct fs.fixture_id) as fixtures_checked,
   cast(sum(case when {BAD} then 1 else 0 end) as bigint) as inconsistent_team_ids,
   {P(f'sum(case when {BAD} then 1 else 0 end)', 'count(*)')} as inconsistent_percent
 from fx_stats fs join fx_schedules s on fs.fixture_id = s.fixture_id""")
oracle("f18_non_member_examples", f"""
, ex AS (select fs.fixture_id, fs.team_id as stats_team_id, s.home_team_id, s.away_team_id
         from fx_stats fs join fx_schedules s on fs.fixture_id = s.fixture_id where {BAD}
         order by fs.fixture_id, fs.team_id limit 10)
 select ex.fixture_id, ex.stats_team_id, t1.name as stats_team_name, ex.home_team_id, t2.name as home_team_name,
   ex.away_team_id, t3.name as away_team_name
 from ex left join fx_teams t1 on ex.stats_team_id = t1.team_id left join fx_teams t2 on ex.home_team_id = t2.team_id
 left join fx_teams t3 on ex.away_team_id = t3.team_id""")

F19 = """
f19 AS (select fixture_id, team_id, period, count(*) as duplicate_count from fx_stats_raw
        group by fixture_id, team_id, period having count(*) > 1)"""
oracle("f19_duplicate_keys", f",{F19} select * from f19")
RAW_COLS = ["fixture_id", "team_id", "period", "goals", "fouls", "red_cards", "tackles", "shots_blocked",
            "successful_passes_percentage", "ball_possession", "saves", "attacks", "shots_total", "shots_insidebox",
            "shots_on_target", "shots_off_target", "passes", "corners", "yellow_cards", "challenges", "api_ts", "src_a", "src_b", "src_c"]
oracle("f19_duplicate_drill", f""",{F19},
top AS (select fixture_id, team_id, period from f19 order by duplicate_count desc, fixture_id, team_id, period limit 1)
 select {', '.join(num(c, 'r.') + ' as ' + c for c in RAW_COLS)}
 from fx_stats_raw r where exists (select 1 from top where top.fixture_id is not distinct from r.fixture_id
   and top.team_id is not distinct from r.team_id and top.period is not distinct from r.period)""")
oracle("f20_duplicate_odds", """
, o AS (select *, cast(null as double) as handicap, cast(null as double) as total from fx_odds)
 select fixture_id, cast(market_id as bigint) as market_id, cast(bookmaker_id as bigint) as bookmaker_id, label,
   handicap, total, count(*) as duplicate_count
 from o group by fixture_id, market_id, bookmaker_id, label, handicap, total having count(*) > 1""")

EXPECTED = [("o_orderkey", "bigint", "bigint", "BIGINT"), ("o_custkey", "bigint", "bigint", "BIGINT"),
            ("o_orderstatus", "int", "string", "INTEGER"), ("o_totalprice", "double", "double", "DOUBLE"),
            ("o_orderdate", "timestamp_ntz", "timestamp_ntz", "TIMESTAMP")]
parts = [f"select 'orders' as table_name, '{c}' as column_name, 'present' as status, '{e}' as expected_type, "
         f"'{a}' as actual_type, count({c}) as non_null, "
         f"cast(sum(case when {c} is not null and try_cast({c} as {d}) is null then 1 else 0 end) as bigint) as not_castable "
         f"from orders" for c, e, a, d in EXPECTED]
parts.append("select 'orders', 'o_clerk', 'missing', 'string', cast(null as varchar), cast(null as bigint), cast(null as bigint)")
parts.append("select 'orders', 'o_orderpriority', 'extra', cast(null as varchar), 'string', cast(null as bigint), cast(null as bigint)")
oracle("f21_conformance", union(parts))

AT = """
 select '{n}' as table_name, count(*) as total_rows,
   cast(sum(case when created_at is null then 1 else 0 end) as bigint) as null_created_at,
   cast(sum(case when updated_at is null then 1 else 0 end) as bigint) as null_updated_at,
   cast(sum(case when updated_at < created_at then 1 else 0 end) as bigint) as illogical_timestamps,
   min(created_at) as earliest_created, max(created_at) as latest_created,
   min(updated_at) as earliest_updated, max(updated_at) as latest_updated from {t}"""
oracle("f22_audit_times", """
, o AS (select o_orderdate as created_at, o_orderdate + to_days(cast(o_orderkey % 3 - 1 as integer)) as updated_at from orders),
li AS (select l_shipdate as created_at, l_shipdate as updated_at from lineitem)
""" + AT.format(n="orders", t="o") + "\n union all" + AT.format(n="lineitem", t="li"))
oracle("f23_time_range", """
 select count(*) as total_rows, cast(sum(case when ts is null then 1 else 0 end) as bigint) as null_timestamps,
   min(ts) as earliest_timestamp, max(ts) as latest_timestamp from events""")
oracle("f24_per_day", "select cast(ts as date) as date, count(*) as records_count from events where ts is not null group by 1")

DESCRIBE = ["goals", "shots_on_target", "shots_total", "ball_possession", "fouls", "red_cards", "attacks",
            "shots_insidebox", "saves", "shots_off_target", "passes", "corners", "yellow_cards", "challenges"]
FHG = "fhg AS (select * from fx_stats where period = 'first_half' and goals is not null)"
oracle("f25_describe", f", {FHG}\n " + union(
    f"select '{c}' as \"column\", count({c}) as count, min(cast({c} as double)) as min, max(cast({c} as double)) as max, "
    f"max(cast({c} as double)) - min(cast({c} as double)) as range, round(avg(cast({c} as double)), 9) as mean, "
    f"round(stddev_samp(cast({c} as double)), 9) as std, quantile_cont(cast({c} as double), 0.25) as p25, "
    f"quantile_cont(cast({c} as double), 0.5) as p50, quantile_cont(cast({c} as double), 0.75) as p75 from fhg"
    for c in DESCRIBE))
Q = "q AS (" + union(
    f"select '{c}' as col, quantile_cont(cast({c} as double), 0.25) as q1, quantile_cont(cast({c} as double), 0.75) as q3 from fhg"
    for c in DESCRIBE) + ")"
LNG = "lng AS (" + union(
    f"select fixture_id, team_id, '{c}' as col, cast({c} as double) as value from fhg" for c in DESCRIBE) + ")"
oracle("f26_iqr_outliers", f""", {FHG}, {Q}, {LNG}
 select lng.fixture_id, lng.team_id, lng.col as "column", lng.value, q.q1 - 3.0 * (q.q3 - q.q1) as lower_bound,
   q.q3 + 3.0 * (q.q3 - q.q1) as upper_bound
 from lng join q on lng.col = q.col
 where lng.value < q.q1 - 3.0 * (q.q3 - q.q1) or lng.value > q.q3 + 3.0 * (q.q3 - q.q1)""")
oracle("f27_box_stats", f""", {FHG}, {Q}, {LNG}
 select q.col as "column", q.q1, q.q3, quantile_cont(lng.value, 0.5) as median,
   min(case when lng.value >= q.q1 - 1.5 * (q.q3 - q.q1) then lng.value end) as lower_whisker,
   max(case when lng.value <= q.q3 + 1.5 * (q.q3 - q.q1) then lng.value end) as upper_whisker,
   q.q3 - q.q1 as iqr
 from lng join q on lng.col = q.col group by q.col, q.q1, q.q3""")

# ------------------------------------------------------------ F28-F30
# Limits and rules are stated here on their own, as one table of rules per check.
oracle("f28_range_violations", """
, limits AS (select * from (values ('ball_possession', 0, 100), ('shots_on_target', 0, null), ('shots_total', 0, null),
    ('goals', 0, null), ('red_cards', 0, 11), ('passes', 0, null)) v(stat, low, high)),
readings AS (
  unpivot (select fixture_id, team_id, period, cast(ball_possession as double) as ball_possession,
             cast(shots_on_target as double) as shots_on_target, cast(shots_total as double) as shots_total,
             cast(goals as double) as goals, cast(red_cards as double) as red_cards, cast(passes as double) as passes
           from fx_stats where period = 'first_half')
  on ball_possession, shots_on_target, shots_total, goals, red_cards, passes into name stat value value)
 select r.fixture_id, r.team_id, tm.name as team_name, r.period, r.stat, r.value
 from readings r join limits using (stat) left join fx_teams tm using (team_id)
 where not (r.value >= low and (high is null or r.value <= high))""")

JUDGED = """
judged AS (
  select fixture_id, team_id, period, shots_total, shots_on_target, shots_off_target, shots_blocked, shots_insidebox, goals,
    unnest([{'rule': 'shots_total >= shots_on_target', 'broken': shots_total < shots_on_target},
            {'rule': 'goals <= shots_on_target', 'broken': goals > shots_on_target},
            {'rule': 'shots_total >= shots_insidebox', 'broken': shots_total < shots_insidebox},
            {'rule': 'shots_on_target + shots_off_target + shots_blocked <= shots_total',
             'broken': shots_on_target + shots_off_target + shots_blocked > shots_total}], recursive := true)
  from fx_stats
  where period = 'first_half' and list_count([shots_total, shots_on_target, shots_insidebox, goals]) = 4)"""
oracle("f29_rule_violations", f", {JUDGED} select rule, count(*) filter (broken) as violations from judged group by rule")
oracle("f29_rule_examples", f""", {JUDGED}
 select rule, fixture_id, team_id, tm.name as team_name, period, shots_total, shots_on_target, shots_off_target, shots_blocked,
   shots_insidebox, goals
 from (select *, row_number() over (partition by rule order by fixture_id, team_id) as place from judged where broken) j
 left join fx_teams tm using (team_id) where place <= 10""")

SHARES = """
shares AS (
  select fixture_id, count(distinct team_id) as team_count, sum(ball_possession) as value_sum,
    list(struct_pack(id := team_id, v := ball_possession) order by team_id) as reports
  from fx_stats where period = 'first_half' and ball_possession is not null group by fixture_id)"""
oracle("f30_possession_pairs", f""", {SHARES}
 select p.fixture_id, p.team_count, p.reports[1].id as team1_id, one.name as team1_name, p.reports[1].v as team1_value,
   p.reports[-1].id as team2_id, two.name as team2_name, p.reports[-1].v as team2_value, p.value_sum,
   abs(p.value_sum - 100) as diff_from_target
 from shares p left join fx_teams one on one.team_id = p.reports[1].id left join fx_teams two on two.team_id = p.reports[-1].id
 where p.team_count >= 2 order by diff_from_target desc, p.fixture_id limit 20""")

# ------------------------------------------------------------ F31-F32
# Second-half goals that each side's own rows report, one row per fixture that has any.
SG = """
reported AS (
  select fixture_id, map_from_entries(list((team_id, scored))) as by_team
  from (select fixture_id, team_id, sum(goals)::bigint as scored from fx_stats
        where period = 'second_half' and goals is not null and team_id is not null group by all) t group by fixture_id),
scores AS (
  select s.fixture_id, s.home_score as home_said, s.away_score as away_said,
    coalesce(by_team[s.home_team_id], 0) as home_seen, coalesce(by_team[s.away_team_id], 0) as away_seen
  from fx_schedules s join reported r using (fixture_id)),
gaps AS (
  select *, home_said - home_seen as home_gap, away_said - away_seen as away_gap from scores),
wrong AS (select * from gaps where abs(home_gap) + abs(away_gap) > 0)"""
oracle("f31_score_mismatch", f""", {SG}
 select fixture_id, home_said as home_goals_schedules, home_seen as home_goals_from_stats, home_gap as home_diff,
   away_said as away_goals_schedules, away_seen as away_goals_from_stats, away_gap as away_diff,
   row_number() over (order by abs(home_gap) + abs(away_gap) desc, fixture_id) as rank from wrong""")
oracle("f32_mismatch_summary", f""", {SG}
 select count(*) as fixtures_with_period_goals, count(*) filter (w) as mismatches,
   round(avg(home_gap) filter (w), 9) as avg_home_diff, round(avg(away_gap) filter (w), 9) as avg_away_diff,
   count(*) filter (w and home_gap > 0) as home_positive, count(*) filter (w and home_gap < 0) as home_negative,
   count(*) filter (w and away_gap > 0) as away_positive, count(*) filter (w and away_gap < 0) as away_negative,
   {P('count(*) filter (w)', 'count(*)')} as mismatch_pct
 from (select *, coalesce(abs(home_gap) + abs(away_gap) > 0, false) as w from gaps) g""")

# ------------------------------------------------------------ F33, F38, F41, F42
# One row per fixture with what is known of its statistics.
MARKS = """
marks AS (
  select s.*, k.fixture_id is not null as seen, coalesce(k.early, false) as early, coalesce(k.red, false) as red
  from fx_schedules s left join (
    select fixture_id, bool_or(period = 'first_half') as early, bool_or(coalesce(red_cards > 0, false)) as red
    from fx_stats group by fixture_id) k using (fixture_id))"""
COVER = f"""count(*) as total_fixtures, count(*) filter (status = 'FT') as finished_fixtures,
  count(*) filter (seen) as fixtures_with_stats, count(*) filter (early) as fixtures_with_first_half,
  {P('count(*) filter (seen)', "count(*) filter (status = 'FT')")} as stats_coverage_pct,
  {P('count(*) filter (early)', "count(*) filter (status = 'FT')")} as first_half_coverage_pct"""
F33 = f"""{MARKS},
f33 AS (
  select g.league_id, lg.name as league_name, g.* exclude (league_id)
  from (select league_id, {COVER} from marks group by league_id) g join fx_leagues lg using (league_id)
  where g.finished_fixtures > 0)"""
oracle("f33_coverage_by_league", f", {F33} select * from f33")
oracle("f33_coverage_overall", f""", {F33}
 select round({P('sum(fixtures_with_first_half)', 'sum(finished_fixtures)', None)}, 9) as weighted_first_half_coverage_pct from f33""")
oracle("f38_coverage_by_month", f""", {MARKS}
 select strftime(start_time, '%Y-%m') as month, {COVER} from marks where start_time is not null
 group by month having count(*) filter (status = 'FT') > 0""")
oracle("f41_scenario_coverage", f""", {MARKS},
cases AS (
  select seen, unnest([
    {{'scenario': 'High-scoring (5+ goals)', 'fits': status = 'FT' and home_score + away_score >= 5}},
    {{'scenario': 'Red Card Issued', 'fits': status = 'FT' and red}},
    {{'scenario': 'Abandoned/Cancelled', 'fits': status in ('ABD', 'CANC', 'INT')}},
    {{'scenario': 'Penalty Shootout', 'fits': status = 'FT_PEN'}},
    {{'scenario': 'Extra Time', 'fits': status = 'AET'}},
    {{'scenario': 'Regular Match', 'fits': status = 'FT' and home_score + away_score < 5 and not red}}], recursive := true)
  from marks)
 select scenario, count(*) filter (fits) as fixture_count, count(*) filter (fits and seen) as fixtures_with_stats,
   {P('count(*) filter (fits and seen)', 'count(*) filter (fits)')} as stats_coverage_pct
 from cases group by scenario""")
oracle("f42_unplayed_with_stats", """
 select x.fixture_id, x.status, x.start_time, (select name from fx_teams where team_id = x.home_team_id) as home_team,
   (select name from fx_teams where team_id = x.away_team_id) as away_team, n as stat_records,
   array_to_string(list_sort(kinds), ',') as periods
 from fx_schedules x
 join (select fixture_id, count(*) as n, list(distinct period) as kinds from fx_stats group by fixture_id) k using (fixture_id)
 where list_contains(['POST', 'CANC', 'INT', 'ABD'], x.status)""")

F34 = """
f34 AS (
  select g.league_id, lg.name as league_name, g.* exclude (league_id)
  from (select s.league_id, count(distinct fixture_id) as fixtures_counted, round(avg(goals), 2) as avg_goals,
          round(avg(shots_total), 2) as avg_shots, round(avg(ball_possession), 2) as avg_possession, round(avg(passes), 2) as avg_passes
        from fx_stats f join fx_schedules s using (fixture_id)
        where f.period = 'first_half' and list_count([goals::double, shots_total::double, ball_possession::double]) = 3
        group by s.league_id) g join fx_leagues lg using (league_id)
  where g.fixtures_counted >= 20)"""
oracle("f34_means_by_league", f", {F34} select * from f34")
oracle("f35_trend", f""", {F34}
 select round(regr_slope(avg_goals, fixtures_counted), 9) as slope, round(regr_intercept(avg_goals, fixtures_counted), 9) as intercept,
   round(avg(avg_goals), 9) as mean, round(stddev_samp(avg_goals), 9) as std from f34""")
oracle("f35_above_mean_sd", f""", {F34}
 select * from f34 where avg_goals > (select avg(avg_goals) + stddev_samp(avg_goals) from f34)""")

MEANS = ["goals", "shots_total", "shots_on_target", "ball_possession", "fouls", "corners", "passes"]
SHARE = {"goals": "goals_availability", "shots_total": "shots_availability", "ball_possession": "possession_availability"}
F36 = f"""
sided AS (
  select f.*, case f.team_id when s.home_team_id then 'Home' when s.away_team_id then 'Away' else 'Unknown' end as location
  from fx_stats f join fx_schedules s using (fixture_id) where f.period = 'first_half'),
f36 AS (
  select location, count(*) as records,
    {', '.join(f'round(count({c}) / count(*) * 100, 2) as {n}' for c, n in SHARE.items())},
    {', '.join(f'round(avg({c}), 2) as avg_{c}' for c in MEANS)}
  from sided group by location)"""
oracle("f36_side_bias", f", {F36} select * from f36")
METRICS = [*SHARE.values(), *[f"avg_{c}" for c in MEANS]]
oracle("f37_side_comparison", f""", {F36},
tall AS (unpivot (select * exclude (records) from f36) on {', '.join(METRICS)} into name metric value v),
both_sides AS (
  select metric, any_value(v) filter (location = 'Home') as home, any_value(v) filter (location = 'Away') as away
  from tall group by metric)
 select metric, round(home, 9) as home, round(away, 9) as away, round(home - away, 9) as difference,
   round((home - away) / nullif(away, 0) * 100, 2) as relative_difference_pct from both_sides""")


def _kickoff(bucket: str, time: str, avgs) -> str:
    """Finished fixtures by a part of their kick-off; means over their first-half rows."""
    sums = ", ".join(f"sum({c}::double) as s_{c}, count({c}) as n_{c}" for c, _ in avgs)
    means = ", ".join(f"round(sum(s_{c}) / nullif(sum(n_{c}), 0), 2) as {n}" for c, n in avgs)
    return f"""
, early AS (select fixture_id, {sums} from fx_stats where period = 'first_half' group by fixture_id),
played AS (select fixture_id, {time} as kick from fx_schedules where status = 'FT' and start_time is not null)
 select {bucket}, count(*) as finished_fixtures, count(e.fixture_id) as fixtures_with_first_half,
   {P('count(e.fixture_id)', 'count(*)')} as coverage_pct, {means}
 from played left join early e using (fixture_id) group by all"""


oracle("f39_coverage_by_weekday", _kickoff("isodow(kick) - 1 as day_of_week_index, dayname(kick) as day_of_week", "start_time",
                                           [("goals", "avg_goals"), ("shots_total", "avg_shots"),
                                            ("ball_possession", "avg_possession")]))
# kick-off hours: the bound table spreads fixtures over the day by their id
oracle("f40_coverage_by_hour", _kickoff("strftime(kick, '%H') as hour_of_day", "start_time + to_hours((fixture_id % 24)::int)",
                                        [("goals", "avg_goals"), ("shots_total", "avg_shots")]))

# ------------------------------------------------------------ F43-F47
FILLED = "list_count([" + ", ".join(f"{c}::double" for c in HT11) + "])"
F43 = f"""
filled AS (
  select fixture_id, count(distinct team_id) as team_count, sum({FILLED})::bigint as non_null_counts
  from fx_stats where period = 'first_half' group by fixture_id),
f43 AS (
  select f.fixture_id, s.league_id, lg.name as league_name, s.season_id, sn.name as season_name, s.start_time, f.team_count,
    f.non_null_counts, {len(HT11)} * f.team_count as total_possible, round(share, 2) as quality_score,
    case when f.team_count < 2 then '{S.Q_CRIT_TEAM}' when f.non_null_counts = 0 then '{S.Q_CRIT_NULL}'
      else ['{S.Q_POOR}', '{S.Q_FAIR}', '{S.Q_GOOD}', '{S.Q_EXCELLENT}'][1 + (share >= 50)::int + (share >= 80)::int + (share >= 100)::int]
    end as quality_category
  from (select *, 100.0 * non_null_counts / nullif({len(HT11)} * team_count, 0) as share from filled) f
  join fx_schedules s using (fixture_id) left join fx_leagues lg using (league_id) left join fx_seasons sn using (season_id))"""
oracle("f43_quality_score", f", {F43} select * from f43")
oracle("f44_category_share", f""", {F43}
 select quality_category, count(*) as fixture_count, round(100.0 * count(*) / sum(count(*)) over (), 2) as percentage
 from f43 group by quality_category""")
KINDS = {"excellent": S.Q_EXCELLENT, "good": S.Q_GOOD, "fair": S.Q_FAIR, "poor": S.Q_POOR}
F45 = f"""
f45 AS (
  select league_id, league_name, count(*) as fixture_count, avg(quality_score) as avg_quality_score,
    {', '.join(f"count(*) filter (quality_category = '{v}') as {k}_fixture_count" for k, v in KINDS.items())},
    count(*) filter (starts_with(quality_category, 'CRITICAL')) as critical_fixture_count
  from f43 where league_name is not null and league_id is not null group by all),
f45p AS (
  select *, {P('excellent_fixture_count', 'fixture_count')} as excellent_pct,
    {P('excellent_fixture_count + good_fixture_count', 'fixture_count')} as good_or_better_pct from f45)"""
oracle("f45_league_quality", f""", {F43}, {F45}
 select * replace (round(avg_quality_score, 9) as avg_quality_score) from f45p""")
GOOD = f"quality_category in ('{S.Q_EXCELLENT}', '{S.Q_GOOD}')"
PROB = f"quality_category in ('{S.Q_CRIT_TEAM}', '{S.Q_CRIT_NULL}', '{S.Q_POOR}')"
oracle("f46_quality_report", f""", {F43}, {F45},
totals AS (
  select count(*)::double as total_fixtures, avg(quality_score) as avg_quality_score,
    {P(f'count(*) filter ({GOOD})', 'count(*)')} as good_or_better_percentage, {P(f'count(*) filter ({PROB})', 'count(*)')} as problem_percentage
  from f43),
placed AS (
  select *, row_number() over (order by good_or_better_pct desc, league_id) as best,
    row_number() over (order by good_or_better_pct, league_id desc) as worst from f45p),
chosen AS (
  select 'top_leagues' as section, best as rank, * from placed where best <= 5
  union all select 'problem_leagues', worst, * from placed where worst <= 5),
listed AS (
  select section, rank, league_name, unnest(['avg_quality_score', 'good_or_better_pct']) as metric,
    unnest([avg_quality_score, good_or_better_pct]) as value from chosen
  union all
  select 'overall', null, null, metric, value
  from (unpivot totals on total_fixtures, avg_quality_score, good_or_better_percentage, problem_percentage into name metric value value))
 select section, rank, league_name, metric, round(value, 9) as value from listed""")
oracle("f47_league_badges", f""", {F43}, {F45}
 select league_id, league_name, round(avg_quality_score, 9) as avg_quality_score,
   ['POOR', 'FAIR', 'GOOD', 'EXCELLENT'][1 + (avg_quality_score >= 50)::int + (avg_quality_score >= 80)::int + (avg_quality_score >= 90)::int]
     as quality_badge from f45p""")

# ------------------------------------------------------------ F48, F50
E = dict(ERROR_PATTERNS)
ERRORS = f"""
flags AS (
  select fixture_id, bool_or(period = 'first_half') as early, count(distinct team_id) filter (period = 'first_half') as teams,
    count(*) filter (period = 'first_half' and ball_possession is null) as unshared,
    count(*) filter (period = 'first_half' and (goals > shots_on_target or shots_total < shots_on_target)) as impossible
  from fx_stats group by fixture_id),
found AS (
  select unnest(['Missing first-half data', 'Incomplete team coverage', 'Missing ball possession', 'Impossible statistics']) as name,
    unnest([count(*) filter (not early), count(*) filter (early and teams < 2), sum(unshared)::bigint, sum(impossible)::bigint]) as count
  from flags
  union all select 'Inconsistent scores', count(*) from wrong
  union all select unnest(['Irregular possession sum', 'Irregular possession teams']),
    unnest([count(*) filter (team_count >= 2 and value_sum not between 95 and 105), count(*) filter (team_count <> 2)]) from shares)"""
oracle("f48_error_register", f""", {SG}, {SHARES}, {ERRORS},
described AS (select * from (values {', '.join(f"('{n}', '{d}')" for n, d in E.items())}) v(name, description))
 select row_number() over (order by count desc, name) as rank, name, description, count from found join described using (name)""")
oracle("f50_incomplete_fixtures", f"""
 select fixture_id from fx_stats where period = 'first_half' group by fixture_id
 having count(distinct team_id) < 2 or min({FILLED}) = 0""")
