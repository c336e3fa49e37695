"""SQL oracles for the validation summary (F49) and the plan-only
operators (P1–P11)."""

from __future__ import annotations

from pitchlake import schema as S
from pitchlake.operators.audit import RECOMMENDATIONS
from pitchlake.plans.oracle import AVG_P, DS1, ORACLE, P, PIVOT_MEAN, SIDED, TARGET, oracle
from pitchlake.plans.oracle_audit import ERRORS, F33, F43, F45, SG, SHARES

HT11 = list(S.REQUIRED_HT_STATS)
R = {k: v.replace("'", "''") for k, v in RECOMMENDATIONS.items()}
GOOD = f"quality_category in ('{S.Q_EXCELLENT}', '{S.Q_GOOD}')"

oracle("f49_validation_summary", f""", {F43}, {F45}, {SG}, {SHARES}, {ERRORS}, {F33},
halves AS (
  select fixture_id, team_id, any_value(goals) filter (period = 'first_half') as g1, any_value(goals) filter (period = 'second_half') as g2,
    any_value(shots_total) filter (period = 'first_half') as s1, any_value(shots_total) filter (period = 'second_half') as s2,
    any_value(attacks) filter (period = 'first_half') as a1, any_value(attacks) filter (period = 'second_half') as a2,
    count(distinct period) as periods
  from fx_stats where period in ('first_half', 'second_half') group by fixture_id, team_id),
fell AS (select count(*) filter (g1 > g2 or s1 > s2 or a1 > a2) as n, count(*) filter (periods = 2) as compared from halves),
ranking AS (select *, row_number() over (order by good_or_better_pct desc, league_id) as place from f45p),
low AS (select *, row_number() over (order by good_or_better_pct desc, league_id) as spot from f45p where avg_quality_score < 50),
worst_errors AS (select *, row_number() over (order by count desc, name) as place from found),
miss AS (select count(*) as total_finished, sum(case when fs.fixture_id is null then 1 else 0 end) as missing_stats,
           {P('sum(case when fs.fixture_id is null then 1 else 0 end)', 'count(*)')} as missing_pct
         from fx_schedules s left join (select distinct fixture_id from fx_stats) fs on s.fixture_id = fs.fixture_id
         where s.status = 'FT'),
tr AS (select sum(case when team_count != 2 then 1 else 0 end) as incomplete,
         {P('sum(case when team_count != 2 then 1 else 0 end)', 'count(*)')} as incomplete_pct
       from (select fixture_id, count(distinct team_id) as team_count from fx_stats where period = 'first_half'
             group by fixture_id) x),
nulls AS ({' union all '.join(f"select '{c}' as statistic, {P(f'sum(case when {c} is null then 1 else 0 end)', 'count(*)')} as null_percent from fx_stats where period = 'first_half'" for c in HT11)}),
worst AS (select * from nulls order by null_percent desc, statistic limit 1),
mem AS (select {P('sum(case when fs.team_id != s.home_team_id and fs.team_id != s.away_team_id then 1 else 0 end)', 'count(*)')} as pct
        from fx_stats fs join fx_schedules s on fs.fixture_id = s.fixture_id),
dups AS (select count(*) as n from (select fixture_id, team_id, period from fx_stats group by 1, 2, 3 having count(*) > 1) d),
mm AS (select (select count(*) from wrong) as mismatches,
         {P('(select count(*) from wrong)', '(select count(*) from scores)')} as mismatch_pct),
q1 AS (select count(*) as n, avg(quality_score) as avg, sum(case when {GOOD} then 1 else 0 end) as good from f43),
rows AS (
  select 'overall' as section, 'total_fixtures' as metric, cast(n as double) as value, cast(null as varchar) as detail from q1
  union all select 'overall', 'avg_quality_score', avg, null from q1
  union all select 'overall', 'good_or_better_pct', {P('good', 'n')}, null from q1
  union all select 'findings', 'missing_stats_pct', missing_pct, null from miss
  union all select 'findings', 'incomplete_team_pct', incomplete_pct, null from tr
  union all select 'findings', 'worst_null_stat_pct', null_percent, statistic from worst
  union all select 'findings', 'team_id_inconsistency_pct', pct, null from mem
  union all select 'findings', 'duplicate_keys', cast(n as double), null from dups
  union all select 'findings', 'score_inconsistency_pct', mismatch_pct, null from mm
  union all select 'findings', 'decreasing_stats', cast(n as double), null from fell
  union all select 'league_ranking', place::varchar, avg_quality_score, league_name from ranking where place <= 5
  union all select 'poor_league', spot::varchar, avg_quality_score, league_name from low where spot <= 3
  union all select 'error_pattern', place::varchar, count::double, name from worst_errors where place <= 3
  union all select 'recommendation', 'league_coverage', 1.0, '{R["league_coverage"]}' from (select count(*) as n from f33) c where n > 0
  union all select 'recommendation', 'decreasing_stats', 1.0, '{R["decreasing_stats"]}' from fell where n > 0
  union all select 'recommendation', 'period_meaning', 1.0, '{R["period_meaning"]}' from fell where compared > 0
  union all select 'gaps', 'poor_leagues', cast(sum(case when avg_quality_score < 50 then 1 else 0 end) as double), null from f45p
  union all select 'recommendation', 'stats_coverage', 1.0, '{R["stats_coverage"]}' from miss where missing_stats > 0
  union all select 'recommendation', 'team_coverage', 1.0, '{R["team_coverage"]}' from tr where incomplete > 0
  union all select 'recommendation', 'null_rates', 1.0, '{R["null_rates"]}' from worst where null_percent > 20
  union all select 'recommendation', 'score_consistency', 1.0, '{R["score_consistency"]}' from mm where mismatches > 0
  union all select 'recommendation', 'monitoring', 1.0, '{R["monitoring"]}'
  union all select 'recommendation', 'modeling_filter', 1.0, '{R["modeling_filter"]}'
  union all select 'recommendation', 'league_registry', 1.0, '{R["league_registry"]}')
 select section, metric, round(value, 9) as value, detail from rows""")

MONO = ["goals", "shots_total", "attacks"]
oracle("p01_period_monotonic", f"""
, per AS (select fixture_id, team_id,
            {', '.join(f"max(case when period = 'first_half' then {c} end) as {c}_1, max(case when period = 'second_half' then {c} end) as {c}_2" for c in MONO)}
          from fx_stats where period in ('first_half', 'second_half') group by fixture_id, team_id),
d AS (select fixture_id, team_id, concat_ws(',', {', '.join(f"case when {c}_1 > {c}_2 then '{c}' end" for c in MONO)}) as decreasing from per)
 select * from d where decreasing <> ''""")

DS1S = DS1 + """,
ds1s AS (select ds1.*, cast(s.league_id as bigint) as league_id, s.start_time from ds1 join fx_schedules s on ds1.fixture_id = s.fixture_id)"""
oracle("p02_league_zscore", DS1S + """,
g AS (select league_id, avg(ht_diff_goals) as m1, stddev_samp(ht_diff_goals) as s1, avg(odds_fav) as m2,
        stddev_samp(odds_fav) as s2 from ds1s group by league_id)
 select d.fixture_id, d.league_id, round((d.ht_diff_goals - g.m1) / nullif(g.s1, 0), 9) as z_ht_diff_goals,
   round((d.odds_fav - g.m2) / nullif(g.s2, 0), 9) as z_odds_fav
 from ds1s d join g on d.league_id = g.league_id""")
oracle("p03_handicap_settlement", DS1 + """,
m AS (select fixture_id, cast(case when favorite_location = 'home' then sh_home_goals - sh_away_goals
                                   else sh_away_goals - sh_home_goals end as bigint) as fav_margin_2h
      from f2 where favorite_location is not null),
l AS (select * from (values (-1.0e0), (-1.5e0), (1.0e0), (1.5e0)) v(line))
 select m.fixture_id, m.fav_margin_2h, l.line,
   case when m.fav_margin_2h + l.line > 0 then 'win' when m.fav_margin_2h + l.line = 0 then 'push' else 'lose' end as outcome
 from m, l""")
oracle("p04_walk_forward_folds", DS1S + """,
folds AS (select distinct year(start_time) as fold from ds1s where year(start_time) > (select min(year(start_time)) from ds1s)),
tagged AS (select f.fold, case when year(d.start_time) < f.fold then 'train' when year(d.start_time) = f.fold then 'test' end as role
           from ds1s d, folds f)
 select cast(fold as bigint) as fold, role, count(*) as rows from tagged where role is not null group by fold, role""")
oracle("p04_walk_forward_evaluation", DS1S + f""",
n AS (select year(start_time) as y, count(*) as n, count(*) filter ({TARGET} = 1) as ones from ds1s where start_time is not null group by 1),
f AS (select n.y as fold, n.n as test_rows, (select sum(p.n) from n p where p.y < n.y) as train_rows,
        (select sum(p.ones) from n p where p.y < n.y) as ones from n where n.y > (select min(y) from n))
 select cast(fold as bigint) as fold, cast(train_rows as bigint) as train_rows, test_rows, true as in_time,
   ones > 0 and ones < train_rows as fitted, ones > 0 and ones < train_rows as sound from f""")
oracle("f38_distinct_by_month_sketched", """
 select strftime(s.start_time, '%Y-%m') as month, fs.period, count(*) as rows, count(distinct fs.fixture_id) as fixtures, true as within_error
 from fx_stats fs join fx_schedules s on fs.fixture_id = s.fixture_id where s.start_time is not null group by 1, 2""")
oracle("p04_rolling_window_folds", DS1S + """,
y AS (select distinct year(start_time) as fold from ds1s)
 select cast(fold as bigint) as fold, case when year(start_time) = fold then 'test' else 'train' end as role, count(*) as rows
 from ds1s join y on year(start_time) between fold - 2 and fold
 where fold > (select min(fold) from y) group by all""")
oracle("p04_temporal_split", DS1S + """
 select case when start_time < timestamp '2000-01-01' then 'train' else 'test' end as role, count(*) as rows,
   min(start_time) as first, max(start_time) as last
 from ds1s group by 1""")

SCORED = DS1 + f""",
scored AS (select fixture_id, {TARGET} as label,
             (1 / odds_fav) / (implied_prob_home + implied_prob_draw + implied_prob_away) as p1 from ds1)"""
oracle("p05_calibration", SCORED + """
 select cast(least(floor(p1 * 10) + 1, 10) as bigint) as bin, count(*) as n, round(avg(p1), 9) as mean_prob,
   round(avg(cast(label as double)), 9) as observed_rate from scored group by 1""")
oracle("p05_brier", SCORED + " select round(avg(power(p1 - label, 2)), 9) as brier from scored")
BETS = DS1 + f""",
sc AS (select fixture_id, odds_fav, cast({TARGET} as bigint) as won,
         ((1 / odds_fav) / (implied_prob_home + implied_prob_draw + implied_prob_away)) * 1.1 as p_model from ds1),
e AS (select *, p_model * odds_fav - 1 as edge from sc),
bets AS (select *, least(0.05, greatest(0.0, (edge / nullif(odds_fav - 1, 0)) * 0.25)) as stake from e where edge > 0.05)"""
oracle("p06_value_bets", BETS + """
 select fixture_id, odds_fav, won, round(p_model, 9) as p_model, round(edge, 9) as edge, round(stake, 9) as stake
 from bets""")
oracle("p07_backtest", BETS + """,
pr AS (select *, case when won = 1 then stake * (odds_fav - 1) else -stake end as profit from bets)
 select count(*) as bets, round(sum(stake), 9) as staked, round(sum(profit), 9) as profit,
   round(sum(profit) / nullif(sum(stake), 0), 9) as roi, round(avg(profit) / nullif(stddev_samp(profit), 0), 9) as sharpe
 from pr""")

DS2F = ["odds_ratio", "avg_pressure_index_1st_half", "ht_goals_diff", "ht_fouls_diff", "ht_tackles_diff",
        "ht_shots_total_diff"]
DS2 = SIDED + f""",{PIVOT_MEAN},{AVG_P},
m AS (select p."Home" as home_o, p."Away" as away_o, ap.avg_pressure_index_1st_half, sd.*
      from pivot_mean p join avg_p ap on ap.fixture_id = p.fixture_id join sided sd on sd.fixture_id = p.fixture_id),
fav AS (select *, case when home_o is null or away_o is null then 'Draw' when home_o = away_o then 'Draw'
                       when home_o < away_o then 'Home' else 'Away' end as favorite from m),
feat AS (
  select fixture_id,
    cast(case when not (home_o > 0 and away_o > 0) or home_o is null or away_o is null then null
              when favorite = 'Home' then home_o / away_o when favorite = 'Away' then away_o / home_o else 1.0 end as double) as odds_ratio,
    avg_pressure_index_1st_half,
    cast(ht_home_goals - ht_away_goals as double) as ht_goals_diff,
    cast(ht_home_fouls - ht_away_fouls as double) as ht_fouls_diff,
    cast(ht_home_tackles - ht_away_tackles as double) as ht_tackles_diff,
    cast(ht_home_shots_total - ht_away_shots_total as double) as ht_shots_total_diff,
    case when favorite = 'Draw' then null
         when favorite = 'Home' then (case when (ft_home_score - ht_home_goals) - (ft_away_score - ht_away_goals) > 0.5 then 1 else 0 end)
         when favorite = 'Away' then (case when (ft_away_score - ht_away_goals) - (ft_home_score - ht_home_goals) > 0.5 then 1 else 0 end)
    end as target
  from fav),
ds2 AS (select * from feat where target is not null and odds_ratio is not null and avg_pressure_index_1st_half is not null)"""
oracle("e03_stratified_split_sizes", DS2 + """,
n AS (select target, count(*) as n from ds2 group by target)
 select target, true as is_train, cast(floor(n * 0.8) as bigint) as rows from n where floor(n * 0.8) > 0
 union all select target, false, cast(n - floor(n * 0.8) as bigint) from n where n > floor(n * 0.8)""")
PAIRS = [(a, b) for i, a in enumerate(DS2F) for b in DS2F[i + 1:]]
oracle("p08_correlation_matrix", DS2 + "\n " + "\n union all\n ".join(
    f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 9) as corr from ds2" for a, b in PAIRS))
oracle("p09_population_stability", DS2 + """,
d AS (select ds2.avg_pressure_index_1st_half as v, year(s.start_time) <= 1997 as is_ref
      from ds2 join fx_schedules s on ds2.fixture_id = s.fixture_id),
b AS (select min(v) as lo, max(v) as hi from d where is_ref),
t AS (select case when b.hi = b.lo then 1 else least(greatest(floor((d.v - b.lo) / ((b.hi - b.lo) / 10)) + 1, 1), 10) end as bin,
        d.is_ref from d, b where d.v is not null),
per AS (select bin, sum(case when is_ref then 1 else 0 end) as ref_n, sum(case when not is_ref then 1 else 0 end) as cur_n
        from t group by bin),
tot AS (select sum(case when is_ref then 1 else 0 end) as tr, sum(case when not is_ref then 1 else 0 end) as tc from t),
sh AS (select cast(bin as bigint) as bin, greatest(ref_n / tr, 1e-6) as e, greatest(cur_n / tc, 1e-6) as a from per, tot)
 select bin, round(e, 9) as ref_share, round(a, 9) as cur_share, round((a - e) * ln(a / e), 9) as psi,
   round((select sum((a - e) * ln(a / e)) from sh), 9) as total_psi from sh""")
oracle("p10_ratio_anomalies", """
, r AS (select fs.fixture_id, fs.team_id, cast(s.league_id as bigint) as league_id, cast(fs.shots_insidebox as bigint) as shots_insidebox,
          cast(fs.shots_total as bigint) as shots_total,
          cast(fs.shots_insidebox as double) / nullif(cast(fs.shots_total as double), 0) as ratio
        from fx_stats fs join fx_schedules s on fs.fixture_id = s.fixture_id where fs.period = 'first_half'),
g AS (select league_id, avg(ratio) as m, stddev_samp(ratio) as sd from r group by league_id),
z AS (select r.*, (r.ratio - g.m) / nullif(g.sd, 0) as z from r join g on r.league_id = g.league_id)
 select fixture_id, team_id, league_id, shots_insidebox, shots_total, round(ratio, 9) as ratio, round(z, 9) as z
 from z where abs(z) > 2.0""")
oracle("p11_totals_mismatch", """
, lt AS (select fixture_id, cast(sum(minute) as bigint) as left_total from fx_timeline group by fixture_id),
rt AS (select fixture_id, cast(sum(attacks) * 2 as bigint) as right_total from fx_stats_raw group by fixture_id)
 select coalesce(lt.fixture_id, rt.fixture_id) as fixture_id, lt.left_total, rt.right_total
 from lt full outer join rt on lt.fixture_id = rt.fixture_id
 where lt.left_total is null or rt.right_total is null or abs(lt.left_total - rt.right_total) > 0""")


oracle("a06_upsert_audited", """
 select fixture_id, case status when 'NS' then 'FT' else status end as status,
   case status when 'NS' then 1000 else home_score end as home_score, 2020 as created, status = 'NS' as moved, status <> 'NS' as untouched
 from fx_schedules""")
oracle("a07_insert_ignore_existing", """
 select home_team_id, season_id, min(fixture_id) as fixture_id, arg_min(status, fixture_id) as status
 from fx_schedules group by home_team_id, season_id having bool_and(fixture_id % 2 <> 0)""")
oracle("a08_with_audit", """
 select team_id, name, coalesce(country_id, -1) as country_id, timestamp '2024-01-01' as created_at, timestamp '2024-01-01' as updated_at,
   (select count(distinct team_id) from fx_teams) as distinct_ids
 from fx_teams""")
# A5: what is read back is what was written
ORACLE["a05_dataset_written_and_read"] = ORACLE["d12_dataset_one"]
# A1: landed files hold the same pressure documents as b13
ORACLE["a01_read_landed_pressure_files"] = ORACLE["b13_normalize_load_pressure"]
# every key keeps the document that landed first; the second year landed last
oracle("h1_stream_normalize_pressure_docs", """
, p AS (select l_orderkey as fixture_id, cast(cast(l_quantity as int) * 2 as bigint) as minute,
          cast(l_linenumber % 2 as bigint) as participant_id, l_extendedprice / 1000 as pressure_index,
          l_orderkey * 8 + l_linenumber as api_event_id, l_shipdate from lineitem where l_orderkey % 4 <> 0),
y AS (select distinct year(l_shipdate) as y from p order by 1 limit 1 offset 1),
ranked AS (select *, row_number() over (partition by fixture_id, minute, participant_id
             order by case when year(l_shipdate) = (select y from y) then 1 else 0 end, l_shipdate, api_event_id) as rn from p)
 select fixture_id, minute, participant_id, 'pressure' as event_type, pressure_index, api_event_id,
   cast(null as timestamp) as timestamp, cast(0 as bigint) as state_rows from ranked where rn = 1""")
oracle("a02_latest_stats_snapshot", """
, d AS (select fixture_id, strftime(api_ts, '%Y-%m-%d %H:%M:%S') as fetch_timestamp,
          case period when 'first_half' then '1st-half' when 'second_half' then '2nd-half'
                      when 'extra_time' then 'Extra-Time' else 'Penalties' end as description,
          cast(17 as bigint) as n_statistics
        from fx_stats_raw),
r AS (select *, row_number() over (partition by fixture_id order by fetch_timestamp desc, description desc,
                                   n_statistics desc) as rn from d)
 select fixture_id, fetch_timestamp, description, n_statistics from r where rn = 1""")


# ------------------------------------------------- trainings: what must hold
def _checks(view: str, rows: str, label: str, features: int) -> str:
    """Rows per class (80 of 100 train), and checks that must be true."""
    return view + f""",
c AS (select cast({label} as bigint) as label, count(*) as n from {rows} group by 1),
k AS (select label, cast(floor(n * 0.8e0) as bigint) as train, n - cast(floor(n * 0.8e0) as bigint) as test from c),
t AS (select cast(sum(test) as bigint) as test from k)
 select * from (
   select 'train_rows_' || label as name, train as value from k union all select 'test_rows_' || label, test from k
   union all select x.name, case x.name when 'probabilities' then t.test when 'reloaded_alike' then t.test
     when 'importances_of_features' then cast({features} as bigint) else cast(1 as bigint) end
   from t, (values ('probabilities'), ('reloaded_alike'), ('auc_in_range'), ('log_loss_positive'), ('accuracy_is_confusion'),
                   ('importances_of_features'), ('importances_sum_to_one'), ('trees_within_rounds')) x(name)) r
 where (select count(*) from c) >= 2"""


from pitchlake.operators.features import DS1_TRAIN_FEATURES, DS2_FEATURES  # noqa: E402

oracle("e04_train_gbt_dataset_two", _checks(DS2, "ds2", "target", len(DS2_FEATURES)))
oracle("e05_train_gbt_dataset_one", _checks(DS1, "ds1", TARGET, len(DS1_TRAIN_FEATURES)))
