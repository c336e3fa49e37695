"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry runs one operator (or a chain of them) over the whole test-bed
tables derived from the driver data.  Outputs end with
``normalize_types`` (integers as bigint, floats as double) and round the
double columns whose last bits depend on summation order, so they compare
by value with the SQL oracle in ``plans.oracle``.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake import schema as S
from pitchlake.functions.exprs import normalize_types
from pitchlake.operators import audit as A
from pitchlake.operators import features as D
from pitchlake.operators import worklist as C
from pitchlake.sources.tables import stored_testbed

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

HT11 = list(S.REQUIRED_HT_STATS)
# first-half statistics described by F25/F26/F27
DESCRIBE_COLS = ["goals", "shots_on_target", "shots_total", "ball_possession", "fouls", "red_cards",
                 "attacks", "shots_insidebox", "saves", "shots_off_target", "passes", "corners", "yellow_cards",
                 "challenges"]


def _finish(df: DataFrame, noisy: Sequence[str] = ()) -> DataFrame:
    df = normalize_types(df)
    if noisy:
        df = df.select(*[F.round(F.col(c), 9).alias(c) if c in noisy else F.col(c) for c in df.columns])
    return df


def register(name: str, noisy: Sequence[str] = ()):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _finish(fn(stored_testbed(spark, sf_dir)), noisy)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


# ---------------------------------------------------------------- datasets
@register("d01_valid_fixtures")
def _(t):
    return D.valid_fixtures(t.stats)


@register("d02_base_rows")
def _(t):
    return D.base_rows(t.schedules, t.stats, t.odds)


@register("d09_target_balance")
def _(t):
    return D.target_balance(D.dataset_one(t.schedules, t.stats, t.odds))


@register("d10_rows_with_missing_stats")
def _(t):
    rest = [s for s in HT11 if s != "goals"]
    return D.rows_with_missing(D.base_rows(t.schedules, t.stats, t.odds).dropna(
        subset=["odds_home", "odds_draw", "odds_away"]),
        [f"ht_{side}_{s}" for s in rest for side in ("home", "away")])


@register("d12_dataset_one")
def _(t):
    return D.dataset_one(t.schedules, t.stats, t.odds)


@register("d13_fixtures_with_timeline")
def _(t):
    return D.with_timeline(t.schedules.select("fixture_id", "status"), t.timeline)


@register("d14_pivot_odds_mean")
def _(t):
    return D.pivot_odds(t.odds, rule="mean", names=["Home", "Draw", "Away"]).dropna(subset=["Home", "Away"])


@register("d15_ft_scores")
def _(t):
    return D.ft_scores(t.schedules)


@register("d16_ht_team_totals")
def _(t):
    return D.ht_team_totals(t.stats)


@register("d17_attach_sides")
def _(t):
    return D.attach_sides(D.ft_scores(t.schedules), D.ht_team_rows(t.stats), D.DS2_STATS,
                          "ht_home_", "ht_away_", how="sum", fill=0)


@register("d18_avg_pressure", noisy=["avg_pressure_index_1st_half"])
def _(t):
    return D.avg_pressure(t.timeline)


@register("d24_dataset_two", noisy=["avg_pressure_index_1st_half"])
def _(t):
    return D.dataset_two(t.schedules, t.stats, t.odds, t.timeline)


@register("d25_fixture_with_stats")
def _(t):
    return D.fixture_with_stats(t.schedules, t.stats, ["goals", "shots_total", "ball_possession"])


# --------------------------------------------------------------- work lists
@register("c01_open_seasons")
def _(t):
    return C.open_seasons(C.season_flags(t.seasons))


@register("c02_pending_stats")
def _(t):
    return C.pending(t.schedules, t.stats, S.FINISHED_STATS, order="fixture_id", numbered=True)


@register("c03_pending_odds")
def _(t):
    # every 17th fixture is taken as not priced yet
    return C.pending(t.schedules, t.odds.filter(F.col("fixture_id") % 17 != 5), S.FINISHED_ODDS, order="start_time", numbered=True)


@register("c04_pending_pressure")
def _(t):
    return C.pending(t.schedules, t.timeline.filter(F.col("event_type") == "pressure"),
                     S.FINISHED_PRESSURE, order="start_time", numbered=True)


@register("c05_pending_without_done")
def _(t):
    return C.pending(t.schedules, None, S.FINISHED_PRESSURE, order="start_time", numbered=True)


# ------------------------------------------------------------------ audits
@register("f00_table_overview")
def _(t):
    return A.table_overview({"leagues": t.leagues, "seasons": t.seasons, "teams": t.teams,
                             "schedules": t.schedules, "fixture_stats": t.stats, "fixture_odds": t.odds,
                             "fixture_timeline": t.timeline}, S.KEYS)


@register("f01_group_counts")
def _(t):
    return A.group_counts(t.schedules, t.leagues, t.seasons)


@register("f02_count_summary")
def _(t):
    return A.summary(A.group_counts(t.schedules, t.leagues, t.seasons), "fixture_count")


@register("f03_histogram")
def _(t):
    return A.histogram(t.raw("lineitem"), "l_extendedprice", 20)


@register("f04_small_groups")
def _(t):
    return A.small_groups(A.group_counts(t.schedules, t.leagues, t.seasons), 80)


@register("f05_missing_stats")
def _(t):
    return A.missing_children(t.schedules, t.stats, t.leagues, t.seasons, t.teams)


@register("f06_missing_rate")
def _(t):
    return A.missing_rate(t.schedules, t.stats)


@register("f07_missing_by_league")
def _(t):
    return A.missing_by(A.missing_children(t.schedules, t.stats, t.leagues, t.seasons, t.teams))


@register("f08_missing_first_half")
def _(t):
    return A.missing_category(t.stats, t.schedules, t.leagues)


@register("f09_first_half_rate")
def _(t):
    return A.distinct_rate(t.stats)


@register("f10_period_combinations")
def _(t):
    return A.combo_counts(A.missing_category(t.stats, t.schedules, t.leagues))


@register("f11_team_count_violations")
def _(t):
    return A.member_count_violations(t.stats)


@register("f11_team_count_rate")
def _(t):
    return A.member_count_rate(t.stats)


@register("f12_drill_down")
def _(t):
    return A.drill_down(t.stats, t.schedules, t.teams, A.member_count_violations(t.stats))


@register("f13_null_profile")
def _(t):
    return A.null_profile(t.stats.filter(F.col("period") == S.FIRST_HALF), HT11)


@register("f14_all_null_rows")
def _(t):
    return A.all_null_rows(t.stats, t.schedules, t.teams, HT11)


@register("f15_side_balance")
def _(t):
    return A.side_balance(t.schedules, t.seasons, t.teams, 10)


@register("f16_balance_summary")
def _(t):
    return A.balance_summary(A.side_balance(t.schedules, t.seasons, t.teams, 10))


@register("f17_orphans")
def _(t):
    return A.orphans({"fixture_stats": t.stats, "fixture_odds": t.odds, "fixture_timeline": t.timeline},
                     t.schedules)


@register("f18_non_member")
def _(t):
    return A.non_member(t.stats, t.schedules)


@register("f18_non_member_examples")
def _(t):
    return A.non_member_examples(t.stats, t.schedules, t.teams, 10)


@register("f19_duplicate_keys")
def _(t):
    return A.duplicates(t.stats_raw, ["fixture_id", "team_id", "period"])


@register("f19_duplicate_drill")
def _(t):
    return A.duplicate_drill(t.stats_raw, ["fixture_id", "team_id", "period"])


@register("f20_duplicate_odds")
def _(t):
    # the full 6-column odds key; the test bed has no handicap/total lines,
    # so those key parts are NULL and must group together
    odds = t.odds.withColumn("handicap", F.lit(None).cast("double")).withColumn("total", F.lit(None).cast("double"))
    return A.duplicates(odds, S.KEYS["fixture_odds"])


ORDERS_EXPECTED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "int",
                   "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_clerk": "string"}


@register("f21_conformance")
def _(t):
    return A.conformance(t.raw("orders"), ORDERS_EXPECTED, "orders")


@register("f22_audit_times")
def _(t):
    o = t.raw("orders").select(F.col("o_orderdate").alias("created_at"),
                               F.expr("timestampadd(DAY, o_orderkey % 3 - 1, o_orderdate)").alias("updated_at"))
    li = t.raw("lineitem").select(F.col("l_shipdate").alias("created_at"), F.col("l_shipdate").alias("updated_at"))
    return A.audit_times({"orders": o, "lineitem": li})


@register("f23_time_range")
def _(t):
    return A.time_range(t.raw("events"), "ts")


@register("f24_per_day")
def _(t):
    return A.per_day(t.raw("events"), "ts")


def _fh_goals(t):
    return t.stats.filter((F.col("period") == S.FIRST_HALF) & F.col("goals").isNotNull())


@register("f25_describe", noisy=["mean", "std"])
def _(t):
    return A.describe_wide(_fh_goals(t), DESCRIBE_COLS)


@register("f26_iqr_outliers")
def _(t):
    return A.iqr_outliers(_fh_goals(t), ["fixture_id", "team_id"], DESCRIBE_COLS, 3.0)


@register("f27_box_stats")
def _(t):
    return A.box_stats(_fh_goals(t), DESCRIBE_COLS)


@register("f28_range_violations")
def _(t):
    return A.range_violations(t.stats, t.teams)


@register("f29_rule_violations")
def _(t):
    return A.rule_violations(t.stats)


@register("f29_rule_examples")
def _(t):
    return A.rule_examples(t.stats, t.teams)


@register("f30_possession_pairs")
def _(t):
    return A.pair_sum_check(t.stats, t.teams)


@register("f31_score_mismatch")
def _(t):
    return A.detail_vs_summary(t.stats, t.schedules, numbered=True)


@register("f32_mismatch_summary", noisy=["avg_home_diff", "avg_away_diff"])
def _(t):
    return A.mismatch_summary(t.stats, t.schedules)


@register("f33_coverage_by_league")
def _(t):
    return A.coverage_by_league(t.schedules, t.stats, t.leagues)


@register("f33_coverage_overall", noisy=["weighted_first_half_coverage_pct"])
def _(t):
    return A.coverage_overall(A.coverage_by_league(t.schedules, t.stats, t.leagues))


@register("f34_means_by_league")
def _(t):
    return A.means_by_league(t.stats, t.schedules, t.leagues)


@register("f35_trend", noisy=["slope", "intercept", "mean", "std"])
def _(t):
    return A.trend(A.means_by_league(t.stats, t.schedules, t.leagues))


@register("f35_above_mean_sd")
def _(t):
    return A.above_mean_sd(A.means_by_league(t.stats, t.schedules, t.leagues))


@register("f36_side_bias")
def _(t):
    return A.side_bias(t.stats, t.schedules)


@register("f37_side_comparison", noisy=["home", "away", "difference"])
def _(t):
    return A.side_comparison(A.side_bias(t.stats, t.schedules))


@register("f38_coverage_by_month")
def _(t):
    return A.coverage_by_month(t.schedules, t.stats)


@register("f39_coverage_by_weekday")
def _(t):
    return A.coverage_by_weekday(t.schedules, t.stats)


@register("f40_coverage_by_hour")
def _(t):
    # order dates carry no time: fixtures are spread over the day by their id
    hours = F.make_dt_interval(hours=F.col("fixture_id") % 24)
    return A.coverage_by_hour(t.schedules.withColumn("start_time", F.col("start_time") + hours), t.stats)


@register("f41_scenario_coverage")
def _(t):
    return A.scenario_coverage(t.schedules, t.stats)


@register("f42_unplayed_with_stats")
def _(t):
    return A.unplayed_with_stats(t.schedules, t.stats, t.teams)


def _quality(t):
    return A.quality_score(t.stats, t.schedules, t.leagues, t.seasons)


@register("f43_quality_score")
def _(t):
    return _quality(t)


@register("f44_category_share")
def _(t):
    return A.category_share(_quality(t))


@register("f45_league_quality", noisy=["avg_quality_score"])
def _(t):
    return A.league_quality(_quality(t))


@register("f46_quality_report", noisy=["value"])
def _(t):
    q = _quality(t)
    return A.quality_report(q, A.league_quality(q))


@register("f47_league_badges", noisy=["avg_quality_score"])
def _(t):
    return A.league_badges(A.league_quality(_quality(t)))


@register("f48_error_register")
def _(t):
    return A.error_register(t.stats, t.schedules)


@register("f50_incomplete_fixtures")
def _(t):
    return A.incomplete_fixtures(t.stats)


# ------------------------------------------------------------------ ingest
from pitchlake.operators import normalize as B  # noqa: E402
from pitchlake.plans import landing as LD  # noqa: E402
from pitchlake.sources import raw as R  # noqa: E402
from pitchlake.sources import sinks as K  # noqa: E402
from pitchlake.sources.versions import VersionedTable  # noqa: E402

CURATED_STATS = ["fixture_id", "team_id", "period", *S.STAT_COLUMNS, "timestamp"]
CURATED_ODDS = [f.name for f in S.FIXTURE_ODDS.fields]
CURATED_TIMELINE = [f.name for f in S.FIXTURE_TIMELINE.fields]


def _leagues_raw(t):
    return R.parse_documents(LD.league_documents(t), "leagues")


@register("b01_normalize_leagues")
def _(t):
    return B.normalize_leagues(_leagues_raw(t))[0]


@register("b01_rejected_leagues")
def _(t):
    return B.normalize_leagues(_leagues_raw(t))[1].select("league_id", "name", "reject_reason")


@register("b02_normalize_seasons")
def _(t):
    return B.normalize_seasons(_leagues_raw(t))[0]


@register("b03_normalize_teams")
def _(t):
    return B.normalize_teams(R.parse_documents(LD.team_documents(t), "teams"))[0]


def _schedules(t):
    return B.normalize_schedules(R.parse_documents(LD.schedule_documents(t), "schedules"))[0]


@register("b04_normalize_schedules")
def _(t):
    return _schedules(t).drop("fetch_timestamp")


@register("a05_dataset_written_and_read")
def _(t):
    """Dataset 1 written and read back with its schema."""
    ds = D.dataset_one(t.schedules, t.stats, t.odds)
    path = H.stream_dir(t.spark, "a05")
    K.write_dataset(ds, path)
    return K.read_dataset(t.spark, path, ds.schema)


@register("a06_upsert_schedules")
def _(t):
    v1 = _schedules(t)
    batch = (v1.filter(F.col("status") == "NS")
             .withColumn("status", F.lit("FT")).withColumn("home_score", F.lit(1))
             .withColumn("away_score", F.lit(0)).withColumn("result", F.lit("H"))
             .withColumn("fetch_timestamp", F.lit("2099-01-01 00:00:00")))
    table = _table(t, "schedules", v1, ["fixture_id"])
    table.upsert(v1, order="fetch_timestamp")
    table.upsert(batch, order="fetch_timestamp")
    return table.read().drop("fetch_timestamp")


def _table(t, name, like, key):
    """An empty versioned table with the columns of ``like``."""
    return VersionedTable.create(t.spark, H.stream_dir(t.spark, f"table-{name}"), like.schema, key, buckets=16)


def _stats_raw(t):
    return R.parse_documents(LD.stats_documents(t), "stats")


def _load_stats(t):
    rows, _ = B.normalize_stats(_stats_raw(t))
    order = ["fetch_timestamp", *[c for c in rows.columns if c not in ("fetch_timestamp", "fixture_id", "team_id",
                                                                      "period")]]
    return K.insert_ignore(None, rows, ["fixture_id", "team_id", "period"], order=order)


@register("b10_normalize_load_stats")
def _(t):
    return _load_stats(t).select(*CURATED_STATS)


@register("b11_coercion_failures")
def _(t):
    return B.coercion_failures(R.parse_documents(LD.stats_documents(t, spoiled=True), "stats"))


@register("b04_rejected_schedules")
def _(t):
    raw = R.parse_documents(LD.schedule_documents(t, spoiled=True), "schedules")
    return B.normalize_schedules(raw)[1].select("fixture_id", "season_id", "reject_reason")


@register("b12_normalize_load_odds")
def _(t):
    ok, _, _ = B.normalize_odds(R.parse_documents(LD.odds_documents(t), "odds"))
    return K.insert_ignore(None, ok, S.KEYS["fixture_odds"], order=["fetch_timestamp", "value"]).select(*CURATED_ODDS)


@register("b12_filtered_odds")
def _(t):
    _, _, filtered = B.normalize_odds(R.parse_documents(LD.odds_documents(t), "odds"))
    return filtered.groupBy(F.col("bookmaker_id")).agg(F.count(F.lit(1)).alias("filtered"))


@register("b12_rejected_odds")
def _(t):
    _, bad, _ = B.normalize_odds(R.parse_documents(LD.odds_documents(t, spoiled=True), "odds"))
    return bad.select("fixture_id", "market_id", "bookmaker_id", "label", "value", "reject_reason")


@register("b13_rejected_pressure")
def _(t):
    bad = B.normalize_pressure(R.parse_documents(LD.pressure_documents(t, spoiled=True), "pressure"))[1]
    return bad.select("fixture_id", "api_event_id", "minute", "participant_id", "pressure_index", "reject_reason")


@register("b13_normalize_load_pressure")
def _(t):
    ok, _ = B.normalize_pressure(R.parse_documents(LD.pressure_documents(t), "pressure"))
    return K.insert_ignore(None, ok, S.KEYS["fixture_timeline"],
                           order=["fetch_timestamp", "api_event_id"]).select(*CURATED_TIMELINE)


@register("a09_load_report_stats")
def _(t):
    # stored: each of the four counts reads it, and no document is built or parsed again
    docs = K.checkpoint_table(R.parse_documents(LD.stats_documents(t, gaps=True), "stats"), "a09")
    rows, bad_periods = B.normalize_stats(docs)
    stored = K.insert_ignore(None, rows, ["fixture_id", "team_id", "period"], order=["fetch_timestamp"])
    return K.load_report(docs, stored, bad_periods, B.empty_documents(docs))


@register("a06_upsert_audited")
def _(t):
    """Two updates of every unplayed fixture, ordered by an integer that
    crosses 9/10; the stamps of untouched rows must not move."""
    stamp = lambda d: F.lit(d).cast("timestamp")
    v1 = t.schedules.select("fixture_id", "status", "home_score", stamp("2020-01-01").alias("created_at"),
                            stamp("2023-01-01").alias("updated_at"))
    ns = v1.filter(F.col("status") == "NS").select("fixture_id", F.lit("FT").alias("status"))
    batch = ns.withColumn("seq", F.explode(F.array(F.lit(10), F.lit(9)))).withColumn("home_score", F.col("seq") * 100)
    table = _table(t, "schedules-audited", v1, ["fixture_id"])
    table.insert_ignore(v1)     # keeps the stamps it is given
    table.upsert(batch, order="seq", audit=True)
    return table.read().select("fixture_id", "status", "home_score", F.year("created_at").alias("created"),
                      (F.year("updated_at") > 2023).alias("moved"), (F.year("updated_at") == 2023).alias("untouched"))


@register("a07_insert_ignore_existing")
def _(t):
    """First fixture per home team and season, for the pairs that no
    even-numbered fixture has loaded before."""
    key = ["home_team_id", "season_id"]
    loaded = t.schedules.filter(F.col("fixture_id") % 2 == 0)
    return K.insert_ignore(loaded, t.schedules, key, order=["fixture_id"]).select(*key, "fixture_id", "status")


@register("a08_with_audit")
def _(t):
    """All but the id, whose values are Spark's hash; that they are as many
    as the rows is checked."""
    out = K.with_audit(t.teams, key=["team_id"], defaults={"country_id": -1}, ts="2024-01-01 00:00:00")
    return out.drop("id").withColumn("distinct_ids", out.select(F.count_distinct("id")).scalar())


# ------------------------------------------------------------------- model
from pitchlake.operators import model as E  # noqa: E402


def _baseline_scored(t):
    """Dataset 1 scored by a fixed rule: the favourite's share of the
    implied probabilities is the probability that it covers."""
    ds = D.dataset_one(t.schedules, t.stats, t.odds)
    p = F.try_divide(F.try_divide(F.lit(1.0), F.col("odds_fav")),
                     F.col("implied_prob_home") + F.col("implied_prob_draw") + F.col("implied_prob_away"))
    return ds.select("fixture_id", F.col(D.target_name()).alias("label"), p.alias("p1")).withColumn(
        "prediction", (F.col("p1") >= 0.5).cast("int"))


@register("e01_clean_features_report")
def _(t):
    ds = D.dataset_one(t.schedules, t.stats, t.odds)
    return E.clean_features(ds, D.ds1_feature_names())[1]


@register("e02_class_share")
def _(t):
    return E.class_share(D.dataset_one(t.schedules, t.stats, t.odds), D.target_name())


@register("e03_stratified_split_sizes")
def _(t):
    ds = D.dataset_two(t.schedules, t.stats, t.odds, t.timeline)
    return E.stratified_split(ds, "target").groupBy("target", "is_train").agg(F.count(F.lit(1)).alias("rows"))


@register("e07_baseline_metrics", noisy=["log_loss"])
def _(t):
    return E.binary_metrics(_baseline_scored(t))


@register("e10_baseline_confusion")
def _(t):
    return E.confusion(_baseline_scored(t))


@register("e11_baseline_class_report", noisy=["precision", "recall", "f1"])
def _(t):
    return E.class_report(_baseline_scored(t))


@register("e04_train_gbt_dataset_two")
def _(t):
    ds = D.dataset_two(t.schedules, t.stats, t.odds, t.timeline).withColumnRenamed("target", "label")
    return _training_checks(t, ds, D.DS2_FEATURES, E.PRESSURE_PARAMS, "e04", early_stopping=False)


def _training_checks(t, ds, features, params, name, early_stopping):
    """Train on ``ds`` and return what must hold of the result."""
    ds = K.checkpoint_table(ds, name)  # every fit and metric reads it, none derives it again
    res = E.train_and_evaluate(ds, features, "label", params, early_stopping=early_stopping)
    if res["model"] is None:
        return t.spark.createDataFrame([], "name string, value long")
    res["predictions"] = K.checkpoint_table(res["predictions"], f"{name}-scored")
    return E.training_checks(res, features, params["rounds"], H.stream_dir(t.spark, f"{name}-model"))


@register("e05_train_gbt_dataset_one")
def _(t):
    """Dataset 1, training subset of features, baseline parameters, early
    stopping on a validation slice of the training rows."""
    ds = D.dataset_one(t.schedules, t.stats, t.odds).withColumnRenamed(D.target_name(), "label")
    return _training_checks(t, ds, D.DS1_TRAIN_FEATURES, E.BASELINE_PARAMS, "e05", early_stopping=True)


# --------------------------------------------------------------- streaming
from pitchlake.streaming import jobs as H  # noqa: E402


EVENT_PARTS = 6


def _event_parts(events):
    """The events in EVENT_PARTS parts in time order."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    edges = events.select(F.percentile_approx(micros, [k / EVENT_PARTS for k in range(1, EVENT_PARTS)])).first()[0]
    return [events.filter(c) for c in [micros <= edges[0], *[(micros > lo) & (micros <= hi) for lo, hi in zip(edges, edges[1:])],
                                       micros > edges[-1]]]


def _landed_events(t, name, job, **kw):
    """Run ``job`` (a streaming transformation) over the events as they land:
    six parts in time order, one run each, all from one checkpoint, so state
    and sinks meet rows of earlier runs; then the third part lands again,
    late and replayed."""
    spark, events = t.spark, t.raw("events")
    base = H.stream_dir(spark, name)
    parts = _event_parts(events)
    for part in [*parts, parts[2]]:
        part.write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/landing")
        out = H.run_available_now(job(stream), name, base=base, **kw)
    return out


@register("h1_stream_dedupe_events")
def _(t):
    return _landed_events(t, "h1", lambda s: H.dedupe_stream(s, ["event_id"], "ts", "1 day").select(
        "event_id", "ts", "user_id", "event_type", "value"))


@register("h1_stream_dedupe_counts")
def _(t):
    """The events land in parts and then all of them once more: what was
    kept, and what of the repetition was a duplicate or too late."""
    spark, events = t.spark, t.raw("events")
    base = H.stream_dir(spark, "h1-counts")
    for part in [*_event_parts(events), events]:
        part.write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/landing")
        out, counts = H.run_counted(stream, lambda s: H.dedupe_stream(s, ["event_id"], "ts", "1 day"), "h1-counts", base=base)
    total = counts.agg(*[F.sum(c).alias(c) for c in ("landed", "kept", "duplicates", "late")])
    return total.withColumn("stored", out.select(F.count(F.lit(1))).scalar())


@register("h1_stream_normalize_pressure_docs")
def _(t):
    """Pressure documents landed year by year of their fetch time, the first
    year again, and the second year last of all: streamed, normalised and
    loaded first-wins, with no state held."""
    spark = t.spark
    base = H.stream_dir(spark, "h1-docs")
    docs = LD.pressure_documents(t).withColumn("year", F.substring(F.get_json_object("doc", "$.fetch_timestamp"), 1, 4))
    docs = K.checkpoint_table(docs, "h1-docs")
    years = [r.year for r in docs.select("year").distinct().orderBy("year").collect()]  # a few
    sink = H.first_wins_sink(f"{base}/table", H.TIMELINE_KEY, ["fetch_timestamp", "api_event_id"], buckets=8)
    for year in [*years[:1], *years[2:], years[0], *years[1:2]]:
        docs.filter(F.col("year") == year).select("doc").write.mode("append").text(f"{base}/landing")
        stream = H.normalized_pressure_stream(spark, f"{base}/landing")
        out, counts = H.run_counted(stream, lambda s: s, "h1-docs", base=base, foreach_batch=sink, out_path=f"{base}/table")
    held = counts.select(F.max("state_rows")).scalar()
    return out.select(*CURATED_TIMELINE).withColumn("state_rows", held)


@register("h2_stream_window_mean", noisy=["avg_value"])
def _(t):
    return _landed_events(t, "h2", lambda s: H.windowed_mean(s, "ts", "event_type", "value"))


@register("h3_stream_first_wins_sink")
def _(t):
    path = H.stream_dir(t.spark, "h3") + "/table"
    sink = H.first_wins_sink(path, ["user_id", "event_type"], ["ts", "event_id"])
    return _landed_events(t, "h3", lambda s: s.select("user_id", "event_type", "ts", "event_id", "value"),
                          foreach_batch=sink, out_path=path).drop(H.BUCKET)


@register("h4_stream_quality_monitor", noisy=["max_null_rate"])
def _(t):
    return _landed_events(t, "h4", lambda s: H.quality_monitor(s, "ts", ["user_id", "value", "props"],
                                                               rules={"odd_value": "value > 100 or value < 0"}))


# ------------------------------------------------------------ plan-only ops
from pitchlake.operators import increments as IN  # noqa: E402
from pitchlake.operators import planned as PL  # noqa: E402


MONOTONIC = ["goals", "shots_total", "attacks"]


@register("f49_validation_summary", noisy=["value"])
def _(t):
    q = _quality(t)
    return A.validation_summary(
        q, A.league_quality(q), A.missing_rate(t.schedules, t.stats), A.member_count_rate(t.stats),
        A.null_profile(t.stats.filter(F.col("period") == S.FIRST_HALF), HT11), A.non_member(t.stats, t.schedules),
        A.duplicates(t.stats, ["fixture_id", "team_id", "period"]), A.mismatch_summary(t.stats, t.schedules),
        A.coverage_by_league(t.schedules, t.stats, t.leagues), PL.period_monotonic(t.stats, MONOTONIC),
        t.stats.filter(F.col("period").isin(S.FIRST_HALF, S.SECOND_HALF)).groupBy("fixture_id", "team_id")
        .agg(F.count_distinct("period").alias("n")).filter("n = 2"), A.error_register(t.stats, t.schedules))


def _ds1_with_season(t):
    ds = D.dataset_one(t.schedules, t.stats, t.odds)
    return ds.join(t.schedules.select("fixture_id", "league_id", "start_time"), "fixture_id")


@register("p01_period_monotonic")
def _(t):
    return PL.period_monotonic(t.stats, MONOTONIC)


@register("p02_league_zscore", noisy=["z_ht_diff_goals", "z_odds_fav"])
def _(t):
    return PL.league_zscore(_ds1_with_season(t), "league_id", ["ht_diff_goals", "odds_fav"]).select(
        "fixture_id", "league_id", "z_ht_diff_goals", "z_odds_fav")


def _fav_margin(t):
    df = D.base_rows(t.schedules, t.stats, t.odds)
    df = D.favourite_three_way(D.require_numeric(df, ["odds_home", "odds_draw", "odds_away"]))
    df = D.second_half_goals(df).filter(F.col("favorite_location").isNotNull())
    return df.select("fixture_id", D.favourite_margin(F.col("favorite_location"), F.col("sh_home_goals"),
                                                      F.col("sh_away_goals")).alias("fav_margin_2h"))


@register("p03_handicap_settlement")
def _(t):
    return PL.handicap_settlement(_fav_margin(t), "fav_margin_2h")


@register("p04_walk_forward_folds")
def _(t):
    f = PL.walk_forward_folds(_ds1_with_season(t), "start_time")
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("rows"))


@register("p04_walk_forward_evaluation")
def _(t):
    """A short fit per fold of dataset 1; what holds of its rows and metrics."""
    e = E.walk_forward(_ds1_with_season(t), D.DS1_TRAIN_FEATURES, D.target_name(), "start_time", {"rounds": 2, "max_depth": 3})
    fitted = F.col("trees").isNotNull()
    return e.select("fold", "train_rows", "test_rows", (F.col("newest_train") < F.col("oldest_test")).alias("in_time"), fitted.alias("fitted"),
                    (fitted & (F.col("trees") == 2) & F.col("accuracy").between(0, 1) & F.col("auc").between(0, 1) & (F.col("log_loss") > 0)).alias("sound"))


@register("f38_distinct_by_month_sketched")
def _(t):
    """Fixtures with statistics per month, from stored daily sketches: rows
    exact, distinct fixtures within the sketches' error of the exact number."""
    rows = t.stats.select("fixture_id", "period").join(t.schedules.select("fixture_id", "start_time"), "fixture_id")
    days = K.checkpoint_table(IN.daily_sketches(rows, "start_time", ["period"], "fixture_id"), "daily-sketches")
    months = IN.merged(days, [F.trunc("day", "month").alias("month"), "period"])
    exact = rows.groupBy(F.trunc(F.to_date("start_time"), "month").alias("_month"), F.col("period").alias("_period")).agg(
        F.count_distinct("fixture_id").alias("fixtures"))
    near = F.abs(F.col("distinct_items") - F.col("fixtures")) <= F.greatest(F.lit(1.0), IN.error() * F.col("fixtures"))
    return (months.join(exact, (F.col("month") == F.col("_month")) & (F.col("period") == F.col("_period")))
            .select(F.date_format("month", "yyyy-MM").alias("month"), "period", "rows", "fixtures", near.alias("within_error")))


@register("p04_rolling_window_folds")
def _(t):
    f = PL.walk_forward_folds(_ds1_with_season(t), "start_time", window=2)
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("rows"))


@register("p04_temporal_split")
def _(t):
    s = PL.temporal_split(_ds1_with_season(t), "start_time", "2000-01-01")
    return s.groupBy("role").agg(F.count(F.lit(1)).alias("rows"), F.min("start_time").alias("first"), F.max("start_time").alias("last"))


@register("p05_calibration", noisy=["mean_prob", "observed_rate"])
def _(t):
    return PL.calibration(_baseline_scored(t))


@register("p05_brier", noisy=["brier"])
def _(t):
    return PL.brier(_baseline_scored(t))


def _bets(t):
    ds = D.dataset_one(t.schedules, t.stats, t.odds)
    p = F.try_divide(F.try_divide(F.lit(1.0), F.col("odds_fav")),
                     F.col("implied_prob_home") + F.col("implied_prob_draw") + F.col("implied_prob_away"))
    scored = ds.select("fixture_id", "odds_fav", F.col(D.target_name()).alias("won"), (p * 1.1).alias("p_model"))
    return PL.value_bets(scored, "p_model", "odds_fav", 0.05, 0.25, 0.05)


@register("p06_value_bets", noisy=["edge", "stake", "p_model"])
def _(t):
    return _bets(t)


@register("p07_backtest", noisy=["staked", "profit", "roi", "sharpe"])
def _(t):
    return PL.backtest(_bets(t), "odds_fav", "won")


@register("p08_correlation_matrix", noisy=["corr"])
def _(t):
    return PL.correlation_matrix(D.dataset_two(t.schedules, t.stats, t.odds, t.timeline), D.DS2_FEATURES)


@register("p09_population_stability", noisy=["ref_share", "cur_share", "psi", "total_psi"])
def _(t):
    ds = D.dataset_two(t.schedules, t.stats, t.odds, t.timeline).join(
        t.schedules.select("fixture_id", "start_time"), "fixture_id")
    return PL.population_stability(ds, "avg_pressure_index_1st_half", F.year("start_time") <= 1997, 10)


@register("p10_ratio_anomalies", noisy=["ratio", "z"])
def _(t):
    rows = t.stats.filter(F.col("period") == S.FIRST_HALF).join(t.schedules.select("fixture_id", "league_id"),
                                                                "fixture_id")
    return PL.ratio_anomalies(rows.select("fixture_id", "team_id", "league_id", "shots_insidebox", "shots_total"),
                              "league_id", "shots_insidebox", "shots_total", 2.0)


@register("p11_totals_mismatch")
def _(t):
    # a pressure row's minute is twice the attacks of the statistics row it
    # comes from, so totals differ where attacks are missing
    return PL.totals_mismatch(t.timeline, t.stats_raw, "fixture_id", F.col("minute"), F.col("attacks") * 2, 0.0)


@register("a02_latest_stats_snapshot")
def _(t):
    """Newest landed statistics document per fixture (ties: larger period
    description, then more statistics)."""
    first = F.get(F.col("fixture_data_with_stats.data.periods"), 0)
    description, n = first["description"], F.size(first["statistics"])
    # whole documents are kept, VARIANT values included; then described
    newest = R.latest_snapshot(_stats_raw(t), "fixture_id", ties=[description, n])
    return newest.select("fixture_id", "fetch_timestamp", description.alias("description"), n.alias("n_statistics"))


# ------------------------------------------------- landed files (A1 path)
@register("a01_read_landed_pressure_files")
def _(t):
    """Pressure documents landed as JSON-lines files in the shared folder,
    read back with the fixed schema, normalised and loaded first-wins."""
    import hashlib

    from pitchlake.session import checkpoint_dir
    spark = t.spark
    tag = hashlib.sha1(t.dir.encode()).hexdigest()[:12]
    path = f"{checkpoint_dir(spark).rstrip('/')}/landing/{spark.sparkContext.applicationId}/{tag}/pressure"
    LD.pressure_documents(t).write.mode("overwrite").text(path)
    raw = R.read_raw(spark, path, "pressure", multiline=False)
    ok, _ = B.normalize_pressure(raw)
    return K.insert_ignore(None, ok, S.KEYS["fixture_timeline"],
                           order=["fetch_timestamp", "api_event_id"]).select(*CURATED_TIMELINE)
