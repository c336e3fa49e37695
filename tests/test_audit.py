"""Audit jobs: known counts, all-scenario output, plan shape (no nested
loops or cartesian products, no Python UDFs anywhere)."""

import pytest

from __spark_entry__ import queries
from pitchlake import schema as S
from pitchlake.operators import audit as A
from tests.conftest import SF_SMALL


def test_quality_categories_match_fixture_notes(bed_mid):
    q = A.quality_score(bed_mid.stats, bed_mid.schedules, bed_mid.leagues, bed_mid.seasons)
    got = {r.quality_category: r[1] for r in q.groupBy("quality_category").count().collect()}
    assert got == {S.Q_CRIT_TEAM: 7210, S.Q_EXCELLENT: 2277, S.Q_GOOD: 567, S.Q_FAIR: 137, S.Q_POOR: 12,
                   S.Q_CRIT_NULL: 2}


def test_known_audit_counts(bed_mid):
    assert A.all_null_rows(bed_mid.stats, bed_mid.schedules, bed_mid.teams, S.REQUIRED_HT_STATS).count() == 329
    nm = A.non_member(bed_mid.stats, bed_mid.schedules).first()
    assert nm.inconsistent_team_ids == 1204
    assert A.duplicates(bed_mid.stats_raw, ["fixture_id", "team_id", "period"]).count() == 11404
    assert A.missing_category(bed_mid.stats, bed_mid.schedules, bed_mid.leagues).count() == 4538
    assert A.missing_children(bed_mid.schedules, bed_mid.stats).count() == 124


def test_scenarios_always_six_rows(bed_mid):
    out = A.scenario_coverage(bed_mid.schedules, bed_mid.stats).collect()
    assert [r.scenario for r in out] == A.SCENARIOS
    extra = [r for r in out if r.scenario == "Extra Time"][0]
    assert extra.fixture_count == 0 and extra.stats_coverage_pct is None


def test_pair_check_keeps_every_fixture(spark):
    rows = [(1, 10, "first_half", 60.0), (1, 11, "first_half", 50.0),
            (2, 10, "first_half", 90.0), (2, 11, "first_half", 50.0), (2, 12, "first_half", 60.0), (3, 10, "first_half", 99.0)]
    st = spark.createDataFrame(rows, "fixture_id long, team_id long, period string, ball_possession double")
    out = sorted((r.fixture_id, r.team_count, r.team1_id, r.team2_id, r.value_sum) for r in A.pair_sum(st).collect())
    assert out == [(1, 2, 10, 11, 110.0), (2, 3, 10, 12, 200.0)]


def test_rules_without_their_columns_are_an_error(spark):
    st = spark.createDataFrame([(1, 10, "first_half", 1)], "fixture_id long, team_id long, period string, goals int")
    with pytest.raises(ValueError, match="shots_total"):
        A.rule_violations(st, required=["goals"])
    with pytest.raises(ValueError, match="passes"):
        A.range_violations(st, st.selectExpr("team_id", "'x' as name"))


@pytest.mark.parametrize("name", ["f15_side_balance", "f30_possession_pairs", "f48_error_register",
                                  "f03_histogram", "f35_above_mean_sd"])
def test_no_nested_loop_or_cartesian(spark, name):
    df = queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_no_python_udf_in_any_registered_query(spark):
    from pitchlake.plans.catalog import REGISTRY
    for name, fn in REGISTRY.items():
        if name.startswith(("e04_", "e05_")):  # model training: result is a small metrics table
            continue
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_filters_pushed_and_columns_pruned(spark):
    df = queries()["f13_null_profile"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the period predicate prunes partitions of the stored statistics
    assert "PartitionFilters: [isnotnull(period" in plan and "= first_half)" in plan
    scan_schema = [line for line in plan.split("\n") if "fixture_stats" in line or "ReadSchema" in line]
    assert all("src_a" not in s and "api_ts" not in s for s in scan_schema)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    out = {r.bin: r.n for r in A.histogram(df, "v", 5).collect()}
    assert out == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}


def test_null_profile_long_format(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a int, b int")
    got = {r.statistic: (r.null_count, r.null_percent, r.total_records) for r in A.null_profile(df, ["a", "b"]).collect()}
    assert got == {"a": (1, 33.33, 3), "b": (2, 66.67, 3)}
