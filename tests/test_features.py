"""Feature-dataset rules (Q1, Q3–Q6) and the known counts of FIXTURES.md."""

from pyspark.sql import functions as F

from pitchlake.operators import features as D


def test_three_way_favourite_rules(spark):
    df = spark.createDataFrame([(1.5, 3.0, 1.5), (2.0, 3.0, 1.8), (2.5, 2.0, 2.5), (1.9, 3.0, 1.9), (3.0, 2.0, 2.9)],
                               "odds_home double, odds_draw double, odds_away double")
    df = df.withColumn("home_team_id", F.lit(10)).withColumn("away_team_id", F.lit(20))
    got = [(r.favorite_location, r.favorite_team_id) for r in D.favourite_three_way(df).collect()]
    # ties go home; away needs strictly lowest; a shortest draw leaves no favourite
    assert got == [("home", 10), ("away", 20), (None, None), ("home", 10), (None, None)]


def test_cover_target_line(spark):
    df = spark.createDataFrame([("home", 2, 1), ("home", 1, 1), ("away", 0, 2), (None, 3, 0)],
                               "favorite_location string, sh_home_goals int, sh_away_goals int")
    assert [r[0] for r in D.cover_target(df, -0.5).select(D.target_name()).collect()] == [1, 0, 1]
    assert [r[0] for r in D.cover_target(df, -1.5, name="t").select("t").collect()] == [0, 0, 1]


def test_two_way_favourite_and_ratio(spark):
    df = spark.createDataFrame([(1.5, 2.5), (2.0, 2.0), (3.0, 1.5), (None, 1.5), (0.0, 1.5)], "Home double, Away double")
    out = D.odds_ratio(D.favourite_two_way(df)).collect()
    assert [r.favorite for r in out] == ["Home", "Draw", "Away", "Draw", "Home"]
    assert [r.odds_ratio for r in out] == [0.6, 1.0, 0.5, None, None]


def test_latest_price_wins_and_mean_rule(spark):
    rows = [(1, 1, 20, "Home", 1.5, "2024-01-01"), (1, 1, 20, "Home", 1.7, "2024-01-02"),
            (1, 1, 20, "Away", 2.0, "2024-01-01"), (1, 6, 20, "Home", 9.9, "2024-01-05")]
    odds = spark.createDataFrame(rows, "fixture_id long, market_id int, bookmaker_id int, label string, "
                                       "value double, latest_bookmaker_update string")
    latest = D.pivot_odds(odds).first()
    assert (latest.odds_home, latest.odds_draw, latest.odds_away) == (1.7, None, 2.0)
    mean = D.pivot_odds(odds, rule="mean", names=["Home", "Draw", "Away"]).first()
    assert abs(mean.Home - 1.6) < 1e-12


def test_dataset_one_counts_match_fixture_notes(bed_mid):
    df = D.base_rows(bed_mid.schedules, bed_mid.stats, bed_mid.odds)
    df = D.favourite_three_way(D.odds_features(D.require_numeric(df, ["odds_home", "odds_draw", "odds_away"])))
    df = D.cover_target(D.second_half_goals(df))
    got = {r.favorite_location: (r.n, r.covers) for r in df.groupBy("favorite_location").agg(
        F.count(F.lit(1)).alias("n"), F.sum(D.target_name()).alias("covers")).collect()}
    assert got == {"home": (688, 390), "away": (483, 147)}


def test_dataset_one_plan_shuffles_only_on_fixture(bed_mid):
    df = D.dataset_one(bed_mid.schedules, bed_mid.stats, bed_mid.odds)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
