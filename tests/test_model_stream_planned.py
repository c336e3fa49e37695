"""Model operators (E), streaming sink replay (H3), planned operators (P)."""

from pyspark.sql import functions as F

from pitchlake.operators import model as E
from pitchlake.operators import planned as PL
from pitchlake.streaming import jobs as H


def test_stratified_split_disjoint_exhaustive(spark):
    df = spark.range(2000).select(F.col("id").alias("fixture_id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    s = E.stratified_split(df, "y", 0.8).cache()
    assert s.count() == 2000
    per = {(r.y, r.is_train): r["count"] for r in s.groupBy("y", "is_train").count().collect()}
    for y, n in ((0, 1600), (1, 400)):
        assert abs(per[(y, True)] - 0.8 * n) <= 1
    again = E.stratified_split(df.repartition(7), "y", 0.8)
    assert s.filter("is_train").select("fixture_id").exceptAll(again.filter("is_train").select("fixture_id")).count() == 0


def test_metrics_confusion_report(spark):
    pred = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.6), (0, 0, 0.1)],
                                 "label int, prediction int, p1 double")
    m = E.binary_metrics(pred).first()
    assert (m.accuracy, m.precision, m.recall) == (0.5, 0.5, 0.5) and m.log_loss > 0
    conf = {r.actual: (r.pred_0, r.pred_1) for r in E.confusion(pred).collect()}
    assert conf == {0: (1, 1), 1: (1, 1)}
    rep = {r["class"]: r for r in E.class_report(pred).collect()}
    assert rep["Covered"].support == 2 and abs(rep["macro avg"].f1 - 0.5) < 1e-12
    none = spark.createDataFrame([(1, 0, 0.2)], "label int, prediction int, p1 double")
    assert E.binary_metrics(none).first().precision == 0.0


def test_clean_features_and_guard(spark):
    df = spark.createDataFrame([(1, float("nan"), 1.0), (2, float("inf"), None)], "fixture_id long, a double, b double")
    clean, rep = E.clean_features(df, ["a", "b"])
    assert [tuple(r) for r in clean.select("a", "b").collect()] == [(0.0, 1.0), (0.0, 0.0)]
    assert {r.feature: r.replaced for r in rep.collect()} == {"a": 2, "b": 1}
    assert E.train_gbt(df.withColumn("y", F.lit(1)), ["a", "b"], "y") is None


def test_best_iteration_patience():
    losses = [0.9, 0.8, 0.7, 0.71, 0.72, 0.69, 0.75, 0.76, 0.77, 0.6]
    assert E.best_iteration(losses, 3) == 5      # 0.6 comes after 3 rounds without a new minimum
    assert E.best_iteration(losses, 10) == 9
    assert E.best_iteration([0.5], 50) == 0


def test_train_gbt_small(spark):
    df = spark.range(400).select(F.col("id").alias("fixture_id"), (F.col("id") % 7).cast("double").alias("x"),
                                 ((F.col("id") % 7) > 3).cast("int").alias("label"))
    res = E.train_and_evaluate(df, ["x"], "label", {"rounds": 10, "early_stop": 3})
    assert res["auc"] > 0.9
    imp = E.importance(spark, res["model"], ["x"]).collect()
    assert imp[0].feature == "x"
    from pitchlake.session import checkpoint_dir
    path = f"{checkpoint_dir(spark)}/models/unit_gbt"
    E.save_model(res["model"], path)
    again = E.score(E.load_model(path), df.limit(20))
    assert again.count() == 20 and "p1" in again.columns


def test_first_wins_sink_replay_is_noop(spark, tmp_path):
    path = str(tmp_path / "tbl")
    sink = H.first_wins_sink(path, ["k"], ["o"])
    batch = spark.createDataFrame([(1, 2, "a"), (1, 1, "b"), (2, 1, "c")], "k long, o int, v string")
    sink(batch, 0)
    sink(batch, 0)  # replayed epoch
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "b"), (2, "c")]


def test_planned_operators(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, -1)], "fixture_id long, m int")
    out = {(r.fixture_id, r.line): r.outcome for r in PL.handicap_settlement(df, "m").collect()}
    assert out[(1, -1.0)] == "push" and out[(1, -1.5)] == "lose" and out[(3, 1.0)] == "push" and out[(2, 1.5)] == "win"
    bets = PL.value_bets(spark.createDataFrame([(0.6, 2.0), (0.5, 2.0), (0.9, 3.0)], "p double, o double"), "p", "o")
    assert [round(r.stake, 6) for r in bets.collect()] == [0.05, 0.05]
    st = spark.createDataFrame([(1, 1, "first_half", 3), (1, 1, "second_half", 2), (2, 1, "first_half", 1),
                                (2, 1, "second_half", 4)], "fixture_id long, team_id long, period string, goals int")
    assert [(r.fixture_id, r.decreasing) for r in PL.period_monotonic(st, ["goals"]).collect()] == [(1, "goals")]
    corr = PL.correlation_matrix(spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 0.0), (3.0, 6.0, 1.0)],
                                                       "a double, b double, c double"), ["a", "b", "c"]).collect()
    assert abs([r for r in corr if r.feature_b == "b"][0].corr - 1.0) < 1e-12
