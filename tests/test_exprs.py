"""Expression helpers: coercion (Q13), ANSI-safe division (Q12), lookups,
skew-safe dedupe."""

from pyspark.sql import functions as F

from pitchlake.functions import exprs as X


def one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_pct_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(3, 0), (1, 3)], "n int, d int")
    assert [r[0] for r in df.select(X.pct("n", "d")).collect()] == [None, 33.33]


def test_coerce_int_text_like_python_int(spark):
    for raw, want in [("3", 3), (" 3 ", 3), ("3.7", None), ("1_000", None), ("abc", None), (None, None)]:
        assert one(spark, X.coerce(F.col("x"), "int"), value=raw) == want, raw


def test_coerce_double_strips_percent(spark):
    assert one(spark, X.coerce(F.col("x"), "double"), value="54.64%") == 54.64
    assert one(spark, X.coerce(F.col("x"), "double"), value=" 7 ") == 7.0
    assert one(spark, X.coerce(F.col("x"), "double"), value="n/a") is None


def test_coerce_boolean_words(spark):
    for raw, want in [("yes", True), ("T", True), ("1", True), ("false", False), ("No", False), ("maybe", None)]:
        assert one(spark, X.coerce(F.col("x"), "boolean"), value=raw) is want, raw


def test_variant_number_vs_string(spark):
    df = spark.createDataFrame([('{"v": 3.7}',), ('{"v": "3.7"}',), ('{"v": "54.6%"}',)], "j string")
    rows = df.select(F.try_variant_get(F.parse_json("j"), "$.v", "int").alias("i"),
                     X.coerce_variant(F.variant_get(F.parse_json("j"), "$.v", "variant"), "double").alias("d")).collect()
    assert [r["i"] for r in rows] == [3, None, None]
    assert [r["d"] for r in rows] == [3.7, 3.7, 54.6]


def test_map_status_and_unknown(spark):
    df = spark.createDataFrame([(5,), (6,), (99,), (None,)], "s int")
    assert [r[0] for r in df.select(X.map_status("s")).collect()] == ["FT", "FT_PEN", "UNKNOWN", "UNKNOWN"]


def test_map_period(spark):
    df = spark.createDataFrame([("1st-half",), ("Second Half",), ("EXTRA-TIME",), ("penalties",), ("",),
                                (None,), ("Overtime",)], "p string")
    assert [r[0] for r in df.select(X.map_period("p")).collect()] == [
        "first_half", "second_half", "extra_time", "penalties", None, None, "Overtime"]


def test_first_by_keeps_smallest_and_is_an_aggregate(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 2, "a"), (1, 9, "c"), (2, None, "n"), (2, 1, "m")],
                               "k int, o int, v string")
    out = X.first_by(df, ["k"], ["o"])
    assert sorted((r.k, r.o, r.v) for r in out.collect()) == [(1, 2, "a"), (2, None, "n")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    last = X.first_by(df, ["k"], ["o"], descending=True)
    assert sorted((r.k, r.v) for r in last.collect()) == [(1, "c"), (2, "m")]
