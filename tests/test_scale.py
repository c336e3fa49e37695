"""What a job must not do twice: parse a document, search an array, write rows nobody reads."""

import datetime as dt
import json

from pyspark.sql import functions as F

from pitchlake.operators import normalize as B
from pitchlake.plans import landing as LD
from pitchlake.sources import raw as R
from pitchlake.sources import tables as T


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _stats_doc(fixture, value):
    item = {"participant_id": 7, "type": {"code": "goals"}, "data": {"value": value}}
    return json.dumps({"fetch_timestamp": "2024-01-01 00:00:00", "fixture_id": fixture, "fixture_data_with_stats": {
        "data": {"id": fixture, "periods": [{"id": 1, "description": "1st-half", "statistics": [item]}]}}})


def test_a_document_is_parsed_once(spark):
    docs = spark.createDataFrame([(_stats_doc(1, 2),), (_stats_doc(2, "n/a"),), (None,), ("{",)], "doc string")
    parsed = R.parse_documents(docs, "stats")
    assert parsed.columns == ["fetch_timestamp", "fixture_id", "fixture_data_with_stats", "_doc_id"]
    assert [r.fixture_id for r in parsed.collect()] == [1, 2, None, None]     # unreadable ones stay, as NULLs
    rows, _ = B.normalize_stats(parsed)
    for df in (rows, B.coercion_failures(parsed), B.empty_documents(parsed)):
        assert _plan(df).count("from_json") == 1
    assert {r.fixture_id: r.goals for r in rows.collect()} == {1: 2, 2: None}
    assert [(r["values"], r.failed) for r in B.coercion_failures(parsed).collect()] == [(2, 1)]


def test_the_sides_of_a_fixture_are_searched_once(spark):
    rows, _ = B.normalize_schedules(R.parse_documents(spark.createDataFrame([("{}",)], "doc string"), "schedules"))
    checks = [line for line in _plan(rows).splitlines() if "Filter" in line]
    assert checks and not any("lambdafunction" in line for line in checks)


def test_numbers_are_written_as_variant_writes_them(spark):
    df = spark.createDataFrame([(x, n) for n, x in enumerate([70.0, 0.0, -1.5, 1e-5, 1.2345678e10, 30.000000000000004, None])], "x double, n int")
    want = F.to_json(F.struct(F.parse_json(F.col("x").cast("string")).alias("v")))
    got = LD._object(v=LD._number(df, "x"))
    assert df.where(~got.eqNullSafe(want)).count() == 0
    want = F.to_json(F.struct(F.parse_json(F.col("n").cast("string")).alias("v")))
    assert df.where(~LD._object(v=LD._number(df, "n")).eqNullSafe(want)).count() == 0


def test_statistics_are_stored_without_their_raw_rows(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    item = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
    lines = [(1, 12, 3, 1, 5.0, 10.0, 0.1, 0.0, day), (1, 11, 3, 1, 6.0, 10.0, 0.1, 0.0, day), (None, 11, 3, 1, 6.0, 10.0, 0.1, 0.0, day)]
    spark.createDataFrame(lines, item).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 4)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    rows = T.stored_testbed(spark, str(tmp_path)).stats.collect()
    assert [(r.fixture_id, r.team_id, r.period, r.src_a, r.attacks) for r in rows] == [(1, 4, "first_half", 11, 6)]
    assert {k[2] for k in T._LOADED if k[1] == str(tmp_path)} == {"stats"}
