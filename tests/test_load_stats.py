"""Loads of statistics documents: how often they are read, and code the JVM compiles."""

import datetime as dt
import re

import pytest

from pitchlake.plans import landing as LD
from pitchlake.plans.catalog import REGISTRY
from pitchlake.sources import tables as T

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz"


def _tables(spark, path):
    day, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [(1, 12, 3, 1, 5.0, 10.0, 0.1, 0.0, later), (1, 11, 3, 1, 6.0, 10.0, 0.1, 0.02, day),
            (1, 11, 3, 1, 6.0, 10.0, 0.1, 0.02, day),      # a copy
            (1, 41, 3, 3, None, 10.0, None, None, day),    # no value at all: still a row of its team
            (2, 92, 3, 1, 7.0, 10.0, 0.1, 0.0, day),       # a period without description
            (2, 90, 3, 2, 7.0, 10.0, 0.1, 0.0, day),       # no statistics
            (0, 13, 3, 1, 7.0, 10.0, 0.1, 0.0, day), (None, 13, 3, 1, 7.0, 10.0, 0.1, 0.0, day)]
    spark.createDataFrame(rows, LINES).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(0, 4), (1, 4), (2, 5)], "o_orderkey long, o_custkey long").write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_the_load_report_parses_no_document_again(spark, tmp_path):
    report = REGISTRY["a09_load_report_stats"](spark, _tables(spark, tmp_path))
    assert [tuple(r) for r in report.collect()] == [(7, 2, 1, 1)]
    assert "from_json" not in report._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", [{}, {"gaps": True}, {"spoiled": True}])
def test_the_code_that_writes_documents_is_compiled(spark, tmp_path, kind):
    """HotSpot interprets methods of more than 8,000 bytes."""
    docs = LD.stats_documents(T.stored_testbed(spark, _tables(spark, tmp_path)), **kind)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = debug.codegenString(docs._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
