"""pitchlake — football match data on Spark.

Curated tables (leagues, seasons, teams, schedules, fixture_stats,
fixture_odds, fixture_timeline) are DataFrames; every job in this package
is a pure function from DataFrames to DataFrames so Catalyst sees one plan
per query.  Sub-packages:

* ``sources``   – landed JSON / CSV readers, curated-table scans, sinks
* ``functions`` – column-expression helpers (coercion, percentages, dedupe)
* ``operators`` – normalisation, work lists, feature datasets, audits, model
* ``plans``     – the registered query catalogue (Spark + SQL oracle)
* ``streaming`` – Structured Streaming versions of the ingest/quality jobs
"""

from pitchlake.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
