"""Every registered query with an oracle matches DuckDB on sf0.001."""

import pytest

from __spark_entry__ import oracle_sql, queries
from pitchlake.plans.catalog import REGISTRY
from tests.conftest import SF_SMALL

# the long training (up to 500 rounds) is checked by tools/oracle_check.py; its parts are tested in test_training.py
ORACLES = {k: v for k, v in oracle_sql().items() if k in REGISTRY and k != "e05_train_gbt_dataset_one"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck_small, name):
    from pitchlake.plans.verify import compare
    sdf = queries()[name](spark, SF_SMALL)
    assert compare(sdf, duck_small, ORACLES[name]) == []


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert "target_fav_covers_ah_neg0_5_2H" in df.columns
