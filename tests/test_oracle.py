"""Every registered query with an oracle equals its DuckDB SQL at sf0.01 (the driver's gate), one test a query.

Queries without SQL have property tests of their own (training, selection, importance, monitoring); those of
the training-data operators are tested beside them.
"""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF001  # noqa: E402

from riskloom.plans.registry import ORACLE, QUERIES  # noqa: E402


@pytest.mark.skipif(not os.path.exists(SF001), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_registered_query_matches_oracle(spark, name):
    import oracle_check
    res = oracle_check.compare(spark, SF001, [name], verbose=False)
    spark.catalog.clearCache()
    assert res[name][0] == "match", res


def test_every_oracle_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
