"""Every core query against its SQL; queries without SQL give rows of a stable schema."""

from importlib import import_module

import pytest

from tests.oracle import check, connect

MODULES = ["run_queries", "data_queries", "sample_queries", "metric_queries", "io_queries"]
QUERIES = {k: (f, m.ORACLES.get(k)) for n in MODULES for m in [import_module(f"frameloom.plans.{n}")] for k, f in m.QUERIES.items()}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    f, sql = QUERIES[name]
    df = f(spark, sf)
    if sql is None:
        assert df.columns and df.count() >= 0
    else:
        check(df, con, sql)


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
