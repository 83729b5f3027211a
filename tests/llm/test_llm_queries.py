import pytest

from frameloom.llm import queries
from tests.oracle import check, connect


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    if name in queries.ORACLES:
        check(df, connect(sf), queries.ORACLES[name])
    else:
        assert df.columns and df.count() >= 0
