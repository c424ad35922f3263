"""Every query against its SQL on the smallest tables; queries without SQL must run."""

import pytest
from oracle_check import compare, connect
from table_rows import SF

from lapwise.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in SQL:
        result = compare(spark, con, name, QUERIES[name], SQL[name], SF)
        assert result.startswith("ok"), result
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
