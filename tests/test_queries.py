"""Every query with a SQL counterpart gives the same rows as that SQL in DuckDB."""

import duckdb
import pytest

from careerpanel.plans.catalog import QUERIES
from tests.conftest import SF

SLOW = {"c12_draws_below", "c13_places"}  # their rules are checked in test_regression.py


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{SF}/orders.parquet'")
    return con


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql and n not in SLOW])
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name].run(spark, SF)
    expected = duck.execute(QUERIES[name].oracle())
    assert result.columns == [c[0] for c in expected.description]
    rows = result.collect()
    assert rows
    assert _sorted(rows) == _sorted(expected.fetchall())
