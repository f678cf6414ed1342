"""Every catalogue query with a SQL twin equals its DuckDB result (sf0.001)."""

import pytest

import __spark_entry__ as entry
from paths import SF_SMOKE
from oracle_compare import compare, duck

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMOKE, name, entry.queries()[name], SQL[name], con)
    assert res["ok"], res


def test_every_query_is_registered_and_entry_runs(spark):
    queries = entry.queries()
    assert set(SQL) <= set(queries)
    df = entry.entry(spark)
    assert df.columns == ["rank", "recording_id", "combined_score"]
    assert 0 < df.count() <= 100
