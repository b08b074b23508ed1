"""Every catalogue query against its DuckDB oracle on the smallest test tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from abacus.catalogue import QUERIES
from abacus.catalogue_sql import SQL
from tests.oracle_compare import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


def test_comparison_type_lists_match_spark_schemas(spark):
    from pyspark.sql import types as T
    from abacus.catalogue import _QUERIES
    from abacus.catalogue_sql import DATE_OUTPUTS, INT_OUTPUTS
    for key, fn in _QUERIES.items():
        fields = fn(spark, SF).schema.fields
        assert [f.name for f in fields if isinstance(f.dataType, T.DateType)] == DATE_OUTPUTS.get(key, []), key
        assert [f.name for f in fields if isinstance(f.dataType, T.IntegralType)] == INT_OUTPUTS.get(key, []), key


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF, key, QUERIES[key], SQL[key], con)
    assert r["cols"] and r["values"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "budget_month" in df.columns
