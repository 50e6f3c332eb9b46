"""Representative registered queries against their DuckDB oracles at sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = ["clean_rows", "error_counts", "time_dim", "location_hierarchy", "product_scd2",
         "order_fact_keyed", "order_fact_substring", "sales_cube"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["cols_ok"] and r["values_ok"], r
