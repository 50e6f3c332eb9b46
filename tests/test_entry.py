import __spark_entry__ as E
from starloom.plans.catalog import QUERIES


def test_every_query_of_the_warehouse_has_an_oracle():
    # Queries of optional folders may be beyond SQL; SQL without a query would be a mistake anywhere.
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(QUERIES) >= 47


def test_entry_runs_the_flagship_cube(spark):
    df = E.entry(spark)
    assert df.columns == ["product_surrogate_id", "address_id", "time_id", "total_price_sum"]
    rows = df.filter("product_surrogate_id IS NULL AND time_id IS NULL AND address_id IS NULL").collect()
    assert len(rows) == 1 and rows[0]["total_price_sum"] > 0
