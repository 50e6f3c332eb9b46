"""Steps whose figures grow with the sales: texts made once an order, rules read typed values, numbering and cube dealt densely."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import cube, keys, quality
from starloom.plans import catalog, warehouse
from starloom.sources.landing import read_landing_csv, write_landing_csv
from starloom.sources.testdata import dirty_landing

T0 = datetime(2024, 1, 1)
LANDED = [(str(i), "TV" if i % 2 else "Phone", "1", f"{i}.50", f"01/0{i}/20 10:00", f"{i % 3} A St, Austin, TX 73301", T0) for i in range(1, 8)]


@pytest.fixture()
def tables(spark, tmp_path):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))

    put("lineitem", [(k, n, 1.0, 1) for k in (1, 2, 59) for n in (1, 2)] + [(1, 3, 2.0, None)], "l_orderkey long, l_linenumber int, l_quantity double, l_partkey long")
    put("orders", [(1, datetime(1996, 3, 4), 10), (2, datetime(1997, 11, 30), 53), (59, None, 10)], "o_orderkey long, o_orderdate timestamp, o_custkey long")
    put("customer", [(10, 3, "AUTO"), (53, 24, "TOYS")], "c_custkey long, c_nationkey int, c_mktsegment string")
    put("part", [(1, "red pin")], "p_partkey long, p_name string")
    return str(tmp_path)


def test_texts_of_an_order_are_made_before_its_items(spark, tables):
    land = dirty_landing(spark, tables)
    plan = land._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join Inner" in line]
    texts = [i for i, line in enumerate(plan) if " St, City" in line]
    assert texts and min(texts) > min(joins)
    rows = sorted((r.order_id, r.order_date, r.price_each, r.purchase_address) for r in land.fillna("-").collect())
    assert rows[:4] == [("1", "03/04/96 01:01", "35.95", "10 AUTO St, City3, dZ 10111"), ("1", "03/04/96 01:02", "35.95", "10 AUTO St, City3, dZ 10111"),
                        ("2", "11/30/1997 2:01", "40.95", "53 TOYS St, City4, YZ N/A"), ("2", "11/30/1997 2:02", "40.95", "53 TOYS St, City4, YZ N/A")]
    assert rows[4:] == [("59", "-", "-", "-")] * 2


def test_rules_match_texts_again_only_without_a_value(spark):
    plan = quality.tag_rows(spark.createDataFrame(LANDED, S.LANDING_SCHEMA), "2021-01-01")._jdf.queryExecution().optimizedPlan().toString()
    for value, text in (("_oid", "order_id"), ("_qty", "quantity_ordered"), ("_price", "price_each")):
        assert re.search(rf"isnull\({value}#\w+\) AND (NOT )?(coalesce\()?RLIKE\({text}|isnull\({value}#\w+\) AND NOT (coalesce\()?RLIKE\({text}", plan), (value, plan)


def test_numbering_is_written_densely(spark):
    tagged = keys.range_tagged(spark.range(9), [F.col("id")])
    assert all(".zstd." in f for f in tagged.inputFiles()) and tagged.count() == 9


def test_compressed_arrivals_are_short_files_with_the_same_rows(spark, tmp_path):
    df = spark.createDataFrame(LANDED, S.LANDING_SCHEMA).coalesce(1)
    write_landing_csv(df, str(tmp_path / "csv"), "gzip", 3)
    assert len(list((tmp_path / "csv").glob("*.csv.gz"))) == 3
    again = read_landing_csv(spark, str(tmp_path / "csv"), "2024-01-01 00:00:00")
    assert sorted(again.collect()) == sorted(df.select(*again.columns).collect())


@pytest.mark.parametrize("match, key", [("keyed", "address_id"), ("substring", "time_id")])
def test_a_run_deals_the_cube_by_streets_if_keyed(spark, tmp_path, monkeypatch, match, key):
    seen, whole = [], cube.sales_cube
    monkeypatch.setattr(warehouse.cube, "sales_cube", lambda f, **kw: (seen.append(kw.get("dealt")), whole(f, **kw))[1])
    wh = warehouse.Warehouse(spark, str(tmp_path / "wh"))
    warehouse.run_warehouse_batch(wh, spark.createDataFrame(LANDED, S.LANDING_SCHEMA), 0, "2021-01-01", address_match=match)
    assert seen == [key]
    text = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert text(wh.read("cube", [0])) == text(whole(wh.read("fact", [0])))


def test_keyed_cube_equals_lattice(spark):
    rows = [(i % 7 or None, f"D{i % 5}", f"A{i % 11}", i) for i in range(100)] + [(1, None, "A1", None)]
    f = spark.createDataFrame(rows, "product_surrogate_id long, time_id string, address_id string, total_price long").withColumn(
        "total_price", F.col("total_price").cast("decimal(38,2)"))
    for data in (f, f.limit(0)):
        got = catalog._keyed_cube(data)
        assert sorted(map(str, got.collect())) == sorted(map(str, cube.sales_cube(data).collect()))
