"""Sale-sized steps: texts parsed once, one deal of the sales, narrow and dense written tables."""

import re
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.dates import parse_order_ts
from starloom.operators import calendar, cube, fact, location, product, quality
from starloom.plans import warehouse
from starloom.session import cut_lineage

ROWS = [("TV", 1, "10.00", datetime(2020, 1, 5, 10), "1 A St, Austin, TX 73301"),
        ("TV", 2, "10.00", datetime(2020, 1, 6, 10), "1 A St, Austin, TX 73301"),
        ("PHONE", 2, "20.00", datetime(2020, 2, 6, 10), "2 B St, Austin, TX 73301")]


@pytest.fixture()
def clean(spark):
    return spark.createDataFrame([(i, p, q, Decimal(pr), ts, a, datetime(2024, 1, 1)) for i, (p, q, pr, ts, a) in enumerate(ROWS)], S.CLEAN_SCHEMA)


def test_addresses_are_parsed_once_a_text(clean):
    staged = location.clean_address_process(clean)
    assert staged.inputFiles(), "parsed from the written distinct texts, not from every row"
    assert staged.count() == 2


def test_keyed_fact_parses_no_sale_and_deals_sales_once(spark, clean):
    t = calendar.build_time_dimension(clean)
    h, k = location.build_location_hierarchy(location.clean_address_process(clean))
    dim = cut_lineage(product.populate_product(clean)[0])
    f = fact.build_order_fact(clean, dim, t, h, k)
    plan = f._jdf.queryExecution().optimizedPlan().toString()
    assert "split" not in plan
    # The written product is small enough to know that its join needs no deal of the sales.
    assert "SortMergeJoin" not in f._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r.order_id, str(r.total_price), r.address_name) for r in f.collect()) == [
        (0, "10.00", "1 A St"), (1, "20.00", "1 A St"), (2, "40.00", "2 B St")]


def test_substring_sales_meet_nodes_once(spark, clean):
    t = calendar.build_time_dimension(clean)
    h, k = location.build_location_hierarchy(location.clean_address_process(clean))
    dim = cut_lineage(product.populate_product(clean)[0])
    f = fact.build_order_fact(clean, dim, t, h, k, "substring")
    assert f._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 3  # product, day, nodes
    assert f.count() == 12


def test_warehouse_files_are_dense(spark, clean, tmp_path):
    wh = warehouse.Warehouse(spark, str(tmp_path / "wh"))
    wh.write(clean, "clean", 0)
    assert list((tmp_path / "wh/clean").rglob("*.zstd.parquet"))


def test_order_dates_equal_the_formatter(spark):
    texts = ["01/02/2020 10:05", "1/2/20 1:05", "02/29/00 00:00", "2/29/70 0:00", "2/29/72 23:59", "02/29/1900 10:00", "13/01/2020 10:00", "04/31/19 10:00",
             "01/01/69 24:00", "01/01/69 23:60", "12/31/69 23:59", "01/01/0000 00:00", "0/1/20 1:00", "01/01/2020 10:00 ", "01/01/2020 10:00\n", " 1/1/20 1:00",
             "01/01/020 10:00", "01-01-2020 10:00", "", "99/99/99 99:99", None]
    old = F.expr("""CASE WHEN s RLIKE r'\\A(\\d{1,2})/(\\d{1,2})/(\\d{2}|\\d{4}) (\\d{1,2}):(\\d{2})\\z' THEN
        CASE WHEN length(substring_index(substring_index(s, ' ', 1), '/', -1)) = 4 THEN try_to_timestamp(s, 'M/d/yyyy H:mm')
        WHEN year(try_to_timestamp(s, 'M/d/yy H:mm')) >= 2070 THEN try_to_timestamp(s, 'M/d/yy H:mm') - INTERVAL 100 YEARS
        ELSE try_to_timestamp(s, 'M/d/yy H:mm') END END""")
    df = spark.createDataFrame([(x,) for x in texts], "s string").select("s", parse_order_ts("s").alias("new"), old.alias("old"))
    assert df.filter(~F.col("new").eqNullSafe(F.col("old"))).count() == 0
    assert df.filter("new IS NOT NULL").count() == 6
    assert "gettimestamp" not in df.select("new")._jdf.queryExecution().optimizedPlan().toString().lower()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_dealt_cube_equals_lattice_and_deals_days_once(spark, tmp_path):
    schema = "product_surrogate_id long, time_id string, address_id string, total_price decimal(38,2)"
    rows = [(i % 7 or None, f"D{i % 5}", f"A{i % 11}", Decimal(i)) for i in range(300)] + [(1, None, "A1", None)]
    for data in (rows, []):
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(str(tmp_path / "fact"))
        f = spark.read.schema(schema).parquet(str(tmp_path / "fact"))
        got, whole = cube.sales_cube(f, dealt="time_id"), cube.sales_cube(f)
        assert got.columns == whole.columns and sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    assert all(exchanges(s) == 1 for s in cube.sets_with(f, "time_id"))


def test_rows_sent_again_are_found_by_id_without_dealing_the_batch(spark, clean):
    fields = ["order_id", "product", "quantity_ordered", "price_each", "order_date", "purchase_address"]
    text = lambda df: df.select(*[F.col(c).cast("string") for c in fields if c != "order_date"],
                                F.date_format("order_date", "MM/dd/yyyy HH:mm").alias("order_date"), "updated_at").select(*fields, "updated_at")
    again = text(clean).unionByName(text(clean.withColumn("order_id", F.col("order_id") + 2)))
    got = quality.anti_dedup(again, clean)
    assert sorted(r.order_id for r in got.collect()) == ["2", "3", "4"]  # order 2 comes once as stored, once with other values
    # Rows of other ids pass by the written ids alone.
    assert re.search(r"BroadcastHashJoin \[_oid#\w+\], \[_e_oid#\w+\], LeftAnti", got._jdf.queryExecution().sparkPlan().toString())


def test_tagged_batch_keeps_one_form(spark, clean):
    row = ("x", "TV", "1", "1.00", "01/01/20 10:00", "1 A St, Austin, TX 73301", datetime(2024, 1, 1))
    tagged = quality.tag_rows(spark.createDataFrame([row, ("1", *row[1:])], S.LANDING_SCHEMA), "2021-01-01")
    kept = {r.error_reason is None: r for r in quality._one_form(tagged).collect()}
    assert kept[True].order_id is None and kept[True]._oid == 1 and kept[False].order_id == "x" and kept[False]._price is None
    assert quality.clean_of(quality._one_form(tagged)).collect() == quality.clean_of(tagged).collect()
    assert quality.errors_of(quality._one_form(tagged)).collect() == quality.errors_of(tagged).collect()


@pytest.mark.parametrize("few", [0, 10])
def test_versions_joined_by_number_give_the_same_fact(spark, clean, monkeypatch, few):
    monkeypatch.setattr(fact, "FEW_VERSIONS", few)
    t = calendar.build_time_dimension(clean)
    h, k = location.build_location_hierarchy(location.clean_address_process(clean))
    dim = product.populate_product(clean)[0]
    twice = cut_lineage(dim.unionByName(dim.filter("product = 'TV'")))
    f = fact.build_order_fact(clean, twice, t, h, k)
    assert sorted(r.order_id for r in f.collect()) == [0, 0, 1, 1, 2]


def test_carried_rows_are_dealt_only_when_files_are_many(spark, tmp_path, monkeypatch):
    from starloom.plans import months
    table = months.MonthTable(spark, str(tmp_path), "t", spark.range(0).schema)
    table.replace(spark.range(9).withColumn(months.MONTH, F.lit("2020-01")), 0, None, ["2020-01"])
    old = table.read(0)
    plan = lambda: table.carried(old, ["2020-01"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" not in plan()
    monkeypatch.setattr(months, "FILES_A_MONTH", 0)
    assert "Rebalance" in plan()
