"""Ids beyond five digits and kept between runs, keys, per-file headers, wide numbers, replayed and stale runs."""

import os
import tempfile
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.text import counter
from starloom.operators.calendar import build_time_dimension, update_time_dimension
from starloom.operators.keys import range_tagged, sequence_ids
from starloom.operators.location import build_location_hierarchy
from starloom.operators.quality import assert_keys, validate_split
from starloom.plans.warehouse import Warehouse, run_warehouse_batch, warehouse_totals
from starloom.session import cut_lineage
from starloom.sources.landing import read_landing_csv


def test_counter_is_never_truncated(spark):
    ids = spark.range(99_990, 100_150).select(counter(F.col("id")).alias("c"))
    assert ids.distinct().count() == 160
    assert [r.c for r in ids.filter("id in (99999, 100000)").orderBy("id").collect()] == ["99999", "100000"]
    assert spark.range(7, 8).select(counter(F.col("id")).alias("c")).first().c == "00007"


def test_calendar_keys_stay_unique_when_an_earlier_year_arrives(spark):
    def sales(*days):
        return spark.createDataFrame([(d,) for d in days], "order_date string").select(F.to_timestamp("order_date").alias("order_date"))
    stored = build_time_dimension(sales("2021-02-01"))
    both = sales("2020-05-05", "2021-02-01")
    _, updated = update_time_dimension(stored, both)
    assert updated.groupBy("time_combined_id").count().filter("count > 1").isEmpty()
    fresh = build_time_dimension(both)
    assert updated.exceptAll(fresh.select(*updated.columns)).isEmpty() and updated.count() == fresh.count()


def test_columns_follow_each_files_header(spark):
    base = tempfile.mkdtemp(prefix="starloom-headers-")
    files = {"a.csv": "Order ID,Product,Quantity Ordered,Price Each,Order Date,Purchase Address\n1,Lamp,2,3.50,01/02/20 10:00,x\n",
             "b.csv": "Product,Order ID,Note,Price Each,Quantity Ordered,Order Date\nDesk,2,hi,9.00,1,01/03/20 10:00\n"}
    for name, text in files.items():
        with open(os.path.join(base, name), "w") as f:
            f.write(text)
    rows = read_landing_csv(spark, base, datetime(2024, 1, 1)).orderBy("order_id").collect()
    assert [(r.order_id, r["product"], r.quantity_ordered, r.price_each, r.purchase_address) for r in rows] == [
        ("1", "Lamp", "2", "3.50", "x"), ("2", "Desk", "1", "9.00", "")]


def test_committed_runs_are_skipped_and_stale_ones_refused(spark):
    wh = Warehouse(spark, os.path.join(tempfile.mkdtemp(prefix="starloom-replay-"), "wh"))

    def batch(n):
        row = (str(n), "Lamp", "1", "3.50", f"01/0{n}/20 10:00", f"{n} Oak Row, Elm, KS 66002", datetime(2024, 1, n))
        return spark.createDataFrame([row], "order_id string, product string, quantity_ordered string, price_each string, "
                                            "order_date string, purchase_address string, updated_at timestamp")
    for n in (1, 2):
        run_warehouse_batch(wh, batch(n), n * 10, "2024-01-01 00:00:00", fact_mode="append")
    totals = sorted(map(tuple, warehouse_totals(wh).collect()))
    for n in (1, 2):  # a replayed epoch
        run_warehouse_batch(wh, batch(n), n * 10, "2024-01-01 00:00:00", fact_mode="append")
    assert sorted(map(tuple, warehouse_totals(wh).collect())) == totals
    with pytest.raises(ValueError):
        run_warehouse_batch(wh, batch(3), 15, "2024-01-01 00:00:00")


def addresses(spark, *rows):
    return spark.createDataFrame(list(rows), "street string, city string, state string, postal_code string")


@pytest.mark.parametrize("mode", ["city_postal", "city"])
def test_stored_locations_keep_their_ids(spark, mode):
    first = addresses(spark, ("5 B St", "Elm", "KS", "66002"), ("7 C St", "Oak", "KS", "66002"))
    nodes, keys = (cut_lineage(x) for x in build_location_hierarchy(first, mode))
    more = first.unionByName(addresses(spark, ("1 A St", "Elm", "KS", "66002"), ("1 A St", "Ash", "KS", "66002"),
                                       ("9 D St", "Elm", "AK", "66002")))
    after, after_keys = build_location_hierarchy(more, mode, stored=(nodes, keys))
    assert nodes.exceptAll(after).isEmpty() and keys.exceptAll(after_keys).isEmpty()
    assert after.count() == after.select("address_id").distinct().count()
    assert after_keys.count() == 5
    assert {r.address_id[-7:] for r in after_keys.filter("street = '1 A St' AND city = 'Elm'").collect()} == {"-S00002"}


def test_more_than_99999_siblings_have_ids_of_their_own(spark):
    many = spark.range(100_050).select(F.concat(F.col("id"), F.lit(" Row")).alias("street"), F.lit("Elm").alias("city"),
                                       F.lit("KS").alias("state"), F.lit("66002").alias("postal_code"))
    _, keys = build_location_hierarchy(many)
    assert keys.select("address_id").distinct().count() == 100_050
    extra = many.unionByName(addresses(spark, ("new", "Elm", "KS", "66002")))
    _, again = build_location_hierarchy(extra, stored=(None, cut_lineage(keys)))
    assert again.filter("street = 'new'").first().address_id.endswith("-S100051")


def test_equal_rows_spread_over_the_numbering(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 5 < 4, F.lit("header")).otherwise(F.col("id").cast("string")).alias("v"))
    ids = sequence_ids(df, ["v"], "n", partitions=8)
    assert ids.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (1, 40_000, 40_000)
    tagged = range_tagged(df.withColumn("_seq_tie", F.monotonically_increasing_id()), [F.col("v"), F.col("_seq_tie")], 8)
    assert tagged.groupBy("_seq_pid").count().agg(F.max("count")).first()[0] < 2 * 40_000 / 8


def test_large_numbers_are_clean_unless_int_limits_are_asked_for(spark):
    row = ("3000000000", "Lamp", "2500000000", "99999999999.50", "01/02/20 10:00", "1 Oak Row, Elm, KS 66002", datetime(2024, 1, 1))
    landing = spark.createDataFrame([row], S.LANDING_SCHEMA)
    clean, errors = validate_split(landing, "2024-01-01 00:00:00")
    assert clean.first().order_id == 3_000_000_000 and errors.isEmpty()
    _, errors = validate_split(landing, "2024-01-01 00:00:00", int_limits=True)
    assert errors.first().error_reason == S.REASON_ORDER_ID_RANGE
    wh = Warehouse(spark, os.path.join(tempfile.mkdtemp(prefix="starloom-wide-"), "wh"))
    run_warehouse_batch(wh, landing, 0, "2024-01-01 00:00:00")
    assert wh.read("cube", [0]).agg(F.max("total_price_sum")).first()[0] == Decimal("99999999999.50") * 2_500_000_000


def test_keys_are_checked(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "f string")
    got = {r.check: r.violations for r in assert_keys({"unique": (parent, ["k"]), "empty": (parent.limit(0), ["k"])},
                                                      {"refers": (child, "f", parent, "k")}).collect()}
    assert got == {"unique": 1, "empty": 0, "refers": 2}


def test_append_mode_keeps_address_ids_and_reversion_runs(spark):
    wh = Warehouse(spark, os.path.join(tempfile.mkdtemp(prefix="starloom-append-"), "wh"))
    for n, street in ((1, "5 B St"), (2, "1 A St")):
        row = (str(n), "Lamp", "1", f"{n}.50", f"01/0{n}/20 10:00", f"{street}, Elm, KS 66002", datetime(2024, 1, n))
        run_warehouse_batch(wh, spark.createDataFrame([row], S.LANDING_SCHEMA), n, "2024-01-01 00:00:00",
                            fact_mode="append", reversion=True)
    ids = {r.address_name: r.address_id[-7:] for r in wh.read("fact", [2]).select("address_name", "address_id").distinct().collect()}
    assert ids == {"5 B St": "-S00001", "1 A St": "-S00002"}
    assert wh.read("product", [2]).filter("curr_status").count() == 1
