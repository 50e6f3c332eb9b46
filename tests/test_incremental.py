"""Fact and cube kept by month: equal to a full rebuild, and only touched months are written."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from starloom.operators import cube, fact
from starloom.plans.warehouse import Warehouse, run_warehouse_batch

LANDING = "order_id string, product string, quantity_ordered string, price_each string, order_date string, purchase_address string, updated_at timestamp"


def arrivals(spark):
    """Four runs: two months, a price change of a product of one month, a late earlier month, and one that brings nothing."""
    import datetime as dt
    at = lambda n: dt.datetime(2024, 1, n)
    row = lambda i, p, q, price, day, place, n: (str(i), p, str(q), price, day, place, at(n))
    where = ["1 North Pl, Aville, OR 97001", "2 South Pl, Aville, OR 97001", "3 West Pl, Bton, ME 04001"]
    first = [row(1, "Lamp", 2, "5.00", "03/02/19 10:00", where[0], 1), row(2, "Phone", 1, "90.00", "03/09/19 10:00", where[1], 1),
             row(3, "Cable", 4, "2.50", "04/02/19 10:00", where[0], 1), row(4, "Cable", 4, "2.50", "04/02/19 11:00", where[0], 1)]
    second = [row(5, "Phone", 1, "80.00", "05/01/19 09:00", where[2], 2)]
    third = [row(6, "Radio TV", 1, "70.00", "01/05/19 09:00", where[2], 3), row(7, "Lamp", 0, "5.00", "04/05/19 09:00", where[2], 3)]
    fourth = [row(8, "Lamp", 0, "5.00", "06/05/19 09:00", where[2], 4)]
    return [spark.createDataFrame(rows, LANDING) for rows in (first, second, third, fourth)]


def files(root, table):
    return {os.path.relpath(f, os.path.join(root, table)): os.stat(f).st_mtime_ns
            for f in glob.glob(os.path.join(root, table, "run_id=*", "order_month=*", "*.parquet"))}


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("price_mode,runs", [("current", 4), ("as_of_sale", 3)])
def test_months_equal_rebuild_and_untouched_files_stay(spark, price_mode, runs):
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="starloom-months-"), layout="months")
    seen = []
    for n, batch in enumerate(arrivals(spark)[:runs]):
        run_warehouse_batch(wh, batch, n, "2024-06-01 00:00:00", price_mode=price_mode)
        seen.append(files(wh.root, "fact"))
        # The same fact and cube built whole from the stored clean sales and dimensions.
        dims = [wh.read(t, [n]) for t in ("product", "time_dim", "location", "street_keys")]
        whole = fact.build_order_fact(wh.read("clean", list(range(n + 1))), *dims, price_mode=price_mode)
        assert rows(wh.read("fact", [n])) == rows(whole), n
        assert rows(wh.read("cube", [n])) == rows(cube.sales_cube(whole)), n
    run_warehouse_batch(wh, batch, n, "2024-06-01 00:00:00", price_mode=price_mode)  # a replay
    assert files(wh.root, "fact") == seen[-1]
    held = {"2019-01": 2, "2019-03": 1, "2019-04": 0, "2019-05": 1}
    assert wh.months["fact"].manifest(n) == held  # March holds the re-priced phone, April nothing of it
    april = [f for f in seen[0] if "2019-04" in f]
    assert april and all(s[f] == seen[0][f] for s in seen for f in april)  # never written again
    assert any("run_id=0/order_month=2019-03" in f for f in seen[1])
    assert not any("run_id=0/order_month=2019-03" in f for f in seen[2])  # replaced two commits ago


def test_lattice_has_no_expand_and_equals_cube(spark):
    f = spark.createDataFrame([(i % 7, f"D{i % 5}", f"A{i % 11}", i) for i in range(400)],
                              "product_surrogate_id long, time_id string, address_id string, total_price long")
    f = f.withColumn("total_price", F.col("total_price").cast("decimal(38,2)"))
    got = cube.sales_cube(f)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    expected = f.cube(*cube.KEYS).agg(F.sum("total_price").cast("decimal(38,2)").alias("total_price_sum"))
    assert rows(got) == rows(expected)


def test_added_cells_equal_whole_cube(spark):
    schema = "product_surrogate_id long, time_id string, address_id string, total_price decimal(38,2)"
    from decimal import Decimal
    a = spark.createDataFrame([(1, "D1", "A1", Decimal(5)), (1, "D2", "A1", Decimal(7)), (2, "D1", "A2", Decimal(0))], schema)
    b = spark.createDataFrame([(1, "D1", "A1", Decimal(2)), (3, "D3", "A1", Decimal(1))], schema)
    cells = lambda f: cube.cube_rows(cube.finest_cells(f))
    both = cube.add_cells(cells(a), cells(b))
    assert rows(both) == rows(cells(a.unionByName(b)))
    assert rows(cube.add_cells(both, cube.negated(cells(a)))) == rows(cells(b))


def test_month_layout_refuses_what_it_cannot_keep(spark):
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="starloom-months-"), layout="months")
    with pytest.raises(ValueError):
        run_warehouse_batch(wh, arrivals(spark)[0], 0, address_match="substring")
    with pytest.raises(ValueError):
        Warehouse(spark, wh.root, layout="years")


@pytest.mark.parametrize("layout", ["slots", "months"])
def test_a_bad_run_is_not_published(spark, monkeypatch, layout):
    from starloom.operators import quality
    from starloom.plans import warehouse
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="starloom-gate-"), layout=layout)
    first, second, *_ = arrivals(spark)
    run_warehouse_batch(wh, first, 0, "2024-06-01 00:00:00", gate=True)
    before = rows(wh.read("fact", [0]))
    good = warehouse.product.populate_product

    def doubled(*args, **options):
        dim, mapped = good(*args, **options)
        return dim.unionByName(dim.filter("product = 'LAMP'")), mapped
    monkeypatch.setattr(warehouse.product, "populate_product", doubled)
    with pytest.raises(quality.ConstraintViolation) as e:
        run_warehouse_batch(wh, second, 1, "2024-06-01 00:00:00", gate=True)
    assert e.value.violations == [("product_key_unique", 1)]
    assert [tuple(r)[:2] for r in spark.read.parquet(os.path.join(wh.root, "violations", "run_id=1")).collect()] == e.value.violations
    assert wh.committed() == [0] and rows(wh.read("fact", [0])) == before
    monkeypatch.undo()
    run_warehouse_batch(wh, second, 1, "2024-06-01 00:00:00", gate=True)  # the same run, mended
    assert wh.committed() == [0, 1] and len(rows(wh.read("fact", [1]))) == len(before) + 1


def test_dedup_reads_the_months_of_the_batch(spark):
    from starloom import schemas as S
    from starloom.operators import quality
    from starloom.plans.months import MONTH, month_of
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-dedup-"), "clean")
    first, *_ = arrivals(spark)
    stored = quality.clean_of(quality.tag_rows(first, "2024-06-01 00:00:00"))
    stored.withColumn(MONTH, month_of("order_date")).write.partitionBy(MONTH).parquet(path)
    again = first.filter("order_id in ('1', '2')").unionByName(arrivals(spark)[2])  # March and January
    history = spark.read.schema(S.CLEAN_SCHEMA.simpleString()[7:-1].replace(":", " ") + f", {MONTH} string").parquet(path)
    got = quality.anti_dedup_by_month(again, history)
    assert sorted(r.order_id for r in got.collect()) == ["6", "7"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f"{MONTH}" in plan and "PartitionFilters: [" in plan and "2019-03" in plan and "2019-04" in plan
    assert quality.batch_months(again) == ["2019-01", "2019-03", "2019-04"]
