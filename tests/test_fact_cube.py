from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import calendar, cube, fact, location, product
from starloom.operators.fact import substring_matches


def model(spark, rows, parent_match="city_postal"):
    clean = spark.createDataFrame(
        [(i + 1, p, q, Decimal(pr), ts, a, datetime(2024, 1, 1)) for i, (p, q, pr, ts, a) in enumerate(rows)],
        S.CLEAN_SCHEMA)
    t = calendar.build_time_dimension(clean)
    h, k = location.build_location_hierarchy(location.clean_address_process(clean), parent_match)
    dim, _ = product.populate_product(clean)
    return clean, t, h, k, dim


ROWS = [("LAPTOP", 2, "100.00", datetime(2020, 1, 5, 10), "1 A St, Austin, TX 73301"),
        ("LAPTOP", 1, "120.00", datetime(2020, 3, 1, 10), "2 B St, Austin, TX 73301"),
        ("TV", 1, "50.00", datetime(2020, 3, 1, 11), "1 A St, Austin, TX 73301")]


def test_keyed_fact_one_row_per_sale_current_price(spark):
    clean, t, h, k, dim = model(spark, ROWS)
    f = fact.build_order_fact(clean, dim, t, h, k)
    rows = sorted(f.collect(), key=lambda r: r["order_id"])
    assert len(rows) == 3 and f.columns == S.FACT_COLUMNS
    # The old-price sale is re-priced at the current price (source behaviour).
    assert rows[0]["total_price"] == Decimal("240.00")
    assert rows[0]["time_id"] == "D_20200105" and rows[0]["address_level"] == 0
    asof = sorted(fact.build_order_fact(clean, dim, t, h, k, price_mode="as_of_sale").collect(),
                  key=lambda r: r["order_id"])
    assert asof[0]["total_price"] == Decimal("200.00")


def test_substring_fact_matches_every_level(spark):
    clean, t, h, k, dim = model(spark, ROWS)
    f = fact.build_order_fact(clean, dim, t, h, k, address_match="substring")
    per_order = {}
    for r in f.collect():
        per_order.setdefault(r["order_id"], set()).add(r["address_level"])
    assert per_order[1] == {0, 1, 2, 3}


def test_substring_matches_equal_like_semantics(spark):
    nodes = spark.createDataFrame(
        [("n1", "255 HOUSEHOLD St"), ("n2", "A%C"), ("n3", "B_D"), ("n4", ""), ("n5", "Z"), ("n6", "x\\%y")],
        "address_id string, address_name string").selectExpr(
        "address_id", "address_name", "'Street' as address_type", "cast(null as string) as parent_id", "0 as level")
    addrs = spark.createDataFrame([("1255 HOUSEHOLD St",), ("ABCD",), ("BxD",), ("x%y",), ("Q",)], "purchase_address string")
    got = {(r[0], r[1]) for r in substring_matches(addrs, nodes).collect()}
    brute = {(a, n) for a in ["1255 HOUSEHOLD St", "ABCD", "BxD", "x%y", "Q"]
             for n, name in [("n1", "255 HOUSEHOLD St"), ("n2", "A%C"), ("n3", "B_D"), ("n4", ""), ("n5", "Z"), ("n6", "x\\%y")]
             if spark.sql(f"select '{a}' like concat('%', '{name.replace(chr(92), chr(92) * 2)}', '%')").first()[0]}
    assert got == brute
    assert ("ABCD", "n2") in got and ("BxD", "n3") in got and ("Q", "n4") in got and ("x%y", "n6") in got


def test_cube_counts_and_totals(spark):
    clean, t, h, k, dim = model(spark, ROWS)
    f = fact.build_order_fact(clean, dim, t, h, k)
    c = cube.sales_cube(f).cache()
    total = f.agg(F.sum("total_price")).first()[0]
    grand = cube.cube_slice(c, product_surrogate_id=None, time_id=None, address_id=None).collect()
    assert len(grand) == 1 and grand[0]["total_price_sum"] == total
    for key in ("product_surrogate_id", "time_id", "address_id"):
        others = {k2: None for k2 in ("product_surrogate_id", "time_id", "address_id") if k2 != key}
        s = cube.cube_slice(c, **{key: "*"}, **others).agg(F.sum("total_price_sum")).first()[0]
        assert s == total


def test_cube_of_one_row_and_of_nothing(spark):
    clean, t, h, k, dim = model(spark, ROWS[:1])
    f = fact.build_order_fact(clean, dim, t, h, k)
    assert cube.sales_cube(f).count() == 8
    empty = cube.sales_cube(f.limit(0)).collect()
    assert len(empty) == 1 and all(v is None for v in empty[0])


def test_rollups_sum_to_total(spark):
    clean, t, h, k, dim = model(spark, ROWS)
    f = fact.build_order_fact(clean, dim, t, h, k).cache()
    total = f.agg(F.sum("total_price")).first()[0]
    for lvl in ("month", "quarter", "year"):
        assert cube.rollup_time(f, t, lvl).agg(F.sum("total_price_sum")).first()[0] == total
    st = cube.rollup_location(f, h, 3).collect()
    assert [(r["address_id"], r["total_price_sum"]) for r in st] == [("S-TX", total)]


def test_hot_product_and_address_third_of_rows(spark):
    """One product at one address holds a third of all sales: results stay whole."""
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        if i % 3 == 0:
            rows.append(("HOT TV", 1, "10.00", datetime(2020, 1, 1 + i % 28, 9), "1 Hot St, Austin, TX 73301"))
        else:
            n = rnd.randint(1, 20)  # one price per product: no tied versions
            rows.append((f"P{n} LAPTOP", 1 + i % 3, f"{5 + n % 5}.00",
                         datetime(2020, 2, 1 + i % 28, 10), f"{i} Side St, City{i % 7}, CA 9000{i % 5}"))
    clean, t, h, k, dim = model(spark, rows)
    f = fact.build_order_fact(clean, dim, t, h, k).cache()
    assert f.count() == 300
    current = {r["product"]: r["price_each"] for r in dim.filter("curr_status").collect()}
    want = sum(q * current[p] for p, q, *_ in rows)
    assert f.agg(F.sum("total_price")).first()[0] == want
    grand = cube.cube_slice(cube.sales_cube(f), product_surrogate_id=None, time_id=None, address_id=None)
    assert grand.first()["total_price_sum"] == want


def test_location_rollups_at_every_level_sum_to_total(spark):
    clean, t, h, k, dim = model(spark, ROWS + [("TV", 2, "50.00", datetime(2020, 4, 2, 9), "7 C St, Dallas, TX 75001")])
    f = fact.build_order_fact(clean, dim, t, h, k).cache()
    total = f.agg(F.sum("total_price")).first()[0]
    for level, n_nodes in ((0, 3), (1, 2), (2, 2), (3, 1)):
        r = cube.rollup_location(f, h, level)
        assert r.count() == n_nodes
        assert r.agg(F.sum("total_price_sum")).first()[0] == total
