from datetime import datetime
from decimal import Decimal

from starloom import schemas as S
from starloom.operators import product


def clean(spark, rows):
    return spark.createDataFrame(
        [(i, p, 1, Decimal(str(pr)), d, "a", datetime(2024, 1, 1)) for i, (p, pr, d) in enumerate(rows)],
        S.CLEAN_SCHEMA)


def d(m, day=1):
    return datetime(2020, m, day)


def versions(dim):
    return sorted((r["product"], str(r["price_each"]), r["start_date"], r["end_date"], r["curr_status"])
                  for r in dim.collect())


def test_single_and_changed_price(spark):
    dim, _ = product.populate_product(clean(spark, [("A", 1, d(1)), ("A", 2, d(3)), ("B", 5, d(2))]))
    v = versions(dim)
    assert v == [("A", "1.00", d(1), datetime(2020, 2, 29), False), ("A", "2.00", d(3), None, True),
                 ("B", "5.00", d(2), None, True)]
    ids = {r["product"]: r["product_id"] for r in dim.collect()}
    assert ids == {"A": "PROD-00001", "B": "PROD-00002"}


def test_price_seen_before_is_not_a_new_version(spark):
    dim, _ = product.populate_product(clean(spark, [("A", 1, d(1)), ("A", 2, d(3)), ("A", 1, d(5))]))
    assert len(versions(dim)) == 2


def test_equal_start_dates_give_two_current_rows(spark):
    dim, _ = product.populate_product(clean(spark, [("A", 1, d(1)), ("A", 2, d(1))]))
    assert [r[4] for r in versions(dim)] == [True, True]


def test_incremental_run_continues_ids_and_closes_versions(spark):
    first, _ = product.populate_product(clean(spark, [("A", 1, d(1)), ("B", 5, d(2))]))
    first = first.cache()
    second, _ = product.populate_product(
        clean(spark, [("A", 1, d(1)), ("B", 5, d(2)), ("A", 3, d(6)), ("C", 7, d(4))]), first)
    rows = {(r["product"], str(r["price_each"])): r for r in second.collect()}
    assert rows[("C", "7.00")]["product_id"] == "PROD-00003"
    assert rows[("A", "3.00")]["product_id"] == "PROD-00001"
    assert sorted(r["id"] for r in rows.values()) == [1, 2, 3, 4]
    assert rows[("A", "1.00")]["end_date"] == datetime(2020, 5, 31)
    assert rows[("A", "1.00")]["curr_status"] is False
    # A second run with nothing new changes nothing.
    third, _ = product.populate_product(clean(spark, [("A", 1, d(1))]), second.cache())
    assert versions(third) == versions(second)


def test_late_arriving_middle_version_is_contiguous(spark):
    first, _ = product.populate_product(clean(spark, [("A", 1, d(1)), ("A", 3, d(9))]))
    second, _ = product.populate_product(clean(spark, [("A", 2, d(5))]), first.cache())
    v = versions(second)
    assert [x[3] for x in v] == [datetime(2020, 4, 30), datetime(2020, 8, 31), None]


def test_reversion_is_identity_on_canonical_form(spark):
    c = clean(spark, [("A", 1, d(1)), ("A", 2, d(3)), ("A", 1, d(5)), ("B", 5, d(2))])
    dim, _ = product.populate_product(c)
    assert versions(product.scd2_reversion(dim, c)) == versions(dim)


def test_reversion_closes_a_stale_current_row(spark):
    c = clean(spark, [("A", 1, d(1)), ("A", 2, d(3))])
    stale = spark.createDataFrame(
        [(1, "PROD-00001", "A", Decimal("1.00"), d(1), None, True, "CAT-00009", "OTHERS")], S.PRODUCT_SCHEMA)
    out = product.scd2_reversion(stale, c).collect()[0]
    # The only version is also the latest: step 2 re-opens it.
    assert out["curr_status"] is True and out["end_date"] is None


def test_point_in_time_mapping(spark):
    c = clean(spark, [("A", 1, d(1)), ("A", 2, d(3)), ("A", 1, datetime(2020, 2, 29, 12))])
    dim, mapped = product.populate_product(c)
    got = sorted((r["order_date"], r["product_sk"]) for r in mapped.collect())
    # The sale at the old price inside the one-day gap matches no version.
    assert [g[0] for g in got] == [d(1), d(3)]


def test_categories_first_match(spark):
    df = spark.createDataFrame([("Wired Headphones",), ("iPhone",), ("usb-c cable",), ("dryer",), ("x",)], "product string")
    got = {r["product"]: r["category_name"] for r in product.categorise(df).collect()}
    assert got == {"Wired Headphones": "HEADPHONES", "iPhone": "PHONE", "usb-c cable": "ACCESSORIES",
                   "dryer": "APPLIANCES", "x": "OTHERS"}
