from datetime import datetime

from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.dates import parse_order_ts
from starloom.operators import quality

AS_OF = "2024-01-01 00:00:00"
T0 = datetime(2024, 1, 1)

# (order_id, product, qty, price, date, address, expected reason or None)
EDGE_ROWS = [
    ("1", " Usb Hub ", "2", "9.5", "01/02/23 7:05", " 1 A St, B, CA 90001 ", None),
    ("2", "X", "1", "1", "01/02/2023 07:05", "a", None),
    ("3", "X", "1", "1", "01/02/95 07:05", "a", None),
    ("Order ID", "Product", "Quantity Ordered", "Price Each", "Order Date", "Purchase Address", S.REASON_ORDER_ID),
    ("", "X", "1", "1", "01/02/23 07:05", "a", S.REASON_ORDER_ID),
    (None, "X", "1", "1", "01/02/23 07:05", "a", S.REASON_ORDER_ID),
    (" 4", "X", "1", "1", "01/02/23 07:05", "a", S.REASON_ORDER_ID),
    ("-4", "X", "1", "1", "01/02/23 07:05", "a", S.REASON_ORDER_ID),
    ("5", None, "1", "1", "01/02/23 07:05", "a", S.REASON_PRODUCT_NULL),
    ("6", "", "1", "1", "01/02/23 07:05", "a", None),
    ("7", "X", "1.5", "1", "01/02/23 07:05", "a", S.REASON_QTY_FORMAT),
    ("8", "X", "0", "1", "01/02/23 07:05", "a", S.REASON_QTY_NOT_POSITIVE),
    ("9", "X", None, "1", "01/02/23 07:05", "a", S.REASON_UNKNOWN),
    ("10", "X", "1", "1.234", "01/02/23 07:05", "a", S.REASON_PRICE_FORMAT),
    ("11", "X", "1", "0.00", "01/02/23 07:05", "a", S.REASON_PRICE_NOT_POSITIVE),
    ("12", "X", "1", "1", None, "a", S.REASON_DATE_NULL),
    ("13", "X", "1", "1", "01/02/30 07:05", "a", S.REASON_DATE_FUTURE),
    ("14", "X", "1", "1", "01/02/23 07:05", None, S.REASON_ADDRESS_NULL),
    ("15", "X", "1", "1", "13/45/23 07:05", "a", S.REASON_DATE_INVALID),
    ("99999999999", "X", "1", "1", "01/02/23 07:05", "a", S.REASON_ORDER_ID_RANGE),
    ("16", "X", "99999999999", "1", "01/02/23 07:05", "a", S.REASON_QTY_RANGE),
    ("17", "X", "1", ".5", "01/02/23 07:05", "a", S.REASON_PRICE_FORMAT),
    ("18", "X", None, "1.234", "01/02/23 07:05", "a", S.REASON_PRICE_FORMAT),
    ("19", "X", "1", "1", "", "a", S.REASON_DATE_INVALID),
    ("20", "X", "1", "1", "02/30/2023 07:05", "a", S.REASON_DATE_INVALID),
    ("21", "X", "1", "1", "01/02/23 07:05 junk", "a", S.REASON_DATE_INVALID),
    ("22", "X", "1", None, "01/02/23 07:05", "a", S.REASON_UNKNOWN),
]


def landing(spark, rows, ts=T0):
    return spark.createDataFrame([(*r[:6], ts) for r in rows], S.LANDING_SCHEMA)


def test_reasons_in_order(spark):
    # With the source's INT limits; without them only what 64 bits cannot hold is out of range.
    tagged = quality.tag_rows(landing(spark, EDGE_ROWS), AS_OF, int_limits=True)
    got = {r["order_id"]: r["error_reason"] for r in tagged.select("order_id", "error_reason").collect()}
    for row in EDGE_ROWS:
        assert got[row[0]] == row[6], row
    wide = [("99999999999", "X", "1", "1", "01/02/23 07:05", "a"), ("9" * 19, "X", "1", "1", "01/02/23 07:05", "a"),
            ("16", "X", "9" * 19, "1", "01/02/23 07:05", "a")]
    got = {r["order_id"]: r["error_reason"] for r in quality.tag_rows(landing(spark, wide), AS_OF).collect()}
    assert got == {"99999999999": None, "9" * 19: S.REASON_ORDER_ID_RANGE, "16": S.REASON_QTY_RANGE}


def test_clean_typed_values(spark):
    clean, errors = quality.validate_split(landing(spark, EDGE_ROWS[:3]), AS_OF)
    rows = {r["order_id"]: r for r in clean.collect()}
    assert errors.count() == 0
    r1 = rows[1]
    assert r1["product"] == "USB HUB" and r1["quantity_ordered"] == 2
    assert str(r1["price_each"]) == "9.50"
    assert r1["order_date"] == datetime(2023, 1, 2, 7, 5)
    assert r1["purchase_address"] == "1 A St, B, CA 90001"
    assert rows[2]["order_date"].year == 2023 and rows[3]["order_date"].year == 1995


def test_split_is_a_partition_of_the_input(spark):
    df = landing(spark, EDGE_ROWS)
    clean, errors = quality.validate_split(df, AS_OF, int_limits=True)
    assert clean.count() + errors.count() == df.count()
    assert clean.count() == sum(1 for r in EDGE_ROWS if r[6] is None)


def test_century_pivot_and_widths(spark):
    cases = [("01/02/69 7:05", datetime(2069, 1, 2, 7, 5)), ("01/02/70 7:05", datetime(1970, 1, 2, 7, 5)),
             ("1/2/2019 17:05", datetime(2019, 1, 2, 17, 5)), ("09/17/19 14:44", datetime(2019, 9, 17, 14, 44)),
             ("09/17/019 14:44", None), ("9/17/19 14:4", None), ("24/01/19 10:00", None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "s string")
    got = [r[0] for r in df.select(parse_order_ts("s")).collect()]
    assert got == [e for _, e in cases]


def test_latest_batch(spark):
    a = landing(spark, EDGE_ROWS[:2], datetime(2024, 1, 1))
    b = landing(spark, EDGE_ROWS[2:3], datetime(2024, 1, 2))
    out = quality.latest_batch(a.unionByName(b)).collect()
    assert [r["order_id"] for r in out] == ["3"]


def test_anti_dedup_typed_and_text(spark):
    first = landing(spark, EDGE_ROWS[:3])
    clean, _ = quality.validate_split(first, AS_OF)
    again = landing(spark, [("1", "usb hub", "2", "9.50", "1/2/2023 07:05", "1 A St, B, CA 90001", None),
                            ("2", "X", "1", "1", "01/02/2023 07:05", "a", None),
                            ("2", "X", "2", "1", "01/02/2023 07:05", "a", None)])
    kept = quality.anti_dedup(again, clean, "typed")
    assert sorted((r["order_id"], r["quantity_ordered"]) for r in kept.collect()) == [("2", "2")]
    # The source compares the typed date as text with the raw text: never equal.
    assert quality.anti_dedup(again, clean, "text").count() == 3


def test_error_ids_continue_and_are_contiguous(spark):
    _, errors = quality.validate_split(landing(spark, EDGE_ROWS), AS_OF)
    ids = sorted(r["error_id"] for r in quality.assign_error_ids(errors, 101).collect())
    assert ids == list(range(101, 101 + errors.count()))


def test_assert_quality_counts_violations(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "q int")
    rep = {r["check"]: r["violations"] for r in
           quality.assert_quality(df, {"positive": F.col("q") > 0, "present": F.col("q").isNotNull()}).collect()}
    assert rep == {"positive": 2, "present": 1}


def test_blank_is_null_option(spark):
    rows = [("6", "", "1", "1", "01/02/23 07:05", "a", None), ("7", "X", "1", "1", "01/02/23 07:05", "  ", None)]
    df = landing(spark, rows)
    default = {r["order_id"]: r["error_reason"] for r in quality.tag_rows(df, AS_OF).collect()}
    assert default == {"6": None, "7": None}
    strict = {r["order_id"]: r["error_reason"] for r in quality.tag_rows(df, AS_OF, blank_is_null=True).collect()}
    assert strict == {"6": S.REASON_PRODUCT_NULL, "7": S.REASON_ADDRESS_NULL}


def test_max_lengths_option(spark):
    rows = [("1", "X" * 101, "1", "1", "01/02/23 07:05", "a", None), ("2", "X", "1", "1", "01/02/23 07:05", "a", None)]
    got = {r["order_id"]: r["error_reason"] for r in
           quality.tag_rows(landing(spark, rows), AS_OF, max_lengths=S.LANDING_WIDTHS).collect()}
    assert got == {"1": "Product is too long", "2": None}
