"""End to end on a small sample-shaped CSV fixture of our own.

Three date shapes (MM/DD/YY HH:MM, MM/DD/YYYY HH:MM, MM/DD/YYYY H:MM), one
exact duplicate row, one city name under two postal codes, quoted commas.
Goldens are computed by brute force in Python from the same rows.
"""

import csv
import os
import tempfile
from datetime import datetime
from decimal import Decimal

from starloom.plans.warehouse import Warehouse, run_warehouse_batch, warehouse_totals
from starloom.sources.landing import read_landing_csv
from starloom.streaming.trigger import start_landing_stream

HEADER = ["Order ID", "Product", "Quantity Ordered", "Price Each", "Order Date", "Purchase Address"]
BATCH1 = [
    ["100", "Garden Batteries box", "4", "6.35", "03/05/19 16:20", "17 Lantern Row, Mill Haven, KS 66002"],
    ["101", "Braided Cable 3m", "2", "8.45", "03/11/2019 11:35", "6 Quarry Ln, Dunmore, NV 89007"],
    ["102", "Kestrel Monitor", "1", "212.40", "03/08/2019 7:42", "92 Tidewater Rd, Ferrow, MN 55011"],
    ["103", "Osprey Headphones", "1", "17.25", "03/02/19 06:15", "3 Copper Ct, Westlow, VT 05033"],
    ["104", "Osprey Headphones", "2", "17.25", "03/04/19 06:15", "8 Juniper Way, Westlow, ID 83209"],
    ["104", "Osprey Headphones", "2", "17.25", "03/04/19 06:15", "8 Juniper Way, Westlow, ID 83209"],
    ["Order ID", "Product", "Quantity Ordered", "Price Each", "Order Date", "Purchase Address"],
]
BATCH2 = [
    ["105", "Kestrel Monitor", "1", "198.70", "04/01/19 09:30", "92 Tidewater Rd, Ferrow, MN 55011"],
    ["100", "Garden Batteries box", "4", "6.35", "03/05/19 16:20", "17 Lantern Row, Mill Haven, KS 66002"],
    ["106", "Heron Laptop", "0", "903.10", "04/02/19 13:10", "5 Orchard Sq, Dunmore, NV 89007"],
]


def write_csv(folder, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part-0.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(HEADER)
        w.writerows(rows)


def expected():
    # batch 1: 6 valid rows (duplicate kept within a batch), 1 header row rejected
    # batch 2: the re-sent order 100 is skipped, order 106 rejected (quantity 0)
    clean = [r for r in BATCH1 if r[0] != "Order ID"] + [BATCH2[0]]
    amount = sum(int(r[2]) * Decimal(r[3]) for r in clean)
    current = {"GARDEN BATTERIES BOX": Decimal("6.35"), "BRAIDED CABLE 3M": Decimal("8.45"),
               "KESTREL MONITOR": Decimal("198.70"), "OSPREY HEADPHONES": Decimal("17.25")}
    fact = sum(int(r[2]) * current[r[1].upper()] for r in clean)
    return {"clean": (7, amount), "errors": (2, Decimal(3)), "product": (5, sum(current.values())),
            "fact": (7, fact), "time_dim": (802, 0)}


def check(totals):
    got = {r["table_name"]: (r["row_count"], r["amount"]) for r in totals.collect()}
    for table, (rows, amount) in expected().items():
        assert got[table][0] == rows, table
        assert got[table][1] == amount, table
    # 5 states, 5 postal codes, 5 cities (Westlow twice), 6 streets
    assert got["location"][0] == 5 + 5 + 5 + 6
    assert got["cube"][1] == 8 * got["fact"][1]


def test_batch_runs(spark):
    base = tempfile.mkdtemp(prefix="starloom-wh-")
    write_csv(os.path.join(base, "in", "b1"), BATCH1)
    write_csv(os.path.join(base, "in", "b2"), BATCH2)
    wh = Warehouse(spark, os.path.join(base, "wh"))
    as_of = "2024-01-01 00:00:00"
    run_warehouse_batch(wh, read_landing_csv(spark, os.path.join(base, "in", "b1"), datetime(2024, 1, 1)), 0, as_of)
    run_warehouse_batch(wh, read_landing_csv(spark, os.path.join(base, "in", "b2"), datetime(2024, 1, 2)), 1, as_of)
    check(warehouse_totals(wh))
    # Re-running a run is idempotent.
    run_warehouse_batch(wh, read_landing_csv(spark, os.path.join(base, "in", "b2"), datetime(2024, 1, 2)), 1, as_of)
    check(warehouse_totals(wh))


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="starloom-stream-")
    src = os.path.join(base, "landing")
    write_csv(os.path.join(src, "batch=0"), BATCH1)
    wh = Warehouse(spark, os.path.join(base, "wh"))
    stamps = [datetime(2024, 1, 1), datetime(2024, 1, 2)]
    q = start_landing_stream(spark, src, wh, os.path.join(base, "ckpt"), stamp_for=lambda k: stamps[k],
                             as_of="2024-01-01 00:00:00")
    q.awaitTermination()
    write_csv(os.path.join(src, "batch=1"), BATCH2)
    q = start_landing_stream(spark, src, wh, os.path.join(base, "ckpt"), stamp_for=lambda k: stamps[k],
                             as_of="2024-01-01 00:00:00")
    q.awaitTermination()
    check(warehouse_totals(wh))
    # A restart with no new files adds nothing.
    q = start_landing_stream(spark, src, wh, os.path.join(base, "ckpt"), stamp_for=lambda k: stamps[k],
                             as_of="2024-01-01 00:00:00")
    q.awaitTermination()
    check(warehouse_totals(wh))


def test_analyst_views(spark):
    from starloom.plans.warehouse import register_views
    base = tempfile.mkdtemp(prefix="starloom-views-")
    write_csv(os.path.join(base, "in", "b1"), BATCH1)
    wh = Warehouse(spark, os.path.join(base, "wh"))
    run_warehouse_batch(wh, read_landing_csv(spark, os.path.join(base, "in", "b1"), datetime(2024, 1, 1)), 0,
                        "2024-01-01 00:00:00")
    assert "sales_data_cube" in register_views(wh)
    total = spark.sql("SELECT total_price_sum FROM sales_data_cube WHERE product_surrogate_id IS NULL "
                      "AND time_id IS NULL AND address_id IS NULL").first()[0]
    assert total == spark.sql("SELECT sum(total_price) FROM order_fact").first()[0]
    assert spark.sql("SELECT count(*) FROM orders_updated").first()[0] == 6


def test_load_landing_appends_and_fills_blanks(spark):
    from starloom.sources.landing import load_landing
    base = tempfile.mkdtemp(prefix="starloom-load-")
    folder = os.path.join(base, "in")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w", newline="") as fh:
        # Columns out of order, one missing, an extra one, an empty field, a quoted comma.
        fh.write('Product,Order ID,Extra,Order Date,Price Each,Quantity Ordered\n')
        fh.write('"Cable, USB",7,x,01/02/23 7:05,,2\n')
    target = os.path.join(base, "landing")
    load_landing(spark, folder, target, "2024-01-01 00:00:00")
    load_landing(spark, folder, target, "2024-01-02 00:00:00")
    rows = spark.read.parquet(target).collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r["order_id"], r["product"], r["price_each"], r["purchase_address"]) == ("7", "Cable, USB", "", "")


def test_repeated_file_adds_no_clean_rows(spark):
    base = tempfile.mkdtemp(prefix="starloom-repeat-")
    src = os.path.join(base, "landing")
    wh = Warehouse(spark, os.path.join(base, "wh"))
    stamps = [datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)]
    for k, rows in enumerate([BATCH1, BATCH2, BATCH1]):
        write_csv(os.path.join(src, f"batch={k}"), rows)
    q = start_landing_stream(spark, src, wh, os.path.join(base, "ckpt"), stamp_for=lambda k: stamps[k],
                             as_of="2024-01-01 00:00:00")
    q.awaitTermination()
    got = {r["table_name"]: (r["row_count"], r["amount"]) for r in warehouse_totals(wh).collect()}
    want = expected()
    for table in ("clean", "product", "fact"):
        assert got[table] == want[table], table
    # Rejected rows are not deduplicated (as in the source): the header row is logged again.
    assert got["errors"][0] == want["errors"][0] + 1
