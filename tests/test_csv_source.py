"""CSV files with headers of their own, malformed records, and streams over them."""

import os
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.plans.warehouse import Warehouse
from starloom.sources.landing import landing_of, load_landing, malformed_of, parse_lines, read_landing_csv, with_origin
from starloom.streaming.trigger import start_landing_stream

FULL = "Order ID,Product,Quantity Ordered,Price Each,Order Date,Purchase Address"
FILES = {
    "a.csv": f'﻿{FULL}\n1,"Cable, short",2,3.50,01/02/23 7:05,"1 Elm St, Town, OR 97001"\n{FULL}\n',
    "b.csv": 'Purchase Address,Note,Order Date,Price Each,Product,Quantity Ordered,Order ID\r\n\r\n"2 Oak St, Town, OR 97001",x,01/03/23 7:05,4.00,"A ""B"" TV",1,2\r\n',
    "c.csv": "Product,Order ID\nLamp,3\n",
    "d.csv": f'\n{FULL}\n4,Short\n5,Long,1,2.00,01/02/23 7:05,x,y,z\n6,"Open,1,2.00,01/02/23 7:05,x\n7,,1,2.00,01/02/23 7:05,\n',
    "e.csv": "", "f.csv": FULL}


@pytest.fixture()
def folder():
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-csv-"), "in")
    os.makedirs(path)
    for name, text in FILES.items():
        with open(os.path.join(path, name), "w", newline="", encoding="utf-8") as fh:
            fh.write(text)
    with open(os.path.join(path, "g.csv"), "wb") as fh:
        fh.write(FULL.encode() + b"\n8,Caf\xe9,1,2.00,01/02/23 7:05,x\n")
    return path


def test_each_file_by_its_header(spark, folder):
    got = {r.order_id: r for r in read_landing_csv(spark, folder, datetime(2024, 1, 1)).collect()}
    assert set(got) == {"1", "2", "3", "4", "5", "6", "7", "8", "Order ID"}  # a header line that comes again is a row
    assert (got["1"].product, got["1"].purchase_address) == ("Cable, short", "1 Elm St, Town, OR 97001")
    assert (got["2"].product, got["2"].quantity_ordered, got["2"].purchase_address) == ('A "B" TV', "1", "2 Oak St, Town, OR 97001")
    assert (got["3"].product, got["3"].price_each, got["4"].price_each, got["5"].purchase_address) == ("Lamp", "", "", "x")
    assert (got["7"].product, got["7"].purchase_address) == ("", "")


def test_malformed_records_are_reported(spark, folder):
    parsed = parse_lines(with_origin(spark.read.text(folder)))
    bad = {r.order_id: r for r in malformed_of(parsed, "2024-01-01 00:00:00").collect()}
    assert {k: r.error_reason for k, r in bad.items()} == {
        "4": "Too few fields", "5": "Too many fields", "6": "Unclosed quote", "8": "Invalid encoding"}
    assert bad["5"].record == "5,Long,1,2.00,01/02/23 7:05,x,y,z"
    assert {r.order_id for r in landing_of(parsed, malformed="reject").collect()} == {"1", "2", "3", "7", "Order ID"}
    with pytest.raises(ValueError):
        landing_of(parsed, malformed="drop")


def test_jobs_do_not_follow_the_number_of_files(spark):
    base = tempfile.mkdtemp(prefix="starloom-many-")
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for n in (2, 40):
        path = os.path.join(base, str(n))
        os.makedirs(path)
        for i in range(n):
            with open(os.path.join(path, f"{i}.csv"), "w") as fh:
                fh.write(f"Product,Order ID,x{i % 3}\np,{i},\n")
        spark.sparkContext.setJobGroup(f"files-{n}", "")
        assert read_landing_csv(spark, path).count() == n
        jobs.append(len(tracker.getJobIdsForGroup(f"files-{n}")))
    spark.sparkContext.setJobGroup("rest", "")
    assert abs(jobs[0] - jobs[1]) <= 1


def test_large_file_in_several_blocks(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-blocks-"), "big.csv")
    with open(path, "w") as fh:
        fh.write("Product,Order ID\n" + "".join(f'"item, {i}",{i}\n' for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        got = read_landing_csv(spark, path).agg(F.count("*").alias("n"), F.sum(F.col("order_id").cast("long")).alias("s")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (got.n, got.s) == (20_000, sum(range(20_000)))


def test_landing_a_batch_again_replaces_it(spark, folder):
    target = os.path.join(os.path.dirname(folder), "landing")
    for batch in (0, 1, 0):
        load_landing(spark, folder, target, "2024-01-01 00:00:00", batch_id=batch)
    assert [(r.batch_id, r["count"]) for r in spark.read.parquet(target).groupBy("batch_id").count().orderBy("batch_id").collect()] == [(0, 9), (1, 9)]


def test_stream_over_two_headers(spark, folder):
    base = os.path.dirname(folder)
    src = os.path.join(base, "landing")
    for k, name in enumerate(("a.csv", "b.csv")):
        os.makedirs(os.path.join(src, f"batch={k}"))
        with open(os.path.join(src, f"batch={k}", name), "w", newline="", encoding="utf-8") as fh:
            fh.write(FILES[name])
    wh = Warehouse(spark, os.path.join(base, "wh"))
    start_landing_stream(spark, src, wh, os.path.join(base, "ckpt"), stamp_for=lambda k: datetime(2024, 1, 1 + k),
                         as_of="2024-06-01 00:00:00", malformed="reject").awaitTermination()
    runs = wh.committed()
    assert sorted((r.order_id, r.product) for r in wh.read("clean", runs).collect()) == [(1, "CABLE, SHORT"), (2, 'A "B" TV')]
