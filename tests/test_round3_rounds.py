"""Steps that grew with the sales: substring matching dealt narrow (F11), streets worked out once, small numberings in few files (F13)."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import calendar, fact, keys, location, product
from starloom.session import cut_lineage

ROWS = [("TV", 1, "10.00", datetime(2020, 1, 5, 10), "1 A St, Austin, TX 73301"),
        ("TV", 2, "10.00", datetime(2020, 1, 6, 10), "11 A St, Austin, TX 73301"),
        ("PHONE", 2, "20.00", datetime(2020, 2, 6, 10), "2 B St, Austin, TX 73301"),
        ("PHONE", 3, "20.00", datetime(2020, 2, 6, 23, 59), "no place")]


@pytest.fixture()
def clean(spark):
    return spark.createDataFrame([(i, p, q, Decimal(pr), ts, a, datetime(2024, 1, 1)) for i, (p, q, pr, ts, a) in enumerate(ROWS)], S.CLEAN_SCHEMA)


def _fact(clean):
    t = calendar.build_time_dimension(clean)
    h, k = location.build_location_hierarchy(location.clean_address_process(clean))
    return fact.build_order_fact(clean, cut_lineage(product.populate_product(clean)[0]), t, h, k, "substring")


def _joins(df):
    return [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]


def test_substring_sales_are_dealt_narrow(monkeypatch, clean):
    few = _fact(clean)
    monkeypatch.setattr(fact, "FEW_NODES", 0)
    many = _fact(clean)
    # Product and day columns join above the nodes, which the sales meet with the number of their version.
    joins = _joins(many)
    at = {c: next(i for i, x in enumerate(joins) if c in x) for c in ("_p_row", "_t_day", "_m_addr", "_p_key")}
    assert max(at["_p_row"], at["_t_day"]) < at["_m_addr"] < at["_p_key"]
    rows = sorted(map(str, many.collect()))
    assert rows == sorted(map(str, few.collect())) and len(rows) == 13
    monkeypatch.setattr(fact, "FEW_VERSIONS", 0)
    assert rows == sorted(map(str, _fact(clean).collect()))


def test_only_rarest_pieces_are_dealt(monkeypatch, spark):
    names = ["1 Oak St", "11 Oak St", "City1", "OR", "", "%", "C_ty1", "nowhere", None, "OR"]
    addresses = spark.createDataFrame([("1 Oak St, City1, OR 9",), ("11 Oak St, City12, OR 9",), ("",), ("x",)], "_addr string")
    nodes = spark.createDataFrame([(x,) for x in names], "address_name string")
    pairs = fact.substring_candidates(addresses, nodes)
    assert any("LeftSemi" in x for x in _joins(pairs))
    got = sorted(map(str, pairs.collect()))
    monkeypatch.setattr(fact, "FEW_PIECES", 0)
    plain = fact.substring_candidates(addresses, nodes)
    assert not any("LeftSemi" in x for x in _joins(plain))
    assert got == sorted(map(str, plain.collect())) and got


def test_streets_are_numbered_and_placed_once(clean):
    h, k = location.build_location_hierarchy(location.clean_address_process(clean))
    files = set(k.inputFiles())
    assert files and files <= set(h.inputFiles()), "the nodes and the keys read the written streets"
    assert "Join" not in k._jdf.queryExecution().optimizedPlan().toString()


def test_written_texts_are_not_written_again(clean):
    texts = cut_lineage(clean.select("purchase_address").distinct(), "address-texts")
    again = location.clean_address_process(texts, written=True)
    assert set(again.inputFiles()) == set(texts.inputFiles())
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, location.clean_address_process(clean).collect()))


def test_small_numberings_are_joined_ranges(spark):
    # Four ranges of a few rows: one file, and the numbers go on through it.
    df = spark.createDataFrame([(i % 3, 40 - i) for i in range(40)], "g int, v int").repartition(5)
    assert len(keys.range_tagged(df, [F.col("g"), F.col("v")]).inputFiles()) == 1
    got = sorted((r.g, r.v, r.n) for r in keys.group_sequence(df, ["g"], ["v"], "n").collect())
    want = {g: sorted(40 - i for i in range(40) if i % 3 == g) for g in range(3)}
    assert got == [(g, v, n) for g in range(3) for n, v in enumerate(want[g], 1)]
