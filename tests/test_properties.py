"""Properties over random inputs (few examples each: every example is a Spark job)."""

from datetime import datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import calendar, product
from starloom.operators.keys import group_sequence

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

sales_st = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(["1.00", "2.50", "3.00", "9.99"]),
              st.integers(min_value=0, max_value=400), st.integers(min_value=0, max_value=23)),
    min_size=1, max_size=40)


def brute_scd2(rows):
    """Versions by (product, price) with the first sale; ends at next distinct start - 1 day."""
    first = {}
    for p, pr, day, hour in rows:
        ts = datetime(2020, 1, 1) + timedelta(days=day, hours=hour)
        first[(p, pr)] = min(first.get((p, pr), ts), ts)
    out = {}
    for (p, pr), start in first.items():
        later = sorted({s for (q, _), s in first.items() if q == p and s > start})
        latest = max(s for (q, _), s in first.items() if q == p)
        out[(p, pr)] = (start, later[0] - timedelta(days=1) if later else None, start == latest)
    return out


@settings(**SETTINGS)
@given(sales_st)
def test_scd2_matches_brute_force_and_never_overlaps(spark, rows):
    clean = spark.createDataFrame(
        [(i, p, 1, Decimal(pr), datetime(2020, 1, 1) + timedelta(days=d, hours=h), "a", datetime(2024, 1, 1))
         for i, (p, pr, d, h) in enumerate(rows)], S.CLEAN_SCHEMA)
    dim, _ = product.populate_product(clean)
    got = {(r["product"], str(r["price_each"])): (r["start_date"], r["end_date"], r["curr_status"])
           for r in dim.collect()}
    assert got == brute_scd2(rows)
    by_product = {}
    for (p, _), (s, e, _) in got.items():
        by_product.setdefault(p, []).append((s, e))
    for spans in by_product.values():
        spans.sort()
        for (s1, e1), (s2, _) in zip(spans, spans[1:]):
            assert s1 == s2 or (e1 is not None and e1 < s2)


@settings(**SETTINGS)
@given(st.integers(min_value=1990, max_value=2040), st.integers(min_value=0, max_value=2))
def test_calendar_parents_exist(spark, year, span):
    df = spark.createDataFrame([(datetime(year, 3, 1),), (datetime(year + span, 11, 30),)], "order_date timestamp")
    rows = calendar.build_time_dimension(df).collect()
    ids = {(r["timebranch"], r["time_id"]) for r in rows}
    assert len({r["time_combined_id"] for r in rows}) == len(rows)
    for r in rows:
        if r["time_parent"] is None:
            # roots: years and weeks; orphans: leading days of the previous ISO year
            assert r["time_lvl"] in ("4", "1") or (r["timebranch"] == "week" and r["day_date"].month == 1)
        else:
            assert (r["timebranch"], r["time_parent"]) in ids


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "x", "y", None]),
                          st.integers(min_value=0, max_value=50)), min_size=1, max_size=120),
       st.integers(min_value=1, max_value=9))
def test_group_sequence_is_row_number(spark, rows, parts):
    df = spark.createDataFrame(rows, "g string, v int").withColumn("u", F.monotonically_increasing_id())
    got = {(r["g"], r["v"], r["u"]): r["n"] for r in
           group_sequence(df, ["g"], ["v", "u"], "n", partitions=parts).collect()}
    want = {(r["g"], r["v"], r["u"]): r["n"] for r in
            df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v", "u"))).collect()}
    assert got == want
