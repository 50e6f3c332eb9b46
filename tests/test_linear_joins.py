"""Inequality lookups and substring matching without pairs: against brute force, with one product that holds all rows."""

import datetime as dt
import fnmatch
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import fact, product

VERSIONS = "id long, product string, price_each decimal(18,2), start_date timestamp"
CLEAN = "product string, price_each decimal(18,2), order_date timestamp"
T0 = dt.datetime(2020, 1, 1)


def given(products, n, seed):
    r = random.Random(seed)
    at = lambda: T0 + dt.timedelta(minutes=r.randint(0, 400))
    price = lambda: Decimal(r.choice([1, 1, 1, 1, 2, 3]))
    sales = [(f"P{r.randint(1, products)}", price(), at()) for _ in range(n)]
    sales += [("CALM", Decimal(5), at()) for _ in range(20)]
    versions = [(i, f"P{r.randint(1, products)}", price(), at()) for i in range(60)]
    versions += [(100, "CALM", Decimal(5), T0), (101, "CALM", Decimal(6), T0), (102, "UNSOLD", Decimal(6), T0),
                 (103, "P1", Decimal(1), dt.datetime(2019, 1, 1)), (104, "P1", Decimal(9), dt.datetime(2021, 1, 1))]
    return versions, sales


@pytest.mark.parametrize("products,n", [(1, 250), (12, 300), (3, 0)])
def test_other_prices_equal_brute_force(spark, products, n):
    versions, sales = given(products, n, products)
    later = {i: [t for q, x, t in sales if q == p and x != own and t > s] for i, p, own, s in versions}
    v, c = spark.createDataFrame(versions, VERSIONS).repartition(3), spark.createDataFrame(sales, CLEAN).repartition(4)
    got = {r.id: r.first_other for r in product.first_sale_at_other_price(v, c).collect()}
    assert got == {i: min(ts) for i, ts in later.items() if ts}
    assert sorted(r.id for r in product.sold_later_at_other_price(v, c).collect()) == sorted(i for i, ts in later.items() if ts)


def test_substring_matches_equal_like(spark):
    r = random.Random(2)
    streets = [f"{i} {r.choice(['Oak', 'Elm', 'Long Lane'])} St" for i in range(40)]
    names = streets + ["City1", "City12", "City2", "OR", "ME", "9", "97001", "", "%", "C_ty1", "100%", "Elm%OR", "nowhere at all", None, "ß", "Long Lane St, City1"]
    nodes = [(f"A{i}", n) for i, n in enumerate(names + ["City1", "OR"])]  # names shared by several nodes
    addresses = [f"{r.choice(streets)}, City{r.choice([1, 2, 12, 3])}, {r.choice(['OR', 'ME'])} 9700{i % 4}" for i in range(80)] + ["", "x", None, "100%", "Straße 9"]
    a = spark.createDataFrame([(x,) for x in addresses * 3], "purchase_address string").repartition(3)
    h = spark.createDataFrame(nodes, "address_id string, address_name string")
    got = {(x.purchase_address, x.address_id) for x in fact.substring_matches(a, h).collect()}

    def like(text, name):
        pattern = "".join({"%": "*", "_": "?", "*": "[*]", "?": "[?]", "[": "[[]"}.get(c, c) for c in name)
        return fnmatch.fnmatchcase(text, f"*{pattern}*")
    assert got == {(x, i) for x in addresses if x is not None for i, n in nodes if n is not None and like(x, n)}
    distinct = a.select(F.col("purchase_address").alias("_addr")).filter("_addr is not null").distinct()
    pairs = fact.substring_candidates(distinct, h).count()
    hits = len({(x, dict(nodes)[i]) for x, i in got})
    assert hits <= pairs <= 2.5 * hits  # the rarest piece leaves few candidates that do not match
