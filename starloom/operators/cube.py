"""Sales cube, slices and level roll-ups (O-23, O-25).

The cube is a lattice: the fact is reduced to its finest (product, time, address) grain once, and every smaller grouping set
is summed from the smallest set that holds its keys, so no row is expanded and the fact is read once. The sets of a level are stored,
which tells their sizes; the last level and the grand total are sums over those. The grand total is a global aggregate: an empty input
has one (SQL's rule), whatever Spark's CUBE gives.

``cube_rows`` keeps the grouping set and the number of fact rows of every cell, so a later change of the fact can be added
to each set (``add_cells``): cells whose rows are all gone disappear.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.schemas import CUBE_SUM_TYPE
from starloom.session import DENSE, cut_lineage

KEYS = ("product_surrogate_id", "time_id", "address_id")
CELL = ["grouping_set", "total", "n_rows"]


def finest_cells(fact: DataFrame, keys=KEYS, measure: str = "total_price") -> DataFrame:
    """keys, total and n_rows of the finest grain."""
    return fact.groupBy(*keys).agg(F.sum(measure).cast(CUBE_SUM_TYPE).alias("total"), F.count(F.lit(1)).alias("n_rows"))


def summed_cells(cells: DataFrame, kept, keys=KEYS) -> DataFrame:
    """``cells`` of a larger set summed over the keys not in ``kept`` (NULL there)."""
    sums = [F.sum("total").cast(CUBE_SUM_TYPE).alias("total"), F.sum("n_rows").alias("n_rows")]
    rolled = cells.groupBy(*kept).agg(*sums) if kept else cells.agg(*sums)
    return rolled.select(*[F.col(k) if k in kept else F.lit(None).cast(cells.schema[k].dataType).alias(k) for k in keys],
                         F.lit(set_number(kept, keys)).alias("grouping_set"), "total", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))


def set_number(kept, keys=KEYS) -> int:
    """A grouping set as bits: one for every key that is rolled up (the first key's is the highest)."""
    return sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in kept)


def add_cells(old: DataFrame, new: DataFrame, keys=KEYS) -> DataFrame:
    """Cells of the same grouping sets added up (``new`` may hold negative ones); a cell without rows goes, the grand total stays."""
    return (old.unionByName(new).groupBy(*keys, "grouping_set")
            .agg(F.sum("total").cast(CUBE_SUM_TYPE).alias("total"), F.sum("n_rows").alias("n_rows"))
            .filter((F.col("n_rows") != 0) | (F.col("grouping_set") == set_number((), keys))))


def negated(cells: DataFrame) -> DataFrame:
    return cells.withColumns({"total": (-F.col("total")).cast(CUBE_SUM_TYPE), "n_rows": -F.col("n_rows")})


def cube_rows(finest: DataFrame, keys=KEYS) -> DataFrame:
    """keys, grouping_set, total, n_rows of all grouping sets over stored finest cells."""
    keys = list(keys)
    whole = tuple(keys)
    level, size_of = {whole: finest}, {whole: 0}
    out = finest.select(*keys, F.lit(0).alias("grouping_set"), "total", "n_rows")
    for size in range(len(keys) - 1, -1, -1):
        made = {}
        for kept in combinations(keys, size):
            parent = min((p for p in level if set(kept) <= set(p)), key=lambda p: size_of[p])
            made[kept] = summed_cells(level[parent], kept, keys)
        both = None
        for df in made.values():
            both = df if both is None else both.unionByName(df)
        if size > 1:
            both = cut_lineage(both, f"cube-{size}", DENSE)
            # One number a grouping set reaches the driver.
            counted = {r.grouping_set: r.n for r in both.groupBy("grouping_set").agg(F.count(F.lit(1)).alias("n")).collect()}
            made = {k: both.filter(F.col("grouping_set") == set_number(k, keys)) for k in made}
            size_of = {k: counted.get(set_number(k, keys), 0) for k in made}
        else:
            size_of = dict.fromkeys(made, 0)
        out, level = out.unionByName(both), made
    return out


def _shaped(cells: DataFrame, kept, keys, like: DataFrame, also=()) -> DataFrame:
    """Cells of the set ``kept`` with all keys (NULL where rolled up) and the set's number."""
    return cells.select(*[F.col(k) if k in kept else F.lit(None).cast(like.schema[k].dataType).alias(k) for k in keys],
                        F.lit(set_number(kept, keys)).alias("grouping_set"), "total", "n_rows", *also)


def sets_with(fact: DataFrame, key: str, keys=KEYS, measure: str = "total_price", also=()) -> list[DataFrame]:
    """The cells of the grouping sets that keep ``key``, after one deal of a stored fact's rows by its ranges: a task holds whole values of it, so
    every set is summed where its rows are. For keys of many values (days, addresses): one of long values is best, the sets without it are then dealt by short ones. ``also``: columns that follow from ``key``, kept with the cells."""
    rows = fact.select(*keys, *also, measure).repartitionByRange(*[F.col(c) for c in (*also, key)])
    cells = finest_cells(rows, [*keys, *also], measure)
    sums = [F.sum("total").cast(CUBE_SUM_TYPE).alias("total"), F.sum("n_rows").alias("n_rows")]
    out = []
    for size in range(len(keys), 0, -1):
        for kept in (c for c in combinations(keys, size) if key in c):
            out.append(_shaped(cells if size == len(keys) else cells.groupBy(*kept, *also).agg(*sums), kept, keys, fact, also))
    return out


def sets_without(fact: DataFrame, key: str, keys=KEYS, measure: str = "total_price") -> list[DataFrame]:
    """The cells of the grouping sets without ``key``, the grand total first: sums of the largest of them."""
    rest = tuple(k for k in keys if k != key)
    top = _shaped(finest_cells(fact, rest, measure), rest, keys, fact)
    return [top if kept == rest else summed_cells(top, kept, keys) for size in range(len(rest) + 1) for kept in combinations(rest, size)]


def cube_view(cells: DataFrame, keys=KEYS, out: str = "total_price_sum") -> DataFrame:
    """The cube as the source stores it: keys (NULL: all) and the sum."""
    order = ["product_surrogate_id", "address_id", "time_id"] if tuple(keys) == KEYS else list(keys)
    return cells.select(*order, F.col("total").cast(CUBE_SUM_TYPE).alias(out))


def sales_cube(fact: DataFrame, keys=KEYS, measure: str = "total_price",
               out: str = "total_price_sum", dealt: str | None = None) -> DataFrame:
    """The whole cube. ``dealt``: a key of many values by which the rows of a stored fact are dealt once (``sets_with``), instead of a deal a set."""
    if dealt is not None:
        # The grand total comes first: the union takes its columns' names, and the other sets keep one shape of their shared deals.
        parts = [*sets_without(fact, dealt, keys, measure), *sets_with(fact, dealt, keys, measure)]
        return cube_view(reduce(DataFrame.unionByName, parts), keys, out)
    return cube_view(cube_rows(cut_lineage(finest_cells(fact, keys, measure), "cube-finest", DENSE), keys), keys, out)


def cube_slice(cube: DataFrame, **fixed) -> DataFrame:
    """Rows of one grouping set: ``key=None`` -> rolled up (NULL), ``key='*'`` ->
    any value (not NULL), any other value -> that value."""
    cond = F.lit(True)
    for k, v in fixed.items():
        if v is None:
            cond = cond & F.col(k).isNull()
        elif v == "*":
            cond = cond & F.col(k).isNotNull()
        else:
            cond = cond & (F.col(k) == F.lit(v))
    return cube.filter(cond)


def fact_slice(fact: DataFrame, keys=KEYS, measure: str = "total_price", out: str = "total_price_sum", **fixed) -> DataFrame:
    """The rows ``cube_slice(sales_cube(fact), **fixed)`` gives, from the fact: one grouping set, no Expand.

    Every key is fixed; those with None are rolled up, a value is filtered before the aggregation.
    """
    kept = [k for k in keys if fixed[k] is not None]
    rows = fact
    for k in kept:
        rows = rows.filter(F.col(k).isNotNull() if fixed[k] == "*" else F.col(k) == F.lit(fixed[k]))
    total = F.sum(measure).cast(CUBE_SUM_TYPE).alias(out)
    summed = rows.groupBy(*kept).agg(total) if kept else rows.agg(total)
    order = ["product_surrogate_id", "address_id", "time_id"] if tuple(keys) == KEYS else keys
    return summed.select(*[F.col(k) if k in kept else F.lit(None).cast(fact.schema[k].dataType).alias(k) for k in order], out)


def rollup_time(fact: DataFrame, time_dim: DataFrame, level: str, measure: str = "total_price",
                out: str = "total_price_sum") -> DataFrame:
    """Sum the fact at a main-branch calendar level: month, quarter, half or year.

    Walks the parent chain from the fact's day (fact.time_parent is the month)
    with the calendar (its size is bounded by the covered years).
    """
    steps = {"month": 0, "quarter": 1, "half": 2, "year": 3}[level]
    per_month = fact.groupBy(F.col("time_parent").alias("_node")).agg(F.sum(measure).alias("_m"))
    parents = time_dim.filter("timebranch = 'main'").select(
        F.col("time_id").alias("_child"), F.col("time_parent").alias("_up"))
    cur = per_month
    for _ in range(steps):
        cur = (cur.join(parents, cur["_node"] == parents["_child"])
               .groupBy(F.col("_up").alias("_node")).agg(F.sum("_m").alias("_m")))
    names = time_dim.filter("timebranch = 'main'").select(
        F.col("time_id").alias("_node"), F.col("time_name"))
    return cur.join(names, "_node").select(
        F.col("_node").alias("time_id"), "time_name", F.col("_m").cast(CUBE_SUM_TYPE).alias(out))


def rollup_location(fact: DataFrame, hierarchy: DataFrame, level: int, measure: str = "total_price",
                    out: str = "total_price_sum") -> DataFrame:
    """Sum a keyed (street-grain) fact at a location level (0 street .. 3 state).

    The fact is reduced to one row per street node before walking up the
    parent chain, so each join carries at most one row per node. Every step reads the nodes of its own level
    only (a stored hierarchy prunes them in the scan).
    """
    cur = fact.groupBy(F.col("address_id").alias("_node")).agg(F.sum(measure).alias("_m"))
    for step in range(level):
        parents = hierarchy.filter(F.col("level") == step).select(F.col("address_id").alias("_child"), F.col("parent_id").alias("_up"))
        cur = (cur.join(parents, cur["_node"] == parents["_child"])
               .groupBy(F.col("_up").alias("_node")).agg(F.sum("_m").alias("_m")))
    names = hierarchy.filter(F.col("level") == level).select(F.col("address_id").alias("_node"), "address_name")
    return cur.join(names, "_node").select(
        F.col("_node").alias("address_id"), "address_name", F.col("_m").cast(CUBE_SUM_TYPE).alias(out))
