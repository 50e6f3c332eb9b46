"""Incremental upkeep of the order fact and the sales cube, month by month (O-22, O-24, O-23).

A run touches the months of its new sales and the months that hold sales of *re-priced* products: those whose relevant
versions (the current ones, or all of them when sales keep their own version's price) differ from the dimension before. In these months the rows of
re-priced products are built again from the clean sales, the run's rows are added, and every other row is carried over as it is. All
other months keep their files. Rows carried over are written as they lie, without a deal.

The cube's grouping sets with a day are sums within a month: they are built again for the touched months alone, from the new fact. The sets without a day get
the difference of those months' finest cells, new less old, or are summed again if every stored month was touched. So a run's cost follows the batch and the products it re-prices.

Right for keyed matching only, where a sale's street node never changes once stored (a new node name may occur inside any old address, so
substring matching has to look at all of them again).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import cube, fact
from starloom.plans.months import MONTH, MonthTable, month_of
from starloom.session import DENSE, cut_lineage

WHOLE = "all"  # the cube's partition of grouping sets without a day


def repriced_products(before: DataFrame | None, now: DataFrame, price_mode: str = "current") -> DataFrame:
    """Distinct products whose versions that the fact reads differ between two states of the dimension."""
    pick = (lambda d: d.filter("curr_status")) if price_mode == "current" else (lambda d: d)
    now = pick(now)
    if before is None:
        return now.select("product").distinct()
    before = pick(before)
    gone, come = before.subtract(now), now.subtract(before)
    return gone.select("product").unionByName(come.select("product")).distinct()


def _months(df: DataFrame) -> list[str]:
    """The distinct months of a frame (bounded by the time covered)."""
    return sorted(r[0] for r in df.select(MONTH).distinct().collect())


def refresh_fact(table: MonthTable, run_id: int, prev: int | None, fresh: DataFrame, history: DataFrame | None,
                 dim_before: DataFrame | None, dims: tuple, price_mode: str = "current") -> list[str]:
    """Write run ``run_id`` of the fact; returns the months it touched.

    ``fresh``: the run's clean sales; ``history``: all earlier ones; ``dims``: product, calendar, hierarchy and street keys now.
    """
    sales, months = fresh, set(_months(fresh.select(month_of("order_date").alias(MONTH))))
    kept = None
    if prev is not None:
        repriced = cut_lineage(repriced_products(dim_before, dims[0], price_mode), "repriced")
        old = table.read(prev)
        months |= set(_months(old.select("product", MONTH).join(repriced, "product", "left_semi")))
        kept = table.carried(table.read(prev, months).join(repriced, "product", "left_anti"), months)
        sales = fresh.unionByName(history.join(repriced, "product", "left_semi").select(*fresh.columns))
    # Only built rows are dealt by month; kept ones lie by month already.
    built = fact.build_order_fact(sales.withColumn(MONTH, month_of("order_date")), *dims, address_match="keyed", price_mode=price_mode, deal_by=MONTH)
    table.replace(built if kept is None else kept.select(*built.columns).unionByName(built), run_id, prev, months)
    return sorted(months)


def refresh_cube(table: MonthTable, facts: MonthTable, run_id: int, prev: int | None, months: list[str]) -> None:
    """Write run ``run_id`` of the cube after its fact; ``months`` are those the fact replaced."""
    keys = list(cube.KEYS)
    new = facts.read(run_id, months)
    # Dealt by day: each task writes few months.
    daily = cube.sets_with(new, "time_id", also=[MONTH])
    if set(table.manifest(prev)) <= {*months, WHOLE}:
        # Every stored month is replaced: the sets without a day are sums of the new fact.
        whole = cube.sets_without(new, "time_id")
    else:
        stored = table.read(prev, {WHOLE}).drop(MONTH)
        before = table.read(prev, months).filter("grouping_set = 0").select(*keys, "total", "n_rows")
        change = daily[0].select(*keys, "total", "n_rows").unionByName(cube.negated(before))
        pairs = cut_lineage(cube.summed_cells(change, (keys[0], "address_id")).filter("n_rows != 0 OR total != 0"), "cube-change", DENSE)
        whole = []
        for kept in ((), (keys[0],), ("address_id",), (keys[0], "address_id")):
            delta = pairs if len(kept) == 2 else cube.summed_cells(pairs, kept)
            held = stored.filter(F.col("grouping_set") == cube.set_number(kept)).select(*delta.columns)
            whole.append(cube.add_cells(held, delta))
    # The grand total comes first: the union takes its columns' names, and the sets with a day keep one shape of their shared deal.
    parts = [p.withColumn(MONTH, F.lit(WHOLE)) for p in whole] + daily
    out = reduce(DataFrame.unionByName, [p.select(*table.columns, MONTH) for p in parts])
    table.replace(out, run_id, prev, [*months, WHOLE])
