"""Product dimension with type-2 price history (O-14..O-20).

Every (product, price) pair seen in the clean sales is a version. A version
starts at the first sale at that price (in the run that first saw it) and
ends one day before the next version's start; the latest versions of a
product are current. Sales are aggregated to (product, price) before any
join, so the dimension work scales with the number of versions, not with
the number of sales; the windows are partitioned by product over versions
only (a product has as many rows as distinct prices).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.text import counter
from starloom.operators.keys import RANGE_PID, group_sequence, range_tagged
from starloom.session import cut_lineage


def categorise(df: DataFrame, col: str = "product",
               rules: Sequence[tuple[str, str, str]] = S.CATEGORY_RULES,
               default: tuple[str, str] = S.CATEGORY_DEFAULT) -> DataFrame:
    """O-14: first matching keyword rule -> (parent_id, category_name)."""
    up = F.upper(F.col(col))
    cid = cname = None
    for pattern, rid, rname in rules:
        hit = up.rlike(pattern)
        cid = F.when(hit, rid) if cid is None else cid.when(hit, rid)
        cname = F.when(hit, rname) if cname is None else cname.when(hit, rname)
    return df.withColumn("parent_id", cid.otherwise(default[0])) \
             .withColumn("category_name", cname.otherwise(default[1]))


def price_key(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 2)


def new_price_versions(clean: DataFrame, dim: DataFrame | None) -> DataFrame:
    """O-15: (product, price_each, start_date) pairs absent from ``dim``.

    Sales are reduced to one row per pair first (map-side partial
    aggregation), then anti-joined with the dimension.
    """
    cand = clean.groupBy("product", "price_each").agg(F.min("order_date").alias("start_date"))
    if dim is None:
        return cand
    seen = dim.select(F.col("product").alias("_d_product"), price_key("price_each").alias("_d_price"))
    cond = (cand["product"] == seen["_d_product"]) & (price_key(cand["price_each"]) == seen["_d_price"])
    return cand.join(seen, cond, "left_anti")


def number_new_versions(new: DataFrame, dim: DataFrame | None) -> DataFrame:
    """O-16 + surrogate keys: ``product_id`` and ``id`` for new versions.

    Known names keep their ``product_id``; new names get ``PROD-%05d``
    continuing from the largest suffix, in order of first start date, then
    name. New versions get ``id`` continuing from the largest id, in order of
    (start date, product, price). Both sequences come from one skew-safe
    numbering pass (``group_sequence`` over a kind column).
    """
    if dim is None:
        known, next_pid, next_id = None, F.lit(0), F.lit(0)
    else:
        known = dim.groupBy("product").agg(F.min("product_id").alias("product_id"))
        next_pid = F.coalesce(dim.agg(F.max(F.substring("product_id", 6, 100).try_cast("bigint"))).scalar(),
                              F.lit(0))
        next_id = F.coalesce(dim.agg(F.max("id")).scalar(), F.lit(0))
    names = new.groupBy("product").agg(F.min("start_date").alias("_t"))
    if known is not None:
        names = names.join(known, "product", "left_anti")
    both = names.select(F.lit("n").alias("_kind"), "_t", "product",
                        F.lit(None).cast(S.PRICE_TYPE).alias("price_each")).unionByName(
        new.select(F.lit("v").alias("_kind"), F.col("start_date").alias("_t"), "product", "price_each"))
    numbered = group_sequence(both, ["_kind"], ["_t", "product", "price_each"], "_n")
    fresh_ids = numbered.filter("_kind = 'n'").select(
        "product", F.concat(F.lit(S.PRODUCT_ID_PREFIX), counter(F.col("_n") + next_pid)).alias("product_id"))
    ids = fresh_ids if known is None else fresh_ids.unionByName(known)
    versions = numbered.filter("_kind = 'v'").select(
        (F.col("_n") + next_id).cast("long").alias("id"), "product", "price_each",
        F.col("_t").alias("start_date"))
    return versions.join(ids, "product", "left")


def close_versions(versions: DataFrame) -> DataFrame:
    """Canonical SCD-2 columns over all versions of each product.

    end_date = next distinct start - 1 day (NULL for the latest);
    curr_status = start equals the product's latest start (ties: several).

    No window is partitioned by product (one product may hold a third of all
    versions): distinct starts are ranked per product with the skew-safe
    numbering, the next start is an equi join on (product, rank + 1) and the
    latest start a partially aggregated max joined back.
    """
    starts = versions.select("product", "start_date").distinct()
    ranked = group_sequence(starts, ["product"], ["start_date"], "_r")
    following = ranked.select("product", (F.col("_r") - 1).alias("_r"), F.col("start_date").alias("_next"))
    nxt = ranked.join(following, ["product", "_r"], "left").select("product", "start_date", "_next")
    latest = starts.groupBy("product").agg(F.max("start_date").alias("_latest"))
    return (
        versions.join(nxt, ["product", "start_date"]).join(latest, "product")
        .withColumn("end_date", F.col("_next") - F.expr("INTERVAL 1 DAY"))
        .withColumn("curr_status", F.col("start_date") == F.col("_latest"))
        .drop("_next", "_latest")
    )


def scd2_merge(dim: DataFrame | None, new: DataFrame) -> DataFrame:
    """O-17: add categorised new versions with ids, then recompute end/current."""
    added = categorise(number_new_versions(new, dim)).select(
        "id", "product_id", "product", "price_each", "start_date",
        F.lit(None).cast("timestamp").alias("end_date"), F.lit(True).alias("curr_status"),
        "parent_id", "category_name")
    versions = added if dim is None else dim.select(*S.PRODUCT_SCHEMA.fieldNames()).unionByName(added)
    return close_versions(versions).select(*S.PRODUCT_SCHEMA.fieldNames())


def first_sale_at_other_price(versions: DataFrame, clean: DataFrame) -> DataFrame:
    """id and first_other: each version's first later sale of its product at another price (versions without one left out).

    ``versions``: id, product, price_each, start_date. Sales are reduced to one row a product and minute (least and largest price); with the versions
    between them they are dealt by ranges of (product, time), so a product that holds all rows is spread over many tasks. The next
    sale after a version answers it unless all of that minute was sold at the version's own price; then the next *change* of price does. Both are
    looked up in running windows within a partition, and from one row per product and partition beyond it: rows are linear in sales and versions.
    """
    none = F.lit(None)
    price = price_key("price_each")
    sales = (clean.filter(F.col("product").isNotNull() & F.col("order_date").isNotNull())
             .groupBy("product", F.col("order_date").alias("at")).agg(F.min(price).alias("low"), F.max(price).alias("high")))
    marks = versions.filter(F.col("product").isNotNull()).select(
        "product", F.col("start_date").alias("at"), none.cast(sales.schema["low"].dataType).alias("low"),
        none.cast(sales.schema["high"].dataType).alias("high"), "id", price.alias("own"))
    rows = sales.withColumn("id", none.cast("long")).withColumn("own", none.cast(marks.schema["own"].dataType)).unionByName(marks)
    sold = F.col("low").isNotNull()
    # A version stands after the sales of its own minute: only later ones count.
    order = [F.col("product"), F.col("at"), F.col("id").asc_nulls_first()]
    placed = range_tagged(rows, order)
    part = [F.col("product"), F.col(RANGE_PID)]
    run = W.partitionBy(*part).orderBy(F.col("at"), F.col("id").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    back = W.partitionBy(*part).orderBy(F.col("at").desc(), F.col("id").desc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    sale = F.when(sold, F.struct("at", "low", "high"))

    ends = placed.groupBy(*part).agg(F.max(sale).alias("last"))
    up = W.partitionBy("product").orderBy(RANGE_PID).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(*part, F.last("last", True).over(up).alias("earlier"))
    before = F.coalesce(F.last(sale, True).over(run), F.col("earlier"))
    changes = sold & F.col("before").isNotNull() & ~((F.col("low") == F.col("high")) & (F.col("low") == F.col("before.low"))
                                                     & (F.col("high") == F.col("before.high")))
    linked = cut_lineage(placed.join(ends, ["product", RANGE_PID]).withColumn("before", before)
                         .withColumn("change", F.when(changes, F.col("at"))).drop("before", "earlier"), "price-changes")

    opened = linked.withColumn("opens", F.min(F.when(sold, F.col("at"))).over(W.partitionBy(*part)))
    edge = opened.groupBy(*part).agg(F.min(sale).alias("first"), F.min("change").alias("change"),
                                     F.min(F.when(F.col("change") > F.col("opens"), F.col("change"))).alias("change_after"))
    down = W.partitionBy("product").orderBy(F.col(RANGE_PID).desc()).rowsBetween(W.unboundedPreceding, -1)
    edge = edge.withColumn("later_change", F.min("change").over(down))
    edge = edge.select(*part, "later_change", F.last(F.when(F.col("first").isNotNull(), F.struct(
        "first.at", "first.low", "first.high", F.coalesce("change_after", "later_change").alias("then"))), True).over(down).alias("beyond"))
    here = (linked.join(edge, ["product", RANGE_PID])
            .withColumn("then", F.coalesce(F.min("change").over(back), F.col("later_change"))))
    coming = F.coalesce(F.last(F.when(sold, F.struct("at", "low", "high", "then")), True).over(back), F.col("beyond"))
    found = here.withColumn("coming", coming).filter(~sold).select("id", F.when(
        (F.col("coming.low") != F.col("own")) | (F.col("coming.high") != F.col("own")), F.col("coming.at")).otherwise(F.col("coming.then")).alias("first_other"))
    return found.filter(F.col("first_other").isNotNull())


def sold_later_at_other_price(versions: DataFrame, clean: DataFrame) -> DataFrame:
    """The versions with a later sale of their product at another price (EXISTS): the latest sales of the product's two
    most recently sold prices decide, so a product meets one row."""
    latest = clean.groupBy("product", price_key("price_each").alias("_price")).agg(F.max("order_date").alias("_at"))
    top = latest.groupBy("product").agg(F.max(F.struct("_at", "_price")).alias("_top"))
    second = (latest.join(top, "product").filter(F.col("_price") != F.col("_top._price"))
              .groupBy("product").agg(F.max("_at").alias("_second")))
    known = top.join(second, "product", "left").withColumnRenamed("product", "_product")
    other = F.when(price_key("price_each") != F.col("_top._price"), F.col("_top._at")).otherwise(F.col("_second"))
    return (versions.join(known, F.col("product") == F.col("_product")).filter(other > F.col("start_date"))
            .select(*versions.columns))


def scd2_reversion(dim: DataFrame, clean: DataFrame) -> DataFrame:
    """O-18: the source's re-versioning pass over a stored dimension.

    1. A current version with a later sale of its product at another price is
       closed at (first such sale - 1 day).
    2. Versions holding their product's latest start become current with an
       open end.
    On a dimension already in canonical form this is the identity.
    """
    later = first_sale_at_other_price(dim.filter("curr_status"), clean)
    step1 = (dim.join(later, "id", "left")
             .withColumn("end_date", F.when(F.col("first_other").isNotNull(),
                                            F.col("first_other") - F.expr("INTERVAL 1 DAY"))
                         .otherwise(F.col("end_date")))
             .withColumn("curr_status", F.when(F.col("first_other").isNotNull(), F.lit(False))
                         .otherwise(F.col("curr_status"))))
    newest = dim.groupBy("product").agg(F.max("start_date").alias("_latest"))
    step1 = step1.join(newest, "product")
    latest = F.col("start_date") == F.col("_latest")
    step2 = (step1.withColumn("end_date", F.when(latest, F.lit(None).cast("timestamp"))
                              .otherwise(F.col("end_date")))
             .withColumn("curr_status", F.when(latest, F.lit(True)).otherwise(F.col("curr_status"))))
    return step2.select(*S.PRODUCT_SCHEMA.fieldNames())


def join_valid_version(sales: DataFrame, dim: DataFrame, prefix: str = "_d_") -> DataFrame:
    """Sales joined to the version of their (product, price) whose validity holds
    the sale date: an equi join on (product, price) with a range residual.
    ``dim`` columns come back prefixed."""
    d = dim.select(*[F.col(c).alias(prefix + c) for c in dim.columns],
                   price_key("price_each").alias(prefix + "pkey"),
                   F.coalesce("end_date", F.lit(S.OPEN_END).cast("timestamp")).alias(prefix + "until"))
    cond = ((sales["product"] == d[prefix + "product"]) & (price_key(sales["price_each"]) == d[prefix + "pkey"])
            & sales["order_date"].between(d[prefix + "start_date"], d[prefix + "until"]))
    return sales.join(d, cond).drop(prefix + "pkey", prefix + "until")


def map_orders_to_versions(clean: DataFrame, dim: DataFrame) -> DataFrame:
    """O-19: each sale -> the version valid at its date."""
    return join_valid_version(clean, dim).select(
        "order_id", "product", F.col("_d_id").alias("product_sk"), F.col("_d_parent_id").alias("category_id"),
        "price_each", "order_date")


def populate_product(clean: DataFrame, dim: DataFrame | None = None,
                     reversion: bool = False) -> tuple[DataFrame, DataFrame]:
    """O-20: (new dimension, orders_updated)."""
    new = new_price_versions(clean, dim)
    merged = scd2_merge(dim, new)
    if reversion:
        merged = scd2_reversion(merged, clean)
    return merged, map_orders_to_versions(clean, merged)
