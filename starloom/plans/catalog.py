"""Registered queries: one per operator family, each over whole driver tables.

Every query derives the raw landing from lineitem x orders x customer x part
(``sources.testdata.dirty_landing``), so its work grows with the tables.
``as_of`` is pinned (2000-06-30) so later orders are "in the future".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.operators import calendar, cube, fact, location, product, quality
from starloom.functions.dates import iso_week_year
from starloom.functions.text import counter
from starloom.session import DENSE, cut_lineage
from starloom.sources.testdata import AS_OF, dirty_landing

EARLY_CUTOFF = "1998-01-01 00:00:00"


# -- shared building blocks ------------------------------------------------------

def tagged(spark: SparkSession, sf: str, materialise: bool = True) -> DataFrame:
    """Landing rows with typed values and their reason, materialised once.

    The rules are evaluated exactly once, by the write; the consumers read
    the table with pruning and pushdown. (Streaming it instead lets the
    optimizer push ``error_reason IS NULL`` below the projection that
    computes it, which evaluates the whole rule chain twice per row.)
    """
    t = quality.tag_rows(dirty_landing(spark, sf), AS_OF)
    return cut_lineage(t, "tagged") if materialise else t


def clean(spark: SparkSession, sf: str, t: DataFrame | None = None) -> DataFrame:
    return quality.clean_of(t if t is not None else tagged(spark, sf))


class Model:
    """The warehouse built from one landing: clean, calendar, locations, product."""

    def __init__(self, spark: SparkSession, sf: str, parent_match: str = "city_postal"):
        # The raw texts other than the address are not read again: only their typed values are kept.
        typed = quality.tag_rows(dirty_landing(spark, sf), AS_OF).drop("order_id", "product", "quantity_ordered", "price_each", "order_date", "_address")
        self.landing = cut_lineage(typed, "tagged", DENSE)
        self.tagged = self.landing.withColumn("_address", F.trim("purchase_address"))
        self.clean = quality.clean_of(self.tagged)
        self.time = calendar.build_time_dimension(self.clean)
        # Distinct texts are found once, for the hierarchy and for the fact.
        self.texts = cut_lineage(self.landing.select("purchase_address").distinct(), "address-texts", DENSE)
        self.addresses = location.clean_address_process(self.texts, written=True)
        self.hierarchy, self.street_keys = location.build_location_hierarchy(self.addresses, parent_match)
        dim, _ = product.populate_product(self.clean)
        # Written: the planner knows its size before the sales are dealt for the join.
        self.product = cut_lineage(dim, "product")

    def fact(self, address_match: str = "keyed", price_mode: str = "current") -> DataFrame:
        return fact.build_order_fact(self.clean, self.product, self.time, self.hierarchy,
                                     self.street_keys, address_match, price_mode,
                                     self.texts.select(F.trim("purchase_address").alias("purchase_address")))


# -- O-02..O-05, O-66, O-67 -----------------------------------------------------------

def q_clean_rows(spark, sf):
    return clean(spark, sf)


def q_error_rows(spark, sf):
    return quality.errors_of(tagged(spark, sf))


def q_error_counts(spark, sf):
    return quality.errors_of(tagged(spark, sf)).groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))


def q_surrogate_error_ids(spark, sf):
    errs = quality.errors_of(tagged(spark, sf))
    order = [*S.LANDING_COLUMNS, "error_reason", "executed_time"]
    from starloom.operators.keys import sequence_ids
    return sequence_ids(errs, [F.col(c).asc_nulls_first() for c in order], "error_id")


def q_latest_batch(spark, sf):
    return quality.latest_batch(dirty_landing(spark, sf))


def q_anti_dedup(spark, sf):
    land = cut_lineage(dirty_landing(spark, sf), "landing", DENSE)
    prev = land.filter(F.col("updated_at") < land.agg(F.max("updated_at")).scalar())
    existing = quality.clean_of(quality.tag_rows(prev, AS_OF))
    return quality.anti_dedup(land, existing, "typed")


def q_anti_dedup_pruned(spark, sf):
    """January's landing rows against the earlier arrivals' clean sales, stored by month: only Januaries are read."""
    from starloom.plans.months import MONTH, month_of
    from starloom.session import scratch_path
    land = cut_lineage(dirty_landing(spark, sf), "landing")
    prev = land.filter(F.col("updated_at") < land.agg(F.max("updated_at")).scalar())
    path = scratch_path(spark, "clean-by-month")
    (quality.clean_of(quality.tag_rows(prev, AS_OF)).withColumn(MONTH, month_of("order_date")).hint("rebalance", F.col(MONTH))
     .write.partitionBy(MONTH).parquet(path))
    stored = spark.read.schema(T.StructType([*S.CLEAN_SCHEMA.fields, T.StructField(MONTH, T.StringType())])).parquet(path)
    return quality.anti_dedup_by_month(land.filter(F.col("order_date").startswith("01/")), stored)


def q_quality_report(spark, sf):
    f = Model(spark, sf).fact()
    return quality.assert_quality(f, {
        "quantity_positive": F.col("quantity") > 0,
        "total_price_present": F.col("total_price").isNotNull(),
        "total_price_positive": F.col("total_price") > 0,
        "product_present": F.col("product_surrogate_id").isNotNull(),
        "time_present": F.col("time_id").isNotNull(),
        "address_present": F.col("address_id").isNotNull(),
        "current_product": F.col("product_current_status"),
        "street_level": F.col("address_level") == 0,
    })


def q_key_report(spark, sf):
    m = Model(spark, sf)
    return quality.star_checks(m.time, m.hierarchy, m.product, m.fact())


def q_gated_run(spark, sf):
    """What would keep a run from being published: a dimension without its cities and with televisions twice."""
    m = Model(spark, sf)
    cities_gone = cut_lineage(m.hierarchy, "hierarchy").filter("address_type <> 'City'")
    products = cut_lineage(m.product, "product")
    twice = products.unionByName(products.filter("category_name = 'TV'"))
    return quality.violated(quality.star_checks(m.time, cities_gone, twice, m.fact()))


# -- O-06, O-07, O-57a ------------------------------------------------------------------

def q_time_dim(spark, sf):
    return calendar.build_time_dimension(clean(spark, sf))


def q_time_dim_increment(spark, sf):
    c = clean(spark, sf)
    early = calendar.build_time_dimension(c.filter(F.col("order_date") < F.lit(EARLY_CUTOFF).cast("timestamp")))
    added, _ = calendar.update_time_dimension(early, c)
    return added


def q_except_days(spark, sf):
    """Calendar days with no clean sale (EXCEPT DISTINCT)."""
    c = clean(spark, sf)
    days = calendar.main_days(calendar.build_time_dimension(c)).select("time_id")
    sold = c.select(F.concat(F.lit("D_"), F.date_format("order_date", "yyyyMMdd")).alias("time_id"))
    return days.subtract(sold)


# -- O-08..O-13 --------------------------------------------------------------------------

def q_address_parts(spark, sf):
    return location.parse_address(dirty_landing(spark, sf))


def q_address_clean(spark, sf):
    return location.clean_address_process(dirty_landing(spark, sf))


def q_location_hierarchy(spark, sf):
    h, _ = location.build_location_hierarchy(location.clean_address_process(dirty_landing(spark, sf)))
    return h


def q_location_hierarchy_city(spark, sf):
    h, _ = location.build_location_hierarchy(
        location.clean_address_process(dirty_landing(spark, sf)), parent_match="city")
    return h


def q_location_ids_incremental(spark, sf):
    """Locations after two runs (the first arrival, then all): stored nodes keep their ids."""
    land = cut_lineage(dirty_landing(spark, sf).select("purchase_address", "updated_at"), "landing")
    first = land.filter(F.col("updated_at") == land.agg(F.min("updated_at")).scalar())
    h, keys = location.build_location_hierarchy(location.clean_address_process(first))
    both, _ = location.build_location_hierarchy(location.clean_address_process(land),
                                                stored=(cut_lineage(h), cut_lineage(keys)))
    return both


def q_counter_wide(spark, sf):
    """Counters on both sides of five digits, one per order key."""
    n = spark.read.parquet(f"{sf}/orders.parquet").select((F.col("o_orderkey") * 37).alias("n"))
    return n.select("n", counter(F.col("n")).alias("id_text"))


# -- O-14..O-20 ----------------------------------------------------------------------------

def q_product_category(spark, sf):
    return product.categorise(clean(spark, sf).select("product").distinct())


def _early(c: DataFrame) -> DataFrame:
    return c.filter(F.col("order_date") < F.lit(EARLY_CUTOFF).cast("timestamp"))


def q_new_versions(spark, sf):
    c = clean(spark, sf)
    dim, _ = product.populate_product(_early(c))
    return product.new_price_versions(c, dim)


def q_product_scd2(spark, sf):
    dim, _ = product.populate_product(clean(spark, sf))
    return dim


def q_product_dim_incremental(spark, sf):
    c = clean(spark, sf)
    first, _ = product.populate_product(_early(c))
    second, _ = product.populate_product(c, cut_lineage(first))
    return second


def q_product_ids(spark, sf):
    """O-16: product ids after two runs (early sales, then all): known names keep
    their id, new names continue from the largest suffix."""
    return q_product_dim_incremental(spark, sf).select("product", "product_id").distinct()


def q_orders_updated(spark, sf):
    c = clean(spark, sf)
    dim, mapped = product.populate_product(c)
    return mapped


def q_semi_active_versions(spark, sf):
    """Versions with a later sale of the product at another price (EXISTS with
    an inequality: the test the re-versioning pass applies to current rows)."""
    c = clean(spark, sf)
    dim, _ = product.populate_product(c)
    return product.sold_later_at_other_price(dim, c)


def q_scd2_reversion(spark, sf):
    """Re-versioning of a stale dimension: versions added without closing any, so all are current."""
    c = clean(spark, sf)
    dim, _ = product.populate_product(c)
    stale = dim.withColumns({"end_date": F.lit(None).cast("timestamp"), "curr_status": F.lit(True)})
    return product.scd2_reversion(cut_lineage(stale), c)


# -- O-21..O-25 ------------------------------------------------------------------------------

def q_order_fact_keyed(spark, sf):
    return Model(spark, sf).fact()


def q_order_fact_substring(spark, sf):
    return Model(spark, sf).fact(address_match="substring")


def q_order_fact_as_of_sale(spark, sf):
    return Model(spark, sf).fact(price_mode="as_of_sale")


def q_order_fact_city(spark, sf):
    return Model(spark, sf, parent_match="city").fact()


def q_fact_append_twice(spark, sf):
    f = cut_lineage(Model(spark, sf).fact())
    return fact.append_fact(f, f, mode="append")


def q_sales_cube(spark, sf):
    return _keyed_cube(Model(spark, sf).fact())


def _keyed_cube(f: DataFrame) -> DataFrame:
    """The whole cube of a keyed fact, which is written with the cube's columns alone and dealt once by its streets."""
    return cube.sales_cube(cut_lineage(f.select(*cube.KEYS, "total_price"), "cube-fact", DENSE), dealt="address_id")


def q_sales_cube_substring(spark, sf):
    return cube.sales_cube(Model(spark, sf).fact(address_match="substring"))


def q_cube_slice(spark, sf):
    return cube.fact_slice(Model(spark, sf).fact(), product_surrogate_id="*", time_id=None, address_id=None)


def q_cube_slice_stored(spark, sf):
    """The slice of one address level cut from a whole cube."""
    c = _keyed_cube(Model(spark, sf).fact())
    return cube.cube_slice(c, product_surrogate_id=None, time_id=None, address_id="*")


def q_rollup_month(spark, sf):
    m = Model(spark, sf)
    return cube.rollup_time(m.fact(), m.time, "month")


def q_rollup_quarter(spark, sf):
    m = Model(spark, sf)
    return cube.rollup_time(m.fact(), m.time, "quarter")


def q_rollup_state(spark, sf):
    return _rollup_location(spark, sf, 3)


def q_rollup_half(spark, sf):
    m = Model(spark, sf)
    return cube.rollup_time(m.fact(), m.time, "half")


def q_rollup_year(spark, sf):
    m = Model(spark, sf)
    return cube.rollup_time(m.fact(), m.time, "year")


def q_rollup_city(spark, sf):
    return _rollup_location(spark, sf, 1)


def q_rollup_postal(spark, sf):
    return _rollup_location(spark, sf, 2)


def _rollup_location(spark, sf, level):
    m = Model(spark, sf)
    return cube.rollup_location(m.fact(), cut_lineage(m.hierarchy, "hierarchy"), level)


# -- scalar function families (O-58) ------------------------------------------------------------

def q_scalar_text(spark, sf):
    land = dirty_landing(spark, sf)
    return land.select(
        F.trim("product").alias("trimmed"),
        F.lower(F.trim("product")).alias("lowered"),
        F.upper("product").alias("uppered"),
        F.split_part("purchase_address", F.lit(","), F.lit(2)).alias("second_part"),
        F.split_part("purchase_address", F.lit(" "), F.lit(-1)).alias("last_word"),
        F.substring("order_date", 7, 4).alias("year_text"),
        F.length("purchase_address").alias("addr_len"),
        F.lpad("quantity_ordered", 5, "0").alias("padded_qty"),
        F.concat(F.lit("S-"), F.col("order_id")).alias("prefixed"),
        F.coalesce("product", F.lit("?")).alias("product_or_mark"),
    )


def q_scalar_date_num(spark, sf):
    c = clean(spark, sf)
    return c.select(
        "order_id",
        F.year("order_date").alias("y"), F.month("order_date").alias("m"),
        F.dayofmonth("order_date").alias("d"), F.weekofyear("order_date").alias("iso_week"),
        iso_week_year(F.col("order_date")).alias("iso_year"),
        F.date_add(F.to_date("order_date"), 30).alias("plus_30"),
        (F.col("order_date") - F.expr("INTERVAL 1 DAY")).alias("minus_day"),
        F.round("price_each", 1).alias("rounded"),
        (F.col("quantity_ordered") * F.col("price_each")).cast(S.FACT_PRICE_TYPE).alias("line_total"),
    )


# -- O-01, O-24, O-60 ------------------------------------------------------------------------------

def q_landing_roundtrip(spark, sf):
    from starloom.session import scratch_path
    from starloom.sources import landing as L
    path = scratch_path(spark, "landing-csv")
    L.write_landing_csv(dirty_landing(spark, sf), path)
    return L.read_landing_csv(spark, path, "2024-01-04 00:00:00")


def _as_lines(df: DataFrame, header: str, line, path: str) -> None:
    """Write one text line a row, with ``header`` as first line of every file."""
    (df.select(line.alias(header)).write.option("header", True).option("sep", "\u0001").option("quote", "\u0000")
     .option("escapeQuotes", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _quoted(name: str):
    return F.concat(F.lit('"'), F.replace(F.coalesce(F.col(name), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def q_landing_mixed_headers(spark, sf):
    """Files of two layouts in one read: the third arrival has its columns in reverse, one more and no quantity."""
    from starloom.session import scratch_path
    from starloom.sources import landing as L
    path = scratch_path(spark, "landing-mixed")
    land = cut_lineage(dirty_landing(spark, sf), "landing")
    third = F.col("updated_at") == F.lit("2024-01-03").cast("timestamp")
    names = list(S.CSV_HEADERS.items())
    _as_lines(land.filter(~third), ",".join(h for h, _ in names), F.concat_ws(",", *[_quoted(c) for _, c in names]), f"{path}/full")
    kept = [(h, c) for h, c in reversed(names) if c != "quantity_ordered"]
    _as_lines(land.filter(third), ",".join(["Note", *(h for h, _ in kept)]),
              F.concat_ws(",", F.lit("a note"), *[_quoted(c) for _, c in kept]), f"{path}/other")
    return L.read_landing_csv(spark, [f"{path}/full", f"{path}/other"], "2024-01-04 00:00:00")


def q_landing_malformed(spark, sf):
    """Records that do not fit their header, with the reason: a field short, one too many, a quote left open."""
    from starloom.session import scratch_path
    from starloom.sources import landing as L
    path = scratch_path(spark, "landing-malformed")
    land = dirty_landing(spark, sf)
    fields = [_quoted(c) for c in S.CSV_HEADERS.values()]
    day = F.dayofmonth("updated_at")
    line = (F.when(day == 2, F.concat_ws(",", *fields[:-1])).when(day == 3, F.concat_ws(",", *fields, F.lit("x")))
            .when(F.col("purchase_address").isNull(), F.concat_ws(",", *fields[:-1], F.lit('"open'))).otherwise(F.concat_ws(",", *fields)))
    _as_lines(land, ",".join(S.CSV_HEADERS), line, path)
    parsed = L.parse_lines(L.with_origin(spark.read.text(path)))
    return L.malformed_of(parsed, "2024-01-04 00:00:00").select("order_id", "product", "price_each", "error_reason", "logged_at")


def q_warehouse_totals(spark, sf):
    from starloom.plans.warehouse import run_batches_from_landing
    return run_batches_from_landing(spark, dirty_landing(spark, sf), AS_OF)


def q_warehouse_fact(spark, sf):
    """The fact's rows after three arrival runs, through the analyst view (ids, which follow arrival, left out)."""
    from starloom.plans.warehouse import register_views, replay_landing
    register_views(replay_landing(spark, dirty_landing(spark, sf), AS_OF))
    return spark.table("order_fact").select("order_id", "quantity", "total_price", "product", "time_id", "address_name")


def q_warehouse_fact_incremental(spark, sf):
    """The whole fact, ids included, after three arrival runs that each replaced the months they touched."""
    from starloom.plans.warehouse import replay_landing
    wh = replay_landing(spark, dirty_landing(spark, sf), AS_OF, layout="months")
    return wh.read("fact", wh.committed()[-1:])


def q_cube_delta(spark, sf):
    """The cube kept up over three arrival runs: old cells plus each run's difference."""
    from starloom.plans.warehouse import replay_landing
    wh = replay_landing(spark, dirty_landing(spark, sf), AS_OF, layout="months")
    return wh.read("cube", wh.committed()[-1:])


def q_stream_equals_batch(spark, sf):
    from starloom.streaming.trigger import stream_totals_from_landing
    return stream_totals_from_landing(spark, dirty_landing(spark, sf), AS_OF)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
