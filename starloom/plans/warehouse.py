"""One warehouse run per arriving landing batch (O-24), and the run ledger.

Accumulating tables (landing, clean, errors) keep one folder per run,
``<root>/<table>/run_id=<n>/``. Rebuilt tables (calendar, addresses,
locations, product, fact, cube) write a full new version per run into one of
two slots, so the previous version stays readable and at most two copies exist. A run overwrites only its own
partitions and commits by writing its ledger row last, so re-running a run
(a replayed stream batch, a lost executor, a killed job) is idempotent.
Tables are read back from storage between stages, which also cuts lineage.

With ``Warehouse(..., layout="months")`` fact and cube are kept by month instead (``plans.months``) and a run writes only the
months it touches (``plans.incremental``).
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.operators import calendar, cube, fact, location, product, quality
from starloom.plans import incremental
from starloom.plans.months import MonthTable
from starloom.session import DENSE, cut_lineage

RUN = "run_id"
LEDGER_SCHEMA = T.StructType([T.StructField(RUN, T.LongType()), T.StructField("finished_at", T.TimestampType())])
KEYS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                            ("street", "city", "state", "postal_code", "address_id", "parent_id")])
FACT_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("quantity", T.LongType()),
    T.StructField("total_price", S.FACT_PRICE_TYPE), T.StructField("product_surrogate_id", T.LongType()),
    T.StructField("product", T.StringType()), T.StructField("time_id", T.StringType()),
    T.StructField("address_id", T.StringType()), T.StructField("product_start_date", T.DateType()),
    T.StructField("product_end_date", T.DateType()), T.StructField("product_current_status", T.BooleanType()),
    T.StructField("product_parent_id", T.StringType()), T.StructField("product_category", T.StringType()),
    T.StructField("time_name", T.DateType()), T.StructField("time_parent", T.StringType()),
    T.StructField("time_level", T.StringType()), T.StructField("time_branch", T.StringType()),
    T.StructField("address_name", T.StringType()), T.StructField("address_type", T.StringType()),
    T.StructField("parent_id", T.StringType()), T.StructField("address_level", T.IntegerType()),
])
CUBE_SCHEMA = T.StructType([
    T.StructField("product_surrogate_id", T.LongType()), T.StructField("address_id", T.StringType()),
    T.StructField("time_id", T.StringType()), T.StructField("total_price_sum", S.CUBE_SUM_TYPE)])

SCHEMAS = {
    "landing": S.LANDING_SCHEMA, "clean": S.CLEAN_SCHEMA, "errors": S.ERROR_SCHEMA,
    "time_dim": S.TIME_SCHEMA, "location": S.LOCATION_SCHEMA, "street_keys": KEYS_SCHEMA,
    "product": S.PRODUCT_SCHEMA, "fact": FACT_SCHEMA, "cube": CUBE_SCHEMA, "_runs": LEDGER_SCHEMA,
    "addresses": T.StructType([T.StructField(c, T.StringType()) for c in ("street", "city", "state", "postal_code")]),
}


# Rebuilt tables keep two versions (the previous run's and the current run's)
# in two slots picked by the run's position in the ledger: the previous
# version stays readable while the next is written, a replayed run rewrites its
# own slot, and storage never exceeds two full copies.
ROLLING = {"time_dim", "addresses", "location", "street_keys", "product", "fact", "cube"}


CELL_SCHEMA = T.StructType([f for f in CUBE_SCHEMA.fields if f.name in cube.KEYS] + [
    T.StructField("grouping_set", T.IntegerType()), T.StructField("total", S.CUBE_SUM_TYPE), T.StructField("n_rows", T.LongType())])


class Warehouse:
    """``layout``: ``slots`` (fact and cube written whole by every run) or ``months`` (kept by month, touched months replaced)."""

    def __init__(self, spark: SparkSession, root: str, layout: str = "slots"):
        if layout not in ("slots", "months"):
            raise ValueError(f"unknown layout {layout!r}")
        self.spark, self.root = spark, root
        self.months = {} if layout == "slots" else {
            "fact": MonthTable(spark, root, "fact", FACT_SCHEMA), "cube": MonthTable(spark, root, "cube", CELL_SCHEMA)}
        self._ledger: list[int] | None = None  # pinned for the duration of one run
        # An empty append creates the ledger folder, so it can always be read.
        spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(self._path("_runs"))

    def _path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def _dir(self, table: str, run_id: int, committed: list[int] | None = None) -> str:
        if table not in ROLLING:
            return os.path.join(self._path(table), f"{RUN}={run_id}")
        done = committed if committed is not None else (
            self._ledger if self._ledger is not None else self.committed())
        position = sum(1 for r in done if r < run_id)
        return os.path.join(self._path(table), f"slot={position % 2}")

    def write(self, df: DataFrame, table: str, run_id: int) -> None:
        cols = SCHEMAS[table].fieldNames()
        df.select(*cols).write.mode("overwrite").parquet(self._dir(table, run_id), compression=DENSE)

    def read(self, table: str, runs: list[int]) -> DataFrame | None:
        """Union of the given runs' data (None when no run is given). A rolling
        table can only be read for the latest two runs."""
        if not runs:
            return None
        if table in self.months:
            found = self.months[table].read(max(runs))
            return cube.cube_view(found) if table == "cube" else found.select(*SCHEMAS[table].fieldNames())
        done = (self._ledger if self._ledger is not None else self.committed()) if table in ROLLING else None
        paths = sorted({self._dir(table, r, done) for r in runs})
        return self.spark.read.schema(SCHEMAS[table]).parquet(*paths)

    def committed(self) -> list[int]:
        """Finished runs, ascending. The ledger has one row per run (a small, bounded read)."""
        rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(self._path("_runs")).select(RUN).distinct().collect()
        return sorted(r[0] for r in rows)

    def commit(self, run_id: int) -> None:
        """Append the run's ledger row (a replayed run appends a duplicate, which reads the same)."""
        row = self.spark.range(1).select(F.lit(run_id).cast("long").alias(RUN),
                                         F.current_timestamp().alias("finished_at"))
        row.coalesce(1).write.mode("append").parquet(self._path("_runs"))


def run_warehouse_batch(wh: Warehouse, batch: DataFrame, run_id: int,
                        as_of: datetime | str | Column | None = None, compare: str = "typed",
                        parent_match: str = "city_postal", address_match: str = "keyed",
                        price_mode: str = "current", fact_mode: str = "rebuild", reversion: bool = False,
                        gate: bool = False, **cleansing) -> None:
    """Land one batch and rebuild every downstream table (the source's trigger chain).

    ``reversion`` adds the re-versioning pass over all clean sales (O-18); ``gate`` checks keys and references of the run's tables
    before it commits (``quality.ConstraintViolation``); ``cleansing`` holds the options of
    ``quality.tag_rows`` (``blank_is_null``, ``max_lengths``, ``int_limits``).

    A committed run is skipped, so a replayed stream epoch or a retried job changes nothing, whatever committed
    after it. A run older than the newest committed one that did not commit itself is refused: its
    arrival would be read as the newest.
    """
    wh._ledger = wh.committed()
    try:
        if run_id in wh._ledger:
            return
        if wh.months and (address_match != "keyed" or fact_mode != "rebuild"):
            raise ValueError("the month layout keeps a keyed fact and never repeats rows")
        if wh._ledger and run_id < wh._ledger[-1]:
            raise ValueError(f"run {run_id} is older than the committed run {wh._ledger[-1]}")
        _run(wh, batch, run_id, as_of, compare, parent_match, address_match, price_mode, fact_mode, reversion, gate, cleansing)
    finally:
        wh._ledger = None


def _run(wh: Warehouse, batch: DataFrame, run_id: int, as_of, compare: str, parent_match: str,
         address_match: str, price_mode: str, fact_mode: str, reversion: bool, gate: bool, cleansing: dict) -> None:
    done = [r for r in wh._ledger if r < run_id]
    prev = done[-1] if done else None
    wh.write(batch.select(*S.LANDING_SCHEMA.fieldNames()), "landing", run_id)

    # 1. cleansing: latest batch, not already loaded, validated. Runs are
    # ordered, so the newest stamps are in this run's partition: only it is scanned.
    clean_prev = wh.read("clean", done)
    errors_prev = wh.read("errors", done)
    err_start = (F.lit(1) if errors_prev is None
                 else F.coalesce(errors_prev.agg(F.max("error_id")).scalar(), F.lit(0)) + 1)
    clean_new, errors_new = quality.clean_sales(wh.read("landing", [run_id]), clean_prev, as_of, compare,
                                                err_start, **cleansing)
    wh.write(clean_new, "clean", run_id)
    wh.write(errors_new, "errors", run_id)
    clean_all = wh.read("clean", done + [run_id])

    # 2. calendar: the days it has already and this run's sales span the same days as all clean rows
    sold = wh.read("clean", [run_id]).select("order_date")
    if prev is not None:
        sold = sold.unionByName(calendar.main_days(wh.read("time_dim", [prev])).select(
            F.col("day_date").cast("timestamp").alias("order_date")))
    wh.write(calendar.build_time_dimension(sold), "time_dim", run_id)

    # 3. locations, from raw landing rows. The distinct address set is kept
    # per run (previous set + this batch), so history is never re-parsed. Stored
    # nodes keep their ids (appended facts refer to them); new ones continue.
    fresh_addr = location.clean_address_process(wh.read("landing", [run_id]))
    if prev is not None:
        fresh_addr = fresh_addr.unionByName(wh.read("addresses", [prev]))
    wh.write(fresh_addr.distinct(), "addresses", run_id)
    stored = None
    if prev is not None:
        stored_keys = wh.read("street_keys", [prev])
        stored = (wh.read("location", [prev]), stored_keys.drop("state") if parent_match == "city" else stored_keys)
    hierarchy, keys = location.build_location_hierarchy(wh.read("addresses", [run_id]), parent_match, stored)
    wh.write(hierarchy, "location", run_id)
    keys_full = keys if "state" in keys.columns else keys.withColumn("state", F.lit(None).cast("string"))
    wh.write(keys_full, "street_keys", run_id)

    # 4. product versions. A (product, price) pair missing from the previous
    # dimension can only come from this run's rows, so only they are scanned.
    dim, _ = product.populate_product(wh.read("clean", [run_id]),
                                      wh.read("product", [prev]) if prev is not None else None)
    if reversion:
        dim = product.scd2_reversion(cut_lineage(dim), clean_all)
    wh.write(dim, "product", run_id)

    # 5. fact and 6. cube, from the stored dimensions
    sk = wh.read("street_keys", [run_id])
    if parent_match == "city":
        sk = sk.drop("state")
    if wh.months:
        touched = incremental.refresh_fact(
            wh.months["fact"], run_id, prev, wh.read("clean", [run_id]), clean_prev,
            wh.read("product", [prev]) if prev is not None else None,
            (wh.read("product", [run_id]), wh.read("time_dim", [run_id]), wh.read("location", [run_id]), sk), price_mode)
        incremental.refresh_cube(wh.months["cube"], wh.months["fact"], run_id, prev, touched)
        _publish(wh, run_id, gate)
        for t in wh.months.values():  # as many versions as the slots keep: this run's and the one before
            t.expire([r for r in (prev, run_id) if r is not None], done[-2:-1])
        return
    f = fact.build_order_fact(clean_all, wh.read("product", [run_id]), wh.read("time_dim", [run_id]),
                              wh.read("location", [run_id]), sk, address_match, price_mode)
    if fact_mode == "append" and prev is not None:
        f = fact.append_fact(wh.read("fact", [prev]), f, "append")
    wh.write(f, "fact", run_id)
    # A street is one of many; substring matching gives states and cities too, which hold far more rows than a day.
    dealt = "address_id" if address_match == "keyed" else "time_id"
    wh.write(cube.sales_cube(wh.read("fact", [run_id]), dealt=dealt), "cube", run_id)
    _publish(wh, run_id, gate)


def _publish(wh: Warehouse, run_id: int, gate: bool) -> None:
    """Commit the run; with ``gate`` only if its staged tables hold every key and reference.

    Violations are written to ``<root>/violations/run_id=<n>`` (a row a check) and raised; what was committed before stays the newest state.
    """
    if gate:
        bad = quality.violated(quality.star_checks(*(wh.read(t, [run_id]) for t in ("time_dim", "location", "product", "fact"))))
        path = os.path.join(wh.root, "violations", f"{RUN}={run_id}")
        bad.write.mode("overwrite").parquet(path)
        found = [(r["check"], r["violations"]) for r in wh.spark.read.schema(bad.schema).parquet(path).collect()]  # one row a check
        if found:
            raise quality.ConstraintViolation(run_id, sorted(found))
    wh.commit(run_id)


def warehouse_totals(wh: Warehouse) -> DataFrame:
    """(table, row_count, amount) over the newest state of every table."""
    runs = wh.committed()
    last = runs[-1:]
    amt = S.CUBE_SUM_TYPE

    def one(name: str, df: DataFrame, amount: Column) -> DataFrame:
        return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                      F.coalesce(amount, F.lit(0)).cast(amt).alias("amount"))

    parts = [
        one("landing", wh.read("landing", runs), F.lit(0)),
        one("clean", wh.read("clean", runs), F.sum(F.col("quantity_ordered") * F.col("price_each"))),
        one("errors", wh.read("errors", runs), F.sum("error_id")),
        one("time_dim", wh.read("time_dim", last), F.lit(0)),
        one("location", wh.read("location", last), F.lit(0)),
        one("product", wh.read("product", last), F.sum(F.col("price_each") * F.col("curr_status").cast("int"))),
        one("fact", wh.read("fact", last), F.sum("total_price")),
        one("cube", wh.read("cube", last), F.sum("total_price_sum")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def replay_landing(spark: SparkSession, landing: DataFrame, as_of=None, root: str | None = None, layout: str = "slots",
                   **options) -> Warehouse:
    """Replay a landing table as its arrival batches (one run per distinct stamp), read from one written copy."""
    from starloom.session import scratch_path
    root = root or scratch_path(spark, "warehouse")
    wh = Warehouse(spark, root, layout)
    landing = cut_lineage(landing, "replay", DENSE)
    # One row per arrival batch: bounded by the number of batches, not by rows.
    stamps = [r[0] for r in landing.select("updated_at").distinct().orderBy("updated_at").collect()]
    for i, ts in enumerate(stamps):
        run_warehouse_batch(wh, landing.filter(F.col("updated_at") == F.lit(ts)), i, as_of, **options)
    return wh


def run_batches_from_landing(spark: SparkSession, landing: DataFrame, as_of=None, root: str | None = None,
                             **options) -> DataFrame:
    """The totals of every table after ``replay_landing``."""
    return warehouse_totals(replay_landing(spark, landing, as_of, root, **options))


VIEW_NAMES = {
    "sales_landing": "landing", "sales_landing_2": "clean", "sales_landing_errors": "errors",
    "time_dimension": "time_dim", "location_hierarchy": "location",
    "product_staging_dimension": "product", "order_fact": "fact", "sales_data_cube": "cube",
}


def register_views(wh: Warehouse) -> list[str]:
    """Analyst access: temp views over the newest committed state, e.g.
    ``spark.sql("SELECT * FROM sales_data_cube ORDER BY product_surrogate_id")``."""
    runs = wh.committed()
    if not runs:
        return []
    accumulating = {"landing", "clean", "errors"}
    for view, table in VIEW_NAMES.items():
        wh.read(table, runs if table in accumulating else runs[-1:]).createOrReplaceTempView(view)
    # O-36: the source's Orders_Updated temp table (each sale -> its valid version).
    product.map_orders_to_versions(wh.read("clean", runs), wh.read("product", runs[-1:])) \
        .createOrReplaceTempView("orders_updated")
    return sorted([*VIEW_NAMES, "orders_updated"])
