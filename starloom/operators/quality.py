"""Landing cleansing (O-02..O-05) and data-quality checks (O-67).

One validation pass tags every landing row with the reason of the first
failing rule (NULL when clean); clean and error tables are two filters of
that tagged frame, so the rules are evaluated once per row, inside
whole-stage codegen, with no Python in the row path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.dates import parse_order_ts
from starloom.functions.text import is_digits, is_price_text
from starloom.operators.keys import sequence_ids
from starloom.session import DENSE, cut_lineage


def _as_of(as_of: datetime | str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def latest_batch(df: DataFrame, ts: str = "updated_at") -> DataFrame:
    """O-02: rows stamped at or after the newest stamp (a scalar subquery)."""
    return df.filter(F.col(ts) >= df.agg(F.max(ts)).scalar())


def typed_columns(df: DataFrame, blank_is_null: bool = False, int_limits: bool = False) -> DataFrame:
    """Add trimmed product/address and the parsed typed values (NULL if unparsable).

    ``blank_is_null`` (Q-10, off like the source): an empty product or address
    counts as missing instead of passing the NOT NULL rules. ``int_limits``
    (off): order ids and quantities over 2,147,483,647 are out of range, as in
    the source's INT columns; otherwise they may use 64 bits.
    """
    whole = "int" if int_limits else "bigint"
    qty_ok, price_ok, oid_ok = is_digits("quantity_ordered"), is_price_text("price_each"), is_digits("order_id")

    def trimmed(c: str) -> Column:
        t = F.trim(c)
        return F.when(t != "", t) if blank_is_null else t

    # Raw text stays as landed (addresses are parsed from it); trimmed copies drive the rules.
    return (
        df.withColumn("_product", trimmed("product"))
        .withColumn("_address", trimmed("purchase_address"))
        .withColumn("_oid", F.when(oid_ok, F.col("order_id").try_cast(whole).cast("bigint")))
        .withColumn("_qty", F.when(qty_ok, F.col("quantity_ordered").try_cast(whole).cast("bigint")))
        .withColumn("_price", F.when(price_ok, F.col("price_each").try_cast(S.PRICE_TYPE)))
        .withColumn("_ts", parse_order_ts("order_date"))
    )


def error_reason(as_of: datetime | str | Column | None = None,
                 max_lengths: Mapping[str, int] | None = None) -> Column:
    """First failing rule, evaluated in the source's order; NULL for a clean row.

    A NULL in a test never selects its branch (three-valued logic), so a row
    with NULL quantity or price and nothing else wrong ends as
    ``Unknown validation error``. ``max_lengths`` (Q-13, opt-in, e.g.
    ``schemas.LANDING_WIDTHS``) rejects over-long fields first: the source
    would abort the whole load on them.
    """
    now = _as_of(as_of)
    oid, prod, qty, price = (F.col(c) for c in ("order_id", "_product", "quantity_ordered", "price_each"))
    date, addr = F.col("order_date"), F.col("_address")
    headers = {c: h for h, c in S.CSV_HEADERS.items()}
    chain = None
    for c, n in (max_lengths or {}).items():
        cond, reason = F.length(F.col(c)) > n, S.REASON_TOO_LONG.format(headers[c])
        chain = F.when(cond, reason) if chain is None else chain.when(cond, reason)
    # A typed value is there only if its text has the right form: the text is matched again only where there is none.
    first = F.col("_oid").isNull() & ~F.coalesce(is_digits(oid), F.lit(False))
    chain = F.when(first, S.REASON_ORDER_ID) if chain is None else chain.when(first, S.REASON_ORDER_ID)
    return (
        chain
        .when(F.col("_oid").isNull(), S.REASON_ORDER_ID_RANGE)
        .when(prod.isNull(), S.REASON_PRODUCT_NULL)
        .when(F.col("_qty").isNull() & ~is_digits(qty), S.REASON_QTY_FORMAT)
        .when(F.col("_qty").isNull() & is_digits(qty), S.REASON_QTY_RANGE)
        .when(F.col("_qty") <= 0, S.REASON_QTY_NOT_POSITIVE)
        .when(F.col("_price").isNull() & ~is_price_text(price), S.REASON_PRICE_FORMAT)
        .when(F.col("_price").isNull() & is_price_text(price), S.REASON_PRICE_RANGE)
        .when(F.col("_price") <= 0, S.REASON_PRICE_NOT_POSITIVE)
        .when(date.isNull(), S.REASON_DATE_NULL)
        .when(F.col("_ts").isNull(), S.REASON_DATE_INVALID)
        .when(F.col("_ts") > now, S.REASON_DATE_FUTURE)
        .when(addr.isNull(), S.REASON_ADDRESS_NULL)
        .when(qty.isNull() | price.isNull(), S.REASON_UNKNOWN)
    )


def tag_rows(df: DataFrame, as_of: datetime | str | Column | None = None, blank_is_null: bool = False,
             max_lengths: Mapping[str, int] | None = None, int_limits: bool = False) -> DataFrame:
    """Landing rows + typed values + ``error_reason``."""
    return typed_columns(df, blank_is_null, int_limits).withColumn("error_reason", error_reason(as_of, max_lengths))


def clean_of(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("error_reason").isNull()).select(
        F.col("_oid").alias("order_id"),
        F.upper("_product").alias("product"),
        F.col("_qty").alias("quantity_ordered"),
        F.col("_price").alias("price_each"),
        F.col("_ts").alias("order_date"),
        F.col("_address").alias("purchase_address"),
        "updated_at",
    )


def errors_of(tagged: DataFrame, executed_time: datetime | str | Column | None = None) -> DataFrame:
    """Rejected rows: the landing text (product/address trimmed) and the reason."""
    run_ts = F.col("updated_at") if executed_time is None else _as_of(executed_time)
    return tagged.filter(F.col("error_reason").isNotNull()).select(
        "order_id", F.col("_product").alias("product"), "quantity_ordered", "price_each", "order_date",
        F.col("_address").alias("purchase_address"), "error_reason",
        run_ts.alias("logged_at"), run_ts.alias("executed_time"))


def validate_split(df: DataFrame, as_of: datetime | str | Column | None = None,
                   executed_time: datetime | str | Column | None = None, blank_is_null: bool = False,
                   max_lengths: Mapping[str, int] | None = None,
                   int_limits: bool = False) -> tuple[DataFrame, DataFrame]:
    """O-04: (clean, errors). Persist the tagged frame when both are consumed."""
    tagged = tag_rows(df, as_of, blank_is_null, max_lengths, int_limits)
    return clean_of(tagged), errors_of(tagged, executed_time)


def anti_dedup(new: DataFrame, existing: DataFrame | None, compare: str = "typed") -> DataFrame:
    """O-03: drop landing rows already present in the clean table.

    ``typed`` compares parsed values (the intent); ``text`` compares the
    clean values cast to text against trimmed landing text, as the source
    does, so order dates never match and re-loads are never removed.
    NULL keys never match. Rows inside one batch are not deduplicated.
    """
    if existing is None:
        return new
    ex = existing.select(
        F.col("order_id").alias("_e_oid"), F.lower(F.trim("product")).alias("_e_prod"),
        F.col("quantity_ordered").alias("_e_qty"), F.col("price_each").alias("_e_price"),
        F.col("order_date").alias("_e_ts"), F.trim("purchase_address").alias("_e_addr"))
    if compare == "typed":
        probe = typed_columns(new)
        # History is far larger than a batch: only ids are dealt to find those of both. They are written, so their size is known: while few
        # are sent again, only those rows of batch and history meet in the anti join, and the other rows are not dealt.
        batch_ids = probe.select(F.col("_oid").alias("_e_oid")).filter(F.col("_e_oid").isNotNull()).distinct()
        both = cut_lineage(ex.select("_e_oid").distinct().join(batch_ids, "_e_oid", "left_semi"), "sent-again-ids", DENSE)
        ex = ex.join(both, "_e_oid", "left_semi")
        keys = [("_oid", "_e_oid"), ("_prod", "_e_prod"), ("_qty", "_e_qty"),
                ("_price", "_e_price"), ("_ts", "_e_ts"), ("_address", "_e_addr")]
        known = probe["_oid"] == both["_e_oid"]
        again = probe.join(both, known, "left_semi").withColumn("_prod", F.lower("_product"))
        out = again.join(ex, [again[a] == ex[b] for a, b in keys], "left_anti")
        return probe.join(both, known, "left_anti").select(*new.columns).unionByName(out.select(*new.columns))
    if compare == "text":
        ext = ex.select(
            F.trim(F.col("_e_oid").cast("string")).alias("_e_oid"), "_e_prod",
            F.trim(F.col("_e_qty").cast("string")).alias("_e_qty"),
            F.trim(F.col("_e_price").cast("string")).alias("_e_price"),
            F.col("_e_ts").cast("string").alias("_e_ts"), "_e_addr")
        cond = [
            F.trim(new["order_id"]) == ext["_e_oid"],
            F.lower(F.trim(new["product"])) == ext["_e_prod"],
            F.trim(new["quantity_ordered"]) == ext["_e_qty"],
            F.trim(new["price_each"]) == ext["_e_price"],
            new["order_date"] == ext["_e_ts"],
            F.trim(new["purchase_address"]) == ext["_e_addr"],
        ]
        return new.join(ext, cond, "left_anti")
    raise ValueError(f"unknown compare mode {compare!r}")


def batch_months(landing: DataFrame) -> list[str]:
    """The months of a batch's readable order dates (bounded by the time it covers)."""
    month = F.date_format("_ts", "yyyy-MM")
    return sorted(r[0] for r in typed_columns(landing).select(month.alias("m")).distinct().collect() if r[0] is not None)


def anti_dedup_by_month(new: DataFrame, existing: DataFrame, month_col: str = "order_month") -> DataFrame:
    """``anti_dedup`` of typed values against a history stored by order month: the date is one of the keys compared, so only
    the batch's months are read (a partition filter of the scan)."""
    return anti_dedup(new, existing.filter(F.col(month_col).isin(batch_months(new))).drop(month_col))


def assign_error_ids(errors: DataFrame, start: Column | int = 1) -> DataFrame:
    """O-66: contiguous ``error_id`` in content order, continuing from ``start``."""
    order = list(S.LANDING_COLUMNS) + ["error_reason"]
    with_id = sequence_ids(errors, [F.col(c).asc_nulls_first() for c in order], "error_id", start)
    return with_id.select("error_id", *errors.columns)


def _one_form(tagged: DataFrame) -> DataFrame:
    """Tagged rows with the values their table reads: typed ones of a clean row, the text of a rejected one (NULL otherwise)."""
    rejected = F.col("error_reason").isNotNull()
    text = ["order_id", "quantity_ordered", "price_each", "order_date"]
    return tagged.drop("product", "purchase_address").withColumns(
        {c: F.when(rejected, F.col(c)) for c in text} | {c: F.when(~rejected, F.col(c)) for c in ("_oid", "_qty", "_price", "_ts")})


def clean_sales(landing: DataFrame, clean_existing: DataFrame | None = None,
                as_of: datetime | str | Column | None = None, compare: str = "typed",
                error_id_start: Column | int = 1, executed_time=None, blank_is_null: bool = False,
                max_lengths: Mapping[str, int] | None = None,
                int_limits: bool = False) -> tuple[DataFrame, DataFrame]:
    """O-05: latest batch -> anti dedup -> trim -> validate -> (clean, errors with ids)."""
    batch = anti_dedup(latest_batch(landing), clean_existing, compare)
    # Both outputs read one materialised tagged batch: the rules and the
    # anti join run once per row, not once per output.
    tagged = cut_lineage(_one_form(tag_rows(batch, as_of, blank_is_null, max_lengths, int_limits)), "tagged-batch", DENSE)
    clean = clean_of(tagged)
    errors = assign_error_ids(errors_of(tagged, executed_time), error_id_start)
    return clean, errors


# --------------------------------------------------------------------------
# O-67 constraint checks
# --------------------------------------------------------------------------

def assert_quality(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row per check: (check, violations). A check is a Column that must hold.

    All checks are counted in one aggregation pass (NULL counts as a violation).
    """
    aggs = [F.sum(F.when(F.coalesce(cond, F.lit(False)), 0).otherwise(1)).cast("long").alias(name)
            for name, cond in checks.items()]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{n}', `{n}`" for n in checks)
    return wide.selectExpr(f"stack({len(checks)}, {pairs}) as (check, violations)") \
        .withColumn("violations", F.coalesce("violations", F.lit(0)).cast("long"))


def assert_keys(unique: Mapping[str, tuple[DataFrame, Sequence[str]]],
                references: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Primary and foreign keys as (check, violations).

    ``unique``: check -> (table, key columns); every row beyond the first of its key is a violation.
    ``references``: check -> (table, column, parent table, parent column); rows whose value no parent has are
    violations, NULL refers to nothing. Rows are counted per key before any join, so a hot key is one row there.
    """
    out = None
    for name, (df, cols) in unique.items():
        n = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1).alias("n"))
        one = n.select(F.lit(name).alias("check"), F.coalesce("n", F.lit(0)).cast("long").alias("violations"))
        out = one if out is None else out.unionByName(one)
    for name, (df, col, parents, key) in references.items():
        used = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
        n = used.join(parents.select(F.col(key).alias("_key")), "_key", "left_anti").agg(F.sum("n").alias("n"))
        one = n.select(F.lit(name).alias("check"), F.coalesce("n", F.lit(0)).cast("long").alias("violations"))
        out = one if out is None else out.unionByName(one)
    return out


def star_checks(time_dim: DataFrame, hierarchy: DataFrame, products: DataFrame, facts: DataFrame) -> DataFrame:
    """Keys and references of the star schema as (check, violations)."""
    return assert_keys(
        {"time_key_unique": (time_dim, ["time_combined_id"]), "address_key_unique": (hierarchy, ["address_id"]),
         "product_key_unique": (products, ["id"])},
        {"location_parent_exists": (hierarchy, "parent_id", hierarchy, "address_id"),
         "fact_address_exists": (facts, "address_id", hierarchy, "address_id"),
         "fact_time_exists": (facts, "time_id", time_dim.filter("time_lvl = '0' AND timebranch = 'main'"), "time_id"),
         "fact_product_exists": (facts, "product_surrogate_id", products, "id")})


class ConstraintViolation(ValueError):
    """A run's staged tables break a key or a reference; ``violations`` has (check, rows) of each."""

    def __init__(self, run_id: int, violations: list[tuple[str, int]]):
        super().__init__(f"run {run_id} is not published: {violations}")
        self.run_id, self.violations = run_id, violations


def violated(report: DataFrame) -> DataFrame:
    return report.filter(F.col("violations") > 0)
