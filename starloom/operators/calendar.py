"""Two-branch calendar dimension (O-06, O-07).

The calendar spans Jan 1 of the first sale year to Dec 31 of the last. It is
generated from a single one-row aggregate: ``sequence`` + ``explode`` makes
the days, and each day emits every node it opens (its own day rows, and the
month / quarter / half-year / year / ISO week that starts on it), so the
whole dimension is one Generate with no shuffle beyond the min/max
aggregate. Its size is bounded by the year span, not by the sales volume.

Ids (fixed formats): day ``D_YYYYMMDD``; month ``M_<Y><m>`` (month not
padded); quarter ``Q_<Y><q>``; half ``HY_<Y><h>``; year ``Y_<Y>``; ISO week
``W_<isoY><w>``. ``time_combined_id`` is ``M_`` or ``W_`` (branch) + id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import iso_week_year, ymd_id


def _node(cid: Column, tid: Column, name: Column, parent: Column, lvl: str, branch: str,
          day: Column | None) -> Column:
    return F.struct(
        cid.alias("time_combined_id"), tid.alias("time_id"), name.alias("time_name"),
        parent.cast("string").alias("time_parent"), F.lit(lvl).alias("time_lvl"),
        F.lit(branch).alias("timebranch"),
        (day if day is not None else F.lit(None).cast("date")).alias("day_date"))


def calendar_days(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """(d, y0): every day of the covered years, with the first covered year."""
    bounds = df.agg(F.min(F.year(date_col)).alias("y0"), F.max(F.year(date_col)).alias("y1"))
    return bounds.select(
        F.explode(F.sequence(F.make_date("y0", F.lit(1), F.lit(1)),
                             F.make_date("y1", F.lit(12), F.lit(31)))).alias("d"),
        "y0")


def build_time_dimension(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """O-06: calendar over the sale years of ``df`` (empty input -> empty dimension)."""
    days = calendar_days(df, date_col)
    d, y0 = F.col("d"), F.col("y0")
    y, m, dd = F.year(d).cast("string"), F.month(d), F.dayofmonth(d)
    q, h = F.quarter(d), F.when(F.month(d) <= 6, 1).otherwise(2)
    iy, wk = iso_week_year(d).cast("string"), F.weekofyear(d).cast("string")
    qs, hs, ms = q.cast("string"), h.cast("string"), m.cast("string")

    day_id = F.concat(F.lit("D_"), ymd_id(d))
    month_id = F.concat(F.lit("M_"), y, ms)
    quarter_id = F.concat(F.lit("Q_"), y, qs)
    half_id = F.concat(F.lit("HY_"), y, hs)
    year_id = F.concat(F.lit("Y_"), y)
    week_id = F.concat(F.lit("W_"), iy, wk)
    day_name = F.date_format(d, "yyyy-MM-dd")
    first_of_month = dd == 1
    # Days of the first covered year's leading ISO week that belongs to the
    # previous year keep a NULL week parent; the week row itself is emitted.
    week_parent = F.when(iso_week_year(d) >= y0, week_id)
    opens_week = (F.dayofweek(d) == 2) | (F.dayofyear(d) == 1) & (F.year(d) == y0)

    nodes = F.array(
        _node(F.concat(F.lit("M_"), day_id), day_id, day_name, month_id, "0", "main", d),
        _node(F.concat(F.lit("W_"), day_id), day_id, day_name, week_parent, "0", "week", d),
        F.when(first_of_month, _node(F.concat(F.lit("M_"), month_id), month_id,
                                     F.concat(y, F.lit("-"), ms), quarter_id, "1", "main", None)),
        F.when(first_of_month & (m % 3 == 1),
               _node(F.concat(F.lit("M_"), quarter_id), quarter_id,
                     F.concat(F.lit("Q"), qs, F.lit("-"), y), half_id, "2", "main", None)),
        F.when(first_of_month & (m % 6 == 1),
               _node(F.concat(F.lit("M_"), half_id), half_id,
                     F.concat(F.lit("HY_"), hs, F.lit("-"), y), year_id, "3", "main", None)),
        F.when(first_of_month & (m == 1),
               _node(F.concat(F.lit("M_"), year_id), year_id, y, F.lit(None), "4", "main", None)),
        F.when(opens_week,
               _node(F.concat(F.lit("W_"), week_id), week_id,
                     F.concat(F.lit("W_"), wk, F.lit("-"), iy), F.lit(None), "1", "week", None)),
    )
    return days.select(F.inline(F.filter(nodes, lambda x: x.isNotNull())))


def update_time_dimension(dim: DataFrame, df: DataFrame, date_col: str = "order_date") -> tuple[DataFrame, DataFrame]:
    """O-07: (new or changed rows, updated dimension) - set difference, NULL-equal.

    A stored row whose key comes again with other values (the days before the first full week, once an
    earlier year has arrived) is replaced, so keys stay unique.
    """
    fresh = build_time_dimension(df, date_col)
    stored = dim.select(*fresh.columns)
    added = fresh.subtract(stored)
    kept = stored.join(added.select("time_combined_id"), "time_combined_id", "left_anti").select(*fresh.columns)
    return added, kept.unionByName(added)


def main_days(dim: DataFrame) -> DataFrame:
    """Day rows of the main branch (the fact's time grain)."""
    return dim.filter((F.col("time_lvl") == "0") & (F.col("timebranch") == "main"))


def update_time_table(spark, table: str, df: DataFrame, date_col: str = "order_date") -> int | None:
    """O-07 + O-42 on a catalog table: append the missing calendar rows, replace changed ones.

    Does nothing (returns None) when the table does not exist, as the source's
    update silently aborts; otherwise returns the number of rows appended or replaced.
    """
    if not spark.catalog.tableExists(table):
        return None
    current = spark.table(table)
    added, _ = update_time_dimension(current, df, date_col)
    # Materialise before inserting: the difference reads the table being written.
    from starloom.session import cut_lineage
    added = cut_lineage(added.select(*current.columns), "time-added")
    n = added.count()
    if n and current.join(added, "time_combined_id", "left_semi").isEmpty():
        added.write.insertInto(table)
    elif n:
        kept = current.join(added.select("time_combined_id"), "time_combined_id", "left_anti").select(*current.columns)
        cut_lineage(kept.unionByName(added), "time-updated").write.insertInto(table, overwrite=True)
    return n
