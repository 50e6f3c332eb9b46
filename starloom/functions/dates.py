"""Order-date parsing and calendar id helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.text import col_
from starloom.schemas import ORDER_TS_RE, YEAR_PIVOT


def parse_order_ts(c: Column | str) -> Column:
    """Parse ``MM/DD/YY HH24:MI`` order dates.

    Accepts one- or two-digit month, day and hour, and a two- or four-digit
    year; two-digit years below ``YEAR_PIVOT`` are 20xx, the others 19xx.
    Anything else (impossible dates, trailing text) gives NULL.

    The shape is checked once with a regex, so the fields between the
    separators are numbers; the value is made of them, without a datetime
    formatter run per row.
    """
    s = col_(c)
    day, time = F.substring_index(s, " ", 1), F.substring_index(s, " ", -1)
    year_text = F.substring_index(day, "/", -1)
    number = lambda text: text.cast("int")
    year = number(year_text)
    year = F.when(F.length(year_text) == 4, year).otherwise(year + F.when(year >= YEAR_PIVOT, 1900).otherwise(2000))
    made = F.try_make_timestamp(
        year, number(F.substring_index(day, "/", 1)), number(F.substring_index(F.substring_index(day, "/", 2), "/", -1)),
        number(F.substring_index(time, ":", 1)), number(F.substring_index(time, ":", -1)), F.lit(0))
    return F.when(s.rlike(ORDER_TS_RE), made)


def iso_week_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d)


def ymd_id(d: Column) -> Column:
    """``YYYYMMDD`` with zero-padded month and day."""
    return F.date_format(d, "yyyyMMdd")
