"""Scalar text helpers, all built from JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.schemas import DIGITS_RE, ID_COUNTER_WIDTH, PRICE_RE


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_digits(c: Column | str) -> Column:
    """``c ~ '^\\d+$'``; NULL stays NULL (three-valued, like the source)."""
    return col_(c).rlike(DIGITS_RE)


def is_price_text(c: Column | str) -> Column:
    """Unsigned decimal with at most two fraction digits."""
    return col_(c).rlike(PRICE_RE)


def counter(n: Column, width: int = ID_COUNTER_WIDTH) -> Column:
    """Counter padded with zeros to at least ``width`` digits, never truncated."""
    text = n.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def part(s: Column, delim: str, n: int) -> Column:
    """``split_part``: '' when the field is missing, negative n counts from the end."""
    return F.split_part(s, F.lit(delim), F.lit(n))


def longest_literal_run(pattern: Column) -> Column:
    """Longest run of a LIKE pattern free of ``%``, ``_`` and the escape ``\\``.

    Any match of ``'%' || pattern || '%'`` contains this run verbatim, so it
    is an exact equi-join key for a containment join.
    """
    runs = F.split(pattern, r"[%_\\]")
    ranked = F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("s")))
    return F.sort_array(ranked, asc=False)[0]["s"]
