"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Words of white-space separated text: what stands between these six bytes.
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores before it where ``df`` has it already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def chunks(rows: Iterable, weight, limit: int) -> Iterator[list]:
    """Cut a stream of rows into lists of at most ``limit`` total weight (one row at least)."""
    held, total = [], 0
    for row in rows:
        w = weight(row)
        if held and total + w > limit:
            yield held
            held, total = [], 0
        held.append(row)
        total += w
    if held:
        yield held
