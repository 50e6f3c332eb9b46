"""Surrogate keys (O-66): dense sequence numbers without a one-task window.

``row_number()`` over an unpartitioned window, or over a window partitioned
by a hot key, runs in one task. Here the rows are range-partitioned on the
full sort key (so one hot group is spread over many tasks), each row takes
its position inside its partition, and a small table of per-partition (and
per-group) counts turns positions into global numbers. The count table has
one row per (group, partition) pair that actually occurs, so it is bounded
by min(rows, groups + partitions); it is joined back on (group, partition),
a key no group can dominate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import DENSE, cut_lineage

RANGE_PID = _PID = "_seq_pid"
_POS = "_seq_pos"
_TIE = "_seq_tie"


def _names(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def range_tagged(df: DataFrame, sort_cols: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` dealt and sorted by ranges of ``sort_cols``, written once, with each row's partition (``RANGE_PID``) and place in it.

    Without ``partitions``, Spark joins neighbouring small ranges: a few thousand rows are not written as a file a shuffle partition.
    """
    dealt = df.repartitionByRange(partitions, *sort_cols) if partitions else df.repartitionByRange(*sort_cols)
    ranged = dealt.sortWithinPartitions(*sort_cols)
    tagged = (
        ranged.withColumn(_PID, F.spark_partition_id())
        # monotonically_increasing_id = (partition << 33) + position in partition
        .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
    )
    # Positions must not change if a partition is recomputed: materialise once.
    return cut_lineage(tagged, "ranged", DENSE)


def sequence_ids(df: DataFrame, order_cols: Sequence[str | Column], id_col: str,
                 start: Column | int = 1, partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... in ``order_cols`` order (ties arbitrary).

    Rows equal in all order columns (repeated header lines may be most of the rejects) are told apart by
    their place in the input, the last range column, so they too are spread over partitions.
    """
    order = _names(order_cols) + [F.col(_TIE)]
    tagged = range_tagged(df.withColumn(_TIE, F.monotonically_increasing_id()), order, partitions).drop(_TIE)
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a single-task window here is bounded by the partition count.
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
    )
    start_c = start if isinstance(start, Column) else F.lit(start)
    return (
        tagged.join(F.broadcast(offsets), _PID)
        .withColumn(id_col, (start_c + F.col("_off") + F.col(_POS)).cast("long"))
        .drop(_PID, _POS, "_off")
    )


def group_sequence(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                   id_col: str, partitions: int | None = None) -> DataFrame:
    """``row_number()`` over ``partitionBy(group_cols).orderBy(order_cols)``, skew-safe."""
    groups = list(group_cols)
    tagged = range_tagged(df, _names(groups) + _names(order_cols), partitions)
    counts = tagged.groupBy(*groups, _PID).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_base"))
    w = Window.partitionBy(*groups).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups], F.col(_PID).alias("_g_pid"), "_base",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # NULL-safe on the group so a NULL parent still gets its numbers.
    cond = [tagged[g].eqNullSafe(offsets[f"_g_{g}"]) for g in groups]
    cond.append(tagged[_PID] == offsets["_g_pid"])
    return (
        tagged.join(offsets, cond)
        .withColumn(id_col, (F.col("_off") + F.col(_POS) - F.col("_base") + 1).cast("long"))
        .drop(_PID, _POS, "_off", "_base", "_g_pid", *[f"_g_{g}" for g in groups])
    )
