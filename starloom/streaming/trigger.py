"""Arrival-driven runs with Structured Streaming (O-60..O-63).

The source fired its whole chain once per inserted batch. Here a file
stream over the landing folder hands each micro-batch to ``foreachBatch``;
files of one arrival folder (``batch=<k>``) form one warehouse run, so a
micro-batch that picked up several arrivals runs them in arrival order.
Run ids derive from (epoch, arrival), so a replayed epoch rewrites the same
partitions (foreachBatch is at-least-once; the runs are idempotent). The
stream checkpoint replaces the source's arrival bookkeeping.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.plans.warehouse import Warehouse, run_warehouse_batch, warehouse_totals
from starloom.sources.landing import landing_of, parse_lines, with_origin, write_landing_csv

RUNS_PER_EPOCH = 1_000_000
# Of the replayed arrivals' compressed files: about 10 MB each.
ROWS_A_FILE = 500_000


def start_landing_stream(spark: SparkSession, landing_dir: str, wh: Warehouse, checkpoint: str,
                         stamp_for: Callable[[int], datetime | str] | None = None, as_of=None,
                         available_now: bool = True, max_files_per_trigger: int | None = None, malformed: str = "keep",
                         **options):
    """Start the stream; returns the StreamingQuery. Every file is read by its own header, as in batch reads."""
    reader = spark.readStream.schema(T.StructType([T.StructField("value", T.StringType()), T.StructField("batch", T.LongType())]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = with_origin(reader.text(landing_dir))

    def each(df: DataFrame, epoch_id: int) -> None:
        # Arrival folders in this micro-batch: bounded by the files per trigger.
        arrivals = sorted(r[0] for r in df.select("batch").distinct().collect())
        if len(arrivals) > RUNS_PER_EPOCH:
            raise ValueError(f"{len(arrivals)} arrivals in one micro-batch: set max_files_per_trigger")
        for i, k in enumerate(arrivals):
            ts = stamp_for(k) if stamp_for else datetime.now(timezone.utc)
            rows = landing_of(parse_lines(df.filter(F.col("batch") == k)), ts, malformed)
            run_warehouse_batch(wh, rows, epoch_id * RUNS_PER_EPOCH + i, as_of, **options)

    writer = raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def stream_totals_from_landing(spark: SparkSession, landing: DataFrame, as_of=None) -> DataFrame:
    """Write a landing table as CSV arrival folders, stream them, return the totals."""
    from starloom.session import DENSE, cut_lineage, scratch_path
    base = scratch_path(spark, "stream")
    landing = cut_lineage(landing, "stream-landing", DENSE)
    src = os.path.join(base, "landing")
    stamps = [r[0] for r in landing.select("updated_at").distinct().orderBy("updated_at").collect()]
    for k, ts in enumerate(stamps):
        write_landing_csv(landing.filter(F.col("updated_at") == F.lit(ts)), os.path.join(src, f"batch={k}"), "gzip", ROWS_A_FILE)
    wh = Warehouse(spark, os.path.join(base, "warehouse"))
    q = start_landing_stream(spark, src, wh, os.path.join(base, "checkpoint"),
                             stamp_for=lambda k: stamps[k], as_of=as_of)
    q.awaitTermination()
    return warehouse_totals(wh)
