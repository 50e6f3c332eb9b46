"""Tables in month partitions that a run replaces one by one.

A run writes the months it touches under ``<root>/<table>/run_id=<n>/order_month=<m>/`` and then one manifest: for every month, the run
whose files hold it. Untouched months stay where an earlier run wrote them; the manifest of a run is
found by its number, so a run that failed or is replayed changes nothing that a committed run refers to. The manifest
has one row per month (the driver reads it to list the folders).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import DENSE, delete_path

MONTH = "order_month"
FILES_A_MONTH = 32
MANIFEST = T.StructType([T.StructField(MONTH, T.StringType()), T.StructField("at_run", T.LongType())])


def month_of(date_col) -> F.Column:
    return F.date_format(date_col, "yyyy-MM")


class MonthTable:
    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType):
        self.spark, self.path, self.name = spark, os.path.join(root, name), name
        self.columns = schema.fieldNames()
        self.schema = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])

    def _manifest_path(self, run_id: int) -> str:
        return os.path.join(f"{self.path}_months", f"run_id={run_id}")

    def manifest(self, run_id: int | None) -> dict[str, int]:
        """Month -> the run that wrote it last, as of ``run_id`` (none: nothing written yet)."""
        if run_id is None:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(self._manifest_path(run_id)).collect()  # one row a month
        return {r[MONTH]: r.at_run for r in rows}

    def read(self, run_id: int | None, months=None) -> DataFrame:
        """The table as of ``run_id``, with its month; only ``months``, if given, are listed at all."""
        held = {m: r for m, r in self.manifest(run_id).items() if months is None or m in months}
        if not held:
            return self.spark.createDataFrame([], self.schema)
        paths = [os.path.join(self.path, f"run_id={r}", f"{MONTH}={m}") for m, r in sorted(held.items())]
        found = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
        return found.select(*self.columns, F.col(MONTH).cast("string").alias(MONTH))

    def carried(self, df: DataFrame, months) -> DataFrame:
        """Rows read from this table's months, to be written again: they lie by month as they are, and are dealt
        only once their files have become many."""
        return df.hint("rebalance", F.col(MONTH)) if len(df.inputFiles()) > FILES_A_MONTH * max(len(months), 1) else df

    def replace(self, df: DataFrame, run_id: int, prev: int | None, months) -> None:
        """Write ``df`` (with its month, already dealt by it) as the new content of ``months``; the others are carried over from ``prev``."""
        path = os.path.join(self.path, f"run_id={run_id}")
        (df.select(*self.columns, MONTH).write.partitionBy(MONTH)
         .option("partitionOverwriteMode", "static").mode("overwrite").parquet(path, compression=DENSE))
        written = self.spark.read.schema(self.schema).parquet(path).select(MONTH).distinct().collect()  # one row a month
        held = {m: r for m, r in self.manifest(prev).items() if m not in set(months)}
        held |= {str(r[MONTH]): run_id for r in written}
        (self.spark.createDataFrame(sorted(held.items()), MANIFEST).coalesce(1).write
         .option("partitionOverwriteMode", "static").mode("overwrite").parquet(self._manifest_path(run_id)))

    def expire(self, keep: list[int], old: list[int]) -> None:
        """Delete the month folders that manifests of ``old`` runs refer to and those of ``keep`` do not, then these manifests."""
        used = {(r, m) for k in keep for m, r in self.manifest(k).items()}
        for run_id in old:
            for m, r in self.manifest(run_id).items():
                if (r, m) not in used:
                    delete_path(self.spark, os.path.join(self.path, f"run_id={r}", f"{MONTH}={m}"))
            delete_path(self.spark, self._manifest_path(run_id))
