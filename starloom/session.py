"""Session construction and shared-folder helpers.

Lineage is cut with reliable ``checkpoint()`` or with tables written under
the cluster's shared folder named by ``spark.checkpoint.dir``. A folder of our
own is only chosen when that setting is unset and Spark runs in local mode
(tests, the bench); on a cluster an unset setting is an error, because a
machine-local folder would not survive the loss of an executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sale-sized tables: about a third less to write than Spark's default codec.
DENSE = "zstd"

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # Small local data: let AQE keep post-shuffle partitions down to 64 KB so
        # CPU-heavy stages over small frames still use every core. Clusters keep
        # Spark's defaults (their partitions are far above this floor).
        conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "64k"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set on the context if only the conf has it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    base = shared_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, name: str = "stage", codec: str | None = None) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared folder and read it back.

    Like a reliable checkpoint this survives executor loss and ends the
    lineage, and unlike one the re-read keeps parquet column pruning, filter
    pushdown and file-size statistics for the planner. ``codec``: the files' compression, Spark's own if not given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the file system that Spark itself would use for it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer partitions than the cluster's cores.

    A source stored as a few unsplittable files (one row group each) would
    otherwise run every downstream narrow stage in a handful of tasks. Large
    inputs already have more partitions than cores and are left untouched.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
