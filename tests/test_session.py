import os

from starloom.session import cut_lineage, scratch_path, shared_dir, spread


def test_spread_only_repartitions_coarse_inputs(spark):
    target = spark.sparkContext.defaultParallelism
    coarse = spark.range(0, 100, numPartitions=1)
    assert spread(coarse).rdd.getNumPartitions() == target
    fine = spark.range(0, 100, numPartitions=target * 2)
    assert spread(fine).rdd.getNumPartitions() == target * 2


def test_scratch_and_cut_stay_in_the_shared_folder(spark):
    base = shared_dir(spark)
    p = scratch_path(spark, "x")
    assert p.startswith(base.replace("file:", "")) or p.startswith(base)
    assert scratch_path(spark, "x") != p
    df = cut_lineage(spark.range(10).selectExpr("id", "id * 2 as twice"), "t")
    # Re-read from parquet: the plan is a file scan, not a recomputation.
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["twice"] for r in df.collect()) == [2 * i for i in range(10)]
