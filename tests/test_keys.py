from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.keys import group_sequence, sequence_ids


def test_sequence_ids_dense_in_order(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("v"))
    out = sorted((r["seq"], r["v"]) for r in sequence_ids(df, ["v"], "seq", start=10, partitions=7).collect())
    assert out == [(10 + i, i) for i in range(500)]


def test_group_sequence_matches_row_number_under_skew(spark):
    # One group holds most rows: it is spread over many range partitions.
    df = spark.range(0, 2000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 13).cast("string")).alias("g"),
        (F.col("id") * 31 % 2000).alias("v"))
    got = {(r["g"], r["v"]): r["n"] for r in group_sequence(df, ["g"], ["v"], "n", partitions=9).collect()}
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v")))
    want = {(r["g"], r["v"]): r["n"] for r in ref.collect()}
    assert got == want


def test_group_sequence_null_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "g string, v int")
    got = sorted((r["g"] or "", r["v"], r["n"]) for r in group_sequence(df, ["g"], ["v"], "n").collect())
    assert got == [("", 1, 1), ("", 2, 2), ("a", 5, 1)]
