"""Mixing: sources full of repeated rows, rows without a source, unequal odds, and clashing names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, mix_row string, size string, mix_place string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(5)


GIVEN = ([(1, "five words are in here", "b")] * 400 + [(100 + i, "one two three four five", "b") for i in range(400)]
         + [(1000 + i, "w " * 10, "a") for i in range(90)] + [(2000 + i, "w " * 10, "c") for i in range(50)]
         + [(3000, None, "b"), (None, None, None), (3001, "", "a")] + [(None, "rows without any id or source", None)] * 70)


def test_targets_are_met_with_repeated_rows(spark):
    docs = frame(spark, GIVEN)
    rows = mixing.mix_sizes(docs).collect()
    assert len(rows) == len(GIVEN)
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size
    for source, target, largest in {(r.source, r.target, 10) for r in rows}:
        assert abs(taken[source] - target) <= largest / 2, source
    whole = mixing.mix(docs)
    assert whole.columns == [*docs.columns, "mix_copies"]
    assert {r.source: r.n for r in whole.groupBy("source").agg(F.sum(mixing.word_count(F.col("text")) * F.col("mix_copies")).alias("n")).collect()} == \
        {k: v for k, v in taken.items() if v}


def test_sql_agrees_on_repeated_rows(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    docs = frame(spark, GIVEN).select("doc_id", "text", "source")
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    relation = con.sql(mixing.OP10_SQL)
    at = [relation.columns.index(c) for c in ("doc_id", "source", "size", "copies", "taken")]
    expected = Counter(tuple(r[i] for i in at) for r in relation.fetchall())
    assert Counter(tuple(r) for r in mixing.op10_mix(spark, str(tmp_path)).select("doc_id", "source", "size", "copies", "taken").collect()) == expected


def test_unequal_odds_follow_the_priority(spark):
    """Documents of priority 3 are included three times as often as those of priority 1, in a sample of fixed size."""
    n, seeds = 400, 12
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.lit("s").alias("source"))
    shares = Counter()
    for seed in range(seeds):
        named = docs.withColumn("text", F.concat(F.lit(f"x{seed} "), "text"))
        rows = mixing.measure(named, priority=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
        targets, edges = mixing.plan_mix(rows, share=0.25)
        got = mixing.apply_mix(rows, targets, edges).groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("taken").alias("t")).collect()
        assert abs(sum(r.t for r in got) - 0.25 * 3 * n) <= 1.5
        for r in got:
            shares[r.odd] += r.t / 3
    assert shares[0] / seeds / (n / 2) == pytest.approx(0.375, abs=0.04)
    assert shares[1] / seeds / (n / 2) == pytest.approx(0.125, abs=0.04)
