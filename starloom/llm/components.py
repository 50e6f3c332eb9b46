"""Connected components of a link table, by alternating large and small stars.

Every step is a grouped minimum and an equi-join; between rounds the links are written to the shared checkpoint folder. Only a
count and a digest of the links (two numbers a round) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node it knows."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a")
    return (moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).filter(F.col("a") != F.col("b")).distinct())


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(a, root): every linked node but the least of its component, with that least node. ``links`` has long a, b."""
    now = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .filter(F.col("a") != F.col("b")).distinct(), name)
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return now.select("a", F.col("b").alias("root"))
        before = state
        now = cut_lineage(_small_star(_large_star(now)), name)
