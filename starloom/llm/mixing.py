"""Mixing sources to target weights by Pareto order sampling (native: DataFrame functions only).

A source's target is its share by weight, at most ``max_copies`` times its own size; what such caps
leave over is shared out by weight again until no source is above its cap. Within a source
every document gets an expected number of copies, ``target / source_size`` (times its priority, if a priority column
is given). Its whole part is taken for certain. The fractions left are inclusion odds of a Pareto sample: with a
uniform number U per document, documents are ranked by ``(U / (1 - U)) / (p / (1 - p))`` and taken in
that order until the words still missing are reached. So the sample has a fixed size in words, and the last
document is taken only if that leaves the source nearer to its target.

No task ever holds a whole source. The rank at which a source is full is found by
counting words in cells of the rank (4,096 cells, then 4,096 within the cell that holds the end, then the ranks of that
cell), each a partial aggregation and a running sum over at most 4,096 rows a source.

Defined results: a NULL or empty text has size 0 and takes 0 words. NULL is a source of its own, ordered last.
U is drawn from a digest of document id, source and text, so reruns agree and input order does not matter. Rows equal
in all three share one rank; where a source is full at such a rank, as many of them are taken as come nearest to the target, in the order of
a written copy of that rank's rows (numbered within its partitions, so that they are never in one task). An empty table gives an empty result.
Other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import SPACE_WORD
from starloom.session import cut_lineage

CELLS = 4096
_TWO52 = float(1 << 52)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)).cast("long"), F.lit(0).cast("long"))


def uniform(*parts: Column, seed: str = "mix") -> Column:
    """A number strictly between 0 and 1 from a digest of ``parts`` (NULL differs from '')."""
    marked = [F.coalesce(F.concat(F.lit("+"), p.cast("string")), F.lit("-")) for p in parts]
    digest = F.md5(F.concat_ws("\x1f", F.lit(seed), *marked))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / _TWO52


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            priority: Column | None = None) -> DataFrame:
    """The narrow rows the mix is planned on: id, source, size, u, priority."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        uniform(F.col(id_col), F.col(source_col), F.col(text_col)).alias("u"),
        (priority if priority is not None else F.lit(1.0)).cast("double").alias("priority"))


def source_targets(rows: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0,
                   max_copies: int = 3) -> DataFrame:
    """One row per source: source_size, target and the size-weighted mean priority.

    Sources are few next to documents: the ordering windows below see one row per source.
    """
    by_source = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("priority")).alias("weighed"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    named = by_source.withColumn("weight", F.element_at(table, ((F.row_number().over(order) - 1) % len(weights) + 1)))
    capped = named.withColumn("cap", F.col("source_size").cast("double") * max_copies)
    # Caps bind in the order of cap / weight: fill them in that order until one has room.
    fill = W.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filled = (capped
              .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("bound", F.col("cap") * F.col("open") <= F.col("weight") * F.col("left")))
    spare = filled.withColumns({
        "left": F.col("total") - F.coalesce(F.sum(F.when(F.col("bound"), F.col("cap"))).over(everything), F.lit(0.0)),
        "open": F.sum(F.when(~F.col("bound"), F.col("weight"))).over(everything)})
    target = F.when(F.col("bound"), F.col("cap")).otherwise(F.col("weight") * F.col("left") / F.col("open"))
    return spare.select("source", "source_size", target.alias("target"),
                        (F.col("weighed") / F.col("source_size")).alias("mean_priority"))


def _expected(rows: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """Certain copies and the sampling rank (``q``: Pareto odds mapped to 0..1) of every row."""
    t = targets.withColumnRenamed("source", "_source")
    joined = rows.join(t, rows["source"].eqNullSafe(t["_source"]), "left").drop("_source")
    mean = F.when(F.col("mean_priority") > 0, F.col("priority") / F.col("mean_priority")).otherwise(F.lit(1.0))
    expected = F.when(F.col("source_size") > 0, F.least(
        F.lit(float(max_copies)), F.col("target") / F.col("source_size") * mean)).otherwise(F.lit(0.0))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    return (joined.withColumn("expected", expected)
            .withColumn("certain", F.floor("expected"))
            .withColumn("p", F.col("expected") - F.col("certain"))
            .withColumn("q", F.when(F.col("p") > 0, odds / (1 + odds)))
            .withColumn("cell1", F.least(F.floor(F.col("q") * CELLS), F.lit(CELLS - 1)))
            .withColumn("cell2", F.least(F.floor((F.col("q") * CELLS - F.col("cell1")) * CELLS), F.lit(CELLS - 1))))


_LEVELS = ("cell1", "cell2", "q")


def plan_mix(rows: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0,
             max_copies: int = 3) -> tuple[DataFrame, DataFrame]:
    """Targets and, per source, where its sample ends: edge_cell1, edge_cell2, edge_q, edge_left."""
    targets = cut_lineage(source_targets(rows, weights, share, max_copies), "mix-targets")
    drawn = _expected(rows, targets, max_copies)
    taken = drawn.groupBy("source").agg(
        F.first("target").alias("target"), F.sum(F.col("certain") * F.col("size")).alias("sure"))
    edges = taken.select("source", (F.col("target") - F.col("sure")).alias("edge_left"))
    inside = drawn.filter(F.col("q").isNotNull())
    for level in _LEVELS:
        e = edges.withColumnRenamed("source", "_source")
        near = inside.join(e, F.col("source").eqNullSafe(F.col("_source")))
        for done in _LEVELS[:_LEVELS.index(level)]:
            near = near.filter(F.col(done) == F.col(f"edge_{done}"))
        cells = near.groupBy("source", level).agg(F.sum("size").alias("words"), F.first("edge_left").alias("edge_left"))
        running = W.partitionBy("source").orderBy(level).rowsBetween(W.unboundedPreceding, -1)
        found = (cells.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
                 .filter((F.col("before") <= F.col("edge_left")) & (F.col("before") + F.col("words") > F.col("edge_left")))
                 .select(F.col("source").alias("_found"), F.col(level).alias(f"edge_{level}"),
                         (F.col("edge_left") - F.col("before")).alias("_left")))
        edges = (edges.join(found, F.col("source").eqNullSafe(F.col("_found")), "left")
                 .withColumn("edge_left", F.coalesce("_left", "edge_left")).drop("_found", "_left"))
        edges = cut_lineage(edges, f"mix-edges-{level}")
    return targets, edges


def apply_mix(rows: DataFrame, targets: DataFrame, edges: DataFrame, max_copies: int = 3) -> DataFrame:
    """``rows`` (with source, size, u, priority) plus source_size, target, copies and taken."""
    drawn = _expected(rows, targets, max_copies)
    e = edges.withColumnRenamed("source", "_source")
    joined = drawn.join(e, drawn["source"].eqNullSafe(e["_source"]), "left").drop("_source")
    c1, c2, q = (F.col(f"edge_{x}") for x in _LEVELS)
    # A level without an edge ends nowhere: everything there still fits.
    same = lambda x: F.coalesce(F.col(x) == F.col(f"edge_{x}"), F.lit(False))
    before = (c1.isNull() | (F.col("cell1") < c1)
              | (same("cell1") & (c2.isNull() | (F.col("cell2") < c2) | (same("cell2") & (q.isNull() | (F.col("q") < q))))))
    at_edge = same("cell1") & same("cell2") & same("q")
    inside = F.when(F.col("q").isNotNull() & before, F.lit(1)).otherwise(F.lit(0))
    last = _numbered(joined.filter(at_edge))
    fits = F.floor((F.col("edge_left") - F.col("size") / 2) / F.nullif("size", F.lit(0))) + 1
    both = (joined.filter(~at_edge).withColumn("extra", inside)
            .unionByName(last.withColumn("extra", F.when((F.col("size") > 0) & (F.col("mix_place") <= fits), F.lit(1)).otherwise(F.lit(0)))
                         .drop("mix_place")))
    copies = (F.coalesce(F.col("certain"), F.lit(0)) + F.col("extra")).cast("long")
    return (both.withColumn("copies", copies).withColumn("taken", copies * F.col("size"))
            .drop("expected", "certain", "p", "q", "cell1", "cell2", "mean_priority", "edge_left", "extra", *[f"edge_{x}" for x in _LEVELS]))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` and their number in their source from 1 (mix_place): counted by partition of a written copy, then within each."""
    held = cut_lineage(rows.withColumn("mix_row", F.monotonically_increasing_id()), "mix-last")
    part = F.shiftright("mix_row", 33)  # the partition that wrote the row
    counts = held.groupBy("source", part.alias("mix_part")).agg(F.count(F.lit(1)).alias("n"))
    running = W.partitionBy("source").orderBy("mix_part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    starts = counts.select(F.col("source").alias("_source"), F.col("mix_part").alias("_part"),
                           F.coalesce(F.sum("n").over(running), F.lit(0)).alias("mix_start"))
    within = F.row_number().over(W.partitionBy("source", "mix_part").orderBy("mix_row"))
    numbered = held.withColumn("mix_part", part).withColumn("mix_in", within)
    return (numbered.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("mix_part") == F.col("_part")))
            .withColumn("mix_place", F.col("mix_start") + F.col("mix_in")).drop("mix_row", "mix_part", "mix_in", "mix_start", "_source", "_part"))


def mix_sizes(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0,
              max_copies: int = 3, **columns) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows = cut_lineage(measure(docs, **columns), "mix-rows")
    targets, edges = plan_mix(rows, weights, share, max_copies)
    return apply_mix(rows, targets, edges, max_copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, max_copies: int = 3,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents themselves: every column of ``docs`` and ``mix_copies``, rows with none left out.

    The text never crosses a shuffle: only the plan per source is joined to the documents.
    An input column called ``mix_copies`` is replaced.
    """
    rows = cut_lineage(measure(docs, id_col, text_col, source_col), "mix-rows")
    targets, edges = plan_mix(rows, weights, share, max_copies)
    kept = [c for c in docs.columns if c.lower() != "mix_copies"]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"),
                       F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                       uniform(F.col(id_col), F.col(source_col), F.col(text_col)).alias("u"), F.lit(1.0).alias("priority"))
    return (apply_mix(held, targets, edges, max_copies).filter(F.col("copies") > 0)
            .select("doc.*", F.col("copies").alias("mix_copies")))


def op10_mix(spark, sf_dir):
    from starloom.llm.common import read
    return mix_sizes(read(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5(concat_ws(chr(31), 'mix', coalesce('+' || doc_id::VARCHAR, '-'), coalesce('+' || source, '-'),
      coalesce('+' || text, '-'))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
    source_size::DOUBLE * 3 AS cap, (sum(source_size) OVER ())::DOUBLE AS total FROM s),
f AS (SELECT *, total - coalesce(sum(cap) OVER b, 0) AS l, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS o
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, cap * o <= weight * l AS bound FROM f),
t AS (SELECT source, source_size, CASE WHEN bound THEN cap ELSE weight * (total - coalesce(sum(CASE WHEN bound THEN cap END) OVER (), 0))
    / sum(CASE WHEN NOT bound THEN weight END) OVER () END AS target FROM g),
e AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN least(3.0, t.target / t.source_size) ELSE 0.0 END AS m
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, floor(m)::BIGINT AS certain, m - floor(m) AS p FROM e),
r AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q,
    target - sum(certain * size) OVER (PARTITION BY source) AS missing FROM p),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, q IS NULL ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r)
SELECT doc_id, source, size, source_size, target, (certain + CASE WHEN q IS NOT NULL AND before + size / 2 <= missing THEN 1 ELSE 0 END)::BIGINT AS copies,
  ((certain + CASE WHEN q IS NOT NULL AND before + size / 2 <= missing THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM c
"""
