"""Benchmark decontamination: a prefix-filtered set join of item windows against documents.

Each benchmark item is cut into windows of ``window`` consecutive words (a shorter item is one window). A
window is a set of word shingles. Shingles are ordered by how rare they are over all documents, and since a window
counts only when it is contained whole, its necessary prefix is its one rarest shingle: a document without it
cannot hold the window. Documents are joined with windows on that shingle alone. A candidate is the place in the
document where the window would have to start; the positional bound (it starts at word 0 or later) and the length bound
(it ends inside the document) are applied first, then the words of the document's window of the item's size are compared.

The windows are dealt by hash into blocks of about ``block_bytes`` (one block for any usual benchmark). A block is
broadcast, having been measured, and joined inside one scan of the documents, so documents never cross a shuffle.
With several blocks there is one scan a block, and the small findings (never the texts) are put together per document.

Defined results: NULL or empty text has no words and no hits. An item without words has no window. An item with
NULL id still marks words, but is not listed. Repeated items, and windows shared by items, list every item once;
repeated documents give one row each. Empty tables give no rows, or documents without hits.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import free_name, read, utf8
from starloom.session import cut_lineage

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 16 << 20

#: Digits, lower-case letters and all bytes of non-ASCII characters stay, capitals become small, the rest separates.
_FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else (b + 32 if chr(b).isupper() else 0x20)
              for b in range(256))

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.StringType()))])


def words(data: bytes | None) -> list[bytes]:
    return data.translate(_FOLD).split() if data else []


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct windows (words joined by one space) with the ids of the items that hold them."""
    def cut(batches):
        for b in batches:
            ids, out = b.column(0).to_pylist(), ([], [])
            for i, data in zip(ids, utf8(b.column(1))):
                w = words(data)
                for s in range(max(1, len(w) - window + 1) if w else 0):
                    out[0].append(i)
                    out[1].append(b" ".join(w[s:s + window]))
            yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.binary())], ["item", "words"])
    pieces = items.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(cut, "item string, words binary")
    return pieces.groupBy("words").agg(F.collect_set("item").alias("items"))


def _shingles(w: list[bytes], k: int):
    return w if k == 1 else list(zip(*(w[i:] for i in range(k))))


def _rarity(docs: DataFrame, text_col: str, wanted, lengths: list[int]) -> dict:
    """How often each wanted shingle occurs over all documents."""
    def count(batches):
        seen = Counter()
        for b in batches:
            for data in utf8(b.column(0)):
                w = words(data)
                for k in lengths:
                    seen.update(filter(wanted.value.__contains__, _shingles(w, k)))
        keys = [b" ".join(x) if isinstance(x, tuple) else x for x in seen]
        yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(list(seen.values()), pa.int64())], ["shingle", "n"])
    counted = docs.select(text_col).mapInArrow(count, "shingle binary, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {bytes(r.shingle): r.n for r in counted.collect()}  # at most the shingles of one measured block


def _index(windows: list, rarity: dict, shingle: int) -> dict:
    """rarest shingle -> (its place in the window, window length) -> window text -> items."""
    index: dict = {}
    for text, items in windows:
        w = text.split(b" ")
        k = min(shingle, len(w))
        at, token = min(enumerate(_shingles(w, k)), key=lambda x: (
            rarity.get(b" ".join(x[1]) if k > 1 else x[1], 0), x[1]))
        index.setdefault(token, {}).setdefault((at, len(w)), {})[text] = items
    return index


def locate(w: list[bytes], index: dict, lengths: list[int]) -> tuple[list[list[int]], set[str]]:
    """Merged word spans [start, end) of ``w`` covered by windows of the index, and the items found."""
    hits, found = [], set()
    n = len(w)
    for k in lengths:
        for i, token in enumerate(_shingles(w, k)):
            if token in index:
                for (at, size), texts in index[token].items():
                    start = i - at
                    if start < 0 or start + size > n:
                        continue
                    items = texts.get(b" ".join(w[start:start + size]))
                    if items is not None:
                        hits.append((start, start + size))
                        found.update(items)
    spans: list[list[int]] = []
    for s, e in sorted(hits):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    return spans, found


def _scan(docs: DataFrame, text_col: str, name: str, index, lengths: list[int]) -> DataFrame:
    @F.arrow_udf(FOUND)
    def find(texts: pa.Array) -> pa.Array:
        n, spans, items = [], [], []
        for data in utf8(texts):
            w = words(data)
            s, f = locate(w, index.value, lengths) if index.value else ([], set())
            n.append(len(w))
            spans.append(s)
            items.append(sorted(f))
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))],
            names=["n_words", "spans", "items"])
    return docs.withColumn(name, find.asNondeterministic()(F.col(text_col)))


def find_contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with one struct column more (n_words, spans, items), and that column's name."""
    spark = docs.sparkSession
    name = free_name(docs, "contamination")
    windows = cut_lineage(item_windows(items, item_id, item_text, window), "item-windows")
    size = windows.agg(F.sum(F.length("words") + 16 + 16 * F.size("items"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    passes = []
    for b in range(blocks):
        held = [(bytes(r.words), r["items"]) for r in
                windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).collect()]  # one measured block
        sizes = {text: len(text.split(b" ")) for text, _ in held}
        lengths = sorted({min(shingle, n) for n in sizes.values()})
        wanted = spark.sparkContext.broadcast(
            {t for text, n in sizes.items() for t in _shingles(text.split(b" "), min(shingle, n))})
        rarity = _rarity(docs, text_col, wanted, lengths) if held else {}
        wanted.unpersist()
        index = spark.sparkContext.broadcast(_index(held, rarity, shingle))
        passes.append((index, lengths))
    if blocks == 1:
        return _scan(docs, text_col, name, *passes[0]), name
    # Findings of the blocks meet by document id and text digest; rows equal in both have equal findings.
    keys = [F.col(id_col).alias("k1"), F.md5(text_col).alias("k2")]
    found = None
    for index, lengths in passes:
        part = _scan(docs, text_col, name, index, lengths).select(*keys, f"{name}.*")
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("k1", "k2").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    k1, k2 = F.col(id_col), F.md5(text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, k1.alias("d1"), k2.alias("d2"))
    joined = keyed.join(merged, F.col("d1").eqNullSafe(F.col("k1")) & F.col("d2").eqNullSafe(F.col("k2")), "left")
    return joined.select("row.*", F.struct("n_words", _merge(F.col("spans")).alias("spans"),
                                           F.sort_array("items").alias("items")).alias(name)), name


def _merge(spans):
    """Overlapping or touching spans as one, from the spans of several blocks."""
    step = lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(F.element_at(acc, -1), 2) >= x[0]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.array(
            F.element_at(F.element_at(acc, -1), 1), F.greatest(F.element_at(F.element_at(acc, -1), 2), x[1]))))
    ).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(F.sort_array(spans), F.array().cast("array<array<bigint>>"), step)


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents (all their columns) in which no benchmark window occurs."""
    marked, name = find_contamination(docs, items, **options)
    return marked.filter(F.size(f"{name}.spans") == 0).drop(name)


def op1_decontaminate(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked, c = find_contamination(docs, read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(f"{c}.spans", F.lit(0).cast("long"), lambda a, x: a + x[1] - x[0])
    return marked.select(
        "doc_id", F.col(f"{c}.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size(f"{c}.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", f"{c}.items"), 256).alias("items_sha256"),
        (F.size(f"{c}.spans") > 0).alias("contaminated"))
