"""SimHash near-dedup: fingerprints, pigeonhole blocks, Hamming check, components.

A text's fingerprint takes the words of the text (capitals A-Z made small), their ``shingle``-word shingles, repeats included, and
the XXH64 (seed 42) of each; a bit is 1 if it is set in over half of the hashes. Fingerprints differing in at most
``bits`` bits are linked.

Pigeonhole: the 64 bits are cut into ``BLOCKS`` blocks. At most ``bits`` blocks can differ between linked
fingerprints, so they agree in some choice of ``BLOCKS - bits`` blocks: one join key a choice. Only distinct fingerprints
are keyed (copies are one row), and two fingerprints under one key differ in the other blocks' bits alone: with 6 blocks and 2 bits that is at most
22 bits, so no key ever holds more than 2**22 rows, whatever the input. Within a key, fingerprints are compared by Hamming
distance: small keys pair by pair, large ones by looking up the fingerprints with up to ``bits`` bits flipped. A key
gives back one link per member (to the least of its local component), never all its pairs.

Defined results: NULL, empty and blank texts have no shingles and fingerprint zero, linked like any other; fewer words than a
shingle are hashed as one sequence. Rows with NULL id take part; a component of NULL ids alone has component NULL.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import free_name, read, utf8
from starloom.llm.components import components
from starloom.session import cut_lineage

SHINGLE, BITS, BLOCKS = 3, 2, 6
SEED = 42
_SMALL = 64  # members of a key that are compared pair by pair
_PIECE = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(data: bytes | None, shingle: int = SHINGLE) -> int:
    words = data.lower().split() if data else []
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:len(words) - shingle].tolist()]
    stops = (ends[shingle - 1:] - 1).tolist()
    digest, n, counts = xxhash.xxh64_digest, len(starts), np.zeros(64, np.int64)
    for at in range(0, n, _PIECE):
        held = b"".join([digest(line[s:e], SEED) for s, e in zip(starts[at:at + _PIECE], stops[at:at + _PIECE])])
        counts += np.unpackbits(np.frombuffer(held, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` and the fingerprint as a signed long."""
    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(d, shingle) for d in utf8(texts)], np.uint64).view(np.int64))
    return docs.withColumn(name, prints.asNondeterministic()(F.col(text_col)))


def _masks(blocks: int, bits: int) -> list[int]:
    """For each choice of blocks that must agree, the mask of their bits."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [((1 << (e - s)) - 1) << s for s, e in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(block, blocks - bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def local_links(values: np.ndarray, bits: int, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints of one key, sorted -> links to the least member of each local component.

    ``free``: the mask of bits in which members can differ.
    """
    n = len(values)
    if n <= _SMALL:
        a, b = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= bits, 1))
    else:
        ones = [np.uint64(1 << i) for i in range(64) if free >> i & 1]
        found = []
        for k in range(1, bits + 1):
            for chosen in combinations(ones, k):
                other = values ^ np.bitwise_or.reduce(chosen)
                at = np.searchsorted(values, other)
                at[at == n] = 0
                hit = np.nonzero((values[at] == other) & (at > np.arange(n)))[0]
                found.append((hit, at[hit]))
        a, b = (np.concatenate(x) for x in zip(*found))
    label = np.arange(n)
    while len(a):  # labels only fall, and follow the label of the label
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.nonzero(label != np.arange(n))[0]
    return values[moved], values[label[moved]]


def block_links(prints: DataFrame, bits: int = BITS, blocks: int = BLOCKS) -> DataFrame:
    """Links (a, b) of distinct fingerprints ``fp`` that keep every component of the bit-distance graph."""
    masks = _masks(blocks, bits)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long"))
                                        .alias("key")) for i, m in enumerate(masks)]))

    def link(batches):
        held = None
        for b in batches:
            rows = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            new = np.nonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))[0] + 1
            if len(new):
                yield _linked([x[:new[-1]] for x in held], new[:-1])
                held = [x[new[-1]:] for x in held]
        if held is not None and len(held[0]):
            yield _linked(held, np.array([], np.int64))

    def _linked(rows, cuts):
        choice, _, fp = rows
        edges = np.concatenate([[0], cuts, [len(fp)]]).astype(np.int64)
        out = ([], [])
        for i in np.nonzero(np.diff(edges) > 1)[0]:
            s, e = edges[i], edges[i + 1]
            a, b = local_links(np.sort(fp[s:e].view(np.uint64)), bits, ~masks[choice[s]] & ((1 << 64) - 1))
            out[0].append(a)
            out[1].append(b)
        join = lambda x: pa.array(np.concatenate(x).view(np.int64) if x else np.array([], np.int64))
        return pa.record_batch([join(out[0]), join(out[1])], ["a", "b"])

    keyed = prints.select(keys.alias("k"), "fp").select("k.choice", "k.key", "fp")
    dealt = keyed.repartition("choice", "key").sortWithinPartitions("choice", "key")
    return dealt.mapInArrow(link, "a long, b long").distinct()


def _roots(rows: DataFrame, bits: int, blocks: int) -> DataFrame:
    """(fp, root) for the fingerprints that are not their component's own root."""
    prints = cut_lineage(rows.select("fp").distinct(), "simhash-prints")
    return components(block_links(prints, bits, blocks), "simhash-links").withColumnRenamed("a", "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    bits: int = BITS, blocks: int = BLOCKS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = cut_lineage(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                                        "text", "fp", shingle).select("doc_id", "fp"), "simhash")
    roots = _roots(rows, bits, blocks)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = cut_lineage(named.join(ids, "root").select("fp", "component_id"), "simhash-classes")
    return rows.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             bits: int = BITS, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with one document of each component: that of the least id (NULL last), of equal ids the first read."""
    fp, row = free_name(docs, "simhash_fp"), free_name(docs, "simhash_row")
    held = cut_lineage(with_fingerprint(docs, text_col, fp, shingle).withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    rows = held.select(F.col(fp).alias("fp"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    roots = _roots(rows, bits, blocks)
    place = F.struct(F.col("id").isNull().alias("n"), "id", "row")
    best = rows.groupBy("fp").agg(F.min(place).alias("best")).join(roots, "fp", "left")
    kept = best.groupBy(F.coalesce("root", "fp")).agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    return held.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_simhash(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))
