"""Where fixed-size windows of documents recur: the shared frame of byte and word substring dedup.

Anchors. The anchor of a window is its least ``gram``-symbol gram by hash (the leftmost of equal ones). It depends on the
window's content alone, so equal windows have equal anchors at the same place within them. Neighbouring windows mostly share
their anchor; a document is so cut into runs of windows with one anchor each (about 2 / (window - gram + 2) of the positions).
The text under a run is a fragment. Every window is in one fragment, so nothing is left out.

Reduction. Fragments meet by anchor. Places whose fragment is equal (64-bit hashes of anchor and of text, and the length) are one text at several places:
all but the first are known to recur. This is done within each batch first, so a passage that is everywhere is one row a batch in the shuffle.
An anchor with one text needs nothing more. Only fragments of anchors with several texts (the edges of near
copies) are cut out of the documents and given to ``decide``, the operator's own method, dealt and sorted by anchor. What it returns and the places known before are
the recurring windows; each document then meets its own by key.

Heavy anchors. A line of boilerplate in very many different contexts is one anchor with very many different texts. Where an anchor's
fragments add up to more than ``heavy`` symbols, its windows are dealt one by one, by their whole content: the earliest place of
each is a partial aggregation, and an equi-join finds the later ones. So no task holds more than ``heavy`` symbols of one anchor.

Documents are told apart by id and a digest of the text. Rows equal in both are one document given twice: their places are one place,
which is not earlier than itself, so a row that is only repeated keeps its text in every copy.
NULL ids count as the smallest id.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import chunks, utf8
from starloom.session import cut_lineage

PIECE = 1 << 19  # symbols hashed at a time
_ODD = 0x9E3779B97F4A7C15
_NULL_ID = -(1 << 63)
_PLACE = pa.schema([("h", pa.int64()), ("fh", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()),
                    ("start", pa.int64()), ("n", pa.int64())])


@dataclass(frozen=True)
class Windows:
    """What a window is: its symbols, their number, the anchor's, and whether only smaller ids count as earlier."""
    split: Callable  # bytes -> symbols, sliceable
    numbers: Callable  # symbols -> uint64 array of well-mixed numbers
    join: Callable  # a slice of symbols -> bytes
    size: int
    gram: int
    other_documents: bool


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_ODD)
    return x ^ (x >> np.uint64(32))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    have = max(_powers, default=0)
    if have < n:
        have = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(have, _ODD, np.uint64)]))
            down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(have, pow(_ODD, -1, 1 << 64), np.uint64)]))
        _powers.clear()
        _powers[have] = up, down
    return _powers[have]


def runs(x: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int, gram: int):
    """Runs of windows in concatenated texts: anchor hash, fragment hash, first window, number of windows."""
    n, m = len(x), size - gram + 1
    up, down = _power(n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[:n], dtype=np.uint64)])
    g = mixed((total[gram:] - total[:-gram]) * down[:n - gram + 1])
    low = np.uint64((1 << 20) - 1)
    least, span = (g & ~low) | np.arange(len(g), dtype=np.uint64), 1
    while span * 2 <= m:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if m > span:
        least = np.minimum(least[:len(least) - (m - span)], least[m - span:])
    edge = np.zeros(n + 2, np.int8)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths - size + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:len(least)]) > 0)
    if not len(at):
        return None
    anchor = (least[at] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]))
    count = np.diff(np.concatenate([first, [len(at)]]))
    s = at[first]
    text = mixed((total[s + count - 1 + size] - total[s]) * down[s])
    return g[anchor[first]].view(np.int64), text.view(np.int64), s, count


def _batch_places(docs: list[tuple[int, int, bytes]], w: Windows):
    """h, fh, document index, start, n of all runs of a batch."""
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    held, total = [], 0

    def flush():
        nonlocal held, total
        if held:
            lengths = np.array([len(x) for _, _, x in held])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            found = runs(np.concatenate([x for _, _, x in held]), starts, lengths, w.size, w.gram)
            if found:
                h, fh, s, n = found
                i = np.searchsorted(starts, s, "right") - 1
                which, base = (np.array([x[j] for x in held]) for j in (0, 1))
                for part, values in zip(out, (h, fh, which[i], s - starts[i] + base[i], n)):
                    part.append(values)
        held, total = [], 0
    for d, (_, _, data) in enumerate(docs):
        symbols = w.split(data) if data else b""
        if len(symbols) < w.size:
            continue
        x = w.numbers(symbols)
        for at in range(0, len(x) - w.size + 1, PIECE):  # long texts: pieces that overlap by a window less one
            part = x[at:at + PIECE + w.size - 1]
            if total + len(part) > PIECE:
                flush()
            held.append((d, at, part))
            total += len(part)
    flush()
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]


def _new(columns) -> np.ndarray:
    """Whether each of the sorted rows differs from the one before."""
    return np.concatenate([[True], np.any([x[1:] != x[:-1] for x in columns], axis=0)])


def _once(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Sorted rows without equal ones: a place that is given twice is one place, which is not after itself."""
    own = _new(rows)
    return rows if own.all() else [x[own] for x in rows]


def places(docs: DataFrame, w: Windows) -> DataFrame:
    """Runs of every document, one per text and batch; n < 0 marks -n windows known to recur."""
    def find(batches):
        for b in batches:
            ids = [i if i is not None else _NULL_ID for i in b.column(0).to_pylist()]
            ties = b.column(1).to_pylist()
            h, fh, d, start, n = _batch_places(list(zip(ids, ties, utf8(b.column(2)))), w)
            if not len(h):
                continue
            doc, tie = (np.array(x, np.int64)[d] for x in (ids, ties))
            order = np.lexsort((start, tie, doc, n, fh, h))
            h, fh, doc, tie, start, n = _once([x[order] for x in (h, fh, doc, tie, start, n)])
            new = _new((h, fh, n))
            kept = new
            if w.other_documents:  # places in the first document are not repeats yet
                kept = doc == doc[np.flatnonzero(new)[np.cumsum(new) - 1]]
            g = [x[~kept] for x in (doc, tie, start, n)]
            if len(g[0]):  # neighbouring runs as one
                order = np.lexsort((g[2], g[1], g[0]))
                gd, gt, gs, gn = (x[order] for x in g)
                first = np.flatnonzero(np.concatenate([[True], (gd[1:] != gd[:-1]) | (gt[1:] != gt[:-1]) | (
                    gs[1:] != gs[:-1] + gn[:-1])]))
                gn = np.add.reduceat(gn, first)
                gd, gt, gs = (x[first] for x in (gd, gt, gs))
                gh = mixed((gd * 31 + gs).view(np.uint64)).view(np.int64)
            else:
                gh, gd, gt, gs, gn = [np.empty(0, np.int64)] * 5
            out = [np.concatenate(x) for x in ((h[kept], gh), (fh[kept], gh), (doc[kept], gd), (tie[kept], gt),
                                               (start[kept], gs), (n[kept], -gn))]
            for at in range(0, len(out[0]), 50_000):
                yield pa.record_batch([pa.array(x[at:at + 50_000]) for x in out], schema=_PLACE)
    return docs.mapInArrow(find, "h long, fh long, doc long, tie long, start long, n long")


def classify(found: DataFrame, w: Windows) -> DataFrame:
    """doc, tie, start, n of windows known to recur (h NULL) and of fragments to be decided (h: their anchor)."""
    dealt = found.repartition("h").sortWithinPartitions("h", "fh", "n", "doc", "tie", "start")

    def of(rows, told):
        h, fh, doc, tie, start, n = rows
        known = n < 0
        new = _new((h, fh, n))
        group = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1
        several = (np.bincount(group, new & ~known) > 1)[group]
        several |= told & (group == 0)
        first = new if not w.other_documents else doc == doc[np.flatnonzero(new)[np.cumsum(new) - 1]]
        recur, check = known | ~first, ~known & first & several
        out = recur | check
        out[0] &= not told
        return pa.record_batch([pa.array(h[out], mask=recur[out]), *(pa.array(x[out]) for x in (doc, tie, start)),
                                pa.array(np.abs(n[out]))], ["h", "doc", "tie", "start", "n"]), several, new

    def run(batches):
        held, told = None, False  # told: the first held row is out already and stands for its text; its anchor has several
        for b in batches:
            rows = [b.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            if not len(rows[0]):
                continue
            held = _once(rows if held is None else [np.concatenate(x) for x in zip(held, rows)])
            result, several, new = of(held, told)
            if several[-1]:  # the last anchor may go on, but what it holds is decided
                yield result
                held, told = [x[np.flatnonzero(new)[-1]:][:1] for x in held], True
            elif cut := np.searchsorted(held[0], held[0][-1]):  # its only text so far waits
                yield of([x[:cut] for x in held], told)[0]
                held, told = [x[cut:] for x in held], False
        if held is not None and len(held[0]):
            yield of(held, told)[0]
    return dealt.mapInArrow(run, "h long, doc long, tie long, start long, n long")


def release(spark) -> None:
    """Let Spark drop the shuffle files of steps whose result is written: it does so when their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _one_by_one(pieces: DataFrame, w: Windows) -> DataFrame:
    """Windows of the fragments (doc, tie, start, n = 1) that stand earlier too, decided by the content of each."""
    def cut(batches):
        for b in batches:
            for part in chunks(zip(*(b.column(i).to_pylist() for i in range(1, 6))), lambda x: x[3], 50_000):
                out: list[list] = [[] for _ in range(4)]
                for doc, tie, start, n, body in part:
                    symbols = w.split(body)
                    for column, values in zip(out, ([doc] * n, [tie] * n, range(start, start + n),
                                                    (w.join(symbols[i:i + w.size]) for i in range(n)))):
                        column.extend(values)
                yield pa.record_batch([*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())],
                                      ["doc", "tie", "start", "body"])
    windows = cut_lineage(pieces.mapInArrow(cut, "doc long, tie long, start long, body binary"), "repeats-windows")
    place = F.struct("doc", "tie", "start")
    first = windows.groupBy("body").agg(F.min(place).alias("first"))
    later = F.col("doc") > F.col("first.doc") if w.other_documents else place > F.col("first")
    return windows.join(first, "body").filter(later).select("doc", "tie", "start", F.lit(1).cast("long").alias("n"))


def recurring(docs: DataFrame, id_col: str, text_col: str, w: Windows, decide: Callable, heavy: int) -> DataFrame:
    """``row`` (the row of ``docs`` as a struct), ``_text`` and ``spans``: start, n of its recurring windows, unordered."""
    spark = docs.sparkSession
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("_doc"),
                        F.xxhash64(text_col).alias("_tie"), F.col(text_col).alias("_text"))
    narrow = keyed.select("_doc", "_tie", "_text")
    known = cut_lineage(classify(places(narrow, w), w), "repeats-places")
    release(spark)

    open_ = known.filter(F.col("h").isNotNull())
    many = cut_lineage(open_.groupBy("h").agg(F.sum(F.col("n") + (w.size - 1)).alias("symbols"))
                       .filter(F.col("symbols") > heavy).select("h"), "repeats-heavy")

    def cut(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for data, doc, tie, asked in zip(utf8(b.column(0)), *(b.column(i).to_pylist() for i in (1, 2, 3))):
                symbols = w.split(data)
                for a in asked:
                    body = w.join(symbols[a["start"]:a["start"] + a["n"] - 1 + w.size])
                    for part, value in zip(out, (a["h"], doc, tie, a["start"], a["n"], body)):
                        part.append(value)
            yield pa.record_batch([*(pa.array(x, pa.int64()) for x in out[:5]), pa.array(out[5], pa.binary())],
                                  ["h", "doc", "tie", "start", "n", "body"])

    def pieces(fragments: DataFrame) -> DataFrame:
        """The fragments with their text. Rows given twice are cut once a row: equal fragments of equal places do no harm."""
        asked = fragments.groupBy("doc", "tie").agg(F.collect_list(F.struct("h", "start", "n")).alias("asked"))
        return (narrow.join(asked, (F.col("_doc") == F.col("doc")) & (F.col("_tie") == F.col("tie")))
                .select("_text", "doc", "tie", "asked")
                .mapInArrow(cut, "h long, doc long, tie long, start long, n long, body binary"))
    single = many.isEmpty()
    decided = cut_lineage(
        pieces(open_ if single else open_.join(many, "h", "left_anti")).repartition("h").sortWithinPartitions("h")
        .mapInArrow(lambda batches: decide(batches), "doc long, tie long, start long, n long"), "repeats-decided")
    if not single:
        decided = decided.union(cut_lineage(_one_by_one(pieces(open_.join(many, "h", "left_semi")), w), "repeats-later"))
    release(spark)
    spans = (known.filter(F.col("h").isNull()).select("doc", "tie", "start", "n").union(decided)
             .groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    # The text crosses the shuffle once, inside its row.
    return (keyed.drop("_text").join(spans, (F.col("_doc") == F.col("doc")) & (F.col("_tie") == F.col("tie")), "left")
            .select("row", F.col(f"row.`{text_col}`").alias("_text"), "spans"))


def blocks(batches, limit: int):
    """Rows (h, doc, tie, start, n, body) sorted by h, in blocks of whole anchors of about ``limit`` bytes.

    An anchor above the limit comes alone, as a list of blocks; all others as a list of one.
    """
    held, size, last = [[]], 0, None
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[0] != last:
                if size >= limit:
                    yield [x for x in held if x]
                    held, size = [[]], 0
                last = row[0]
            elif size >= limit:  # the anchor itself is large: what came before it goes first
                if len(held) == 1 and held[0] and held[0][0][0] != row[0]:
                    before = [x for x in held[0] if x[0] != row[0]]
                    own = held[0][len(before):]
                    yield [before]
                    held, size = [own], sum(len(x[5]) for x in own)
                if sum(len(x[5]) for x in held[-1]) >= limit:
                    held.append([])
            held[-1].append(row)
            size += len(row[5])
    if any(held):
        yield [x for x in held if x]
