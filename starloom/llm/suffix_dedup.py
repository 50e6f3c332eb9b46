"""Suffix-array dedup: remove bytes covered by a 100-byte string that also starts earlier.

Documents are reduced to the fragments that can still matter (``repeats``) and these dealt to shards by anchor, so that equal strings meet.
Each shard of about ``SHARD`` bytes builds its suffix array by Larsson-Sadakane refinement in numpy (sort by eight bytes, then
double the sorted length, touching only groups that are not yet single), and the common prefixes of neighbours by Kasai's walk in
text order, in many lanes at once. Neighbours with a common prefix of ``WINDOW`` bytes hold the same string; all but the earliest recur. Where one
anchor fills several shards, their sorted strings are merged by binary search: a string's earliest place over all shards
is found in the merged table. Anchors of more than ``HEAVY`` bytes are split by window (see ``repeats``).

Defined results: NULL is an empty text. Strings are bytes of UTF-8, so what is left may cut a character; results are digests and
counts of bytes. Texts under 100 bytes are kept. Repeated rows (equal id and text) are one document given twice: equal
results. See ``repeats`` for NULL ids. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import free_name, read, utf8
from starloom.llm.repeats import Windows, blocks, recurring

WINDOW, GRAM = 100, 24
SHARD = 1 << 20
HEAVY = 4 * SHARD  # bytes of one anchor that are merged from several shards in one task
_TABLE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

RESULT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                       T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Larsson-Sadakane: all suffixes of a byte array in order."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | padded[j:j + n]
    # Zero bytes at the end and in the text must differ: the length left decides between equal keys.
    key_order = np.argsort(key, kind="stable")
    sa = key_order
    ordered = key[sa]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[sa] = group
    width = 8
    while True:
        size = np.diff(np.concatenate([np.flatnonzero(head), [n]]))
        loose = np.flatnonzero(np.repeat(size, size) > 1)
        if not len(loose):
            return sa
        at = sa[loose]
        second = rank[np.minimum(at + width, n)]
        order = np.lexsort((np.where(at + width > n, -1 - (at + width - n), second), rank[at]))
        at, second = at[order], second[order]
        first = rank[at]
        sa[loose] = at
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (
            (at[1:] + width > n) | (at[:-1] + width > n))])
        head[loose] = new
        rank[at] = np.maximum.accumulate(np.where(new, loose, 0))
        width *= 2


def common_prefixes(text: np.ndarray, sa: np.ndarray, lane: int = 256) -> np.ndarray:
    """Kasai: lcp[i] of suffixes sa[i - 1] and sa[i] (lcp[0] = 0); each lane walks ``lane`` positions in text order."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    plcp = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(n, np.uint64)  # the eight bytes from each position, first byte lowest
    for j in range(8):
        eight |= padded[j:j + n] << np.uint64(8 * j)
    first = np.arange(0, n, lane)
    h = np.zeros(len(first), np.int64)
    for step in range(lane):
        i = first + step
        live = np.flatnonzero(i < n)
        i, j = i[live], before[first[live] + step]
        length = np.maximum(h[live] - 1, 0)
        length[j < 0] = 0
        going = np.flatnonzero(j >= 0)
        while len(going):
            a, b = i[going] + length[going], j[going] + length[going]
            room = n - np.maximum(a, b)
            ok = room > 0
            going, a, b, room = going[ok], a[ok], b[ok], room[ok]
            diff = eight[a] ^ eight[b]
            lowest = diff & (~diff + np.uint64(1))
            same = np.where(diff == 0, 8, np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) >> 3)
            same = np.minimum(same, room)
            length[going] += same
            going = going[same == 8]
        h[live] = length
        plcp[i] = length
    return plcp[sa]


class Shard:
    """The windows of some fragments, grouped by content with a suffix array."""

    def __init__(self, rows: list[tuple], window: int):
        self.text = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        lengths = np.array([len(r[5]) for r in rows])
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        counts = np.array([r[4] for r in rows])
        self.frag = np.repeat(np.arange(len(rows)), counts)
        inner = np.arange(len(self.frag)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = begin[self.frag] + inner
        self.doc, self.tie = (np.array([r[i] for r in rows], np.int64)[self.frag] for i in (1, 2))
        self.start = np.array([r[3] for r in rows], np.int64)[self.frag] + inner
        sa = suffix_array(self.text)
        group = np.cumsum(common_prefixes(self.text, sa) < window)  # neighbours that share a window
        at = np.empty(len(sa), np.int64)
        at[sa] = group
        self.group = at[place]
        order = np.lexsort((self.start, self.tie, self.doc, self.group))
        head = np.concatenate([[True], self.group[order][1:] != self.group[order][:-1]])
        self.first = order[head]  # of each group, the earliest window; groups are in order of their strings
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(head) - 1
        self.place, self.window = place, window

    def strings(self) -> np.ndarray:
        """The distinct windows in order."""
        rows = np.lib.stride_tricks.sliding_window_view(self.text, self.window)[self.place[self.first]]
        return np.ascontiguousarray(rows).view(f"S{self.window}").ravel()

    def later(self, doc, tie, start) -> tuple[np.ndarray, ...]:
        """doc, tie, start of windows that stand after the given earliest place of their group."""
        d, t, s = doc[self.of], tie[self.of], start[self.of]
        after = (self.doc > d) | (self.doc == d) & ((self.tie > t) | (self.tie == t) & (self.start > s))
        return self.doc[after], self.tie[after], self.start[after]


def merge(shards: list[Shard]) -> list[tuple[np.ndarray, ...]]:
    """For each shard, the earliest place over all shards of each of its strings, found by binary search."""
    table, where = shards[0].strings(), [x[shards[0].first] for x in (shards[0].doc, shards[0].tie, shards[0].start)]
    for s in shards[1:]:
        own = s.strings()
        at = np.searchsorted(table, own)
        known = np.flatnonzero((at < len(table)) & (table[np.minimum(at, len(table) - 1)] == own))
        mine = [x[s.first] for x in (s.doc, s.tie, s.start)]
        old = [w[at[known]] for w in where]
        new = [m[known] for m in mine]
        less = (new[0] < old[0]) | (new[0] == old[0]) & ((new[1] < old[1]) | (new[1] == old[1]) & (new[2] < old[2]))
        for w, m in zip(where, new):
            w[at[known][less]] = m[less]
        fresh = np.setdiff1d(np.arange(len(own)), known)
        where = [np.insert(w, at[fresh], m[fresh]) for w, m in zip(where, mine)]
        table = np.insert(table, at[fresh], own[fresh])
    return [tuple(w[np.searchsorted(table, s.strings())] for w in where) for s in shards]


def decide(batches, window: int = WINDOW, shard: int = SHARD):
    """Windows of the given fragments whose string stands earlier, as (doc, tie, start, n) runs."""
    for parts in blocks(batches, shard):
        shards = [Shard(rows, window) for rows in parts]
        first = merge(shards) if len(shards) > 1 else [tuple(x[shards[0].first] for x in (
            shards[0].doc, shards[0].tie, shards[0].start))]
        for s, places in zip(shards, first):
            doc, tie, start = s.later(*places)
            order = np.lexsort((start, tie, doc))
            doc, tie, start = doc[order], tie[order], start[order]
            if len(doc):
                head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (
                    start[1:] != start[:-1] + 1)]))
                n = np.diff(np.concatenate([head, [len(doc)]]))
                yield pa.record_batch([pa.array(x) for x in (doc[head], tie[head], start[head], n)], ["doc", "tie", "start", "n"])


def byte_windows(window: int = WINDOW, gram: int = GRAM) -> Windows:
    return Windows(split=lambda data: data or b"", numbers=lambda s: _TABLE[np.frombuffer(s, np.uint8)], join=bytes,
                   size=window, gram=gram, other_documents=False)


def covered(spans: list[dict], window: int) -> list[list[int]]:
    """Runs of windows as merged [start, end) spans of symbols."""
    out: list[list[int]] = []
    for s, e in sorted((x["start"], x["start"] + x["n"] - 1 + window) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, shard: int = SHARD, heavy: int = HEAVY) -> tuple[DataFrame, str]:
    """``docs`` with a struct column more, and that column's name: n_bytes, n_removed, n_spans, kept (the bytes left)."""
    found = recurring(docs, id_col, text_col, byte_windows(window, gram), lambda b: decide(b, window, shard), heavy)

    @F.arrow_udf(RESULT)
    def strip(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out: list[list] = [[], [], [], []]
        for data, s in zip(utf8(texts), spans.to_pylist()):
            data, gone = data or b"", covered(s, window) if s else []
            edges = [0, *(x for g in gone for x in g), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            for part, value in zip(out, (len(data), len(data) - len(kept), len(gone), kept)):
                part.append(value)
        return pa.StructArray.from_arrays([*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())],
                                          names=["n_bytes", "n_removed", "n_spans", "kept"])
    name = free_name(docs, "dedup")
    return found.select("row.*", strip.asNondeterministic()(F.col("_text"), F.col("spans")).alias(name)), name


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def op2_suffix_dedup(spark, sf_dir):
    done, d = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", f"{d}.n_bytes", f"{d}.n_removed", f"{d}.n_spans",
                       F.sha2(f"{d}.kept", 256).alias("kept_sha256"))
