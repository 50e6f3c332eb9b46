"""Exact top-k search: BM25 over per-shard inverted indexes with block-max WAND pruning.

A shard is a batch of documents. It holds an inverted index (per term its postings by document, cut into
aligned blocks of ``BLOCK`` documents, which are placed so that those with the same common terms stand together) and for every term and block the largest term weight there. A query goes through a
shard in document order. No document of a block can score more than the sum of the block maxima of the query's terms, so the next
pivot is the next block whose sum reaches the threshold, and the cursors of all terms move there; postings before it are not read (over a gap of at
most ``GAP`` blocks the cursors read on; the weights of a term that more than one document in ``DENSE`` has lie in a row over all documents). Pivots are taken in waves of growing width, a wave at a time in numpy; after each wave the threshold is the k-th best score so far, so the next wave's pivots are fewer.

Document counts, mean length and document frequencies are global, from a pass over all rows, so scores of all shards compare and
the best k over shards are the best k of all. Thresholds are global too: queries first run over nested hash samples of the
documents, each ``SEED`` times the one before, the first about a shard in size. The k-th best of a sample (score and id) bounds the k-th best of all from below, so
the last round, over all documents, starts from it, and a task gives only the rows, k at most, that reach it: about ``SEED`` times k
rows a query and round, however many shards there are. A sample only sets thresholds; results are exact.

Queries come in blocks of ``QUERY_BYTES``, each measured before it is collected and broadcast, one at a time; a block's results are written before the next
is read. Every block indexes all documents again. No pair of query and document is ever a row.

Words are those of ``decontaminate``. A query counts every occurrence of its words. Equal scores (rounded to 9 places) go
by smaller document id. Defined results: NULL and empty texts match nothing and find nothing; a NULL id is kept and comes last of equal scores;
repeated rows are found as often as they are there; query rows are answered one by one, rows of one id too; very long texts are read whole, a
document over ``SHARD_BYTES`` is a shard of its own; without documents or queries the result is empty. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import chunks, read, utf8
from starloom.llm.decontaminate import words
from starloom.session import cut_lineage

K1, B = 1.2, 0.75
BLOCK = 64
WAVE = 16
GAP = 2
DENSE = 8
KINDS = 32
SEED = 16
GROUP = 2048
SHARE = 1000
ROWS = 4096
NEAR = 16
SPAN = 128
COMMON = 128
LINE = 64
TILE = 1 << 19
PIECE = 1 << 18
LINE_CELLS = 1 << 16
FEW = 8
SHARD_BYTES = 16 << 20
QUERY_BYTES = 32 << 20
COUNTED_BYTES = 4 << 20
COUNTED_ROWS = 5000
SLICE = 500
FOUND = "number long, query_id long, doc_id long, score double"


class Shard:
    """Inverted index of some documents; weights do not hold the idf, which is the query's. Terms have numbers; of a
    document's terms (in order of their first place) it keeps the weights too, for exact scores of single documents."""

    def __init__(self, texts: list[bytes | None], mean: float):
        counts = [Counter(words(data)) for data in texts]
        self.terms: dict[bytes, int] = {}
        term = np.array([self.terms.setdefault(w, len(self.terms)) for c in counts for w in c], np.int64)
        doc = np.repeat(np.arange(len(texts)), np.array([len(c) for c in counts], np.int64))
        tf = np.array([x for c in counts for x in c.values()], np.int64)
        length = np.array([sum(c.values()) for c in counts], np.int64)
        self._fill(term, doc, self._weights(tf, length[doc], mean), self._alike(term, doc, len(texts)), len(self.terms))

    @classmethod
    def several(cls, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, length: np.ndarray, mean: float, asked: np.ndarray) -> Iterator[Shard]:
        """Shards of at most ``GROUP`` documents alike, of documents of some ``length`` with their numbered terms, in order of the document.
        ``asked``: the share of queries that has each term."""
        size = len(length)
        first = np.searchsorted(doc, np.arange(size + 1))
        for held in cls._parts(term, doc, lambda at: cls._weights(tf[at], length[doc[at]], mean), size, GROUP):
            held = held[np.argsort((first[:-1] - first[1:])[held], kind="stable")]  # most terms first
            t, n, which = cls._slices(first[held], first[held + 1], term, tf)
            shard = cls.__new__(cls)
            shard._fill(t, which, cls._weights(n, length[held][which], mean), np.arange(len(held)), len(asked))
            shard.order, shard.asked = held, asked[shard.numbers[:-1] >= 0]
            yield shard

    def _fill(self, term: np.ndarray, doc: np.ndarray, weight: np.ndarray, order: np.ndarray, vocabulary: int) -> None:
        """``doc``: rows, in order; ``order``: the row at each place."""
        self.order, self.size, self.blocks = order, len(order), -(-len(order) // BLOCK)
        place = np.empty(self.size, np.int64)
        place[order] = np.arange(self.size)
        self.row_first = np.searchsorted(doc, np.arange(self.size + 1))[order]  # where a place's own terms begin
        self.row_end = self.row_first + np.bincount(doc, minlength=self.size)[order]
        there = np.bincount(term, minlength=vocabulary) > 0
        self.numbers = np.append(np.where(there, np.cumsum(there) - 1, -1), -1).astype(np.int32)  # the shard's own number of each term, -1 for those it has not
        self.own, self.own_weight = self.numbers[term], weight
        self.count = int(there.sum())
        order = np.argsort(self.own * self.size + place[doc])
        self.doc, self.weight, self.df = place[doc][order], weight[order], np.bincount(self.own, minlength=self.count)
        self.first = np.append(0, np.cumsum(self.df))  # postings of each term

    @staticmethod
    def _parts(term: np.ndarray, doc: np.ndarray, weight: Callable, size: int, limit: int) -> list[np.ndarray]:
        """Rows in parts of at most ``limit``, neighbours alike: split by the sign of the first principal component of their commonest terms' weights."""
        df = np.bincount(term)
        common = np.argsort(-df, kind="stable")[:COMMON]
        column = np.full(len(df), -1)
        column[common] = np.arange(len(common))
        some = np.flatnonzero(column[term] >= 0)
        held = np.zeros((size, len(common)))
        held[doc[some], column[term[some]]] = weight(some) * np.log1p(size / df[term[some]])
        held /= np.maximum(np.linalg.norm(held, axis=1), 1e-9)[:, None]
        whole, out = [np.arange(size)], []
        while whole:
            part = whole.pop()
            if len(part) <= limit:
                out.append(part)
                continue
            x = held[part] - held[part].mean(axis=0)
            side = x @ np.linalg.eigh(x.T @ x)[1][:, -1] > 0 if len(common) else np.zeros(len(part), bool)
            if min(side.sum(), (~side).sum()) * KINDS < len(part):  # hardly any on one side
                side = np.arange(len(part)) % 2 > 0
            whole += [part[side], part[~side]]
        return out

    @staticmethod
    def _weights(tf: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
        return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(mean, 1e-9)))

    @staticmethod
    def _alike(term: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
        """Rows ordered by which of the shard's commonest terms they hold, so that a block's documents are of one kind (a language, say)."""
        df = np.bincount(term)
        common = np.argsort(-df, kind="stable")[:KINDS]
        value = np.zeros(len(df))
        value[common] = 2.0 ** np.arange(len(common))[::-1]
        return np.argsort(-np.bincount(doc, value[term], size), kind="stable")

    @staticmethod
    def _slices(begin: np.ndarray, end: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
        """The ranges of each column one after the other, and the range each place is of."""
        n = end - begin
        which = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(which)) + np.repeat(begin - np.cumsum(n) + n, n)
        return [*(c[at] for c in columns), which]

    def codes(self, vocabulary: list[bytes]) -> np.ndarray:
        """The number of each term, -1 for terms the shard has not."""
        return np.array([self.terms.get(w, -1) for w in vocabulary], np.int64)

    @cached_property
    def _cursors(self) -> tuple[np.ndarray, ...]:
        """What ``top`` reads: blocks and maxima of each term's postings, and rows of the terms of more documents than one in ``DENSE``."""
        term, block = np.repeat(np.arange(self.count), self.df), self.doc // BLOCK
        head = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))) if len(term) else term
        entry = np.append(head, len(term))  # postings of each (term, block)
        most = np.maximum.reduceat(self.weight, head) if len(term) else np.empty(0)
        block, first = block[head], np.searchsorted(term[head], np.arange(self.count + 1))  # entries of each term
        frequent = np.flatnonzero(self.df * DENSE > self.size)
        row = np.full(self.count, -1)
        row[frequent] = np.arange(len(frequent))
        rows, rows_most = np.zeros((len(frequent), self.size)), np.zeros((len(frequent), self.blocks))
        for r, t in enumerate(frequent):
            held, at = slice(first[t], first[t + 1]), slice(self.first[t], self.first[t + 1])
            rows[r, self.doc[at]] = self.weight[at]
            rows_most[r, block[held]] = most[held]
        return entry, block, most, first, row, rows, rows_most

    def top(self, term: np.ndarray, factor: np.ndarray, k: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Documents (their places, see ``order``) and scores: all of the k best that reach ``floor``, ties of the last included."""
        entries, blocks, maxima, first, rows_of, rows, rows_most = self._cursors
        term = self.numbers[term]
        factor, term = factor[term >= 0], term[term >= 0]
        best_doc, best = np.empty(0, np.int64), np.empty(0)
        frequent = rows_of[term] >= 0
        row, heavy = rows_of[term[frequent]], factor[frequent]
        term, factor = term[~frequent], factor[~frequent]
        block, most, which = self._slices(first[term], first[term + 1], blocks, maxima)
        bound = np.bincount(block, factor[which] * most, self.blocks) + heavy @ rows_most[row]
        place, line = which * self.blocks + block, np.arange(len(term)) * self.blocks  # a term's entries are in order of their block
        entry = first[term] - np.searchsorted(place, line)
        at, width = 0, 4 * WAVE if floor else WAVE
        while at < self.blocks:
            pivots = at + np.flatnonzero((bound[at:] > 0) & (bound[at:] >= floor - 1e-9))[:width]
            if not len(pivots):
                break
            gap = np.flatnonzero(np.diff(pivots) > GAP)
            for from_, to in zip(pivots[np.append(0, gap + 1)], pivots[np.append(gap, len(pivots) - 1)] + 1):
                cursor, stop = (entries[entry + np.searchsorted(place, line + x)] for x in (from_, to))
                doc, weight, which = self._slices(cursor, stop, self.doc, self.weight)
                score = np.bincount(doc, factor[which] * weight, self.size).astype(float, copy=False)
                inside = slice(from_ * BLOCK, to * BLOCK)
                score[inside] += heavy @ rows[row, inside]
                good = np.flatnonzero((score > 0) & (score >= floor - 1e-9))
                score = np.round(score[good], 9)
                keep = (score > 0) & (score >= floor)
                best_doc, best = np.concatenate([best_doc, good[keep]]), np.concatenate([best, score[keep]])
            if len(best) > k:
                floor = max(floor, np.partition(best, len(best) - k)[len(best) - k])
                best_doc, best = best_doc[best >= floor], best[best >= floor]
            at, width = pivots[-1] + 1, width * 4
        return best_doc, best

    @cached_property
    def _matrix(self) -> tuple[np.ndarray, ...]:
        """What ``tops`` reads: a row over all documents for each term that at least one pair of query and document in ``SHARE`` has (the most
        frequent ones that fit), its largest weight in each block, the norm of each block's longest column, and the postings of the other terms."""
        pairs = self.df * self.asked
        frequent = np.flatnonzero(pairs * SHARE >= self.size)
        frequent = frequent[np.argsort(-pairs[frequent], kind="stable")[:ROWS]]
        row = np.full(self.count + 1, -1)
        row[frequent], row[-1] = np.arange(len(frequent)), -2
        rows = np.zeros((len(frequent), -(-self.size // SPAN) * SPAN), np.float32)
        weight, place, which = self._slices(self.first[frequent], self.first[frequent + 1], self.weight, self.doc)
        rows[which, place] = weight
        most = rows.reshape(len(frequent), rows.shape[1] // NEAR, NEAR).max(axis=2, initial=0)
        norm = np.sqrt(np.einsum("ij,ij->j", rows, rows)).reshape(-1, NEAR).max(axis=1, initial=0)
        return row, rows, most, norm, self.weight.astype(np.float32), self.doc.astype(np.int32)

    def _rare(self, query: np.ndarray, term: np.ndarray, factor: np.ndarray, n: int) -> np.ndarray:
        """What some terms add to the score of each query and document, from their postings; a few queries at a time."""
        rows, small, at = self._matrix[1], *self._matrix[4:]
        wide, df = rows.shape[1], self.df[term]
        total = np.empty((n, wide), np.float32)
        kind = np.arange(n) // max(1, LINE_CELLS // wide) + np.cumsum(np.bincount(query, df, n)) // PIECE
        cuts = [0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), n]
        edges = np.searchsorted(query, cuts).tolist()
        for x, y, a, b in zip(cuts, cuts[1:], edges, edges[1:]):
            count = df[a:b]
            read = np.arange(count.sum()) + np.repeat(self.first[term[a:b]] - np.cumsum(count) + count, count)
            cell = np.repeat((query[a:b] - x) * wide, count) + at[read]
            total[x:y] = np.bincount(cell, np.repeat(factor[a:b], count) * small[read], (y - x) * wide).reshape(y - x, wide)
        return total

    def tops(self, edges: np.ndarray, term: np.ndarray, factor: np.ndarray, k: int, floor: np.ndarray):
        """Query, documents (their places) and scores as of ``top``, for each query that finds any, many queries at a time.

        Scores of the rarer terms are added up from their postings. With them and the block maxima (or norms) of the frequent terms a
        block is a pivot of the queries it can reach the threshold of; the frequent terms of these are a matrix product. Its scores are of single precision
        and only choose documents, by more than their rounding error; what is returned is added up anew in double precision."""
        row, rows, most, norm = self._matrix[:4]
        wide = rows.shape[1]
        slack = (len(rows) + 32) * 2.0 ** -23
        known = np.zeros(self.count + 1)
        tile = max(1, TILE // max(wide, len(rows)))
        for from_ in range(0, len(floor), tile):
            n = min(tile, len(floor) - from_)
            edge = edges[from_:from_ + n + 1]
            part = slice(edge[0], edge[-1])
            own, weight = self.numbers[term[part]], factor[part].astype(np.float32)
            query, r = np.repeat(np.arange(n), np.diff(edge)), row[own]
            often, rare = np.flatnonzero(r >= 0), np.flatnonzero(r == -1)
            asked = np.zeros((n, len(rows)), np.float32)
            asked[query[often], r[often]] = weight[often]
            score = self._rare(query[rare], own[rare], weight[rare], n)
            bound = score
            while bound.shape[1] > wide // NEAR:
                bound = np.maximum(bound[:, ::2], bound[:, 1::2])
            bound = bound + np.minimum(asked @ most, np.sqrt(np.einsum("ij,ij->i", asked, asked))[:, None] * norm)
            least = np.maximum(floor[from_:from_ + n] * (1 - slack) - 2e-9, 1e-30).astype(np.float32)  # a score of single precision under this is under the threshold
            pivot = bound * (1 + slack) >= least[:, None]
            live = np.flatnonzero(pivot.any(axis=1))
            asked, score, least, pivot = (x if len(live) == n else x[live] for x in (asked, score, least, pivot))
            found = []
            for b in range(0, wide, SPAN):
                some = np.flatnonzero(pivot[:, b // NEAR:(b + SPAN) // NEAR].any(axis=1))
                if len(some):
                    if len(some) * 2 > some[-1] + 1 - some[0]:  # most of a range: without a copy
                        some = np.arange(some[0], some[-1] + 1)
                        whole = asked[some[0]:some[-1] + 1] @ rows[:, b:b + SPAN]
                    else:
                        whole = asked[some] @ rows[:, b:b + SPAN]
                    whole += score[some, b:b + SPAN]
                    q, place = np.divmod(np.flatnonzero((whole >= least[some, None]).ravel()), SPAN)
                    found.append((live[some[q]], place + b, whole[q, place]))
            if not any(len(x[0]) for x in found):
                continue
            q, place, near = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(q, kind="stable")
            q, place, near = q[order], place[order], near[order]
            end = np.append(np.flatnonzero(np.diff(q)) + 1, len(q))
            for a, b in zip([0, *end[:-1].tolist()], end.tolist()):
                x = int(q[a])
                docs = place[a:b]
                if b - a > k:
                    docs = docs[near[a:b] >= np.partition(near[a:b], b - a - k)[b - a - k] * (1 - 2 * slack) - 4e-9]
                part = slice(edge[x], edge[x + 1])
                terms = self.numbers[term[part]]
                known[terms] = factor[part]  # the last place is of those the shard has not
                parts = map(slice, self.row_first[docs].tolist(), self.row_end[docs].tolist())
                exact = np.round([(known[self.own[at]] * self.own_weight[at]).sum() for at in parts], 9)
                known[terms] = 0
                keep = (exact > 0) & (exact >= floor[from_ + x])
                if keep.any():
                    yield from_ + x, docs[keep], exact[keep]


@dataclass
class Queries:
    """One measured block of queries: terms as places in the block's vocabulary, and the least row that can be of a query's k best."""

    vocabulary: pa.Array
    number: np.ndarray
    ids: list[int | None]
    edges: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    floor: np.ndarray  # score; 0 while unknown
    floor_id: list[tuple[bool, int]]  # is NULL, id

    @classmethod
    def of(cls, rows: pa.Table) -> Queries:
        rows = rows.sort_by([("number", "ascending"), ("term", "ascending")]).combine_chunks()
        coded = pa.concat_arrays([pa.array([], rows["term"].type), *rows["term"].chunks]).dictionary_encode()
        number, first = np.unique(rows["number"].to_numpy(), return_index=True)
        ids = rows["query_id"].take(pa.array(first, pa.int64())).to_pylist()
        return cls(coded.dictionary, number, ids, np.append(first, rows.num_rows).astype(np.int64), coded.indices.to_numpy().astype(np.int32),
                   rows["weight"].to_numpy(), np.zeros(len(number)), [(False, 0)] * len(number)).alike()

    @cached_property
    def asked(self) -> np.ndarray:
        """The share of queries that has each term."""
        return np.bincount(self.term, minlength=len(self.vocabulary)) / len(self.number)

    def alike(self) -> Queries:
        """The same queries, those alike one after the other."""
        if not len(self.number):
            return self
        size = np.diff(self.edges)
        order = np.concatenate(Shard._parts(self.term, np.repeat(np.arange(len(size)), size), self.weight.__getitem__, len(size), LINE))
        term, weight, _ = Shard._slices(self.edges[:-1][order], self.edges[1:][order], self.term, self.weight)
        return Queries(self.vocabulary, self.number[order], [self.ids[q] for q in order.tolist()], np.append(0, np.cumsum(size[order])),
                       term, weight, self.floor[order], [self.floor_id[q] for q in order.tolist()])

    def run(self, batches, mean: float, k: int, shard_bytes: int):
        """The k best rows of all documents in ``batches`` (see ``_counted``) for each query, without those under its threshold."""
        n = len(self.number)
        floor = self.floor.copy()
        kept: list[list[tuple[float, bool, int]]] = [[] for _ in range(n)]  # (-score, id is NULL, id), in order
        for ids, counted in _pieces(batches, shard_bytes):
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for shard in self._shards(counted, mean):
                for q, at, score in self._found(shard, k, floor):
                    at = shard.order[at]
                    first = np.lexsort((ids[at], null[at], -score))[:k]
                    new = zip((-score[first]).tolist(), null[at[first]].tolist(), ids[at[first]].tolist())
                    kept[q] = sorted([*kept[q], *new])[:k]
                    if len(kept[q]) == k:
                        floor[q] = max(floor[q], -kept[q][-1][0])
        for from_ in range(0, n, 1000):
            out: list[list] = [[], [], [], []]
            for q in range(from_, min(n, from_ + 1000)):
                least = (-self.floor[q], *self.floor_id[q])
                for row in kept[q]:
                    if self.floor[q] == 0 or row <= least:
                        for column, x in zip(out, (int(self.number[q]), self.ids[q], None if row[1] else row[2], -row[0])):
                            column.append(x)
            yield pa.record_batch([*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.float64())],
                                  ["number", "query_id", "doc_id", "score"])

    def _shards(self, counted: tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray], mean: float) -> Iterator[Shard]:
        """Shards of some rows, with the terms that any query has."""
        every, tf, size, length = counted
        term = pc.index_in(_split(every), value_set=self.vocabulary).fill_null(-1).to_numpy()
        known = term >= 0
        doc = np.repeat(np.arange(len(size), dtype=np.int32), size)[known]
        return Shard.several(term[known], doc, tf[known], length, mean, self.asked)

    def _found(self, shard: Shard, k: int, floor: np.ndarray):
        """Query, documents and scores: a few queries one after the other, more at a time."""
        if len(self.number) >= FEW:
            yield from shard.tops(self.edges, self.term, self.weight, k, floor)
        else:
            for q in range(len(self.number)):
                part = slice(self.edges[q], self.edges[q + 1])
                at, score = shard.top(self.term[part], self.weight[part], k, floor[q])
                if len(at):
                    yield q, at, score


def _counted(docs: DataFrame) -> DataFrame:
    """id, the distinct words of each row's text (joined by a space), how often each is there, and their sum."""
    def count(batches):
        for b in batches:
            some = (b.slice(at, SLICE) for at in range(0, b.num_rows, SLICE))
            rows = (x for part in some for x in zip(part.column(0).to_pylist(), utf8(part.column(1))))
            for piece in chunks(rows, lambda x: len(x[1] or b"") + 64, COUNTED_BYTES):
                counts = [Counter(words(data)) for _, data in piece]
                edges = pa.array(np.cumsum([0, *map(len, counts)]), pa.int32())
                times = pa.array(np.fromiter(chain.from_iterable(c.values() for c in counts), np.int32))
                yield pa.record_batch([pa.array([i for i, _ in piece], pa.int64()), pa.array([b" ".join(c) for c in counts], pa.binary()),
                                       pa.ListArray.from_arrays(edges, times), pa.array([sum(c.values()) for c in counts], pa.int64())],
                                      ["id", "words", "times", "length"])
    return cut_lineage(docs.select(*docs.columns[:2]).mapInArrow(count, "id long, words binary, times array<int>, length long"), "search-counted")


def _pieces(batches, shard_bytes: int) -> Iterator[tuple[pa.Array, tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]]:
    """Rows of ``_counted`` of at most ``shard_bytes``: ids; words, how often each is there, how many words, and their sum."""
    for b in batches:
        weight = (np.diff(b.column(2).offsets.to_numpy()) * 8 + pc.binary_length(b.column(1)).to_numpy() + 64).tolist()
        for rows in chunks(range(b.num_rows), weight.__getitem__, shard_bytes):
            ids, every, times, length = b.slice(rows[0], len(rows)).columns
            yield ids, (every, times.flatten().to_numpy(), np.diff(times.offsets.to_numpy()), length.to_numpy())


def _split(every: pa.Array) -> pa.Array:
    """All words of some rows' distinct words."""
    some = pc.greater(pc.binary_length(every), 0)
    return pc.split_pattern(every if pc.all(some).as_py() else every.filter(some), b" ").flatten()


def _statistics(counted: DataFrame) -> tuple[int, float, DataFrame]:
    """Documents, mean length and the document frequency of every term, over all rows."""
    def count(batches):
        for b in batches:
            for at in range(0, max(1, b.num_rows), COUNTED_ROWS):
                part = b.slice(at, COUNTED_ROWS)
                found = pc.value_counts(_split(part.column(0)))
                term, df = found.field("values"), found.field("counts")
                yield pa.record_batch([pa.concat_arrays([pa.nulls(1, pa.binary()), term]), pa.concat_arrays([pa.array([part.num_rows]), df]),
                                       pa.array([pc.sum(part.column(1)).as_py() or 0, *[0] * len(term)], pa.int64())], ["term", "df", "length"])
    terms = cut_lineage(counted.select("words", "length").mapInArrow(count, "term binary, df long, length long").groupBy("term")
                        .agg(F.sum("df").alias("df"), F.sum("length").alias("length")), "search-terms")
    whole = terms.filter(F.col("term").isNull()).first()
    n = whole.df if whole else 0
    return n, (whole.length / n if n else 0.0), terms.filter(F.col("term").isNotNull()).select("term", "df")


def _query_terms(queries: DataFrame, frequencies: DataFrame, n: int) -> DataFrame:
    """A row for each term of each query row (number): its count times its idf."""
    def cut(batches):
        for b in batches:
            rows = [(k, q, t, c) for k, q, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)))
                    for t, c in Counter(words(data)).items()]
            cols = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                                  ["number", "query_id", "term", "n"])
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    numbered = queries.select(F.monotonically_increasing_id(), *queries.columns[:2])
    return (numbered.mapInArrow(cut, "number long, query_id long, term binary, n long").join(frequencies, "term")
            .select("number", "query_id", "term", (F.col("n") * idf).alias("weight")))


def search(docs: DataFrame, queries: DataFrame, k: int = 10, query_bytes: int = QUERY_BYTES,
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """query_id, rank, doc_id, score: the k best of ``docs`` (id, text) for each row of ``queries`` (id, text)."""
    spark = docs.sparkSession
    counted = _counted(docs)
    n, mean, frequencies = _statistics(counted)
    asked = cut_lineage(_query_terms(queries, frequencies, n), "search-queries")
    parts = max(1, -(-asked.count() * 12 // query_bytes))
    shards = n * mean * 6 / shard_bytes  # at about six bytes a word
    rounds = 0
    while shards > SEED ** rounds:
        rounds += 1
    samples = [counted]
    for r in range(1, rounds + 1):
        part = samples[-1].filter(F.pmod(F.xxhash64("id", "words"), F.lit(SEED ** r)) == 0)
        samples.append(cut_lineage(part.repartition(int(shards / SEED ** r) + 1), "search-sample"))
    order = W.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    answers = []
    for p in range(parts):
        block = Queries.of(asked.filter(F.pmod(F.xxhash64("number"), F.lit(parts)) == p).toArrow())  # one measured block
        for r in range(rounds, -1, -1):
            given = spark.sparkContext.broadcast(block)
            found = samples[r].mapInArrow(lambda batches, given=given: given.value.run(batches, mean, k, shard_bytes), FOUND)
            found = cut_lineage(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "search-found")
            given.unpersist()
            if r:  # a row a query of the block
                place = {number: q for q, number in enumerate(block.number.tolist())}
                for row in found.filter(F.col("rank") == k).collect():
                    q = place[row["number"]]
                    block.floor[q], block.floor_id[q] = row["score"], (row["doc_id"] is None, row["doc_id"] or 0)
        answers.append(found)
    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    return found.select("query_id", "rank", "doc_id", "score")


def op5_search(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return search(docs, docs.filter(F.col("doc_id") % 100 == 0))
