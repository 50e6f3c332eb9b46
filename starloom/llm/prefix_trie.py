"""Conversation prefix trie: one node per distinct sequence of first turns, by shards of a minimal-perfect-hash node table.

1. ``paths``: conversations are dealt by the group that lends its opening (20 ids at most on each side of zero), each turn as a narrow row
   (role, SHA-256 of the text, number of words). One sorted stream a task chains the turns into prefix digests (BLAKE2b, 128 bits):
   a row per conversation and depth, root included. The rows are written to the shared folder.
2. ``nodes``: one row per distinct digest, by partial aggregation: members, conversations that end there, smallest member, words.
3. ``subtree_sums``: a node belongs to its smallest member, so the nodes of one member are the lower end of its path. Paths and nodes are
   dealt by that member and cut into shards of bounded size. A shard enumerates its distinct digests, gives each a slot of a minimal perfect
   hash (every slot holds the digest it was given to, and a look-up compares it), scatters the counts of its nodes into flat numpy
   arrays and adds them up through the array of parent slots, deepest first. What a shard found for a node is added over shards by a
   partial aggregation: a first turn shared by a third of all conversations is a row a shard, never a group in one task. A path
   cut by a shard's end hands its sums on to the next shard.
4. Ids of conversations ending at a node are joined in blocks of 4,096 neighbouring ids (bounded), and the blocks of a node hashed as a
   stream: SHA-256 has to see them in order, but they are never held together.

A conversation is read as a stream by one task (its digests are a chain), in memory that does not grow with its length.

Defined results: NULL turns come first; rows of one turn number are ordered by role, then by the SHA-256 of the text; repeated rows
are turns of their own. NULL role or text is empty. Rows with a NULL conv_id belong to no conversation. Ids below zero take
SQL's remainder (-5 % 20 = -5, so they borrow from 0). An empty table has no conversation and no node, not even a root. Texts of
any length count as their digest and words; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import SPACE_WORD, read
from starloom.session import cut_lineage

ROOT = bytes(16)
FAMILY = 20  # conversations c - c % FAMILY .. share that one's opening
SHARD_ROWS = 1 << 18
BATCH_ROWS = 1 << 16
ID_BITS = 12  # ids are joined in blocks of 4,096
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def borrowed(conv: Column) -> Column:
    """How many first turns a conversation takes from its family's first one: 0 to 3."""
    return (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")


def _chain(rows, lend: bool):
    """Rows sorted by family, lender first, conversation, turn -> (conversation, [(turn digest, words)]), as a stream of turns.

    Yields (conversation, turn digest, words) of rebuilt turns in order, and (conversation, None, 0) after the last.
    """
    family, opening, conv, left, own = None, [], None, 0, 0
    for fam, c, h, turn, words in rows:
        if c != conv:
            if conv is not None:
                yield conv, None, 0
            if fam != family:
                family, opening = fam, []
            conv, own = c, 0
            left = h if lend else 0
            if lend and c != fam:
                yield from ((c, t, w) for t, w in opening[:left])
        if c == fam and len(opening) < 3:
            opening.append((turn, words))
        if own >= left or c == fam:
            yield c, turn, words
        own += 1
    if conv is not None:
        yield conv, None, 0


_PATHS = "conv_id long, depth long, prefix binary, parent binary, words long, ends boolean"


def paths(turns: DataFrame, lend: bool = True) -> DataFrame:
    """conv_id, depth, prefix, parent, words, ends: every conversation's path from the root down.

    ``turns``: conv_id, turn, role, text. With ``lend``, the first ``borrowed`` turns of each conversation are those of the first
    conversation of its family.
    """
    conv = F.col("conv_id").cast("long")
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    narrow = turns.filter(conv.isNotNull()).select(
        (conv - conv % FAMILY if lend else conv).alias("family"), conv.alias("conv_id"), borrowed(conv).alias("h"),
        F.col("turn").cast("long").alias("turn"), role.alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.regexp_count(text, F.lit(SPACE_WORD)).cast("long").alias("words"))
    dealt = narrow.repartition("family").sortWithinPartitions(
        "family", F.col("conv_id") != F.col("family"), "conv_id", F.col("turn").asc_nulls_first(), "role", "digest")

    def chain(batches):
        def rows():
            for b in batches:
                d = b.to_pydict()
                for f, c, h, r, t, w in zip(d["family"], d["conv_id"], d["h"], d["role"], d["digest"], d["words"]):
                    name = r.encode()
                    yield f, c, h, struct.pack(">Q", len(name)) + name + t, w

        out: list[list] = [[] for _ in range(6)]

        def batch():
            made = pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
                                    pa.array(out[3], pa.binary()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.bool_())],
                                   ["conv_id", "depth", "prefix", "parent", "words", "ends"])
            for column in out:
                column.clear()
            return made

        at = None  # the row of the current conversation that is not yet written: its end is known with the next turn
        for c, turn, words in _chain(rows(), lend):
            if at is None or at[0] != c:
                at = (c, 0, ROOT, None, 0)
            for column, x in zip(out, (*at, turn is None)):
                column.append(x)
            at = None if turn is None else (c, at[1] + 1, hashlib.blake2b(at[2] + turn, digest_size=16).digest(), at[2], words)
            if len(out[0]) >= BATCH_ROWS:
                yield batch()
        yield batch()
    return dealt.select("family", "conv_id", "h", "role", "digest", "words").mapInArrow(chain, _PATHS)


def nodes(found: DataFrame) -> DataFrame:
    """One row per distinct prefix of ``paths``: prefix, parent, depth, conv_id, n_convs, n_ends, saved (its own)."""
    grouped = found.groupBy("prefix").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends"),
        F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("words").alias("words"))
    return grouped.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).drop("words")


class SlotTable:
    """A minimal perfect hash of distinct 128-bit keys: ``slot`` is 0..n-1 for them and -1 for any other key.

    Keys that fall alone on a position of a level keep it, the others go on to the next level; a slot is the rank of its position
    over all levels. The key given to a slot is kept there and compared at every look-up.
    """

    def __init__(self, keys: np.ndarray):
        if len(np.unique(keys, axis=0)) != len(keys):
            raise ValueError("keys of a slot table must be distinct")
        self.n, self.taken, self.offset = len(keys), [], [0]
        rest = keys
        while len(rest):
            size = 2 * len(rest)
            at = self._position(rest, len(self.taken), size)
            alone = np.bincount(at, minlength=size) == 1
            self.taken.append(np.where(alone, np.cumsum(alone) - 1, -1))
            self.offset.append(self.offset[-1] + int(alone.sum()))
            rest = rest[~alone[at]]
        self.key = np.zeros((self.n, 2), np.uint64)
        self.key[self._find(keys)] = keys
        if (self.slot(keys) < 0).any():
            raise ValueError("two keys were given one slot")

    @staticmethod
    def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys[:, 0] ^ (keys[:, 1] * np.uint64(_MIX[0])) ^ np.uint64((level + 1) * _MIX[1] % (1 << 64))
        x ^= x >> np.uint64(29)
        x *= np.uint64(_MIX[2])
        x ^= x >> np.uint64(32)
        return (x % np.uint64(size)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, rank in enumerate(self.taken):
            at = rank[self._position(keys[rest], level, len(rank))]
            slot[rest[at >= 0]] = at[at >= 0] + self.offset[level]
            rest = rest[at < 0]
        return slot

    def slot(self, keys: np.ndarray) -> np.ndarray:
        found = self._find(keys)
        given = found >= 0
        given[given] = (self.key[found[given]] == keys[given]).all(axis=1)
        return np.where(given, found, -1)


def shard_sums(prefix: np.ndarray, parent: np.ndarray, depth: np.ndarray, own: np.ndarray) -> tuple[SlotTable, np.ndarray]:
    """The table of a shard's distinct prefixes and, by slot, the sums of ``own`` rows (children, leaves, saved) over each subtree.

    ``children`` counts at the parent alone. Rows may repeat a prefix; a parent outside the shard gets nothing here.
    """
    order = np.lexsort((prefix[:, 1], prefix[:, 0]))
    first = np.ones(len(order), bool)
    first[1:] = (prefix[order[1:]] != prefix[order[:-1]]).any(axis=1)
    kept = order[first]
    table = SlotTable(prefix[kept])
    slot = table.slot(prefix)
    above, level = np.full(table.n, -1, np.int64), np.zeros(table.n, np.int64)
    above[slot[kept]], level[slot[kept]] = table.slot(parent[kept]), depth[kept]
    sums = np.zeros((table.n, 3), np.int64)
    np.add.at(sums, slot, own * np.array([0, 1, 1]))
    up = above[slot]
    np.add.at(sums[:, 0], up[up >= 0], own[up >= 0, 0])
    deepest = np.argsort(-level, kind="stable")
    bounds = np.flatnonzero(np.diff(level[deepest])) + 1
    for same in np.split(deepest, bounds):
        to = above[same]
        np.add.at(sums, (to[to >= 0][:, None], np.array([1, 2])), sums[same[to >= 0]][:, 1:])
    return table, sums


_SUMS = "prefix binary, n_children long, n_leaves long, saved_tokens long"


def _keys(column: pa.Array) -> np.ndarray:
    """16-byte digests as two unsigned numbers each (NULL: all ones, which no node has)."""
    joined = b"".join(x if x is not None else b"\xff" * 16 for x in column.to_pylist())
    return np.frombuffer(joined, ">u8").astype(np.uint64).reshape(-1, 2)


def _shards(batches, shard_rows: int):
    """conversation, depth, prefix, parent and own counts of up to ``shard_rows`` rows each, in the order of the stream."""
    held, total = [], 0

    def arrays():
        t = pa.Table.from_batches(held).combine_chunks()
        own = np.stack([t.column(n).to_numpy() for n in ("child", "leaf", "saved")], axis=1).astype(np.int64)
        return [t.column("conv_id").to_numpy(), t.column("depth").to_numpy(), _keys(t.column("prefix")), _keys(t.column("parent")), own]

    for b in batches:
        at = 0
        while at < b.num_rows:
            piece = b.slice(at, shard_rows - total)
            held.append(piece)
            at, total = at + piece.num_rows, total + piece.num_rows
            if total == shard_rows:
                yield arrays()
                held, total = [], 0
    if total:
        yield arrays()


def subtree_sums(found: DataFrame, made: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """prefix, n_children, n_leaves, saved_tokens of every node, from its whole subtree."""
    none = F.lit(0).cast("long")
    path = found.select("conv_id", "depth", "prefix", "parent", none.alias("child"), none.alias("leaf"), none.alias("saved"))
    rows = path.unionByName(made.select(
        "conv_id", "depth", "prefix", "parent", (F.col("depth") > 0).cast("long").alias("child"),
        (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf"), "saved"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("depth").desc())

    def add_up(batches):
        carry = None  # a path cut by the shard's end: its last node with what was found below it
        for shard in _shards(batches, shard_rows):
            if carry is not None and carry[0][0] != shard[0][0]:
                carry = None
            if carry is not None:
                shard = [np.concatenate(x) for x in zip(carry, shard)]
            conv, depth, prefix, parent, own = shard
            table, sums = shard_sums(prefix, parent, depth, own)
            if carry is not None:  # given out with the shard before
                sums[table.slot(carry[2])] -= carry[4] * np.array([0, 1, 1])
            given = np.flatnonzero(sums.any(axis=1))
            digest = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(given), [None, pa.py_buffer(table.key[given].astype(">u8").tobytes())])
            yield pa.record_batch([digest.cast(pa.binary()), *(pa.array(sums[given, i]) for i in range(3))],
                                  ["prefix", "n_children", "n_leaves", "saved_tokens"])
            at, carried = table.slot(prefix[-1:]), carry
            carry = None
            if table.slot(parent[-1:])[0] < 0:  # else another path of this shard took the sums up
                below = sums[at].copy()
                same = (prefix == prefix[-1]).all(axis=1)
                below[0, 0] = own[same, 0].max()
                if carried is not None and (carried[2][0] == prefix[-1]).all():
                    below[0, 1:] += carried[4][0, 1:]
                carry = [conv[-1:], depth[-1:], prefix[-1:], parent[-1:], below]
    return dealt.mapInArrow(add_up, _SUMS)


def end_digests(found: DataFrame) -> DataFrame:
    """prefix, ends_sha256 of the nodes where conversations end."""
    pieces = (found.filter("ends").groupBy("prefix", F.shiftright("conv_id", ID_BITS).alias("block"))
              .agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids")))
    dealt = pieces.repartition("prefix").sortWithinPartitions("prefix", "block")

    def digest(batches):
        now, state = None, None
        for b in batches:
            out: list[list] = [[], []]
            for prefix, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if prefix != now:
                    if now is not None:
                        out[0].append(now)
                        out[1].append(state.hexdigest())
                    now, state = prefix, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.record_batch([pa.array(out[0], pa.binary()), pa.array(out[1], pa.string())], ["prefix", "ends_sha256"])
        if now is not None:
            yield pa.record_batch([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["prefix", "ends_sha256"])
    return dealt.mapInArrow(digest, "prefix binary, ends_sha256 string")


def trie(turns: DataFrame, lend: bool = False, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node: prefix (its digest), conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    found = cut_lineage(paths(turns, lend), "trie-paths")
    made = cut_lineage(nodes(found), "trie-nodes")
    summed = subtree_sums(found, made, shard_rows).groupBy("prefix").agg(
        *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")))
    above = made.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nobody = hashlib.sha256(b"").hexdigest()
    return (made.join(summed, "prefix").join(end_digests(found), "prefix", "left").join(above, "parent", "left")
            .select("prefix", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256")))


def op11_prefix_trie(spark, sf_dir):
    return trie(read(spark, sf_dir, "conversations"), lend=True).drop("prefix")
