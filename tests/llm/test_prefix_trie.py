"""The prefix trie against a plain dictionary of prefixes, and its slot table."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, prefix string, depth string"


def brute(rows, lend=True):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append(((t is not None, t or 0, r.encode(), hashlib.sha256(x.encode()).digest()), (r, x)))
    own = {c: [turn for _, turn in sorted(v, key=lambda v: v[0])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if lend else 0
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = (own.get(base, [])[:h] + turns[h:]) if lend else turns
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, who in members.items():
        inside = [n for n in members if n[:len(node)] == node]
        parents = {n[:-1] for n in inside if n}
        ends = sorted(c for c in who if len(built[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who),
                    sum(len(n) == len(node) + 1 for n in inside), sum(n not in parents for n in inside),
                    sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in inside if n),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows():
    r = random.Random(3)
    said = ["", "a", "b c", "é  d\te", "one two three", None]
    out = [(c, t, r.choice(["user", "assistant", None, ""]) if r.random() < .2 else "user", r.choice(said if t else said[1:3]))
           for c in [*range(0, 70), 1000, 1001, 1019, -5, -20, -21, 10**12] if c % 11 != 6 for t in range(r.randint(1, 6))]
    out += [(40, t, "user", f"deep {t}") for t in range(6, 90)] + [(41, t, "user", f"deep {t}") for t in range(6, 90)]  # long and alike
    out += [(60, t, "user", f"deep {t}") for t in range(6, 60)]
    out += [(7, None, "user", "first"), (7, None, "user", "first"), (8, 0, "user", "tie"), (8, 0, "user", "tie 2"), (8, 0, "a", "tie"),
            (None, 0, "user", "nobody's"), (None, None, None, None), (9, 1, "user", "x" * 200_000 + " y" * 50_000)]
    return out


@pytest.mark.parametrize("lend,shard_rows", [(True, 1 << 18), (True, 7), (False, 50)])
def test_trie_equals_brute_force(spark, lend, shard_rows):
    given = rows()
    turns = spark.createDataFrame([(*x, "p", "d") for x in given], SCHEMA).repartition(5)
    got = prefix_trie.trie(turns, lend, shard_rows)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str) == brute(given, lend)


def test_one_opening_shared_by_all(spark):
    turns = spark.range(3000).select(F.col("id").alias("conv_id"), F.explode(F.expr("array(0L, 1L)")).alias("turn"),
                                     F.lit("user").alias("role")).withColumn(
        "text", F.when(F.col("turn") == 0, "same").otherwise(F.concat(F.lit("own "), (F.col("conv_id") % 1000).cast("string"))))
    got = {(r.conv_id, r.depth): r for r in prefix_trie.trie(turns, shard_rows=100).collect()}
    assert len(got) == 1002
    top = got[0, 1]
    assert (top.n_convs, top.n_children, top.n_leaves, top.saved_tokens) == (3000, 1000, 1000, 2999 + 1000 * 2 * 2)
    assert got[5, 2].ends_sha256 == hashlib.sha256(b"5,1005,2005").hexdigest()


def test_ids_over_several_blocks(spark):
    turns = spark.range(10_000).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("u").alias("role"), F.lit("t").alias("text"))
    leaf = prefix_trie.trie(turns).filter("depth = 1").first()
    assert leaf.ends_sha256 == hashlib.sha256(",".join(map(str, range(10_000))).encode()).hexdigest()


def test_empty_table(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA), lend=True).count() == 0


def test_slot_table():
    keys = np.random.default_rng(1).integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    table = prefix_trie.SlotTable(keys)
    assert sorted(table.slot(keys)) == list(range(5000))
    assert (table.slot(keys + np.uint64(1)) == -1).all()
    assert prefix_trie.SlotTable(keys[:0]).slot(keys[:3]).tolist() == [-1, -1, -1]
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(np.concatenate([keys, keys[:1]]))
