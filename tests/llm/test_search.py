"""Top-k search: document ids, ties and thresholds against full scoring, and rows that are repeated, empty or NULL."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from starloom.llm import search
from starloom.llm.decontaminate import words

SCHEMA = "id long, text string, vocabulary string"


def by_hand(docs, queries, k):
    """(query id, rank, id, score) of every query row, every document scored."""
    counts = [(i, Counter(words((t or "").encode()))) for i, t, *_ in docs]
    n, df = len(counts), Counter(w for _, c in counts for w in c)
    mean = sum(sum(c.values()) for _, c in counts) / max(n, 1)
    out = []
    for q, text, *_ in queries:
        asked = Counter(words((text or "").encode()))
        scored = []
        for i, c in counts:
            s = sum(x * math.log(1 + (n - df[w] + .5) / (df[w] + .5)) * c[w] * 2.2 / (c[w] + 1.2 * (.25 + .75 * sum(c.values()) / mean))
                    for w, x in asked.items() if w in c)
            if s > 0:
                scored.append((-round(s, 9), i is None, i or 0))
        out += [(q, r + 1, None if null else i, round(-s, 6)) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def rows(n=600):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(i * 7 % n, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 30))), "x") for i in range(n)]
    docs += [(n + i, docs[5][1], "x") for i in range(200)]  # a quarter are copies
    docs += [docs[5], docs[5], (None, docs[5][1], None), (None, None, None), (9000, "", ""), (9001, "w3 " * 3000, "x")]
    return docs


@pytest.mark.parametrize("shard_bytes", [900, 40000])
def test_every_answer(spark, shard_bytes):
    docs = rows()
    queries = docs[:25] + [docs[5], (None, "w1 w90", ""), (None, "w1 w90", ""), (77777, "unheard of", ""), (5, None, "")]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    got = search.search(frame, spark.createDataFrame(queries, SCHEMA), k=6, shard_bytes=shard_bytes, query_bytes=4000)
    assert got.columns == ["query_id", "rank", "doc_id", "score"]
    assert sorted(((*r[:3], round(r[3], 6)) for r in got.collect()), key=str) == by_hand(docs, queries, 6)


def test_empty_tables(spark):
    some = spark.createDataFrame([(1, "a b"), (2, "b")], "id long, text string")
    assert search.search(some.limit(0), some).count() == search.search(some, some.limit(0)).count() == 0
    assert search.search(spark.createDataFrame([(1, ""), (2, None)], some.schema), some).count() == 0
    assert {(r.query_id, r["rank"], r.doc_id) for r in search.search(some, some).collect()} == {(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1)}


def test_blocks_under_the_threshold_are_not_read():
    texts = [(b"rare word " * 5 if i % 640 == 0 else b"word" if i % 20 == 0 else b"filler%d" % i) for i in range(3200)]
    shard = search.Shard(texts, 3.0)
    term, factor = shard.codes([b"rare", b"word"]), np.array([5.0, 0.1])
    every = shard.top(term, factor, 5)
    read = []
    slices = shard._slices
    shard._slices = lambda a, b, *c: (read.append(int((b - a).sum())), slices(a, b, *c))[1]
    at, score = shard.top(term, factor, 5, every[1].min())
    assert sorted(at) == sorted(every[0]) and sorted(shard.order[at]) == [0, 640, 1280, 1920, 2560]
    assert read == [3 + 1, 64 + 5]  # maxima of all fifty blocks; postings of the one that can reach the threshold
