"""Many long queries at a time: as full scoring, as one query at a time, and by pivots; the text is read once."""

import numpy as np
import pytest

from starloom.llm import search
from tests.llm.test_search import SCHEMA, by_hand, rows


def coded(texts, queries, mean=12.0):
    """The shards of some texts, and queries whose words weigh a different share each."""
    vocabulary = sorted({w for t in texts for w in t.split()})
    number = {w: i for i, w in enumerate(vocabulary)}
    term = [np.array(sorted({number[w] for w in q.split() if w in number}), np.int64) for q in queries]
    edges, term = np.append(0, np.cumsum([len(t) for t in term])), np.concatenate(term)
    weight = 0.25 + np.arange(len(vocabulary))[term] % 7
    words = [sorted(set(t.split())) for t in texts]
    tf = np.array([t.split().count(w) for t, ws in zip(texts, words) for w in ws])
    doc = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    asked = np.bincount(term, minlength=len(vocabulary)) / len(queries)
    codes = np.array([number[w] for ws in words for w in ws])
    shards = search.Shard.several(codes, doc, tf, np.array([len(t.split()) for t in texts]), mean, asked)
    return list(shards), edges, term, weight


@pytest.mark.parametrize("share", [1, 1000, 10 ** 9])  # hardly any term, some, and all of them in the matrix
def test_many_are_as_one(monkeypatch, share):
    monkeypatch.setattr(search, "SHARE", share)
    monkeypatch.setattr(search, "GROUP", 200)
    monkeypatch.setattr(search, "TILE", 40 * 256)
    monkeypatch.setattr(search, "PIECE", 500)
    texts = [t for _, t, _ in rows() if t]
    shards, edges, term, weight = coded(texts, [*texts[:60], "unheard of", *texts[:60]])
    assert sorted(np.concatenate([s.order for s in shards]).tolist()) == list(range(len(texts)))
    for floor in (np.zeros(121), np.full(121, 14.0), np.full(121, 1e9)):
        for shard in shards:
            many = {q: (at, score) for q, at, score in shard.tops(edges, term, weight, 5, floor)}
            for q in range(121):
                part = slice(edges[q], edges[q + 1])
                at, score = shard.top(term[part], weight[part], 5, floor[q])
                found = dict(zip(*(x.tolist() for x in many.get(q, (np.empty(0), np.empty(0))))))
                best = {a: s for a, s in zip(at.tolist(), score.tolist())}
                assert len(best) == 0 or {a: found.get(a) for a in best} == pytest.approx(best)
                assert len(found) >= len(best) and (not best or all(s <= max(best.values()) + 1e-9 for s in found.values()))


def test_blocks_under_the_threshold_are_not_multiplied(monkeypatch):
    texts = ["rare word" if i % 640 == 0 else "word" if i % 20 == 0 else f"filler{i}" for i in range(3200)]
    shards, edges, term, weight = coded(texts, ["rare word"] * 30)
    scored = []
    monkeypatch.setattr(np, "divmod", lambda x, y, plain=np.divmod: (scored.append(len(x)), plain(x, y))[1])
    best = max(s.max() for shard in shards for _, _, s in shard.tops(edges, term, weight, 5, np.zeros(30)))
    every, scored[:] = len(scored), []
    found = [len(at) for shard in shards for _, at, _ in shard.tops(edges, term, weight, 5, np.full(30, best))]
    assert sum(found) == 30 * 5 and 0 < len(scored) < every


@pytest.mark.parametrize("shard_bytes", [3000, 1 << 20])
def test_every_answer_of_many(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(search, "GROUP", 300)  # on the driver only; workers take the default
    docs = rows()
    queries = docs[:300] + [(None, "w1 w90", ""), (77777, "unheard of", ""), (5, None, "")]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    got = search.search(frame, spark.createDataFrame(queries, SCHEMA), k=6, shard_bytes=shard_bytes)
    assert sorted(((*r[:3], round(r[3], 6)) for r in got.collect()), key=str) == by_hand(docs, queries, 6)


def test_texts_are_cut_into_words_once(spark, monkeypatch):
    """However many blocks of queries and rounds there are, the documents' texts are scanned once."""
    scans = []
    counted = search._counted
    monkeypatch.setattr(search, "_counted", lambda docs: (scans.append(docs), counted(docs))[1])
    docs = spark.createDataFrame(rows(200), SCHEMA)
    found = search.search(docs, docs.limit(40), k=3, shard_bytes=2000, query_bytes=1500)
    assert len(scans) == 1 and not [f for f in found.inputFiles() if "search-found" not in f]
    stored = counted(docs)
    assert stored.columns == ["id", "words", "times", "length"] and stored.count() == docs.count()
    row = stored.filter("id = 9001").first()
    assert (bytes(row.words), row.times, row.length) == (b"w3", [3000], 3000)
