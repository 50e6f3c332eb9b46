"""Token counts: greedy longest-match word pieces counted by a linear automaton.

The vocabulary is a trie over bytes. Every node has a failure link (the node of the longest suffix that is
still open once the longest pieces before it have been taken off) and the number of pieces taken off on the way,
computed once per node. Reading a byte either follows an edge, or pops: add the node's count, go to its failure link and
try again. So each word costs time linear in its bytes and its pieces are never built or looked up again.

The automaton is built once on the driver and broadcast as arrays; its size depends on the vocabulary file alone,
whose path is a parameter. A word is a run of characters other than white space, preceded by one blank, as the vocabulary
has most words. Every single byte must be in the vocabulary (bytes that are not are counted as pieces of their own).

Defined results: NULL and empty texts have 0 words, bytes and pieces; repeated rows give equal rows.
"""

from __future__ import annotations

import base64
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import free_name, read, utf8

#: A vocabulary as ranks: one base64 piece and its rank a line.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_bytes", "n_tokens")])


def load_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Pieces:
    """Longest-match automaton over a vocabulary of byte strings."""

    def __init__(self, vocabulary: list[bytes]):
        pieces = {p for p in vocabulary if p} | {bytes([b]) for b in range(256)}
        edges: dict[int, int] = {}  # node * 256 + byte -> node
        text, final = [b""], [False]
        for p in sorted(pieces):
            node = 0
            for i, b in enumerate(p, 1):
                key = node * 256 + b
                if key not in edges:
                    edges[key] = len(text)
                    text.append(p[:i])
                    final.append(False)
                node = edges[key]
            final[node] = True
        # Breadth first: a node's link only needs links of shorter nodes.
        fail, popped = [-1] * len(text), [0] * len(text)
        parent = {child: divmod(key, 256) for key, child in edges.items()}
        for node in sorted(range(1, len(text)), key=lambda n: len(text[n])):
            if final[node]:
                fail[node], popped[node] = 0, 1
                continue
            up, b = parent[node]
            at, n = fail[up], popped[up]
            while at >= 0 and at * 256 + b not in edges:
                n += popped[at]
                at = fail[at]
            fail[node], popped[node] = (edges[at * 256 + b], n) if at >= 0 else (-1, n)
        self.keys = np.array(list(edges), np.int64)
        self.nodes = np.array(list(edges.values()), np.int32)
        self.fail, self.popped = fail, popped
        self._edges: dict[int, int] | None = None

    def __getstate__(self):
        return {**self.__dict__, "_edges": None}  # the dictionary is made again from the arrays in each worker

    def count(self, word: bytes) -> int:
        if self._edges is None:
            self._edges = dict(zip(self.keys.tolist(), self.nodes.tolist()))
        edges, fail, popped = self._edges, self.fail, self.popped
        node = total = 0
        for b in word:
            while (step := edges.get(node * 256 + b)) is None:
                total += popped[node]
                node = fail[node]
            node = step
        while node > 0:
            total += popped[node]
            node = fail[node]
        return total


def count_tokens(docs: DataFrame, text_col: str = "text", vocabulary: list[bytes] | None = None,
                 path: str = VOCABULARY) -> tuple[DataFrame, str]:
    """``docs`` with a struct column more (n_words, n_bytes, n_tokens), and that column's name."""
    pieces = docs.sparkSession.sparkContext.broadcast(Pieces(vocabulary if vocabulary is not None else load_vocabulary(path)))
    name = free_name(docs, "token_counts")

    @F.arrow_udf(COUNTS)
    def count(texts: pa.Array) -> pa.Array:
        known: dict[bytes, int] = {}  # of this batch: each distinct word is walked once
        walk, out = pieces.value.count, ([], [], [])
        for data in utf8(texts):
            words = data.split() if data else []
            total = 0
            for w, n in Counter(words).items():
                if w not in known:
                    known[w] = walk(b" " + w)
                total += n * known[w]
            out[0].append(len(words))
            out[1].append(len(data or b""))
            out[2].append(total)
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in out], names=["n_words", "n_bytes", "n_tokens"])
    return docs.withColumn(name, count.asNondeterministic()(F.col(text_col))), name


def op7_token_counts(spark, sf_dir):
    counted, c = count_tokens(read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    return counted.select("doc_id", "source", "lang", f"{c}.*")
