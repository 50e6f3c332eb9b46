"""Substring dedup: remove words covered by a 50-word window that also starts in a document of smaller id.

Documents are reduced to fragments around anchors (``repeats``), dealt and sorted by anchor. In each shard of about ``SHARD`` bytes, windows
that stand in two documents or more are confirmed as recurring passages; they are compiled into an Aho-Corasick automaton
(pyahocorasick; every distinct word of the shard is one symbol), and all fragments of the shard are streamed through it, which locates
every occurrence of every passage. A window recurs if its passage was located in a document of smaller id. Where one anchor fills several shards, all
their fragments are streamed through the automaton of each shard in turn. Anchors of more than ``HEAVY`` words are split by
window (see ``repeats``).

Defined results: NULL and blank texts have no words; texts under 50 words are kept. Windows within one document do not count as
recurring. Repeated rows (equal id) do not count as different documents. NULL ids count as the smallest id.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import free_name, read, utf8
from starloom.llm.repeats import Windows, blocks, recurring
from starloom.llm.suffix_dedup import covered

WINDOW, GRAM = 50, 6
SHARD = 1 << 20
HEAVY = 1 << 19  # words of one anchor that are streamed through the automata of several shards in one task

RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                       T.StructField("kept", T.BinaryType())])


class _Numbers(dict):
    """Words to well-mixed 64-bit numbers, each computed once while it is held."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_numbers = _Numbers()


def _word_numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_numbers.__getitem__, words), np.uint64, len(words)) | np.uint64(1)


def word_windows(window: int = WINDOW, gram: int = GRAM) -> Windows:
    return Windows(split=lambda data: data.split() if data else [], numbers=_word_numbers, join=b" ".join,
                   size=window, gram=gram, other_documents=True)


def _symbols(parts: list[list[tuple]]) -> list[list[str]]:
    """Each fragment as a string with one character a word; surrogate code points are left out."""
    codes: dict[bytes, str] = {}

    def code(word: bytes) -> str:
        c = codes.get(word)
        if c is None:
            n = len(codes) + 32
            c = codes[word] = chr(n if n < 0xD800 else n + 0x800)
        return c
    return [["".join(map(code, r[5].split(b" "))) for r in rows] for rows in parts]


def _confirmed(parts, texts, window: int) -> list[dict[str, int]]:
    """Passages that stand in several documents, dealt to the shard that has them first."""
    seen: dict[int, int] = {}  # digest of a window -> its document, or -1 for several
    for rows, strings in zip(parts, texts):
        for r, s in zip(rows, strings):
            for i in range(r[4]):
                key = hash(s[i:i + window])
                if seen.setdefault(key, r[1]) != r[1]:
                    seen[key] = _SEVERAL
    out, given = [], set()
    for rows, strings in zip(parts, texts):
        own = {p: 0 for r, s in zip(rows, strings) for i in range(r[4])
               if seen[hash(p := s[i:i + window])] is _SEVERAL and p not in given}
        given.update(own if len(parts) > 1 else ())
        out.append(own)
    return out


_SEVERAL = object()


def decide(batches, window: int = WINDOW, shard: int = SHARD):
    """Windows of the fragments that stand in a document of smaller id, as (doc, tie, start, n) runs."""
    for parts in blocks(batches, shard):
        texts = _symbols(parts)
        out: list[tuple[int, int, int]] = []
        for passages in _confirmed(parts, texts, window):
            if not passages:
                continue
            automaton = ahocorasick.Automaton()
            for i, p in enumerate(passages):
                automaton.add_word(p, i)
            automaton.make_automaton()
            least = [None] * len(passages)
            located = []
            for rows, strings in zip(parts, texts):
                for r, s in zip(rows, strings):
                    for end, i in automaton.iter(s):
                        at = end - window + 1
                        if at < r[4]:
                            if least[i] is None or r[1] < least[i]:
                                least[i] = r[1]
                            located.append((r[1], r[2], r[3] + at, i))
            out += [(d, t, s) for d, t, s, i in located if d > least[i]]
        out.sort()
        runs: list[list[int]] = []
        for d, t, s in out:
            if runs and runs[-1][:2] == [d, t] and s <= runs[-1][2] + runs[-1][3]:
                runs[-1][3] = s - runs[-1][2] + 1
            else:
                runs.append([d, t, s, 1])
        if runs:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*runs)], ["doc", "tie", "start", "n"])


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    gram: int = GRAM, shard: int = SHARD, heavy: int = HEAVY) -> tuple[DataFrame, str]:
    """``docs`` with a struct column more, and that column's name: n_words, n_removed, kept (the words left, joined by one space)."""
    found = recurring(docs, id_col, text_col, word_windows(window, gram), lambda b: decide(b, window, shard), heavy)

    @F.arrow_udf(RESULT)
    def strip(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out: list[list] = [[], [], []]
        for data, s in zip(utf8(texts), spans.to_pylist()):
            words = data.split() if data else []
            edges = [0, *(x for g in (covered(s, window) if s else []) for x in g), len(words)]
            kept = [x for a, b in zip(edges[::2], edges[1::2]) for x in words[a:b]]
            for part, value in zip(out, (len(words), len(words) - len(kept), b" ".join(kept))):
                part.append(value)
        return pa.StructArray.from_arrays([*(pa.array(x, pa.int64()) for x in out[:2]), pa.array(out[2], pa.binary())],
                                          names=["n_words", "n_removed", "kept"])
    name = free_name(docs, "dedup")
    return found.select("row.*", strip.asNondeterministic()(F.col("_text"), F.col("spans")).alias(name)), name


def op8_phrase_dedup(spark, sf_dir):
    done, d = remove_passages(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", f"{d}.n_words", f"{d}.n_removed", F.sha2(f"{d}.kept", 256).alias("kept_sha256"))
