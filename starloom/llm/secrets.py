"""Secret scans: every rule in one deterministic automaton, one pass over the bytes.

All rules are compiled together by subset construction and minimisation (``automata``) into one transition array, which is
broadcast (its size depends on the rules alone). Each text is read once, byte by byte, whatever the number of
rules: a state at or beyond ``first_accepting`` says which rules have a match ending there. Runs of such ends are kept
per rule; for each run the match's start is found by a walk back with the automaton of the reversed rule, as far as the previous match
of that rule at most, so matches are leftmost and do not overlap. All rules used here are such that a match ends exactly where a run of ends does.

The rules of the contract: ``assign`` (a keyword, ``:`` or ``=``, a value of 6 characters or more), ``access`` (``AKIA`` and
16 or more capitals or digits), ``hex`` (24 hex digits or more). Beyond these come tokens of well-known forms: ``github``,
``slack`` and ``pem`` (private key headers). Positions are code points, ends exclusive.

Defined results: NULL is an empty text and has no spans; a text of any length is scanned whole; repeated rows give equal rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.automata import Automaton, compile_rules
from starloom.llm.common import free_name, read, utf8

_VALUE = r"[A-Za-z0-9+/_.=-]"
_KEY = r"(password|passwd|secret|token|api_?key)"

#: kind, rule, letters in any case, shortest match. A match under that length uses up its text, but is dropped; ``hex``,
#: whose letters are in any text, has the length in the rule. For ``assign`` the length is that of the value.
RULES = (
    ("assign", _KEY + r"""["']?\x20*[:=]\x20*["']?""" + _VALUE + "+", True, 6),
    ("access", r"AKIA[A-Z0-9]+", False, 20),
    ("hex", r"[0-9a-f]{24,}", False, 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", False, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", False, 15),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", False, 0),
)
#: The same rules read from the end.
_BACK = (
    _VALUE + r"""+["']?\x20*[:=]\x20*["']?(drowssap|dwssap|terces|nekot|yek_?ipa)""",
    r"[A-Z0-9]+AIKA",
    r"[0-9a-f]{24,}",
    r"[A-Za-z0-9]+_[pousr]hg",
    r"[A-Za-z0-9-]+-[abprs]xox",
    r"-----YEK ETAVIRP[A-Z ]* NIGEB-----",
)
BASE = ("assign", "access", "hex")
KINDS = tuple(rule[0] for rule in RULES)
SHORTEST = tuple(rule[3] for rule in RULES)

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class Scanner:
    """The flat tables a task scans with. Rows of the flat table start at multiples of 256."""

    def __init__(self, forward: Automaton, backward: list[Automaton]):
        self.next = (forward.table.astype(int) * 256).ravel().tolist()
        self.limit = forward.first_accepting * 256
        self.accepts = forward.accepts.tolist()
        self.back = [(a.table.tolist(), (a.accepts > 0).tolist()) for a in backward]
        self.dead = [next((s for s, row in enumerate(t) if not a[s] and set(row) == {s}), -1) for t, a in self.back]

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, kind, end) in bytes, sorted; only matches that count."""
        step, limit, state = self.next, self.limit, 0
        ends: list[list[int]] = [[] for _ in KINDS]
        for i, b in enumerate(data, 1):
            state = step[state + b]
            if state >= limit:
                mask = self.accepts[state >> 8]
                for k in range(len(KINDS)):
                    if mask >> k & 1:
                        run = ends[k]
                        if run and run[-1] == i - 1:
                            run[-1] = i
                        else:
                            run.append(i)
        found = []
        for k, run in enumerate(ends):
            last = 0
            for end in run:
                start = self._start(k, data, end, last)
                if start is None:
                    continue
                last = end
                size = self._value_size(data, start, end) if KINDS[k] == "assign" else end - start
                if size >= SHORTEST[k]:
                    found.append((start, k, end))
        return sorted(found)

    def _start(self, k: int, data: bytes, end: int, last: int) -> int | None:
        table, accepting = self.back[k]
        state, best = 0, None
        for i in range(end - 1, last - 1, -1):
            state = table[state][data[i]]
            if accepting[state]:
                best = i
            if state == self.dead[k]:
                break
        return best

    @staticmethod
    def _value_size(data: bytes, start: int, end: int) -> int:
        """Characters of the value: what stands behind the first ``:`` or ``=``, blanks and a quote."""
        at = min(x for x in (data.find(b":", start, end), data.find(b"=", start, end)) if x >= 0) + 1
        while data[at] == 0x20:
            at += 1
        return end - at - (data[at] in b"\"'")


def build_scanner() -> Scanner:
    return Scanner(compile_rules([(rule, cased) for _, rule, cased, _ in RULES]),
                   [compile_rules([(back, rule[2])], anchored=True) for back, rule in zip(_BACK, RULES)])


def code_points(data: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets of sorted spans as code point offsets."""
    places = sorted({x for s, _, e in found for x in (s, e)})
    at, count, known = 0, 0, {}
    for p in places:
        count += len(data[at:p].decode("utf-8", "surrogatepass"))
        known[p], at = count, p
    return [(known[s], k, known[e]) for s, k, e in found]


def find_secrets(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with an array column more (kind, start, end by start, then kind), and that column's name."""
    scanner = docs.sparkSession.sparkContext.broadcast(build_scanner())
    name = free_name(docs, "secret_spans")

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        out = []
        for data in utf8(texts):
            found = scanner.value.scan(data) if data else []
            out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in code_points(data, found)] if found else [])
        return pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
    return docs.withColumn(name, scan.asNondeterministic()(F.col(text_col))), name


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by ``[kind]`` (overlapping spans as one, named by the first).

    ``length_col``, where the table has it, is set to the new length in code points of changed texts.
    """
    marked, name = find_secrets(docs, text_col)

    @F.arrow_udf(T.StringType())
    def blank(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts.to_pylist(), spans.to_pylist()):
            if found:
                parts, at = [], 0
                for x in found:
                    if x["start"] >= at:
                        parts += [text[at:x["start"]], f"[{x['kind']}]"]
                    at = max(at, x["end"])
                text = "".join(parts) + text[at:]
            out.append(text)
        return pa.array(out, pa.string())
    hit = F.size(name) > 0
    new = free_name(marked, "redacted")
    out = marked.withColumn(new, blank.asNondeterministic()(F.col(text_col), F.col(name)))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col(new).alias(c))
        elif c == length_col:
            columns.append(F.when(hit, F.char_length(new)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return out.select(*columns)


def op6_secrets(spark, sf_dir):
    marked, s = find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long")
    line = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    base = F.filter(s, lambda x: x["kind"].isin(*BASE))
    return marked.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                         count("hex").alias("n_hex"), F.sha2(line(base), 256).alias("base_sha256"),
                         line(F.col(s)).alias("spans"))
