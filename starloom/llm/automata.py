"""Regular rules to one minimal deterministic automaton: parser, subset construction, minimisation.

The rule language is what secret rules need: literals, ``\\`` escapes, ``\\xHH``, classes, ``(...)``, ``|``,
``? * + {m} {m,} {m,n}``; every symbol is one byte. Rules are compiled together, unanchored: after any byte the
state tells which rules have a match ending there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Parser:
    def __init__(self, rule: str, any_case: bool):
        self.s, self.i, self.any_case = rule, 0, any_case

    def peek(self) -> str:
        return self.s[self.i] if self.i < len(self.s) else ""

    def take(self) -> str:
        self.i += 1
        return self.s[self.i - 1]

    def alternatives(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return ("alt", parts) if len(parts) > 1 else parts[0]

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeat(self.atom()))
        return ("seq", parts)

    def repeat(self, node):
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                end = self.s.index("}", self.i)
                low, _, high = self.s[self.i:end].partition(",")
                exact = "," not in self.s[self.i:end]
                self.i = end + 1
                lo, hi = int(low), int(low) if exact else int(high) if high else None
            else:
                lo, hi = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            rest = [("star", node)] if hi is None else [("opt", node)] * (hi - lo)
            node = ("seq", [node] * lo + rest)
        return node

    def symbol(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.s[self.i - 2:self.i], 16)
        return {"n": 10, "r": 13, "t": 9}.get(c, ord(c))

    def cased(self, codes: set[int]) -> frozenset[int]:
        if self.any_case:
            codes |= {ord(chr(c).swapcase()) for c in codes if c < 128 and chr(c).isalpha()}
        return frozenset(codes)

    def atom(self):
        c = self.peek()
        if c == "(":
            self.take()
            node = self.alternatives()
            assert self.take() == ")"
            return node
        if c == "[":
            self.take()
            negated = self.peek() == "^"
            if negated:
                self.take()
            codes: set[int] = set()
            while self.peek() != "]":
                low = self.symbol()
                high = low
                if self.peek() == "-" and self.s[self.i + 1] != "]":
                    self.take()
                    high = self.symbol()
                codes |= set(range(low, high + 1))
            self.take()
            return ("set", self.cased(codes) if not negated else frozenset(range(256)) - self.cased(codes))
        return ("set", self.cased({self.symbol()}))


@dataclass
class _Nfa:
    empty: list
    steps: list

    def state(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def build(self, node, start: int) -> int:
        kind, body = node
        if kind == "set":
            end = self.state()
            self.steps[start].append((body, end))
            return end
        if kind == "seq":
            for x in body:
                start = self.build(x, start)
            return start
        end = self.state()
        if kind == "alt":
            for x in body:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.build(x, first)].append(end)
            return end
        first = self.state()  # star and opt
        self.empty[start] += [first, end]
        self.empty[self.build(body, first)] += [end] + [first] * (kind == "star")
        return end


@dataclass(frozen=True)
class Automaton:
    """table[state, byte] -> state; accepts[state]: bit i set where rule i has a match that ends here.

    State 0 is the start. States that accept come last, from ``first_accepting`` on.
    """
    table: np.ndarray
    accepts: np.ndarray
    first_accepting: int


def compile_rules(rules: list[tuple[str, bool]], anchored: bool = False) -> Automaton:
    """One automaton for all rules (pattern, letters in any case)."""
    nfa = _Nfa([], [])
    root, ends = nfa.state(), {}
    for i, (rule, any_case) in enumerate(rules):
        p = _Parser(rule, any_case)
        tree = p.alternatives()
        assert p.i == len(rule), f"unread: {rule[p.i:]}"
        first = nfa.state()
        nfa.empty[root].append(first)
        ends[nfa.build(tree, first)] = i

    def closed(states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in nfa.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    start = closed([root])
    ids, order, rows = {start: 0}, [start], []
    for at in order:  # subset construction; ``order`` grows while it is read
        targets: list[set[int]] = [set() for _ in range(256)]
        for s in at:
            for codes, t in nfa.steps[s]:
                for c in codes:
                    targets[c].add(t)
        row, known = [], {}
        for t in targets:
            key = frozenset(t)
            if key not in known:
                full = closed(key) | (frozenset() if anchored else start)
                if full not in ids:
                    ids[full] = len(order)
                    order.append(full)
                known[key] = ids[full]
            row.append(known[key])
        rows.append(row)
    table = np.array(rows, np.int32)
    accepts = np.array([sum(1 << i for e, i in ends.items() if e in at) for at in order], np.int64)
    return _minimal(table, accepts)


def _minimal(table: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Moore's refinement: states are split by what they accept, then by the classes they lead to."""
    _, group = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    n = int(group.max()) + 1
    one = np.zeros(n, np.int64)
    one[group] = np.arange(len(group))
    # start first, accepting states last
    rank = np.lexsort((np.arange(n), (accepts[one] > 0).astype(int) * 2 - (np.arange(n) == group[0])))
    new = np.empty(n, np.int32)
    new[rank] = np.arange(n, dtype=np.int32)
    members = one[rank]
    out = new[group[table[members]]]
    acc = accepts[members]
    return Automaton(out, acc, int(np.argmax(acc > 0)) if (acc > 0).any() else n)
