"""Regular expressions to one minimal deterministic byte automaton.

Syntax: literals, escapes, classes with ranges, groups, ``(?:``, ``(?i:``, ``|`` and the
quantifiers ``? * + {m,} {m} {m,n}``. Everything is over bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FENCE = 0xFF  # never part of UTF-8: stands between documents


class _Parser:
    """Pattern to a tree of ("set", bytes), ("cat", ...), ("alt", ...), ("rep", node, least, most)."""

    def __init__(self, pattern: str):
        self.p, self.i = pattern, 0

    def parse(self, fold: bool = False):
        branches, items = [], []
        while self.i < len(self.p) and self.p[self.i] != ")":
            if self.p[self.i] == "|":
                branches.append(("cat", *items))
                items, self.i = [], self.i + 1
            else:
                items.append(self._quantified(self._atom(fold)))
        branches.append(("cat", *items))
        return branches[0] if len(branches) == 1 else ("alt", *branches)

    def _atom(self, fold: bool):
        c = self.p[self.i]
        self.i += 1
        if c == "(":
            for mark, on in (("?i:", True), ("?:", fold)):
                if self.p.startswith(mark, self.i):
                    self.i += len(mark)
                    fold = on
                    break
            node = self.parse(fold)
            self.i += 1
            return node
        if c == "[":
            return ("set", self._class())
        value = self._escape() if c == "\\" else ord(c)
        both = {value} | ({ord(chr(value).swapcase())} if fold and chr(value).isalpha() else set())
        return ("set", frozenset(both))

    def _escape(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def _class(self) -> frozenset:
        found, negated = set(), self.p[self.i] == "^"
        self.i += negated
        while self.p[self.i] != "]":
            c = self.p[self.i]
            self.i += 1
            low = self._escape() if c == "\\" else ord(c)
            high = low
            if self.p[self.i] == "-" and self.p[self.i + 1] != "]":
                c = self.p[self.i + 1]
                self.i += 2
                high = self._escape() if c == "\\" else ord(c)
            found.update(range(low, high + 1))
        self.i += 1
        return frozenset(set(range(FENCE)) - found if negated else found)

    def _quantified(self, node):
        while self.i < len(self.p) and self.p[self.i] in "?*+{":
            c = self.p[self.i]
            self.i += 1
            if c == "{":
                close = self.p.index("}", self.i)
                low, _, high = self.p[self.i : close].partition(",")
                least, most = int(low), (int(high) if high else None) if "," in self.p[self.i : close] else int(low)
                self.i = close + 1
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("rep", node, least, most)
        return node


def _reversed(node):
    if node[0] == "set":
        return node
    if node[0] == "rep":
        return ("rep", _reversed(node[1]), *node[2:])
    kids = [_reversed(x) for x in node[1:]]
    return (node[0], *(kids[::-1] if node[0] == "cat" else kids))


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def new(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.empty) - 1

    def add(self, node, start: int) -> int:
        """Builds ``node`` after state ``start``; the state after it."""
        if node[0] == "set":
            end = self.new()
            self.step[start] = (node[1], end)
            out = self.new()
            self.empty[end].append(out)
            return out
        if node[0] == "cat":
            for x in node[1:]:
                start = self.add(x, start)
            return start
        out = self.new()
        if node[0] == "alt":
            for x in node[1:]:
                first = self.new()
                self.empty[start].append(first)
                self.empty[self.add(x, first)].append(out)
            return out
        _, inner, least, most = node
        for _ in range(least):
            start = self.add(inner, start)
        if most is None:
            loop = self.new()
            self.empty[start].append(loop)
            body = self.new()
            self.empty[loop] += [body, out]
            self.empty[self.add(inner, body)].append(loop)
            return out
        self.empty[start].append(out)
        for _ in range(most - least):
            body = self.new()
            self.empty[start].append(body)
            start = self.add(inner, body)
            self.empty[start].append(out)
        return out


@dataclass
class Automaton:
    """next[state, class_of[byte]]; accepts[state] has bit r if rule r ends here."""

    class_of: np.ndarray
    next: np.ndarray
    accepts: np.ndarray
    start: int = 0


def compile_rules(patterns: list[str], anchored: bool = False, backwards: bool = False) -> Automaton:
    """Subset construction over byte classes, then partition refinement.

    Not anchored, a match may begin at any byte, except across FENCE.
    """
    nfa = _Nfa()
    root, ends = nfa.new(), {}
    for r, pattern in enumerate(patterns):
        tree = _Parser(pattern).parse()
        first = nfa.new()
        nfa.empty[root].append(first)
        ends[nfa.add(_reversed(tree) if backwards else tree, first)] = 1 << r
    sets = sorted({s[0] for s in nfa.step if s}, key=sorted)
    member = np.array([[b in s for s in sets] for b in range(256)], dtype=bool)
    _, class_of = np.unique(np.packbits(member, axis=1), axis=0, return_inverse=True)
    class_of = class_of.reshape(-1)
    class_of[FENCE] = class_of.max() + 1
    sample = {int(c): b for b, c in enumerate(class_of)}
    n_classes = int(class_of.max()) + 1

    def closed(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in nfa.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(x for x in seen if nfa.step[x] or x in ends)

    begin = closed([root])
    number, table, queue = {begin: 0}, [], [begin]
    for state in queue:
        row = []
        for c in range(n_classes):
            b = sample[c]
            to = {nfa.step[x][1] for x in state if nfa.step[x] and b in nfa.step[x][0]}
            after = closed(to) if to else frozenset()
            after = begin if b == FENCE and not anchored else after if anchored else after | begin
            if after not in number:
                number[after] = len(number)
                queue.append(after)
            row.append(number[after])
        table.append(row)
    accepts = np.zeros(len(queue), np.int64)
    for k, state in enumerate(queue):
        for x in state:
            accepts[k] |= ends.get(x, 0)
    moves = np.array(table)
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        key = np.column_stack([block, block[moves]])
        _, finer = np.unique(key, axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    count = int(block.max()) + 1
    lead = np.zeros(count, int)
    lead[block[::-1]] = np.arange(len(block))[::-1]
    return Automaton(class_of.astype(np.uint8), block[moves[lead]].astype(np.int32), accepts[lead], int(block[0]))


def run(auto: Automaton, data: np.ndarray, lanes: int = 8192) -> np.ndarray:
    """The state after each byte, in one pass over ``data``.

    The bytes are cut into lanes that step together. Each lane first assumes the start
    state; those whose true entry state differs are stepped again until they agree with
    what is recorded, which the next lanes then build on.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int32)
    steps = max(64, -(-n // lanes))
    lanes = -(-n // steps)
    padded = np.full(lanes * steps, FENCE, np.uint8)
    padded[:n] = data
    width = auto.next.shape[1]
    flat = np.ascontiguousarray(auto.next.reshape(-1) * width, dtype=np.int32)  # states as row offsets
    classes = np.ascontiguousarray(auto.class_of[padded].reshape(lanes, steps).T).astype(np.int32)
    states = np.empty((steps, lanes), np.int32)
    at = np.full(lanes, auto.start * width, np.int32)
    for i in range(steps):
        at = flat[at + classes[i]]
        states[i] = at
    assumed = np.full(lanes, auto.start * width, np.int32)
    while True:
        true = np.concatenate([[auto.start * width], states[-1, :-1]]).astype(np.int32)
        wrong = np.flatnonzero(true != assumed)
        if not len(wrong):
            break
        assumed[wrong] = true[wrong]
        at = true[wrong]
        for i in range(steps):
            at = flat[at + classes[i, wrong]]
            differs = at != states[i, wrong]
            if not differs.any():
                break
            states[i, wrong] = at
            wrong, at = wrong[differs], at[differs]
    return (states.T.reshape(-1)[:n]) // width
