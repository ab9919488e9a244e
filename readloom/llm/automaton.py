"""One deterministic automaton for many byte patterns: subset construction, minimisation, transition arrays.

Patterns have literals, escapes (``\\.``, ``\\x20``), classes, groups, ``|`` and ``? * +``. Every pattern reads one
byte at least before it matches. Bytes of 0xFF, which UTF-8 does not have, part texts and match nothing.
"""

from __future__ import annotations

import functools
import operator

import numpy as np

PART = 0xFF
#: Lanes that are read side by side, and the least bytes of a lane.
LANES, LANE_BYTES = 4096, 64


class _Nfa:
    """Thompson's construction; an edge has a set of bytes as an integer of 256 bits."""

    def __init__(self):
        self.edges: list[list[tuple[int, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def add(self, pattern: str, fold: bool) -> tuple[int, int]:
        """First and last state of a pattern; with ``fold``, ASCII letters match in either case."""
        self.text, self.at, self.fold = pattern, 0, fold
        made = self._either()
        if self.at < len(pattern):
            raise ValueError(f"unbalanced pattern: {pattern}")
        return made

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self) -> tuple[int, int]:
        begin, end = self.state(), self.state()
        while True:
            a, b = self._row()
            self.free[begin].append(a)
            self.free[b].append(end)
            if self._peek() != "|":
                return begin, end
            self.at += 1

    def _row(self) -> tuple[int, int]:
        begin = end = self.state()
        while self._peek() not in ("", "|", ")"):
            a, b = self._atom()
            while (sign := self._peek()) and sign in "?*+":
                self.at += 1
                x, y = self.state(), self.state()
                self.free[x] += [a] if sign == "+" else [a, y]
                self.free[b] += [y] if sign == "?" else [a, y]
                a, b = x, y
            self.free[end].append(a)
            end = b
        return begin, end

    def _atom(self) -> tuple[int, int]:
        if self._peek() == "(":
            self.at += 1
            made = self._either()
            if self._peek() != ")":
                raise ValueError(f"unbalanced pattern: {self.text}")
            self.at += 1
            return made
        begin, end = self.state(), self.state()
        self.edges[begin].append((self._class() if self._peek() == "[" else self._mask(self._byte()), end))
        return begin, end

    def _byte(self) -> int:
        c = self._peek()
        self.at += 1
        if c == "\\":
            c = self._peek()
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def _mask(self, low: int, high: int | None = None) -> int:
        out = 0
        for b in range(low, (low if high is None else high) + 1):
            out |= 1 << b
            if self.fold and chr(b).isascii() and chr(b).isalpha():
                out |= 1 << (b ^ 0x20)
        return out

    def _class(self) -> int:
        self.at += 1
        no = self._peek() == "^"
        self.at += no
        out = 0
        while self._peek() != "]":
            low = self._byte()
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                out |= self._mask(low, self._byte())
            else:
                out |= self._mask(low)
        self.at += 1
        return (1 << PART) - 1 & ~out if no else out

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


class Automaton:
    """Transition arrays of some patterns; state 0 is the first one.

    ``accepts[s]`` and ``alive[s]`` have bit r where pattern r ends in state s, or has begun and may still end. With
    ``restart`` patterns may begin at any byte; without, only at the first.
    """

    def __init__(self, patterns: list[tuple[str, bool]], restart: bool):
        nfa, ends = _Nfa(), []
        for pattern, fold in patterns:
            before = len(nfa.edges)
            ends.append((before, *nfa.add(pattern, fold)))
        owner = np.searchsorted([b for b, _, _ in ends], np.arange(len(nfa.edges)), side="right") - 1
        masks = sorted({m for edges in nfa.edges for m, _ in edges})
        of = [tuple(m >> b & 1 for m in masks) for b in range(256)]
        kinds = {k: i for i, k in enumerate(dict.fromkeys(of))}
        letters = [of.index(k) for k in kinds]  # a byte of each class of bytes that no pattern tells apart
        step = [[sum(1 << t for t in nfa.closure([t for m, t in edges if m >> b & 1])) for b in letters] for edges in nfa.edges]
        start = sum(1 << s for s in nfa.closure([a for _, a, _ in ends]))
        # A state is the set, as bits, of what has been begun, without what may begin here.
        number: dict[int, int] = {0 if restart else start: 0}
        todo, table = list(number), []
        for held in todo:  # grows as it is read
            rows = [step[s] for s in _members(held | start if restart else held)]
            row = []
            for to in map(functools.partial(functools.reduce, operator.or_), zip(*rows)) if rows else [0] * len(letters):
                if to not in number:
                    number[to] = len(todo)
                    todo.append(to)
                row.append(number[to])
            table.append(row)
        bits = lambda rules: sum(1 << r for r in set(rules))
        last = {e: r for r, (_, _, e) in enumerate(ends)}
        accepts = np.array([bits(last[s] for s in _members(held) if s in last) for held in todo], np.int64)
        alive = np.array([bits(int(owner[s]) for s in _members(held)) for held in todo], np.int64)
        same = _minimal(np.array(table), accepts, alive)
        firsts = np.unique(same, return_index=True)[1]
        self.accepts, self.alive = accepts[firsts], alive[firsts]
        self.table = same[np.array(table)[firsts]][:, [kinds[k] for k in of]]
        self._next = (self.table * 256).astype(np.int32).ravel()  # int32: fewer than 2**23 states
        self.rows = self.table.tolist()

    def states(self, raw: np.ndarray) -> np.ndarray:
        """The state after each byte. Lanes of the text are read side by side, each as if it were the text's
        beginning; where the lane before ends in another state, it is read anew from that one until both agree."""
        n = len(raw)
        lanes = max(1, min(LANES, n // LANE_BYTES))
        size = -(-n // lanes) if n else 0
        padded = np.full(lanes * size, PART, np.uint8)
        padded[:n] = raw
        text = np.ascontiguousarray(padded.reshape(lanes, size).T)
        out = np.zeros((size, lanes), np.int32)
        now = np.zeros(lanes, np.int32)
        for t in range(size):
            now = self._next.take(now + text[t])
            out[t] = now
        stale, begun = np.arange(1, lanes), np.zeros(lanes, np.int32)
        while size and len(stale):
            real = out[-1, stale - 1]
            wrong = real != begun[stale]
            lane, now = stale[wrong], real[wrong]
            begun[lane] = now
            ended = []
            for t in range(size):
                if not len(lane):
                    break
                now = self._next.take(now + text[t, lane])
                differs = now != out[t, lane]
                lane, now = lane[differs], now[differs]
                out[t, lane] = now
            else:
                ended = lane
            stale = np.asarray([x + 1 for x in ended if x + 1 < lanes], np.intp)
        return (out.T.ravel()[:n]) // 256


def _members(bits: int) -> list[int]:
    return [i for i, b in enumerate(reversed(f"{bits:b}")) if b == "1"]


def _minimal(table: np.ndarray, *outputs: np.ndarray) -> np.ndarray:
    """A number for each state, the same for states that no text tells apart; that of state 0 is 0."""
    same = np.unique(np.stack(outputs, axis=1), axis=0, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack((same, same[table])), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == same.max():
            break
        same = finer
    _, first, back = np.unique(same, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    return rank[back.ravel()]
