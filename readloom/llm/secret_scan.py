"""Secret scans: the regexes of all rules in one minimised automaton, read once over the bytes of a text.

The automaton says after every byte which rules have begun and which match. Where a rule has been alive without a
break and has matched for long enough, a second automaton, which begins at one place only, lays its matches from left
to right; such places are few.
"""

from __future__ import annotations

import functools
import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import automaton


class Rule(NamedTuple):
    """A match has ``tail`` places at least at which its pattern could end; shorter ones are dropped, but take their place."""

    kind: str
    pattern: str
    tail: int
    fold: bool = False


#: The base rules, then the public forms of some services' keys. The automaton tells all sets of rules apart
#: that can be under way together, so each further rule of a long open end may double it; these make some 2,000 states.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 24),
)
RULES = (
    *BASE,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 35),
    Rule("stripe", r"[rs]k_(live|test)_[A-Za-z0-9]+", 16),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
)
#: Bytes of texts that are read at a time; a longer text is read alone.
SLICE = 4 << 20
OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


@functools.cache
def machines(rules: tuple[Rule, ...]) -> tuple[automaton.Automaton, automaton.Automaton]:
    """The automata that begin anywhere and at one place."""
    patterns = [(r.pattern, r.fold) for r in rules]
    return automaton.Automaton(patterns, True), automaton.Automaton(patterns, False)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge[0::2], edge[1::2]


def find(texts: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """Of each text the matches (first code point, rule, one past the last code point), sorted."""
    scan, place = machines(rules)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    raw = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    states = scan.states(raw).astype(np.uint16)
    ends = np.cumsum([len(t) + 1 for t in texts])
    found: list[tuple[int, int, int]] = []
    for r, rule in enumerate(rules):
        begin, end = _runs((scan.accepts >> r & 1).astype(bool)[states])
        long = end - begin >= rule.tail
        if not long.any():
            continue
        at, to = _runs((scan.alive >> r & 1).astype(bool)[states])
        for k in np.unique(np.searchsorted(at, begin[long], side="right") - 1):
            found += _laid(place, r, rule.tail, raw[at[k] : to[k]].tolist(), int(at[k]))
    if found:
        # A code point begins at each byte that continues none.
        points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        for begin, r, end in sorted(found):
            doc = int(np.searchsorted(ends, begin, side="right"))
            zero = points[ends[doc] - len(texts[doc]) - 1]
            out[doc].append((int(points[begin] - zero), r, int(points[end] - zero)))
    return out


def _laid(place: automaton.Automaton, rule: int, tail: int, raw: list[int], base: int) -> list[tuple[int, int, int]]:
    """Longest matches of a rule from left to right."""
    out, at, bit = [], 0, 1 << rule
    table, accepts, alive = place.rows, place.accepts.tolist(), place.alive.tolist()
    while at < len(raw):
        state, end, n = 0, 0, 0
        for i in range(at, len(raw)):
            state = table[state][raw[i]]
            if not alive[state] & bit:
                break
            if accepts[state] & bit:
                end, n = i + 1, n + 1
        if n >= tail:
            out.append((base + at, rule, base + end))
        at = end or at + 1
    return out


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Secrets in each whole text: counts of the base kinds, a digest of their spans, and all spans.

    Takes ``doc_id`` and ``text``; other columns, of any name, are ignored. One row per input row, repeated rows alike;
    null and empty texts have no span (counts 0, the digest of the empty string, an empty list). A span is
    ``kind:start:end`` in code points, by start and then in the order of ``rules``; those of one kind never overlap,
    those of different kinds may. Very long texts are scanned whole, at about 30 bytes of memory a byte. An empty table
    gives no rows. ``rules`` begin with the base rules; more may follow.
    """
    if rules[: len(BASE)] != BASE:
        raise ValueError("rules begin with the base rules")

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            begin = 0
            while begin < len(texts):
                size, end = 0, begin
                while end < len(texts) and (end == begin or size + len(texts[end]) <= SLICE):
                    size, end = size + len(texts[end]), end + 1
                yield _rows(b.column("doc_id").slice(begin, end - begin), find(texts[begin:end], rules), rules)
                begin = end

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, OUT)


def _rows(ids: pa.Array, found: list[list[tuple[int, int, int]]], rules: tuple[Rule, ...]) -> pa.RecordBatch:
    joined = lambda spans: ",".join(f"{rules[r].kind}:{a}:{z}" for a, r, z in spans)
    counts = [[sum(r == k for _, r, _ in spans) for spans in found] for k in range(len(BASE))]
    sha = [hashlib.sha256(joined([s for s in spans if s[1] < len(BASE)]).encode()).hexdigest() for spans in found]
    columns = [ids, *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string()), pa.array(map(joined, found), pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{r.kind}" for r in BASE), "base_sha256", "spans"])
