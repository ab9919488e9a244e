"""Benchmark decontamination with one Aho-Corasick automaton.

The normalised windows of all benchmark items form one automaton. Its letters are the digits of word
numbers, so a word costs as many states as it has digits and a state has few ways on. A document is
normalised the same way, scanned once, and every match is mapped back to its words, and through the words to
byte offsets of the original text. Benchmarks beyond a bound on states are scanned in blocks of items, one
block after another over a written table, so that one automaton is held at a time; no item is left out.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, resident, shared

WINDOW = 10
#: States of one automaton at most, 40 bytes each, unless one item has more.
BLOCK_STATES = 6_000_000
#: Digits of a word's number.
BASE = 48
OUT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<struct<begin: long, end: long>>"
HELD = "doc_id long, text string, hits array<long>, items array<string>"


def words(text: bytes) -> list[bytes]:
    """A-Z in lower case; runs of digits, letters and bytes of other characters."""
    return text.translate(kernel.ALNUM_FOLD).split()


class Automaton:
    """All windows of some items (item_id or None, normalised words)."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        import ahocorasick

        number: dict[bytes, int] = {}
        for _, w in items:
            for x in w:
                number.setdefault(x, len(number))
        self.digits = _digits(len(number))
        letter = [[chr(0x100 + BASE * k + d) for d in range(BASE)] for k in range(self.digits)]
        self.written = {x: "".join(letter[k][i // BASE**k % BASE] for k in range(self.digits)) for x, i in number.items()}
        self.unknown = "\0" * self.digits
        self.length: list[int] = []  # words of each window
        self.of: list[list[str | None]] = []  # and its items
        seen: dict[str, int] = {}
        for item, w in items:
            for i in range(max(1, len(w) - window + 1) if w else 0):
                part = w[i : i + window]
                k = seen.setdefault("".join([self.written[x] for x in part]), len(self.of))
                if k == len(self.of):
                    self.length.append(len(part))
                    self.of.append([])
                if not self.of[k] or self.of[k][-1] != item:
                    self.of[k].append(item)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for pattern, k in seen.items():
            self.machine.add_word(pattern, k)
        if seen:
            self.machine.make_automaton()

    def matches(self, w: list[bytes]) -> Iterator[tuple[int, int]]:
        """(first word behind the match, window) of each match, from left to right."""
        if self.of and w:
            written, unknown = self.written, self.unknown
            for end, k in self.machine.iter("".join([written.get(x, unknown) for x in w])):
                yield end // self.digits + 1, k


def _digits(words: int) -> int:
    n = 1
    while BASE**n < words:
        n += 1
    return n


def word_spans(text: bytes, w: list[bytes]) -> list[tuple[int, int]]:
    """Begin and end byte of each word in the original text."""
    flat, at, out = text.translate(kernel.ALNUM_FOLD), 0, []
    for x in w:
        at = flat.index(x, at)
        out.append((at, at + len(x)))
        at += len(x)
    return out


def scan(text: bytes, machine: Automaton) -> tuple[int, list[tuple[int, int]], set[str | None]]:
    """Number of words, hit runs of words (first, last + 1) and items of a document."""
    w = words(text)
    runs: list[tuple[int, int]] = []
    items: set[str | None] = set()
    for end, k in machine.matches(w):
        runs.append((end - machine.length[k], end))
        items.update(machine.of[k])
    return len(w), merged(runs), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _sorted(items: set[str | None]) -> list[str | None]:
    return [*sorted(items - {None}), *items & {None}]


def _blocks(benchmark: DataFrame, window: int, limit: int) -> Iterator[tuple[list[tuple[str | None, list[bytes]]], bool]]:
    """Blocks of items, and whether one is the last; an item is read at a time."""
    held, states, distinct = [], 0, set()
    for r in benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].cast("string").alias("text")).orderBy("item_id", "text").toLocalIterator():
        w = words((r.text or "").encode())
        more = window * max(1, len(w) - window + 1)
        if held and (states + more) * _digits(len(distinct | set(w))) > limit:
            yield held, False
            held, states, distinct = [], 0, set()
        held.append((r.item_id, w))
        distinct.update(w)
        states += more
    yield held, True


def _sent(docs: DataFrame, block: list, window: int):
    """A function that gives the block's automaton, made once in each worker."""
    sent, name = docs.sparkSession.sparkContext.broadcast(pickle.dumps(block)), uuid.uuid4().hex
    return lambda: resident.hold(("items", name), lambda: Automaton(pickle.loads(sent.value), window))


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_states: int = BLOCK_STATES) -> DataFrame:
    """Mark the words of documents that stand in a window of a benchmark item.

    Takes ``doc_id`` and ``text`` of ``docs``, ``item_id`` and ``text`` of ``benchmark``; other columns
    are ignored. An item of fewer words than ``window`` is one window; null and wordless texts of either
    side have none. Rows of ``benchmark`` without item_id are one item together, which stands as a null
    at the end of items and is left out of items_sha256. One row per input row: doc_id, n_words, n_hit,
    n_items, items_sha256 (item ids sorted as strings, joined by commas), contaminated, items, and spans
    (byte ranges of the original UTF-8 text). Repeated rows are marked alike; empty
    tables give no rows, or no hits.
    """
    held = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
    now = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), F.expr("cast(array() as array<long>)").alias("hits"), F.expr("cast(array() as array<string>)").alias("items"))
    for block, last in _blocks(benchmark, window, block_states):

        def run(batches, get=_sent(docs, block, window), last=last):
            machine = get()
            for b in batches:
                rows = []
                for t, old, known in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("hits").to_pylist(), b.column("items").to_pylist()):
                    n, runs, found = scan(t or b"", machine)
                    rows.append((t or b"", n, merged([*runs, *zip(old[::2], old[1::2])]) if old else runs, _sorted(found.union(known))))
                if last:
                    yield _result(b.column("doc_id"), rows)
                else:
                    yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array([[x for r in runs for x in r] for _, _, runs, _ in rows], pa.list_(pa.int64())), pa.array([i for *_, i in rows], pa.list_(pa.string()))], schema=held)

        now = now.mapInArrow(run, OUT if last else HELD)
        now = now if last else shared.table(now, "hits")
    return now


def _result(ids: pa.Array, rows: list[tuple[bytes, int, list[tuple[int, int]], list[str | None]]]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    spans, sha, n_hit = [], [], [sum(y - x for x, y in runs) for _, _, runs, _ in rows]
    for text, _, runs, items in rows:
        at = word_spans(text, words(text)) if runs else []
        spans.append([{"begin": at[x][0], "end": at[y - 1][1]} for x, y in runs])
        sha.append(hashlib.sha256(",".join(x for x in items if x is not None).encode()).hexdigest())
    columns = [ids, pa.array([n for _, n, _, _ in rows], pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(i) for *_, i in rows], pa.int64()), pa.array(sha, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_()), pa.array([i for *_, i in rows], pa.list_(pa.string())), pa.array(spans, kind)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"])


@shared.any_names
def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_states: int = BLOCK_STATES) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, with all of their columns.

    Null and wordless texts have no window and stay; repeated rows stay or go together; the id plays no
    part; other columns may have any name. An empty benchmark keeps all rows, an empty table gives none.
    """
    place = docs.columns.index("text")
    for block, last in _blocks(benchmark, window, block_states):

        def run(batches, get=_sent(docs, block, window)):
            machine = get()
            for b in batches:
                yield b.filter(pa.array([next(machine.matches(words(t or b"")), None) is None for t in b.column(place).cast(pa.string()).cast(pa.binary()).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        docs = docs if last else shared.table(docs, "clean")
    return docs
