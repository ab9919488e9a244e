"""Substring dedup by windows of words, with a count-min prefilter.

Each chunk of documents counts its windows in a sketch: two rows of counters, a window adding to one
counter of each row, once for each document of the chunk up to two. The sketches of all chunks are added up,
shard by shard of the counters' range, and the smaller of a window's two counters overestimates in how many
documents it starts. Windows of which it is one cannot repeat; all others are grouped exactly, by 112 bits
of hash made of 128 bits of each word, so no repeated window is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import chunks, kernel

WINDOW = 13
#: Rows of the sketch, and counters of a row for each expected window.
ROWS, CELLS = 2, 4
#: Bytes of text for each shard of the sketch and of the windows, and what a counter holds at most.
SHARD_BYTES, FULL = 32 << 20, 250
LAST = np.iinfo(np.int64).max
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"


class _Windows:
    """All windows of a chunk: 128 bits of hash, and the document's rank; of its words only the last pack's are held."""

    def __init__(self, table: pa.Table, size: int):
        a, b, doc = [], [], []
        for ids, texts in chunks.slices(table):
            words = kernel.Words(texts)
            at = words.windows(size)
            rank = np.array([LAST if i is None else i for i in ids], np.int64)
            a.append(words.window_hashes(at, size))
            b.append(words.window_hashes(at, size, 1))
            doc.append(rank[words.doc[at]])
        empty = np.empty(0, np.uint64)
        self.a, self.b, self.doc = np.concatenate([empty, *a]), np.concatenate([empty, *b]), np.concatenate([empty.astype(np.int64), *doc])

    def row(self, r: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the windows by their counter in a row of the sketch, begin of each counter in it, and the counters."""
        cell = (self.b if r else self.a) // np.uint64(step)
        order = np.argsort(cell)
        cell = cell[order]
        begin = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.empty(0, np.int64)
        return order, begin, cell[begin]

    def candidates(self, answer: pa.Table, step: int, n: int) -> np.ndarray:
        """Windows of which both counters reached two."""
        many = np.ones(len(self.a), bool)
        for r in range(ROWS):
            order, begin, cell = self.row(r, step)
            got = chunks.flags(answer, r, cell * np.uint64(step), n)
            many[order] &= np.repeat(got, np.diff(np.append(begin, len(order))))
        return np.flatnonzero(many)

    def groups(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the picked windows by hash, begin of each group of equal ones, smallest document of it."""
        order = pick[np.argsort(self.a[pick])]
        if not len(order):
            return order, order, order
        a, b = self.a[order], self.b[order]
        if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():  # the first half alone does not tell them apart
            order = pick[np.lexsort((self.b[pick], self.a[pick]))]
            a, b = self.a[order], self.b[order]
        begin = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        return order, begin, np.minimum.reduceat(self.doc[order], begin)


def _add(step: int, n: int):
    """Adds up what the chunks counted in a shard of each row, and tells each chunk which of its counters reached two."""
    width = (1 << 64) // n // step + 2

    def read(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        at = 4 + int.from_bytes(data[:4], "little")
        cell = chunks.unpack_keys(data[at:]).astype(np.int64)
        return cell, kernel.unbits(data[4:at], len(cell))

    def merge(shard: int, got: list[tuple[int, int, bytes]]) -> list[tuple[int, int, bytes]]:
        out = []
        for r in range(ROWS):
            counters, mine = np.zeros(width, np.uint8), [(c, d) for t, c, d in got if t == r]
            for _, d in mine:
                cell, several = read(d)
                counters[cell] = np.minimum(counters[cell] + several + np.uint8(1), FULL)
            out += [(r, c, kernel.bits(counters[read(d)[0]] > 1)) for c, d in mine]
        return out

    return merge


def _merge_windows(shard: int, got: list[tuple[int, int, bytes]]) -> list[tuple[int, int, bytes]]:
    """Each chunk learns for which of its windows another chunk has a smaller document."""
    parts = [_unpack_windows(d) for _, _, d in got]
    a, b, doc = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(a)
    x, y = a[order], b[order]
    if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():
        order = np.lexsort((b, a))
        x, y = a[order], b[order]
    begin = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    least = np.empty(len(a), np.int64)
    least[order] = np.minimum.reduceat(doc[order], np.flatnonzero(begin))[np.cumsum(begin) - 1]
    smaller = least < doc
    ends = np.cumsum([len(d) for _, _, d in parts])
    return [(t, c, kernel.bits(smaller[e - len(d) : e])) for (t, c, _), (_, _, d), e in zip(got, parts, ends)]


def _pack_windows(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> bytes:
    """Sorted first halves as gaps of their upper 48 bits and the lower 16; the upper 48 bits of the second halves; documents from the smallest on."""
    base, keys = int(doc.min()), chunks.pack_keys(a >> np.uint64(16))
    wide = 8 if int(doc.max()) - base >= 1 << 32 else 4
    head = len(a).to_bytes(4, "little") + len(keys).to_bytes(4, "little") + bytes([wide]) + base.to_bytes(8, "little", signed=True)
    return head + keys + a.astype("<u2").tobytes() + (b >> np.uint64(32)).astype("<u4").tobytes() + (b >> np.uint64(16)).astype("<u2").tobytes() + (doc - base).view(np.uint64).astype(f"<u{wide}").tobytes()


def _unpack_windows(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, keys, wide, base = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little"), data[8], int.from_bytes(data[9:17], "little", signed=True)
    at = 17 + keys
    a = chunks.unpack_keys(data[17:at]) << np.uint64(16) | np.frombuffer(data, "<u2", n, at)
    b = np.frombuffer(data, "<u4", n, at + 2 * n).astype(np.uint64) << np.uint64(16) | np.frombuffer(data, "<u2", n, at + 6 * n)
    doc = np.frombuffer(data, f"<u{wide}", n, at + 8 * n).astype(np.uint64).view(np.int64) + base
    return a, b, doc


def dedup(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = chunks.CHUNK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Remove each word covered by a window of words that also starts in a document of smaller doc_id.

    Takes ``doc_id`` and ``text`` of ``docs``; other columns are ignored. One row per input row:
    doc_id, n_words, n_removed, kept_sha256, text (kept words joined by one space). A null text
    has no words. A row without doc_id comes after all others; rows that repeat a doc_id count as
    the same document, so a window shared by them only is kept. An empty table gives no rows.
    """
    dealt, total = chunks.deal(docs, chunk_bytes)
    n = chunks.shards(dealt, total, shard_bytes)
    step = (1 << 64) // max(1 << 16, CELLS * total // 6)

    def sketch(table: pa.Table) -> pa.Table:
        w, chunk, out = _Windows(table, window), table.column("chunk")[0].as_py(), []
        for r in range(ROWS):
            order, begin, cell = w.row(r, step)
            if not len(begin):
                continue
            several = np.minimum.reduceat(w.doc[order], begin) != np.maximum.reduceat(w.doc[order], begin)
            for s, x, y in chunks.parts(cell * np.uint64(step), n):
                bits = kernel.bits(several[x:y])
                out.append((r, chunk, s, len(bits).to_bytes(4, "little") + bits + chunks.pack_keys(cell[x:y] - np.uint64(-(-(s << 64) // n) // step))))
        return chunks.packed(out)

    def exact(table: pa.Table, answer: pa.Table) -> pa.Table:
        w, chunk = _Windows(table, window), table.column("chunk")[0].as_py()
        order, begin, low = w.groups(w.candidates(answer, step, n))
        a, b = w.a[order[begin]], w.b[order[begin]]
        return chunks.packed([(ROWS, chunk, s, _pack_windows(a[x:y], b[x:y], low[x:y])) for s, x, y in chunks.parts(a, n)])

    def finish(table: pa.Table, answer: pa.Table) -> pa.Table:
        w = _Windows(table, window)
        order, begin, low = w.groups(w.candidates(answer, step, n))
        smaller, size = chunks.flags(answer, ROWS, w.a[order[begin]], n), np.diff(np.append(begin, len(order)))
        gone = np.zeros(len(w.a), bool)
        gone[order] = np.repeat(smaller, size) | (w.doc[order] > np.repeat(low, size))
        out, done = [], 0
        for ids, texts in chunks.slices(table):
            out.append(_cut(ids, texts, gone, done, window))
            done += len(out[-1][1])
        return pa.concat_tables([t for t, _ in out])

    first = chunks.merge(chunks.send(dealt, total, sketch), total, _add(step, n))
    second = chunks.merge(chunks.reply(dealt, first, total, exact, chunks.PACKED), total, _merge_windows)
    return chunks.reply(dealt, first.unionByName(second), total, finish, OUT)


def _cut(ids: list, texts: list[bytes], gone: np.ndarray, done: int, window: int) -> tuple[pa.Table, np.ndarray]:
    """The rows of a pack, of whose windows the first is number ``done`` of the chunk; and the windows' first words."""
    split = [t.split() for t in texts]
    count = np.fromiter(map(len, split), np.int64, len(split))
    first, doc = np.cumsum(count) - count, np.repeat(np.arange(len(split)), count)
    at = np.flatnonzero(doc[window - 1 :] == doc[: len(doc) - window + 1]) if len(doc) >= window else np.empty(0, np.int64)
    hit = at[gone[done : done + len(at)]]
    cover = np.zeros(len(doc) + 1, np.int32)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + window, -1)
    dead = np.cumsum(cover[:-1]) > 0
    removed = np.bincount(doc[dead], minlength=len(ids)) if len(dead) else np.zeros(len(ids), np.int64)
    kept = []
    for i, words in enumerate(split):
        if removed[i]:
            words = [w for w, d in zip(words, dead[first[i] : first[i] + len(words)].tolist()) if not d]
        kept.append(b" ".join(words))
    shas = [hashlib.sha256(k).hexdigest() for k in kept]
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": count, "n_removed": removed.astype(np.int64), "kept_sha256": pa.array(shas, pa.string()), "text": pa.array(kept, pa.binary()).cast(pa.string())}), at
