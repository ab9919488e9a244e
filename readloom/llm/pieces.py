"""SentencePiece encoding and decoding by suffix-array matching.

No piece of the vocabulary has a space mark after another character, so a text falls into units
that are encoded alone. The distinct new units of a batch are concatenated and indexed by a
suffix array as deep as the longest piece; every piece is binary-searched for its range of
occurrences; the edges so found are sorted by their end and relaxed from left to right. Where no edge crosses a border, the parts on both sides are found each alone.

Merging by rank has one valid segmentation of each prefix: its last piece is the one edge whose
piece may follow the last piece of the prefix before it. Two pieces may follow each other when no
merge across their border would have come before the merges that made them. Relaxing an edge is
that test; pairs are remembered.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, resident

MARK = "▁"
#: Units and piece pairs remembered by a task; places, as a power of two, of the pairs that are looked up all at once.
CACHE_UNITS, YOUNG_UNITS, CACHE_PAIRS, RECENT_PAIRS = 480_000, 70_000, 400_000, 19
#: Bytes of text encoded at once, and new units indexed at once.
BATCH_BYTES, NEW_UNITS = 1 << 20, 20_000
#: A character outside the vocabulary; it stands for its bytes and merges with nothing.
NONE = -1


class Vocabulary:
    """Pieces of a byte-fallback merge model, with their ranks."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        kind = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.of_byte = {i: b for b, i in self.byte.items()}
        self.silent = {i for i in range(n) if sp.is_control(i)}
        self.id = {self.text[i]: i for i in range(n) if not kind[i]}
        #: Merge order: higher scores first; equal scores are taken from left to right.
        self.rank = {t: -sp.get_score(i) for t, i in self.id.items()}
        self.deepest = max(map(len, self.id))
        if any(MARK in p.strip(MARK) for p in self.id) or any(p.rstrip(MARK) != p and p.strip(MARK) for p in self.id):
            raise ValueError("pieces of this model cross spaces")

    def merge(self, parts: list[str], border: int = 0) -> list[str] | None:
        """Plain merging of a sequence of symbols, the definition that segmentation follows.

        With a ``border`` between two of the symbols, None as soon as a merge crosses it.
        """
        rank, parts = self.rank, list(parts)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if at < 0:
                break
            if at == border - 1:
                return None
            border -= at < border
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, a: int, b: int) -> bool:
        """Whether encoding the joined text of two pieces gives these two pieces."""
        left, right = self.text[a], self.text[b]
        return self.merge(list(left + right), len(left)) == [left, right]


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of an array by their first ``depth`` entries, by doubling; suffixes that share these have any order."""
    n = len(codes)
    letter = np.unique(codes, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
    if n and int(letter.max()) < 1 << 16:  # four characters fit one key
        key, done = np.zeros(n + 4, np.uint64), 4
        for k in range(4):
            key[: n - k] |= letter[k:] << np.uint64(48 - 16 * k)
        key = key[:n]
    else:
        key, done = letter, 1
    order = np.argsort(key)
    k = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate(([1], (k[1:] != k[:-1]).astype(np.int64)))[:n])
    while done < depth:
        key = rank * (n + 1)
        key[:-done or None] += rank[done:] if done < n else 0
        order = np.argsort(key)
        k = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([1], (k[1:] != k[:-1]).astype(np.int64))))
        done *= 2
    return order


class _Kept(dict):
    """Units seen first, which are mostly the frequent ones, are kept; later ones pass through ``young``."""

    def __init__(self):
        self.young: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        return self.young[unit]


class Encoder:
    """Ids of texts. One per process; units and pairs once seen are looked up."""

    def __init__(self, path: str):
        v = self.vocabulary = Vocabulary(path)
        items = sorted((t, i) for t, i in v.id.items())
        self.pieces = np.array([i for _, i in items], np.int64)
        self.lengths = np.array([len(t) for t, _ in items], np.int64)
        self.codes = np.zeros((len(items), v.deepest), np.uint32)
        for k, (t, _) in enumerate(items):
            self.codes[k, : len(t)] = [ord(c) for c in t]
        self.units = _Kept()
        # A line feed outside the vocabulary merges with nothing, so units end there too.
        stop = "" if any("\n" in t for t in v.id) else "\n"
        self.cut = re.compile(f"{MARK}+[^{MARK}{stop}]*|[^{MARK}{stop}]+" + (f"|{stop}" if stop else "")).findall
        self.pairs: dict[int, bool] = {}
        #: Pairs, each at the place of its hash, with the answer in the lowest bit; what is pushed out is still in ``pairs``.
        self.recent = np.full(1 << RECENT_PAIRS, -1, np.int64)

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, piece) of every occurrence of every piece; code 0 separates units."""
        order = suffix_array(codes, self.vocabulary.deepest)
        padded = np.concatenate((codes, np.zeros(self.vocabulary.deepest, np.uint32)))
        low, high = np.zeros(len(self.pieces), np.int64), np.full(len(self.pieces), len(order), np.int64)
        for d in range(self.vocabulary.deepest):  # narrows the ranges of all pieces by one character
            live = np.flatnonzero((self.lengths > d) & (low < high))
            if not len(live):
                break
            column = padded[order + d]
            low[live], high[live] = _narrow(column, low[live], high[live], self.codes[live, d])
        count = high - low
        which = np.repeat(np.arange(len(self.pieces)), count)
        at = order[np.repeat(low, count) + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)]
        return at, at + self.lengths[which], self.pieces[which]

    def _segment(self, units: list[str]) -> dict[str, bytes]:
        """Ids of new units, found together."""
        found: dict[str, bytes] = {}
        keys, units = units, [u[1:] if u[:1] == "\0" else MARK + u for u in units]
        v, text = self.vocabulary, "\0".join(units) + "\0"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(u) for u in units], np.int64)
        base = np.cumsum(sizes + 1) - sizes - 1
        begin, end, piece = self.edges(codes)
        inside = np.ones(len(codes), bool)
        inside[base + sizes] = False
        one = np.zeros(len(codes), bool)
        one[begin[end == begin + 1]] = True
        lone = np.flatnonzero(inside & ~one)  # characters outside the vocabulary, zero among them
        begin, end, piece = np.concatenate((begin, lone)), np.concatenate((end, lone + 1)), np.concatenate((piece, np.full(len(lone), NONE)))
        # Nothing merges across a border that no piece crosses, so what lies between two such borders is found alone.
        long = end > begin + 1
        crossed = np.bincount(begin[long] + 1, minlength=len(codes) + 1) - np.bincount(end[long], minlength=len(codes) + 1)
        start = inside & (np.cumsum(crossed)[:-1] == 0)
        origin = np.flatnonzero(start)
        place = np.arange(len(codes)) - origin[np.maximum(np.cumsum(start) - 1, 0)] if len(origin) else np.zeros(len(codes), np.int64)
        stop = np.append(origin[1:], len(codes))
        stop = np.minimum(stop, np.repeat(base + sizes, np.bincount(np.searchsorted(base, origin, "right") - 1, minlength=len(units)))) if len(origin) else stop
        # By the place of their end; of edges with one end the longest comes first. Small keys are sorted digit by digit.
        most = int((end - begin).max(initial=0))
        key = place[end - 1] * (most + 1) + most - (end - begin)
        order = np.argsort(key.astype(np.uint16) if int(key.max(initial=0)) < 1 << 16 else key, kind="stable")
        begin, end, piece = begin[order], end[order], piece[order]
        step = np.searchsorted(place[end - 1], np.arange(int((stop - origin).max(initial=0)) + 1))
        last = np.full(len(codes) + 1, NONE - 1, np.int64)  # last piece of the prefix that ends here
        back = np.zeros(len(codes) + 1, np.int64)
        for x, y in zip(step, step[1:]):
            b, e, p = begin[x:y], end[x:y], piece[x:y]
            first = place[b] == 0
            before = np.where(first, NONE, last[b])
            good = first | (p == NONE) | (before == NONE) | self._may_follow(before, p)
            last[e[good]], back[e[good]] = p[good], b[good]
        at, live, walked = stop.copy(), np.arange(len(origin)), []
        while len(live):  # all parts at once, from their ends
            walked.append((live, last[at[live]]))
            at[live] = back[at[live]]
            live = live[at[live] > origin[live]]
        of, ids = (np.concatenate(c) for c in zip(*walked[::-1])) if walked else (np.empty(0, np.int64), np.empty(0, np.int64))
        order = np.argsort(of, kind="stable")
        of, ids = np.searchsorted(base, origin[of[order]], "right") - 1, ids[order]
        if (ids < NONE).any():
            raise AssertionError("a unit has no segmentation")
        data, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(np.bincount(of, minlength=len(units)))
        for u, x, y in zip(keys, np.concatenate(([0], ends[:-1])).tolist(), ends.tolist()):
            found[u] = data[x:y]
        for k in np.unique(of[ids == NONE]).tolist():
            found[keys[k]] = self._with_bytes(units[k], ids[(ends[k - 1] // 4 if k else 0) : ends[k] // 4].tolist())
        return found

    def _with_bytes(self, unit: str, ids: list[int]) -> bytes:
        """Ids of a unit, characters outside the vocabulary replaced by their bytes."""
        v, out, at = self.vocabulary, [], 0
        for p in ids:
            if p == NONE:
                out.extend(v.byte[x] for x in unit[at].encode("utf-8", "replace"))
                at += 1
            else:
                out.append(p)
                at += len(v.text[p])
        return np.array(out, "<u4").tobytes()

    def _may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces may follow others; what is no piece follows none and is followed by none."""
        out = np.zeros(len(a), bool)
        real = np.flatnonzero((a >= 0) & (b >= 0))
        key = (a[real] << 32) | b[real]
        place = (key.view(np.uint64) * kernel.MIX_1 >> np.uint64(64 - RECENT_PAIRS)).view(np.int64)
        held = self.recent[place]
        answer = (held & 1).astype(bool)
        other = np.flatnonzero(held >> 1 != key)
        if len(other):
            unique, first, inverse = np.unique(key[other], return_index=True, return_inverse=True)
            known = self.pairs
            if len(known) > CACHE_PAIRS:
                known.clear()
            found = np.zeros(len(unique), bool)
            for i, k in enumerate(unique.tolist()):
                got = known.get(k)
                if got is None:
                    got = known[k] = self.vocabulary.follows(k >> 32, k & 0xFFFFFFFF)
                found[i] = got
            answer[other] = found[inverse]
            self.recent[place[other[first]]] = unique << 1 | found
        out[real] = answer
        return out

    def _units(self, text: str) -> list[str]:
        """Units of a text: a word stands for itself with one space mark before it, other units follow a zero."""
        if not text:
            return []
        if text[0] != " " and "  " not in text and MARK not in text and "\0" not in text:
            return text.split(" ")
        units = self.cut(MARK + text.replace(" ", MARK))
        return [u[1:] if u[0] == MARK and u[1:2] not in (MARK, "\0") else "\0" + u for u in units]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self._units(t) for t in texts]
        kept, young = self.units, self.units.young
        every = set().union(*split)
        if len(young) > YOUNG_UNITS:
            young.clear()
        new = [u for u in every if u not in kept and u not in young]
        for x in range(0, len(new), NEW_UNITS):
            got = self._segment(new[x : x + NEW_UNITS])
            room = max(0, CACHE_UNITS - len(kept))
            some = iter(got.items())
            kept.update(itertools.islice(some, room))
            young.update(some)
            resident.trim()
        return [np.frombuffer(b"".join(map(kept.__getitem__, units)), "<u4") for units in split]


def encoder(path: str) -> Encoder:
    """The encoder of this process, with what it has learnt in earlier tasks."""
    return resident.hold(("pieces", path), lambda: Encoder(path))


def _narrow(column: np.ndarray, low: np.ndarray, high: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search, in each sorted range of a column, for the part that holds a code."""
    out = []
    for before in (np.less, np.less_equal):
        a, b = low.copy(), high.copy()
        while (open_ := a < b).any():
            mid = (a + b) // 2
            go = open_ & before(column[np.minimum(mid, len(column) - 1)], code)
            a, b = np.where(go, mid + 1, a), np.where(open_ & ~go, mid, b)
        out.append(a)
    return out[0], out[1]


class Decoder:
    """Texts of ids."""

    def __init__(self, model: str | Vocabulary):
        v = model if isinstance(model, Vocabulary) else Vocabulary(model)
        self.raw = [b"" if i in v.silent else bytes([v.of_byte[i]]) if i in v.of_byte else t.replace(MARK, " ").encode() for i, t in enumerate(v.text)]

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        data = b"".join([raw[i] for i in ids.tolist()])
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _slices(b: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of a batch, so many rows at a time that they hold few characters; only these texts are Python's."""
    column = b.column("text")
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    at = size = 0
    for i, n in enumerate([*sizes.tolist(), None]):
        if n is None or size and size + n > BATCH_BYTES:
            if at < i:
                yield b.column("doc_id")[at:i], [t or "" for t in column[at:i].to_pylist()]
            at, size = i, 0
        size += n or 0


def encode(docs: DataFrame, model: str) -> DataFrame:
    """Piece ids of every whole text: doc_id, ids.

    Takes ``doc_id`` and ``text`` of ``docs``; other columns are ignored. A null or empty text has no
    ids; repeated rows give equal rows; null ids are passed on; an empty table gives no rows. ``model``
    is a file of the sentencepiece library at the same place on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        learnt = encoder(model)
        for b in batches:
            for keys, texts in _slices(b):
                ids = learnt.encode(texts)
                ends = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
                flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32))
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Texts of piece ids: doc_id, n_pieces, ids_crc32 (of the ids as 32-bit little-endian integers), text.

    Null ids, or none, give an empty text; repeated rows give equal rows; null doc_ids are passed on; other
    columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        decoder = Decoder(model)
        for b in batches:
            for x in range(0, b.num_rows, 256):
                part = b.slice(x, 256)
                ids = [np.asarray(i.values if i.is_valid else [], np.uint32) for i in part.column("ids")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()), pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()), pa.array([decoder.decode(i) for i in ids], pa.string())], names=["doc_id", "n_pieces", "ids_crc32", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, text string")


def round_trip(docs: DataFrame, model: str, with_text: bool = True) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_pieces, ids_crc32, n_chars and text_sha256 of what came back, round_trip, ids, text.

    The text itself is left out where it is not wanted, so that it is not sent back from the workers.     ``round_trip`` is whether decoding gives the text again; a null text counts as empty. Texts that hold
    the space mark itself come back with spaces in its place. Null ids are passed on; repeated rows give
    equal rows; an empty table gives no rows.
    """
    schema = "doc_id long, n_pieces long, ids_crc32 long, n_chars long, text_sha256 string, round_trip boolean, ids array<int>" + ", text string" * with_text

    def run(batches: Iterator[pa.RecordBatch]):
        learnt = encoder(model)
        decoder = Decoder(learnt.vocabulary)
        for b in batches:
            for keys, texts in _slices(b):
                ids = learnt.encode(texts)
                back = [decoder.decode(i) for i in ids]
                ends = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
                flat = pa.array(np.concatenate(ids).astype(np.int32))
                columns = [keys, pa.array([len(i) for i in ids], pa.int64()), pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()), pa.array([len(t) for t in back], pa.int64())]
                columns += [pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]), pa.array([t == o for t, o in zip(back, texts)]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), *([pa.array(back, pa.string())] if with_text else [])]
                del back, ids, flat, texts
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_pieces", "ids_crc32", "n_chars", "text_sha256", "round_trip", "ids", *(["text"] if with_text else [])])
                del columns
                resident.trim()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
