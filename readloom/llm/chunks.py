"""Exchange between chunks of documents and shards of a key space.

A chunk is a run of documents of one task, up to a number of bytes; a shard holds the keys of a part of
the key space for many chunks. A chunk sends each shard what it holds of that shard's keys, one packed row
per (chunk, shard); the shard merges what all chunks sent and answers every chunk in the order of the keys
it sent. A key costs at most one entry per chunk however many rows share it, rows never outnumber keys, and
no task holds more than its chunk or its shard. Chunks are written once, so a lost executor costs a reread
and every pass sees the same chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, resident, shared

#: Bytes of text in a chunk, and in one of the packs that it is stored in, which are looked at one at a time.
CHUNK_BYTES, PACK_BYTES = 8 << 20, 2 << 20
#: Bytes of text for each partition of an exchange, of which a task looks at a chunk or shard at a time.
TASK_BYTES = 128 << 20
PACKS = "chunk long, pack int, size long, data binary, rest binary"
PACKED = "tag int, chunk long, shard int, data binary"
PACKED_ARROW = pa.schema([("tag", pa.int32()), ("chunk", pa.int64()), ("shard", pa.int32()), ("data", pa.binary())])


def _pack(ids: list, texts: list[bytes]) -> bytes:
    null = np.array([i is None for i in ids], np.uint8)
    head = np.array([len(ids)], "<u4").tobytes() + np.array([i or 0 for i in ids], "<i8").tobytes() + null.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + np.array([len(t) for t in texts], "<u8").tobytes() + b"".join(texts))


def _unpack(data: bytes) -> tuple[list, list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ids, null = np.frombuffer(raw, "<i8", n, 4).tolist(), np.frombuffer(raw, np.uint8, n, 4 + 8 * n).tolist()
    ends = np.cumsum(np.frombuffer(raw, "<u8", n, 4 + 9 * n)).astype(np.int64) + 4 + 17 * n
    begins = np.concatenate(([4 + 17 * n], ends[:-1])).tolist() if n else []
    return [None if x else i for i, x in zip(ids, null)], [raw[b:e] for b, e in zip(begins, ends.tolist())]


def _freeze(slices: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, slices[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for b in slices:
            out.write_batch(b)
    return sink.getvalue().to_pybytes()


def rest(data: bytes) -> pa.Table:
    """The other columns of a pack's rows."""
    return pa.ipc.open_stream(data).read_all()


def deal(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, pack_bytes: int = PACK_BYTES, carry: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Chunks of (doc_id, text) as written packs, with columns to ``carry`` beside them, and the bytes of all texts."""
    pack_bytes = min(pack_bytes, chunk_bytes)

    def run(batches: Iterator[pa.RecordBatch]):
        chunk, pack, size, inside = TaskContext.get().partitionId() << 32, 0, 0, 0
        ids: list = []
        texts: list[bytes] = []
        others: list[pa.RecordBatch] = []

        def flush():
            nonlocal pack, size
            values = [[chunk], [pack], [size], [_pack(ids, texts)], [_freeze(others) if carry else None]]
            row = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["chunk", "pack", "size", "data", "rest"])
            pack, size = pack + 1, 0
            for held in (ids, texts, others):
                held.clear()
            return row

        for b in batches:
            other, begin = b.select([f"_{i}" for i in range(len(carry))]), 0
            for k, (i, t) in enumerate(zip(b.column("_id").to_pylist(), b.column("_text").cast(pa.binary()))):
                t = t.as_py() or b""
                full = bool(inside) and inside + len(t) > chunk_bytes
                if ids and (full or size + len(t) > pack_bytes):
                    others.append(other.slice(begin, k - begin))
                    begin = k
                    yield flush()
                if full:
                    chunk, pack, inside = chunk + 1, 0, 0
                ids.append(i)
                texts.append(t)
                size, inside = size + len(t), inside + len(t)
            others.append(other.slice(begin))
        if ids:
            yield flush()

    columns = [docs[c].alias(f"_{i}") for i, c in enumerate(carry)]
    rows = docs.select(docs["doc_id"].cast("long").alias("_id"), docs["text"].cast("string").alias("_text"), *columns)
    dealt = shared.table(rows.mapInArrow(run, PACKS), "chunks")
    return dealt, int(dealt.agg(F.sum("size")).first()[0] or 0)


def shards(dealt: DataFrame, total: int, shard_bytes: int) -> int:
    """Shards of a key space: as many as the texts fill, or as there are partitions where that is more and the texts are not few."""
    wide = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-total // shard_bytes), min(wide, total // PACK_BYTES))


def slices(table: pa.Table) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of a chunk, pack by pack in their order."""
    resident.drop()
    for i in order(table):
        yield _unpack(table.column("data")[i].as_py())


def order(table: pa.Table) -> list[int]:
    """The packs of a chunk in their order."""
    number = table.column("pack").to_pylist()
    return sorted(range(len(number)), key=number.__getitem__)


def _wide(frame: DataFrame, total: int, key: str) -> DataFrame:
    """Rows dealt by a key over more partitions than the session's where the texts are many, so that a task's share stays the same."""
    parts = total // TASK_BYTES
    return frame.repartition(parts, key) if parts > int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")) else frame


def packed(out: list[tuple[int, int, int, bytes]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ([],) * 4, PACKED_ARROW.types)], schema=PACKED_ARROW)


def cuts(keys: np.ndarray, n: int) -> np.ndarray:
    """Where the shards 0..n begin and the last one ends in sorted 64-bit keys."""
    return np.append(np.searchsorted(keys, np.array([-(-(s << 64) // n) for s in range(n)], np.uint64)) if n > 1 else np.zeros(1, np.int64), len(keys))


def parts(keys: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(shard, begin, end) of the shards that sorted 64-bit keys belong to."""
    cut = cuts(keys, n)
    some = np.flatnonzero(np.diff(cut))
    return list(zip(some.tolist(), cut[some].tolist(), cut[some + 1].tolist()))


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps in units of 1, 2 or 4 bytes; a unit of ones alone says that the gap goes on."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    full = {w: (1 << 8 * w) - 1 for w in (1, 2, 4)}
    wide = min(full, key=lambda w: w * (len(gaps) + int((gaps // np.uint64(full[w])).sum())))
    more = (gaps // np.uint64(full[wide])).astype(np.int64)
    ends = np.cumsum(more + 1)
    out = np.full(ends[-1] if len(ends) else 0, full[wide], f"<u{wide}")
    out[ends - 1] = gaps % np.uint64(full[wide])
    return bytes([wide]) + out.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, f"<u{data[0]}", offset=1)
    return np.cumsum(steps, dtype=np.uint64)[steps != np.iinfo(steps.dtype).max]


def answers(table: pa.Table, tag: int) -> dict[int, bytes]:
    """What the shards answered under a tag, by shard."""
    return {s: d for t, s, d in zip(*(table.column(c).to_pylist() for c in ("tag", "shard", "data"))) if t == tag}


def flags(answer: pa.Table, tag: int, keys: np.ndarray, n: int, size: np.ndarray | None = None) -> np.ndarray:
    """Answered bits in the order of the sorted keys that were sent, one for each or ``size`` of them."""
    got = answers(answer, tag)
    found = [kernel.unbits(got[s], y - x if size is None else int(size[x:y].sum())) for s, x, y in parts(keys, n)]
    return np.concatenate(found) if found else np.empty(0, bool)


def send(dealt: DataFrame, total: int, f) -> DataFrame:
    return _wide(dealt, total, "chunk").groupBy("chunk").applyInArrow(f, PACKED)


def merge(sent: DataFrame, total: int, f) -> DataFrame:
    """``f`` gets a shard's number and [(tag, chunk, data)] in order, and gives [(tag, chunk, answer)]."""

    def shard(table: pa.Table) -> pa.Table:
        resident.drop()
        got = sorted(zip(*(table.column(c).to_pylist() for c in ("tag", "chunk", "data"))))
        s = table.column("shard")[0].as_py()
        return packed([(t, c, s, d) for t, c, d in f(s, got)])

    return _wide(sent, total, "shard").groupBy("shard").applyInArrow(shard, PACKED)


def reply(dealt: DataFrame, answered: DataFrame, total: int, f, schema: str) -> DataFrame:
    """``f`` gets the packs of a chunk and the shards' answers to it."""
    return _wide(dealt, total, "chunk").groupBy("chunk").cogroup(_wide(answered, total, "chunk").groupBy("chunk")).applyInArrow(f, schema)
