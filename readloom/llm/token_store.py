"""Token-id output: binary segments of documents, each compressed on its own with one shared dictionary.

A store is a folder with ``segments`` and ``dictionary`` (Parquet as the carrier, so any store that
Spark reaches will do). A segment is one binary value:

    magic "RLTK", version u8, id width u8, zero u16, documents u32, sha-256 of the dictionary,
    index of (doc_id i64, offset u64, tokens u32, flags u32) per document and a last offset,
    then the frames, one Zstandard frame per document.

Segments hold documents in ascending doc_id order; ``part`` and ``segment`` order them, ``base`` is
the number of ids before the segment in its part. A document is read from its frame alone.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import resident

MAGIC, VERSION, END_ID = b"RLTK", 1, 0
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("tokens", "<u4"), ("flags", "<u4")])
HEAD = "<4sBBHI32s"
NO_ID = 1
SEGMENT_BYTES = 4 << 20
#: Documents from which the dictionary is trained (smallest hashes of doc_id and text), ids taken of each, dictionary bytes.
SAMPLE_DOCS, SAMPLE_IDS, DICT_BYTES = 1000, 4096, 64 << 10
CACHE_ENTRIES, YOUNG_ENTRIES = 500_000, 80_000
#: Letters and numbers among the characters of PLAIN.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
#: Pre-tokenisation of byte-level BPE for such texts: a fixed pattern of the public vocabulary, classes written out.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\t\n\r {LETTERS}{NUMBERS}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
#: Characters outside these take the tokenizer's own path: Unicode tables of two libraries may differ there.
PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")


class _Kept(dict):
    """Pieces seen first, which are mostly the frequent ones, are kept; later ones pass through ``young``. A piece in neither is made."""

    def __init__(self, make: Callable[[str], bytes]):
        self.young: dict[str, bytes] = {}
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        young = self.young
        found = young.get(piece)
        if found is None:
            found = self.make(piece)
            if len(self) < CACHE_ENTRIES:
                self[piece] = found
            else:
                if len(young) >= YOUNG_ENTRIES:
                    young.clear()
                young[piece] = found
        return found


def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable ones stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Encoder:
    """Ids of texts by the tokenizers library; pieces of the pre-tokenisation go to its model once and are then looked up.

    The pieces are cut here only where the tokenizer's file asks for plain byte-level BPE; texts go
    through the library whole where it asks for anything else.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # an executor's cores have their own tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))).search if added else None
        self.split = re.compile(PATTERN).findall
        self.model, self.letters = self.tokenizer.model, byte_letters()
        with open(path, encoding="utf-8") as f:
            self.plain = _is_plain(json.load(f))
        self.kept = _Kept(self._piece)

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece by the library's model alone."""
        return array("I", [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]).tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        return [self._piece(p) for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        kept, out = self.kept.__getitem__, []
        for t in texts:
            if t and (not self.plain or PLAIN.search(t) or self.special and self.special(t)):
                out.append(self._direct([t])[0])
            else:
                out.append(b"".join(map(kept, self.split(t))))
        return out


def _is_plain(file: dict) -> bool:
    """Whether a tokenizer file asks for byte-level BPE with the usual cutting, and nothing before or after it."""
    cut, model = file.get("pre_tokenizer") or {}, file["model"]
    usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    bare = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    return usual and bare and model.get("type") == "BPE" and not any(file.get(k) for k in ("normalizer", "post_processor", "truncation", "padding"))


def encoder(path: str) -> Encoder:
    """The encoder of this process, with what it has looked up in earlier tasks."""
    return resident.hold(("tokens", path), lambda: Encoder(path))


def _width(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(True) <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, path: str, width: int) -> bytes:
    """A Zstandard dictionary from the serialized ids of a bounded sample: the first SAMPLE_IDS ids of SAMPLE_DOCS documents.

    The sample is encoded in tasks; what reaches the driver is bounded. Too few samples to train on serve
    as the dictionary themselves; a dictionary only changes how small the frames are.
    """
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("h"), "text")
    least = keyed.select("h").orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if least is None:
        return b""

    def run(batches):
        look_up = encoder(path)
        for b in batches:
            ids = look_up.encode([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("h"), pa.array([_narrow(i[: 4 * SAMPLE_IDS], width) for i in ids], pa.binary())], names=["h", "ids"])

    # Rows that repeat both id and text have one hash: they are one sample.
    few = keyed.where(F.col("h") <= least).dropDuplicates(["h"]).mapInArrow(run, "h long, ids binary")
    samples = [bytes(r.ids) for r in sorted(few.collect()) if r.ids]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICT_BYTES]


def _narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def _encode(path: str, dictionary: bytes, width: int):
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("tokens", pa.int64()), ("frame", pa.binary())])

    def run(batches):
        look_up = encoder(path)
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=False)
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            for x in range(0, b.num_rows, 512):
                part = b.slice(x, 512)
                ids = [i + end for i in look_up.encode([t or "" for t in part.column("text").to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column("part"), part.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([pack.compress(_narrow(i, width)) for i in ids], pa.binary())], schema=schema)

    return run, "part int, doc_id long, tokens long, frame binary"


def _segments(dictionary: bytes, width: int):
    digest = hashlib.sha256(dictionary).digest()
    schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()), ("base", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("dictionary", pa.string()), ("data", pa.binary())])

    def run(batches):
        now, number, base, size = None, 0, 0, 0
        held: list[tuple] = []

        def flush():
            nonlocal number, base, size
            index = np.zeros(len(held) + 1, INDEX)
            index["offset"][1:] = np.cumsum([len(f) for _, _, f in held])
            index["doc_id"][:-1] = [i or 0 for i, _, _ in held]
            index["tokens"][:-1] = [t for _, t, _ in held]
            index["flags"][:-1] = [NO_ID * (i is None) for i, _, _ in held]
            data = struct.pack(HEAD, MAGIC, VERSION, width, 0, len(held), digest) + index.tobytes() + b"".join(f for _, _, f in held)
            tokens, ids = sum(t for _, t, _ in held), [i for i, _, _ in held if i is not None]
            row = [now, number, len(held), tokens, base, min(ids, default=None), max(ids, default=None), digest.hex(), data]
            number, base, size = number + 1, base + tokens, 0
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for b in batches:
            for part, doc, tokens, frame in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "tokens", "frame"))):
                if held and (part != now or size > SEGMENT_BYTES):
                    yield flush()
                if part != now:
                    now, number, base = part, 0, 0
                held.append((doc, tokens, frame))
                size += len(frame)
        if held:
            yield flush()

    return run, "part int, segment int, docs long, tokens long, base long, first_id long, last_id long, dictionary string, data binary"


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode every whole text, end each document with id 0 and write the store to ``path``.

    Takes ``doc_id`` and ``text``; other columns are ignored. A null text is the end id alone. Rows
    without doc_id come last, rows that repeat a doc_id stand side by side in the order of their texts'
    frames; rows that repeat both are stored each. An empty table gives a store without segments. ``tokenizer`` is a file of the tokenizers
    library at the same place on every executor.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    width = _width(tokenizer)
    dictionary = train_dictionary(docs, tokenizer, width)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted({int(x) for x in docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)}) if parts > 1 else []
    # Parts by ranges of ids, then as many again for rows without one, spread by their texts.
    without = F.lit(len(cuts) + 1) + F.pmod(F.xxhash64("text"), F.lit(parts))
    ranged = F.expr(f"aggregate(array({','.join(f'{c}L' for c in cuts)}), 0, (n, c) -> n + int(doc_id > c))") if cuts else F.lit(0)
    place = F.when(F.col("doc_id").isNull(), without).otherwise(ranged)
    run, schema = _encode(tokenizer, dictionary, width)
    encoded = docs.withColumn("part", place.cast("int")).mapInArrow(run, schema)
    # The part is the partition, so no partition is empty while another has several parts.
    ordered = encoded.repartitionById(parts, F.col("part") % parts).sortWithinPartitions("part", F.asc_nulls_last("doc_id"), "frame")
    run, schema = _segments(dictionary, width)
    ordered.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(f"{path}/segments")
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), dictionary)], "dictionary string, data binary").coalesce(1).write.parquet(f"{path}/dictionary")


def open_segment(data: bytes) -> tuple[int, str, np.ndarray, int]:
    """Width of an id, dictionary hash, index and begin of the frames."""
    magic, version, width, _, n, digest = struct.unpack_from(HEAD, data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token segment of this version")
    return width, digest.hex(), np.frombuffer(data, INDEX, n + 1, struct.calcsize(HEAD)), struct.calcsize(HEAD) + (n + 1) * INDEX.itemsize


def frame_ids(data: bytes, index: np.ndarray, origin: int, i: int, width: int, unpack) -> np.ndarray:
    """Ids of document ``i`` of a segment, from its frame alone."""
    raw = unpack.decompress(data[origin + int(index["offset"][i]) : origin + int(index["offset"][i + 1])])
    return np.frombuffer(raw, f"<u{width}").astype("<u4")


def read(spark: SparkSession, path: str, ids: bool = True, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of a store: doc_id, start, n_tokens, ids_crc32 and, unless ``ids`` is false, the ids.

    One row per row that was written: a null text has the end id alone, rows without doc_id come back
    with a null and stand after all others, repeated rows come back each; an empty store gives no rows.
    ``doc_ids`` reads those documents only: other segments are not read, other frames not decompressed.
    """
    known = {r.dictionary: bytes(r.data) for r in spark.read.parquet(f"{path}/dictionary").collect()}
    segments = spark.read.parquet(f"{path}/segments")
    totals = {r.part: r.tokens for r in segments.groupBy("part").agg(F.sum("tokens").alias("tokens")).collect()}  # a row per part
    start, starts = 0, {}
    for part in sorted(totals):
        starts[part], start = start, start + totals[part]
    wanted = None if doc_ids is None else np.unique(np.array(doc_ids, np.int64))
    if wanted is not None:
        keep = F.lit(False)
        for d in wanted.tolist():
            keep = keep | (F.col("first_id") <= d) & (F.col("last_id") >= d)
        segments = segments.where(keep)
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * ids
    schema = pa.schema(fields)

    def run(batches):
        unpack = {k: zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d) if d else None) for k, d in known.items()}
        for b in batches:
            for part, base, data in zip(*(b.column(c).to_pylist() for c in ("part", "base", "data"))):
                width, digest, index, origin = open_segment(data)
                at = starts[part] + base + np.cumsum(index["tokens"]) - index["tokens"]
                n = len(index) - 1
                picked = range(n) if wanted is None else np.flatnonzero(np.isin(index["doc_id"][:n], wanted) & (index["flags"][:n] == 0)).tolist()
                for x in range(0, len(picked), 512):
                    some = picked[x : x + 512]
                    got = [frame_ids(data, index, origin, i, width, unpack[digest]) for i in some]
                    out = [[None if index["flags"][i] & NO_ID else int(index["doc_id"][i]) for i in some], [int(at[i]) for i in some], [len(g) for g in got], [zlib.crc32(g.tobytes()) for g in got]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out + [got] * ids, schema)], schema=schema)

    return segments.select("part", "base", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)
