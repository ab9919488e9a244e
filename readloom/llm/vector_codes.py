"""Vector code compression: codebooks by Lloyd's rounds over cover trees that stay where their vectors are.

Vectors become integers and are cut into parts. Each task builds, once, a cover tree per part position over its chunk of
vectors; the trees are written. A round sends the codebooks (a few kilobytes) to all chunks, which assign whole subtrees
where the triangle inequality allows it, and gets back sums and counts of each entry. All arithmetic is exact.
"""

from __future__ import annotations

import hashlib
import pickle
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .cover_tree import CoverTree, exact, squares

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components of one chunk of vectors, and the fewest vectors.
CELLS, LEAST = 1 << 19, 16
#: Scaled components beyond this, which no sum in 38 digits could hold, count as this.
HUGE = 1e27
LONG = (1 << 63) - 1
_CODES = "vec_id long, label long, code string, error long"


def _integers(vectors: list[list[float]], width: int, scale: int) -> np.ndarray:
    """Scaled and floored components; vectors shorter than ``width`` go on with zeros."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return exact(np.floor(np.clip(out * scale, -HUGE, HUGE)))


def kept(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and vector of the rows whose vector is there, with all components finite."""
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["label"].cast("long").alias("label"), embeddings["embedding"].cast("array<double>").alias("vector"))
    wrong = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vector").isNotNull() & ~wrong)


def _chunks(rows: DataFrame, width: int, parts: int, scale: int) -> DataFrame:
    """Chunks of vectors with a cover tree for each part position, as a written table."""
    size, step = max(LEAST, CELLS // max(width, 1)), width // parts

    def packed(ids, labels, vectors):
        whole = _integers(vectors, width, scale)
        trees = [pickle.dumps(CoverTree(exact(whole[:, k * step : (k + 1) * step]))) for k in range(parts)]
        values = [pa.array([x], t) for x, t in ((ids, pa.list_(pa.int64())), (labels, pa.list_(pa.int64())), (trees, pa.list_(pa.binary())))]
        return pa.RecordBatch.from_arrays(values, names=["ids", "labels", "trees"])

    def run(batches):
        ids, labels, vectors = [], [], []
        for b in batches:
            for begin in range(0, b.num_rows, size):
                c = b.slice(begin, size).to_pydict()
                ids, labels, vectors = ids + c["vec_id"], labels + c["label"], vectors + c["vector"]
                if len(ids) >= size:
                    yield packed(ids[:size], labels[:size], vectors[:size])
                    ids, labels, vectors = ids[size:], labels[size:], vectors[size:]
        if ids:
            yield packed(ids, labels, vectors)

    return shared.table(rows.mapInArrow(run, "ids array<long>, labels array<long>, trees array<binary>"), "vectors")


def _round(chunks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: entries become the floored mean of what falls to them."""

    def totals(batches):
        sums = [np.zeros(book.shape, object) for book in books]
        counts = [np.zeros(len(book), object) for book in books]
        for b in batches:
            for trees in b.column("trees").to_pylist():
                for k, tree in enumerate(trees):
                    _, s, n = pickle.loads(tree).assign(books[k])
                    sums[k] += s
                    counts[k] += n
        rows = [(k, e, i, Decimal(int(x))) for k in range(len(books)) for e in range(len(books[k])) if counts[k][e] for i, x in enumerate([counts[k][e], *sums[k][e]])]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "entry", "place", "total"])

    # At most parts x entries x (1 + components of a part) rows: these come to the driver.
    found = chunks.select("trees").mapInArrow(totals, "part int, entry int, place int, total decimal(38,0)").groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect()
    total = {(r.part, r.entry, r.place): int(r.total) for r in found}
    return [exact(np.array([[total[k, e, i + 1] // total[k, e, 0] if (k, e, 0) in total else int(x) for i, x in enumerate(entry)] for e, entry in enumerate(book)], object).reshape(book.shape)) for k, book in enumerate(books)]


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of vectors, and the codebooks: for each part position an array of entries.

    Takes ``vec_id``, ``label`` and ``embedding``; other columns, of any name, are ignored. Rows whose vector is null or
    has a null or non-finite component are left out. Vectors are meant to have one length that ``parts`` divides;
    shorter ones count as filled with zeros, to the longest rounded up; empty ones are zeros. The first codebooks are
    the parts of the ``entries`` vectors of smallest vec_id (equal ids by vector, null ids last); fewer vectors make
    fewer entries. Each of the ``rounds`` assigns all parts to their nearest entries, ties to the lower index, and
    replaces entries by floored means; unused ones stay. Repeated rows are coded alike. An empty table gives no rows.

    Gives (vec_id, label, code, error): two hex digits a part, and the squared distances summed (no more than a long holds).
    """
    rows = kept(embeddings)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width, step = -(-longest // parts) * parts, -(-longest // parts)
    chunks = _chunks(rows, width, parts, scale)
    start = _integers([r.vector for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()], width, scale)
    books = [exact(start[:, k * step : (k + 1) * step]) for k in range(parts)]
    for _ in range(rounds):
        books = _round(chunks, books)

    def codes(batches):
        for b in batches:
            for ids, labels, trees in zip(*(b.column(c).to_pylist() for c in ("ids", "labels", "trees"))):
                error, digits = np.zeros(len(ids), object), []
                for book, data in zip(books, trees):
                    tree = pickle.loads(data)
                    own, _, _ = tree.assign(book)
                    error += squares(tree.points, book[own]).astype(object)[tree.of]
                    digits.append([f"{x:02x}" for x in own[tree.of].tolist()])
                columns = [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(map("".join, zip(*digits)), pa.string()), pa.array([min(e, LONG) for e in error.tolist()], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return chunks.mapInArrow(codes, _CODES), books


def with_label_error(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Codes with the error summed over equal labels (nulls together), and the digest of the codebooks."""
    coded = shared.table(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(str(int(x)) for book in books for entry in book for x in entry).encode()).hexdigest()
    joined = coded.join(sums, coded["label"].eqNullSafe(sums["of"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
