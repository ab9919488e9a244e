"""Quality rules: a few counts per document, and a calibrated classifier.

The classifier is a logistic regression on hashed word and character n-gram frequencies, trained
on labelled quality rows and calibrated on held-out ones; its probability is held against a
fixed threshold. Documents are scored in Arrow batches, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, resident, shared
from .ngram_join import _batches

#: Hashed features: one half for words and word pairs, one for character 2- and 3-grams.
BITS = 16
#: Labelled rows that the classifier is fitted on at most (smallest hashes of doc_id); a quarter calibrates.
SAMPLE_ROWS, HELD_OUT = 3000, 4
SCALE, RIDGE, STEPS, RATE = 20.0, 1e-4, 150, 0.3
#: Base rules: fewest words, and largest percentage of words in repeated three-word windows.
FEWEST, REPEATED = 50, 50
#: A document is kept when its probability of good quality is at least this.
THRESHOLD = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUT = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, probability double, kept boolean"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Model:
    """Weights of the features, bias, and slope and offset of the calibration."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -35, 35)))


class Batch:
    """Words and characters of some documents."""

    def __init__(self, texts: list[bytes]):
        self.texts, self.words = texts, kernel.Words(texts)
        decoded = [t.decode("utf-8", "replace") for t in texts]
        lengths = np.fromiter(map(len, decoded), np.int64, len(texts))
        #: Characters of all documents, a separator after each.
        self.chars = np.frombuffer((" ".join(decoded) + " ").encode("utf-32-le"), np.uint32)
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths


def _features(b: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document and feature of word n-grams; feature of the character 2-gram and 3-gram at each character."""
    half = 1 << (BITS - 1)
    w = b.words
    one, at = w.hashes(), w.windows(2)
    words = np.concatenate((one, w.window_hashes(at, 2))) >> np.uint64(64 - BITS + 1)
    docs = np.concatenate((w.doc, w.doc[at]))
    c = b.chars.astype(np.uint64)
    pair = c[:-1] | c[1:] << np.uint64(21)
    third = np.append(c[2:], np.uint64(32))
    third[b.end - 1] = 32  # a separator follows the document's own, not the next document
    three = pair | third << np.uint64(42)
    spread = lambda x, salt: ((x * kernel.MIX_1 + np.uint64(salt)) * kernel.MIX_2 >> np.uint64(64 - BITS + 1)).astype(np.int32) + half
    return docs, words.astype(np.int32), spread(pair, 1), spread(three, 2)


def _means(b: Batch, values: np.ndarray) -> np.ndarray:
    """Mean per document of values given per character, added up within the document alone."""
    inside = np.append(values.astype(np.float64), 0.0)
    inside[b.end] = 0
    return np.add.reduceat(inside, b.start) / np.maximum(1, b.end - b.start)


def margins(b: Batch, weights: np.ndarray) -> np.ndarray:
    """Linear score of each document without bias: mean weight over its words' and over its characters' features."""
    docs, words, pair, three = _features(b)
    n = len(b.texts)
    per_word = np.bincount(docs, weights[words], n) / np.maximum(1, np.bincount(docs, minlength=n))
    return SCALE * (per_word + _means(b, weights[pair] + weights[three]) / 2)


def vectors(b: Batch) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and their values of each document, as ``margins`` weighs them."""
    docs, words, pair, three = _features(b)
    out = []
    order = np.argsort(docs, kind="stable")
    ends = np.searchsorted(docs[order], np.arange(len(b.texts) + 1))
    for d, (x, y) in enumerate(zip(b.start.tolist(), b.end.tolist())):
        own = words[order[ends[d] : ends[d + 1]]]
        idx = np.concatenate((own, pair[x:y], three[x:y]))
        val = np.concatenate((np.full(len(own), SCALE / max(1, len(own))), np.full(len(idx) - len(own), SCALE / (2 * max(1, y - x)))))
        unique, inverse = np.unique(idx, return_inverse=True)
        out.append((unique, np.bincount(inverse, val, len(unique)).astype(np.float32)))
    return out


def counts(texts: list[bytes], w: kernel.Words) -> dict[str, np.ndarray]:
    """The base rule's counts; words are told apart by 128 bits of a cryptographic hash."""
    b = kernel.Bytes(texts)
    total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[np.stack((b.doc_start, b.doc_end))], axis=0)[0]
    inside = ~kernel.SPACE[b.bytes] & ((b.bytes & 0xC0) != 0x80)
    dup = []
    for t in texts:
        seen, n = set(), 0
        for line in t.split(b"\n"):
            if line in seen:
                n += 1
            elif line.strip():
                seen.add(line)
        dup.append(n)
    at = w.windows(3)
    repeat = np.zeros(len(texts), np.int64)
    if len(at):
        x, y, doc = w.window_hashes(at, 3), w.window_hashes(at, 3, 1), w.doc[at]
        order = np.lexsort((y, x, doc))
        d, x, y = doc[order], x[order], y[order]
        same = (d[1:] == d[:-1]) & (x[1:] == x[:-1]) & (y[1:] == y[:-1])
        many = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        hit = at[order[many]]
        cover = np.zeros(len(w.doc) + 1, np.int32)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + 3, -1)
        repeat = np.bincount(w.doc[np.cumsum(cover[:-1]) > 0], minlength=len(repeat))
    return dict(zip(COUNTS, (w.count, total(inside), total(_SYMBOL[b.bytes]), np.array(dup, np.int64), repeat)))


def fit(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, held: np.ndarray) -> Model | None:
    """Logistic regression by accelerated gradient steps on the rows not held out, then Platt scaling on the others."""
    fitted = [i for i in range(len(y)) if not held[i]]
    if len(set(y[fitted].tolist())) < 2:
        return None
    idx, val = np.concatenate([x[i][0] for i in fitted]), np.concatenate([x[i][1] for i in fitted])
    row = np.repeat(np.arange(len(fitted)), [len(x[i][0]) for i in fitted])
    t = y[fitted].astype(np.float64)
    size = 1 << BITS
    w, b, v, vb = np.zeros(size), 0.0, np.zeros(size), 0.0
    g2, gb2 = np.full(size, 1e-8), 1e-8
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[idx] * val, len(t)) + b, -35, 35)))
        e = (p - t) / len(t)
        g, gb = np.bincount(idx, e[row] * val, size) + RIDGE * w, e.sum()
        g2, gb2 = 0.99 * g2 + 0.01 * g * g, 0.99 * gb2 + 0.01 * gb * gb
        v, vb = 0.9 * v + 0.1 * g, 0.9 * vb + 0.1 * gb
        w, b = w - RATE * v / (np.sqrt(g2) + 1e-5), b - RATE * vb / (np.sqrt(gb2) + 1e-5)
    rest = [i for i in range(len(y)) if held[i]]
    m = np.array([float((w[x[i][0]] * x[i][1]).sum()) + b for i in rest])
    slope, offset = platt(m, y[rest]) if rest else (1.0, 0.0)
    return Model(w.astype(np.float32), b, slope, offset)


def platt(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that map margins to probabilities, by Newton steps on smoothed targets."""
    good, bad = int(y.sum()), int(len(y) - y.sum())
    if not good or not bad:
        return 1.0, 0.0
    t = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    x = np.stack([m, np.ones(len(m))])
    loss = lambda a, b: float(np.logaddexp(0, a * m + b).sum() - (t * (a * m + b)).sum())
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (p - t))
        rate, now = 1.0, loss(a, b)
        while rate > 1e-4 and loss(a - rate * step[0], b - rate * step[1]) > now:
            rate /= 2
        a, b = a - rate * step[0], b - rate * step[1]
        if np.abs(rate * step).max() < 1e-7:
            break
    return float(a), float(b)


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list, np.ndarray, np.ndarray]:
    """Feature vectors, labels and held-out marks of a bounded sample of labelled documents.

    Labels of one doc_id vote; ties and null labels are left out. The sample has ``rows`` doc_ids at most, and
    of documents that repeat one of them the one with the smallest hash of its text.
    """
    few = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(F.col("quality").cast("double")).alias("q")).where("q <> 0.5").select("doc_id", (F.col("q") > 0.5).cast("int").alias("y"), F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            for x, y in _batches([], texts):
                got = vectors(Batch(texts[x:y]))
                yield pa.RecordBatch.from_arrays([b.column("h")[x:y], b.column("doc_id")[x:y], b.column("y")[x:y], pa.array([i.astype("<u4").tobytes() for i, _ in got]), pa.array([v.tobytes() for _, v in got])], names=["h", "doc_id", "y", "idx", "val"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(few), "doc_id")
    joined = found.groupBy("h", "doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = joined.mapInArrow(run, "h long, doc_id long, y int, idx binary, val binary").toArrow().sort_by([("h", "ascending"), ("doc_id", "ascending")])
    x = [(np.frombuffer(i, "<u4"), np.frombuffer(v, np.float32)) for i, v in zip(got.column("idx").to_pylist(), got.column("val").to_pylist())]
    held = np.array([h % HELD_OUT == 0 for h in got.column("h").to_pylist()], bool)
    return x, np.array(got.column("y").to_pylist(), np.int64), held


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """The classifier; None when the labels have one class only, and base rules then decide alone."""
    return fit(*sample(docs, labels, rows))


def _judge(model: Model | None, threshold: float):
    def judge(texts: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        b = Batch(texts)
        c = counts(texts, b.words)
        failed = (c["n_words"] < FEWEST) | (100 * c["n_repeat_words"] > REPEATED * c["n_words"])
        p = np.ones(len(texts)) if model is None else model.probability(margins(b, model.weights) + model.bias)
        return c, failed, p, ~failed & (p >= threshold)

    return judge


def rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: Model | None = None) -> DataFrame:
    """Counts, base rule and verdict of every document.

    Takes ``doc_id`` and ``text`` of ``docs`` and ``doc_id`` and ``quality`` of ``labels``; other columns
    are ignored. One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, probability, kept. Null and empty texts have no words and fail the base
    rule; repeated rows are judged alike; an empty table gives no rows. Without usable labels the base
    rule decides alone.
    """
    model = model or train(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        resident.drop()
        judge = _judge(sent.value, threshold)
        for b in batches:
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            for x, y in _batches([], texts):
                c, failed, p, kept = judge(texts[x:y])
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[x:y], *(pa.array(c[k].astype(np.int64)) for k in COUNTS), pa.array(failed), pa.array(p), pa.array(kept)], names=["doc_id", *COUNTS, "base_failed", "probability", "kept"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, OUT)


@shared.any_names
def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with all of their columns.

    Takes ``doc_id`` and ``text`` by name whatever other columns there are. Null and empty texts fail; rows
    without doc_id are judged by their text; repeated rows stay or go together; an empty table gives no rows.
    """
    model = model or train(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        resident.drop()
        judge = _judge(sent.value, threshold)
        for b in batches:
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            kept = [judge(texts[x:y])[3] for x, y in _batches([], texts)]
            yield b.filter(pa.array(np.concatenate(kept) if kept else np.empty(0, bool)))

    return docs.mapInArrow(run, docs.schema)
