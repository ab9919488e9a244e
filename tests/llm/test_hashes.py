"""Words that a polynomial hash modulo a power of two takes for equal, columns with clashing names, and hot keys."""

import pytest
from llm_helpers import DOCS, pairs, prose
from test_dedup import brute_bytes, brute_join, brute_windows

from readloom.llm import chunks, ngram_join, quality, substring, suffix_dedup

ONE = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
TWO = "".join("ba"[bin(i).count("1") % 2] for i in range(1024))
TAIL = prose(12, 41).split()
ROWS = [(1, " ".join([ONE, *TAIL])), (2, " ".join([TWO, *TAIL])), (3, " ".join([ONE, *TAIL])), (4, f"x {ONE} y x {TWO} y"), (5, f"{ONE} b {TWO}")]


@pytest.fixture(scope="module")
def twins(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def test_join_tells_them_apart(twins):
    assert pairs(ngram_join.join(twins), "doc_id", "n_shingles", "component_id") == brute_join(ROWS)


def test_windows_tell_them_apart(twins):
    assert pairs(substring.dedup(twins), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_windows(ROWS)


def test_repeated_words_tell_them_apart(spark, twins):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r.n_repeat_words for r in quality.rules(twins, labels).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0}


def test_columns_of_any_name_are_carried(spark):
    names = ["own_key", "left_text", "left_key", "kept_id", "kept_node", "node", "chunk", "pack", "rest", "_0", "component_id", "first"]
    rows = [(i, t, *[f"{n}{k}" for n in names]) for k, (i, t) in enumerate(DOCS)]
    d = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    cut = suffix_dedup.cut_repeats(d)
    assert cut.columns == d.columns
    left = {r.own_key: r for r in cut.collect()}
    assert len(left) == len(rows) and all(left[r[2]].doc_id == r[0] and tuple(left[r[2]])[2:] == r[2:] for r in rows)
    kept = ngram_join.keep_first(d)
    assert kept.columns == d.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and not {4, 5, None} & set(ids) and ids.count(14) == 2 and ids.count(15) == 1


@pytest.mark.parametrize("hot", [0, 1, 3])
def test_hot_keys_give_the_same(docs, hot):
    got = suffix_dedup.dedup(docs, chunk_bytes=1 << 10, hot_runs=hot)
    assert pairs(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(DOCS)


def test_exchanged_rows_do_not_grow_with_the_square(spark):
    """Rows are at most one per chunk and shard, and never more than the keys that are sent."""
    sent = {}
    for size in (40, 160):
        d = spark.createDataFrame([(i, prose(400, i)) for i in range(size)], "doc_id long, text string")
        dealt, total = chunks.deal(d)
        n, parts = chunks.shards(dealt, total, suffix_dedup.SHARD_BYTES), dealt.select("chunk").distinct().count()
        sent[size] = parts * n
        assert n <= max(1, -(-total // suffix_dedup.SHARD_BYTES), 4)
    assert sent[160] <= 4 * sent[40]


def test_keys_come_back_as_they_were_sent():
    import numpy as np

    r = np.random.default_rng(3)
    for n, top in ((0, 9), (1, 2**48), (5000, 2**15), (5000, 2**24), (5000, 2**40), (300, 2**48)):
        keys = np.unique(r.integers(0, top, n, dtype=np.uint64))
        assert chunks.unpack_keys(chunks.pack_keys(keys)).tolist() == keys.tolist()


def test_windows_come_back_as_they_were_sent():
    import numpy as np

    r = np.random.default_rng(4)
    for low, high in ((-5, 90), (0, 2**40), (2**62, substring.LAST), (-(2**62), 2**62)):
        a, b, doc = np.sort(r.integers(0, 2**64, 500, dtype=np.uint64)), r.integers(0, 2**64, 500, dtype=np.uint64), r.integers(low, high, 500)
        x, y, z = substring._unpack_windows(substring._pack_windows(a, b, doc))
        assert x.tolist() == a.tolist() and y.tolist() == (b >> np.uint64(16)).tolist() and z.tolist() == doc.tolist()


def test_packs_of_many_sizes_keep_all_rows(spark):
    rows = [(i if i % 7 else None, None if i % 11 == 0 else "x" * (i * 37 % 900), i) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string, size int")
    dealt, total = chunks.deal(d, chunk_bytes=4000, pack_bytes=1500, carry=("doc_id", "size"))
    assert total == sum(len(t or "") for _, t, _ in rows)
    got = []
    for r in dealt.collect():
        ids, texts = chunks._unpack(bytes(r.data))
        other = chunks.rest(bytes(r.rest))
        assert other.column(0).to_pylist() == ids
        got += zip(ids, (t.decode() for t in texts), other.column(1).to_pylist())
    assert sorted(got, key=lambda g: g[2]) == [(i, t or "", n) for i, t, n in rows]


def test_texts_that_share_their_first_hash_are_told_apart(docs, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ngram_join, "_names", lambda text: (F.xxhash64(F.length(text)), F.xxhash64(text)))
    assert pairs(ngram_join.join(docs), "doc_id", "n_shingles", "component_id") == brute_join(DOCS)
    kept = sorted((r.doc_id for r in ngram_join.keep_first(docs).collect()), key=repr)
    monkeypatch.undo()
    assert kept == sorted((r.doc_id for r in ngram_join.keep_first(docs).collect()), key=repr)


def test_a_larger_sketch_gives_the_same(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL_BYTES", 1)
    monkeypatch.setattr(ngram_join, "SKETCH_BITS", (15, 24))
    assert pairs(ngram_join.join(docs), "doc_id", "n_shingles", "component_id") == brute_join(DOCS)
