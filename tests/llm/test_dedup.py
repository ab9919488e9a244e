import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import DOCS, pairs

from readloom.llm import components, kernel, ngram_join, substring, suffix_dedup, suffix_sort

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_join(rows, k=5, percent=80):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(FOLD))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    best = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return sorted(((rows[i][0], len(sets[i]), best[group[i]] if sets[i] else rows[i][0]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("limit,hot", [(256, 2000), (2, 1)])
def test_join_equals_brute_force(docs, limit, hot):
    got = ngram_join.join(docs, limit=limit, hot_least=hot)
    assert pairs(got, "doc_id", "n_shingles", "component_id") == brute_join(DOCS)


def test_keep_first_leaves_one_row_per_component(docs):
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[3] == 1 and ids[4] == 0 and ids[5] == 0 and ids[None] == 0 and ids[14] == 2 and ids[15] == 1 and ids[6] == ids[7] == ids[8] == 1


def test_trie_finds_what_pairs_find():
    import random

    import numpy as np

    r = random.Random(5)
    base = [sorted(r.sample(range(400), 40)) for _ in range(6)]
    sets = sorted({tuple(sorted(set(b) - set(r.sample(b, r.randint(0, 8))) | set(r.sample(range(400), r.randint(0, 8))))) for b in base for _ in range(25)})
    parent = list(range(len(sets)))
    ngram_join.trie_join([np.array(s, np.int32) for s in sets], 80, parent)

    def find(p, i):
        while p[i] != i:
            i = p[i]
        return i

    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            o = len(set(sets[i]) & set(sets[j]))
            if 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                x, y = find(want, i), find(want, j)
                want[x] = y
    same = lambda p: [[find(p, i) == find(p, j) for j in range(i)] for i in range(len(sets))]
    assert same(parent) == same(want)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)}


def brute_windows(rows, k=13):
    words = [WORD.findall(t or "") for _, t in rows]
    rank = [float("inf") if i is None else i for i, _ in rows]
    first = {}
    for r, w in zip(rank, words):
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(r, first.get(key, r))
    out = []
    for (d, _), r, w in zip(rows, rank, words):
        dead = bytearray(len(w))
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < r:
                dead[i : i + k] = b"\1" * k
        kept = " ".join(x for x, y in zip(w, dead) if not y)
        out.append((d, len(w), sum(dead), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def brute_bytes(rows, k=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + k] for t in texts for i in range(len(t) - k + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        dead = bytearray(len(t))
        for i in range(len(t) - k + 1):
            if seen[t[i : i + k]] > 1:
                dead[i : i + k] = b"\1" * k
        kept = bytes(x for x, y in zip(t, dead) if not y)
        out.append((d, len(t), sum(dead), len(re.findall(b"\1+", bytes(dead))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1 << 10, 1 << 21])
def test_substring_dedup_equals_brute_force(docs, size):
    got = substring.dedup(docs, chunk_bytes=size)
    assert pairs(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_windows(DOCS)


@pytest.mark.parametrize("size", [1 << 10, 1 << 21])
def test_suffix_dedup_equals_brute_force(docs, size):
    got = suffix_dedup.dedup(docs, chunk_bytes=size)
    assert pairs(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(DOCS)


def test_cut_repeats_keeps_rows_and_columns(docs):
    cut = suffix_dedup.cut_repeats(docs)
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert left[3] == left[4] == "" and left[9] == "one two three" and left[6] == ""
    assert sum(r.doc_id == 15 for r in cut.collect()) == 1 or sum(r.doc_id == 15 for r in cut.collect()) == 2


def test_deep_shallow_sort_finds_equal_suffixes():
    import random

    import numpy as np

    r = random.Random(3)
    for _ in range(20):
        data = bytes(r.choice(b"ab") for _ in range(300)) * 2 + bytes(r.choice(b"abc") for _ in range(200))
        starts = np.arange(len(data) - 60)
        count = Counter(data[s : s + 60] for s in starts)
        assert suffix_sort.equal_suffixes(data, starts, 60, shallow=16).tolist() == [count[data[s : s + 60]] > 1 for s in starts]


def test_blind_trie_sorts():
    import random

    r = random.Random(4)
    s = [bytes(r.choice(b"ab") for _ in range(12)) for _ in range(200)]
    classes = suffix_sort.blind_trie(s)
    assert [s[c[0]] for c in classes] == sorted(set(s)) and sorted(i for c in classes for i in c) == list(range(200))


def test_empty_tables_give_no_rows(none):
    for got in (ngram_join.join(none), substring.dedup(none), suffix_dedup.dedup(none), ngram_join.keep_first(none), suffix_dedup.cut_repeats(none)):
        assert got.count() == 0


@pytest.mark.parametrize("unit", ["a", "ab", "abcdefg ", " " * 50 + "-" * 13])
def test_long_periodic_texts_are_one_segment_each(unit):
    import tracemalloc

    n = 400_000
    runs = suffix_dedup._Runs([1], [(unit * n)[:n].encode()], 200, 50)
    tracemalloc.start()
    found = runs.segments(np.arange(len(runs.key)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len({s for (_, s), _ in found}) == len(found) <= 3 * len(unit)
    assert sorted(np.concatenate([at for _, at in found]).tolist()) == sorted(runs.lo.tolist())
    assert peak < 120 * n


def test_a_key_is_hot_by_segments_that_differ(monkeypatch):
    # 3,000 texts of 200 bytes share 170 of them, with which most keys go, and differ in the bytes around.
    shared = bytes(np.random.default_rng(3).integers(97, 123, 170, np.uint8)).decode()
    texts = [f"{i:015d}{shared}{i:015d}".encode() for i in range(3000)]

    def chunk(given):
        monkeypatch.setattr(suffix_dedup.chunks, "slices", lambda _: [(list(range(len(given))), given)])
        return suffix_dedup._Chunk(pa.table({"chunk": [0]}), 200, 50)

    assert chunk(texts).count.sum() == 3000 and chunk(texts).count.max() > 255
    assert chunk(texts[:1] * 3000).count.tolist() == [2] and chunk(texts[:1]).count.tolist() == [1]
    assert chunk([b"a" * 100_000]).count.max() == 2


@pytest.mark.parametrize("hot_runs", [0, 1, 5, 100_000])
def test_periodic_and_hot_texts_equal_brute_force(spark, hot_runs):
    shared = "".join(chr(97 + i * i % 26) for i in range(170))
    texts = ["a" * 3000, "ab" * 900, "ab" * 120, *[f"{i % 7:015d}{shared}{i % 5:015d}" for i in range(40)], "xyz" * 66 + "xy", None, ""]
    rows = list(enumerate(texts))
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), hot_runs=hot_runs, chunk_bytes=2000)
    windows = Counter((t or "").encode()[i : i + 200] for t in texts for i in range(len((t or "").encode()) - 199))
    for r in got.collect():
        raw = (texts[r.doc_id] or "").encode()
        dead = {j for i in range(len(raw) - 199) if windows[raw[i : i + 200]] > 1 for j in range(i, i + 200)}
        assert (r.n_bytes, r.n_removed) == (len(raw), len(dead))
        assert r.kept_sha256 == hashlib.sha256(bytes(b for j, b in enumerate(raw) if j not in dead)).hexdigest()


def test_windows_of_a_pack_are_hashed_a_part_at_a_time(monkeypatch):
    import tracemalloc

    r = np.random.default_rng(4)
    texts = [bytes(r.integers(97, 101, n, dtype=np.uint8)) for n in (0, 5, 199, 200, 201, *[3000] * 600, 700_000, 1)]
    texts += texts[300:320]

    def runs():
        kernel.release()
        tracemalloc.start()
        try:
            got = suffix_dedup._Runs(list(range(len(texts))), texts, 200, 50)
            return got, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
            kernel.release()

    got, peak = runs()
    monkeypatch.setattr(suffix_dedup, "HASH_BYTES", 1 << 30)
    whole, most = runs()
    for name in ("begin", "end", "lo", "hi", "key", "hash"):
        assert np.array_equal(getattr(got, name), getattr(whole, name))
    assert len(got.lo) and peak < most / 2 and peak < 60_000_000, (peak, most)


def test_windows_of_a_key_are_ordered_some_at_a_time(monkeypatch):
    """However many segments share a key, what is ordered at once stays bounded, and the answers are those of all at once."""
    rng = np.random.default_rng(3)
    letters = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8))
    middle, parts = letters(60), []
    for i in range(300):
        parts.append(letters(20) + middle + letters(20) if i % 4 else b"x" * 100 if i == 100 else (parts[-1] if parts else letters(100))[:80] + letters(20))
    seen, held = [1 + (i % 50 == 0) for i in range(300)], []
    order = suffix_dedup.equal_suffixes
    monkeypatch.setattr(suffix_dedup, "equal_suffixes", lambda data, starts, *a: (held.append(len(starts)), order(data, starts, *a))[1])
    got = suffix_dedup._repeated(parts, seen, 80, most=500)
    windows = [[p[i : i + 80] for i in range(len(p) - 79)] for p in parts]
    times = {}
    for p in windows:
        for w in p:
            times[w] = times.get(w, 0) + 1
    assert [g.tolist() for g in got] == [[s > 1 or times[w] > 1 for w in p] for p, s in zip(windows, seen)]
    assert len(held) > 10 and sum(held) == sum(map(len, windows)) and max(held) < 1000
    assert [g.tolist() for g in suffix_dedup._repeated(parts, seen, 80)] == [g.tolist() for g in got]
