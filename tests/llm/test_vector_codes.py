"""Vector codes against plain Lloyd rounds in Python's integers, cover trees against brute force and their own invariants."""

import hashlib
import math

import numpy as np
import pytest

from readloom.llm import vector_codes
from readloom.llm.cover_tree import CoverTree, exact, squares

SCHEMA = "label int, vec_id long, embedding array<float>, code string, `a.b` int"


def plain(rows, entries=16):
    """(vec_id, code, error, label_error) sorted, and the digest."""
    rows = [(i, lab, v) for lab, i, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    longest = max((len(v) for *_, v in rows), default=0)
    step = -(-longest // 8)
    ints = [[math.floor(4096 * x) for x in [*v, *[0.0] * (8 * step - len(v))]] for *_, v in rows]
    cut = [[tuple(v[k * step : (k + 1) * step]) for v in ints] for k in range(8)]
    books = [list(c[:entries]) for c in cut]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda p, book: min(range(len(book)), key=lambda e: (dist(p, book[e]), e))
    for _ in range(6):
        for k in range(8):
            own = [nearest(p, books[k]) for p in cut[k]]
            for e in range(len(books[k])):
                mine = [p for p, o in zip(cut[k], own) if o == e]
                if mine:
                    books[k][e] = tuple(sum(c) // len(mine) for c in zip(*mine))
    codes = [[nearest(cut[k][i], books[k]) for k in range(8)] for i in range(len(rows))]
    errors = [sum(dist(cut[k][i], books[k][codes[i][k]]) for k in range(8)) for i in range(len(rows))]
    by = {}
    for (_, lab, _), e in zip(rows, errors):
        by[lab] = by.get(lab, 0) + e
    out = [(r[0], "".join(f"{x:02x}" for x in c), e, by[r[1]]) for r, c, e in zip(rows, codes, errors)]
    return sorted(out, key=repr), hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = vector_codes.with_label_error(*vector_codes.compress(df))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = got.collect()
    want, digest = plain([tuple(r) for r in df.collect()])
    assert sorted((tuple(r)[:4] for r in got), key=repr) == want
    assert {r.codebooks_sha256 for r in got} <= {digest}
    return want


def made(n, dims, seed):
    r = np.random.default_rng(seed)
    return [(None if i % 7 == 0 else i % 3, i, np.float32(r.normal(size=dims) * 0.3).tolist(), "clash", 1) for i in range(n)]


def test_nulls_ties_and_copies(spark):
    rows = made(150, 16, 1)
    rows += [(1, 300 + i, rows[3][2], "", 1) for i in range(60)] + [(1, 5, rows[9][2], "", 1)] * 3  # copies, repeated rows
    rows += [(1, None, rows[20][2], "", 1), (2, 400, None, "", 1), (2, -7, [None] * 16, "", 1), (2, -8, [float("nan")] * 16, "", 1), (2, -9, [float("inf")] + [0.0] * 15, "", 1)]
    assert len(check(spark, rows)) == 150 + 60 + 3 + 1


@pytest.mark.parametrize("rows", [made(5, 8, 2), [(1, i, [0.5] * 8, "", 1) for i in range(40)], [(1, i, [], "", 1) for i in range(3)], [(None, 2, [0.1, -0.2, 9.0], "", 1), (None, 1, [1.0] * 11, "", 1)], [(1, i, [float(i) * 2000.0, -5.0e5] + [0.0] * 6, "", 1) for i in range(40)]])
def test_small_equal_empty_ragged_and_large(spark, rows):
    check(spark, rows)


def test_empty_and_huge(spark):
    df = spark.createDataFrame([(1, 1, [3.0e38] * 8, "", 1), (1, 2, [-3.0e38] * 8, "", 1)], SCHEMA)
    got = vector_codes.compress(df)[0].collect()
    assert sorted(r.code for r in got) == ["00" * 8, "01" * 8] and [r.error for r in got] == [0, 0]
    assert vector_codes.with_label_error(*vector_codes.compress(df.where("vec_id < 0"))).count() == 0


def test_many_chunks(spark, monkeypatch):
    """The rounds do not depend on how vectors are cut into chunks."""
    rows = made(400, 8, 3)
    one = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    many = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(9))
    assert sorted(map(tuple, one[0].collect())) == sorted(map(tuple, many[0].collect()))
    assert all((a == b).all() for a, b in zip(one[1], many[1]))


@pytest.mark.parametrize("n, dims, size", [(1, 3, 5), (300, 1, 40), (500, 2, 1000), (700, 8, 300), (60, 0, 1), (200, 3, 1 << 40)])
def test_tree(n, dims, size):
    r = np.random.default_rng(n)
    points = exact((r.normal(size=(n, dims)) * size).round())
    tree = CoverTree(points)
    assert (tree.points[tree.of] == points).all() and tree.count[0] == n and (tree.sum[0] == points.sum(axis=0)).all()
    # Every node covers what lies below it, and siblings are apart by more than half of what their parent may cover.
    up = tree.leaf.copy()
    while (up >= 0).any():
        far = np.sqrt(squares(tree.points[up >= 0], tree.points[tree.centre[up[up >= 0]]]).astype(float))
        assert (far <= tree.radius[up[up >= 0]] * (1 + 1e-9)).all()
        up = np.where(up >= 0, tree.parent[up], -1)
    for seed in range(3):
        entries = exact((np.random.default_rng(seed).normal(size=(16, dims)) * size).round())
        own, sums, counts = tree.assign(entries)
        far = squares(points[:, None], entries[None])
        assert (own[tree.of] == far.argmin(axis=1)).all()
        assert (counts == np.bincount(own[tree.of], minlength=16)).all()
        assert all((sums[e] == points[own[tree.of] == e].sum(axis=0)).all() for e in range(16) if counts[e])


def test_subtrees_go_whole():
    """Of tight groups the tree is not descended: nodes that are looked at are few."""
    r = np.random.default_rng(5)
    middles = r.integers(-20000, 20000, (16, 4))
    points = exact((middles[r.integers(0, 16, 3000)] + r.integers(-20, 20, (3000, 4))).astype(float))
    tree, asked = CoverTree(points), []
    from readloom.llm import cover_tree

    def counted(a, b, real=cover_tree.squares):
        asked.append(len(a))
        return real(a, b)

    cover_tree.squares, real = counted, cover_tree.squares
    try:
        own, _, _ = tree.assign(exact(middles.astype(float)))
    finally:
        cover_tree.squares = real
    assert sum(asked) < 150 and (own[tree.of] == real(points[:, None], middles[None]).argmin(axis=1)).all()
