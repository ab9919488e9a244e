import re

import corpus_pipeline
import pytest
from llm_helpers import prose
from test_dedup import brute_bytes, brute_join
from test_text import brute_counts, brute_hits

from readloom.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.shared.table(stage(spark, docs, SF), "test")
        sizes.append(docs.count())
        if i < 4:
            assert docs.columns == columns
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > sizes[0] / 2
    assert all(r.round_trip for r in docs.collect())


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, kept_id int"
LEAK = prose(14, 77)
TEXTS = [
    (1, prose(90, 1)), (2, prose(90, 1) + " more"), (3, prose(60, 2) + " " + prose(70, 3)), (4, prose(70, 3) + " " + prose(60, 4)), (5, prose(60, 5) + " " + LEAK), (6, None), (7, ""), (8, prose(10, 6)), (None, prose(90, 1)), (9, prose(80, 8)), (9, prose(80, 8)), (9, prose(80, 9)), (None, prose(70, 10)), (10, "word " * 90),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en" if k % 2 else None, "s", None, f"n{k}", k) for k, (i, t) in enumerate(TEXTS)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, LEAK), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    # No usable labels: the base rule decides alone, and the whole run can be followed by hand.
    spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_run_equals_brute_force(spark, folder):
    rows = [(i, t) for i, t in TEXTS if not brute_counts(t)[5]]
    groups = brute_join([(k, t) for k, (_, t) in enumerate(rows)])  # by place in the table
    first: dict = {}
    for (k, _, g), (i, t) in ((x, rows[x[0]]) for x in groups):
        if g not in first or (i is None, i) < (first[g][1] is None, first[g][1]):
            first[g] = (k, i, t)
    kept = [(i, t) for _, i, t in first.values()]
    cut = []
    texts = [(t or "").encode() for _, t in kept]
    seen: dict = {}
    for t in texts:
        for x in range(len(t) - 199):
            seen[t[x : x + 200]] = seen.get(t[x : x + 200], 0) + 1
    for (i, _), t in zip(kept, texts):
        dead = bytearray(len(t))
        for x in range(len(t) - 199):
            if seen[t[x : x + 200]] > 1:
                dead[x : x + 200] = b"\1" * 200
        cut.append((i, bytes(c for c, d in zip(t, dead) if not d).decode("utf-8", "ignore")))
    assert any(len(a[1]) < len(b[1]) for a, b in zip(cut, kept)) and len(brute_bytes(kept)) == len(kept)
    clean = [(i, t) for (i, t) in cut if not brute_hits([(i, t)], [(1, LEAK)])[0][5]]
    assert len(clean) == len(cut) - 1
    got = corpus_pipeline.run(spark, folder)
    decoded = corpus_pipeline.benchmark_leaks(spark, corpus_pipeline.repeated_passages(spark, corpus_pipeline.near_duplicates(spark, corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder), folder), folder), folder)
    assert decoded.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(((r.doc_id, r.text) for r in decoded.collect()), key=repr) == sorted(clean, key=repr)
    assert all(r.n_chars == len(r.text) and re.fullmatch(r"n\d+", r.node) and r.node == f"n{r.kept_id}" for r in decoded.collect())
    assert sorted(((r.doc_id, r.n_chars) for r in got.collect()), key=repr) == sorted(((i, len(t)) for i, t in clean), key=repr) and all(r.round_trip for r in got.collect())


def test_empty_tables_pass_through(spark, folder, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
