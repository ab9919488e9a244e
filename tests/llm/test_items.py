"""Benchmark rows without an id count."""

import hashlib

import duckdb

from readloom.llm import decontaminate, oracles


def test_benchmark_rows_without_an_id_count(spark):
    docs = spark.createDataFrame([(1, "x one two"), (2, "one seven"), (3, "none")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "one"), (None, "two"), (5, "seven")], "item_id long, text string")
    for block in (1 << 20, 1):
        got = {r.doc_id: r for r in decontaminate.mark(docs, bench, block_states=block).collect()}
        assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in (1, 2, 3)] == [(2, 1, True), (2, 2, True), (0, 0, False)]
        assert [got[i].items_sha256 for i in (1, 2, 3)] == [hashlib.sha256(x).hexdigest() for x in (b"", b"5", b"")] and got[2]["items"] == ["5", None]
        assert [r.doc_id for r in decontaminate.keep_clean(docs, bench, block_states=block).collect()] == [3]


def test_benchmark_rows_without_an_id_count_as_in_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM (VALUES (1, 'x one two'), (2, 'one seven'), (3, 'none')) t(doc_id, text)")
    con.execute("CREATE TABLE benchmark AS SELECT * FROM (VALUES (NULL, 'one'), (NULL, 'two'), (5, 'seven')) t(item_id, text)")
    want = sorted(con.execute(f"SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM ({oracles.ORACLE_SQL['op7_benchmark_decontamination']})").fetchall())
    docs, bench = (spark.createDataFrame(con.execute(f"FROM {t}").fetchall(), s) for t, s in (("documents", "doc_id long, text string"), ("benchmark", "item_id long, text string")))
    assert sorted(tuple(r)[:6] for r in decontaminate.mark(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()) == want
