"""Stages that give back all columns of documents take columns of any name."""

import pytest
from pyspark.sql import functions as F

from readloom.llm import decontaminate, ngram_join, quality, suffix_dedup

PROSE = " ".join(f"word{i}" for i in range(80))


@pytest.mark.parametrize("stage", ["quality", "join", "suffix", "benchmark"])
def test_columns_of_any_name(spark, stage):
    rows = [(1, PROSE, "x", 1), (2, PROSE, "y", 2), (3, None, "z", None), (4, "short", "w", 4)]
    docs = spark.createDataFrame(rows, "`a.b` long, text string, `c``d` string, doc_id long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([("i", PROSE)], "item_id string, text string")
    run = {"quality": lambda: quality.keep(docs, labels), "join": lambda: ngram_join.keep_first(docs), "suffix": lambda: suffix_dedup.cut_repeats(docs), "benchmark": lambda: decontaminate.keep_clean(docs, items)}
    got = run[stage]()
    assert got.columns == docs.columns
    want = {"quality": {1, 2}, "join": {1, 3, 4}, "suffix": {1, 2, 3, 4}, "benchmark": {3, 4}}[stage]
    found = got.toDF("n", "text", "s", "id").select("n", "s", F.length(F.coalesce("text", F.lit(""))).alias("size")).collect()
    assert {r["n"] for r in found} == want and all({1: "x", 2: "y", 3: "z", 4: "w"}[r["n"]] == r["s"] for r in found)
    if stage == "suffix":
        assert sorted(r["size"] for r in found) == [0, 0, 0, 5]
