"""Tables made part by part, joins of intervals of any size, and pairs among several candidates."""

import random

import pytest
from engine_helpers import rows
from pyspark.sql import functions as F

from readloom.operators import alignments, counting, intervals
from readloom.sources import settled


def test_parts_are_made_once(spark, tmp_path):
    made = []

    def make(missing):
        made.append(rows(missing))
        return missing.where("sample <> 'none'").select("sample", "chunk", F.concat("sample", F.lit("-"), "chunk").alias("id"), F.lit(1.5).alias("count"))

    parts = lambda *p: spark.createDataFrame(list(p), "sample string, chunk int")
    run = lambda *p: rows(settled.by_parts(spark, str(tmp_path / "t"), parts(*p), make, "id string, count double"), "id", "count")
    assert run(("none", 1)) == []
    assert run(("none", 1)) == [] and made == [[("none", 1)]]
    assert run(("a", 1), ("a", 1), ("b", 2), ("none", 1)) == [("a-1", 1.5), ("b-2", 1.5)]
    assert run(("a", 1), ("b", 2)) == [("a-1", 1.5), ("b-2", 1.5)] and made[1:] == [[("a", 1), ("b", 2)]]
    assert run(("a", 2)) == [("a-1", 1.5), ("a-2", 1.5), ("b-2", 1.5)] and made[2:] == [[("a", 2)]]


def test_broken_run_is_made_anew(spark, tmp_path):
    path, parts = str(tmp_path / "t"), spark.createDataFrame([("a", 1), ("b", 1)], "sample string, chunk int")
    rest = lambda n: (lambda missing: missing.select("sample", "chunk", F.lit(n).alias("id"), F.lit(1.0).alias("count")))
    rest("left over")(parts.where("sample = 'b'")).write.partitionBy("sample", "chunk").parquet(f"{path}/rows")  # rows without a manifest
    assert rows(settled.by_parts(spark, path, parts, rest("new"), "id string, count double"), "sample", "id") == [("a", "new"), ("b", "new")]
    with pytest.raises(ZeroDivisionError):
        settled.by_parts(spark, path, spark.createDataFrame([("c", 1)], "sample string, chunk int"), lambda m: 1 / 0, "id string, count double")
    assert rows(settled.by_parts(spark, path, parts, lambda m: 1 / 0, "id string, count double"), "sample", "id") == [("a", "new"), ("b", "new")]


@pytest.mark.parametrize("seed", [1, 2])
def test_intervals_of_any_size(spark, seed):
    """Points, genes of megabases and intervals at the edges of bins meet as a plain join has them; none has more than a few rows."""
    r = random.Random(seed)

    def some(n):
        out = []
        for i in range(n):
            size = r.choice([0, 1, 40, 1023, 1024, 8191, 8192, 300_000, 2_500_000, 90_000_000])
            start = r.choice([0, 1023, 1024, 8192, 1 << 19, r.randint(0, 4_000_000)])
            out.append((f"e{i}", r.choice("cd"), start, start + size, r.choice("+-"), i))
        return out

    e = spark.createDataFrame(some(60), "exon_id string, chrom string, start long, end long, strand string, n int")
    b = spark.createDataFrame(some(80), "name string, chrom string, start long, end long, strand string, n int").drop("n")
    columns = ("name", "exon_id", "overlap")
    for least in (1, 5):
        assert rows(intervals.interval_join(b, e, least), *columns) == rows(intervals.plain_interval_join(b, e, least), *columns)
    want = [x for x in rows(intervals.plain_interval_join(b, e), "name", "exon_id", "overlap", "strand", "exon_strand") if x[3] == x[4]]
    assert rows(intervals.interval_join(b, e, stranded=True), "name", "exon_id", "overlap", "strand", "exon_strand") == want
    every = list(range(len(intervals.LEVELS)))
    assert intervals.binned(b, "start", "end", {intervals.BOTH: every, intervals.LEFT_UP: every}, (intervals.RIGHT_UP, every), "_first").groupBy("name").count().agg(F.max("count")).first()[0] <= 2 * (len(every) + 2)
    assert intervals.interval_join(b, e.where("n < 0")).count() == 0


def test_pairs_among_several_candidates(spark):
    """Rows with one HI tag, and rows that agree in place, pair in order and one to one."""
    kind = "fragment_id string, row_no long, query_name string, ref string, pos long, mate_ref string, mate_pos long, read_index int, HI int"
    same = [("f", i, "q", "c", 10, "c", 50, 1, 1) if i % 2 else ("f", i, "q", "c", 50, "c", 10, 2, 1) for i in range(1, 7)]
    places = [("g", 1, "q", "c", 10, "c", 50, 1, None), ("g", 2, "q", "c", 50, "c", 10, 2, None), ("g", 3, "q", "c", 50, "c", 10, 2, None), ("g", 4, "q", "c", 10, "c", 50, 1, None)]
    got = rows(alignments.mate_pairs(spark.createDataFrame(same + places, kind)))
    assert got == [("f", 1, 2), ("f", 3, 4), ("f", 5, 6), ("g", 1, 2), ("g", 3, 4)]


def test_alignment_numbers_of_both_sides(spark):
    h = spark.createDataFrame([("f", "r1", "a"), ("f", "r1", "a"), ("f", "r1", "b"), ("f", "r2", "c"), ("g", "p", "x"), ("g", "r2", "y"), ("g", "r2", "z")], "fragment_id string, side string, canonical string")
    assert rows(counting.with_numbers(h).select("fragment_id", "n").distinct()) == [("f", 2), ("g", 2)] == rows(counting.alignment_numbers(h))
