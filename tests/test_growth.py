"""Plans of steps whose tables grow with the input: nothing of them goes through the driver, nothing is dealt or made twice."""

import pytest
from pyspark.sql import functions as F

from readloom.functions import names
from readloom.operators import alignments, counting, intervals, projection, weights
from readloom.sources import readers, writers


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark):
    blocks = spark.range(50).select(F.col("id").alias("fragment_id"), F.lit("c").alias("chrom"), (F.col("id") * 10 + 1).alias("start"), (F.col("id") * 10 + 30).alias("end"), F.lit("+").alias("strand"))
    exons = spark.range(40).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("exon_id"), F.lit("c").alias("chrom"), (F.col("id") * 15 + 1).alias("start"), (F.col("id") * 15 + 20).alias("end"), F.lit("-").alias("strand"))
    return blocks, exons


def test_bins_are_not_broadcast(spark):
    blocks, exons = _tables(spark)
    got = intervals.interval_join(blocks, exons).select("fragment_id", "exon_id", "overlap")
    assert "Broadcast" not in _plan(got)
    assert sorted(got.collect()) == sorted(intervals.plain_interval_join(blocks, exons).select("fragment_id", "exon_id", "overlap").collect())


def test_object_maps_are_not_broadcast(spark):
    _, exons = _tables(spark)
    objects = exons.where("start > 20").select("exon_id", F.col("strand").alias("object_id"))
    got = counting.with_objects(exons, objects)
    assert "Broadcast" not in _plan(got)
    assert {r.exon_id: r.objects for r in got.collect()} == {f"e{i}": ["-"] if i > 1 else [f"e{i}"] for i in range(40)}


def test_block_names_are_tried_once_a_row(spark, tmp_path):
    names = ["f-A00001-L50-I0-D2-F0-1/P1", "a-b-A00012-L5-I3-D0-F1-2/S2", "f-A00001-L1-I0-D0-F0-0/P1-A00002-L7-I0-D0-F0-0/S1", "-A00003-L7-I0-D0-F0-0/S1", "f-A0001-L50-I0-D0-F0-1/P1", "f-A00001-L50-I0-D0-F0-1/P3", "plain", "f-A00001-L-I0-D0-F0-1/P1"]
    (tmp_path / "b.bed").write_text("".join(f"c\t0\t9\t{n}\t0\t+\n" for n in names))
    got = readers.bed6(spark, str(tmp_path / "b.bed")).select("name", "block.*")
    parts = [F.regexp_extract("name", readers.BLOCK_NAME, i) for i in range(1, 10)]
    want = spark.createDataFrame([(n,) for n in names], "name string").select("name", *parts).collect()
    as_text = lambda r: ["" if r.fragment_id is None else r.fragment_id, *["" if x is None else str(x) for x in r[2:8]], "" if r.paired is None else "P" if r.paired else "S", "" if r.read_index is None else str(r.read_index)]
    number = lambda x: str(int(x)) if x.isdigit() else x
    assert {r.name: as_text(r) for r in got.collect()} == {r[0]: [r[1], *map(number, r[2:])] for r in want}
    plan = _plan(got)
    assert plan.count("RLIKE") == 1 and "regexp_extract" not in plan


def test_objects_join_hits_that_conform(spark):
    hit = "fragment_id string, aln_no int, read_index int, side string, chrom string, start long, end long, strand string, block_idx int, last_block int, aligned_len int, ins int, del int, exon_id string, exon_start long, exon_end long, exon_strand string, overlap long"
    rows = [("f", 1, 1, "r1", "c", 11, 20, "+", 0, 0, 10, 0, 0, e, s, 30, "+", 10) for e, s in (("E1", 11), ("E2", 12), ("E3", 1))]
    hits = spark.createDataFrame(rows, hit)
    objects = spark.createDataFrame([("E1", "G"), ("E1", "H"), ("E2", "I")], "exon_id string, object_id string")
    got = counting.qualified(hits, counting.MODES["gene"], objects=objects)
    assert sorted(r.object_id for r in got.collect()) == ["E3", "G", "H"]
    assert "Broadcast" not in _plan(got)


def test_rows_are_not_multiplied_to_count_distinct_ones(spark):
    b = spark.createDataFrame([("f", 1, 1, "c", 5, 9, "+", 0, 1), ("f", 1, 1, "c", 20, 25, "+", 1, 1), ("f", 1, 1, "c", 5, 9, "+", 0, 1)], "fragment_id string, aln_no int, read_index int, chrom string, start long, end long, strand string, block_idx int, last_block int")
    got = projection.assemble(b)
    assert "Expand" not in _plan(got)
    assert [len(r.blocks) for r in got.collect()] == [2]
    for column in ("strand", "last_block", "start"):
        bad = b.withColumn(column, F.when(F.col("block_idx") == 1, F.col(column)).otherwise(F.lit("-") if column == "strand" else F.monotonically_increasing_id() + 7 if column == "start" else F.lit(3)))
        with pytest.raises(Exception, match="contradict"):
            projection.assemble(bad).collect()


def test_exon_ids_are_cut_once_a_row(spark):
    ids = ["g/c1/0/9/-", "c1/5/9", "c1/5/9/+.inv-strand", "tr-x.2/5/9/*", None]
    got = spark.createDataFrame([(i,) for i in ids], "exon_id string").select("exon_id", names.parse_exon(F.col("exon_id")).alias("e")).select("exon_id", "e.*")
    assert {r.exon_id: tuple(r[1:]) for r in got.collect() if r.exon_id} == {"g/c1/0/9/-": ("g", "c1", 1, 9, "-", False), "c1/5/9": (None, "c1", 5, 9, "+", False), "c1/5/9/+.inv-strand": (None, "c1", 5, 9, "-", False), "tr-x.2/5/9/*": (None, "tr-x", 5, 9, "*", True)}
    one = spark.range(1).select(names.parse_exon(F.col("id").cast("string")).alias("e"))._jdf.queryExecution().analyzed().toString()
    assert one.count("split(") == 1


def test_hits_are_numbered_in_one_sort(spark):
    rows = [("f", 1, 1, True, 2), ("f", 1, 2, True, 1), ("f", 2, 1, False, None), ("f", 2, 1, False, 0), ("f", 3, 1, False, 0), ("f", 3, 2, False, 4), ("g", 7, 2, False, 3), ("g", 9, 1, False, 1), ("h", None, 1, False, 1), ("h", 4, 1, None, 1)]
    a = spark.createDataFrame(rows, "fragment_id string, aln_no int, read_index int, paired boolean, nm int")
    got = weights.summarize(a)
    assert {r.fragment_id: tuple(r[1:]) for r in got.collect()} == {"f": (3, 6, "paired-end"), "g": (1, 4, "single-read (both)"), "h": (0, 2, "single-read")}
    plan = _plan(weights.summarize(a))
    assert "Expand" not in plan and plan.count("Exchange") == 1


def test_cigars_are_cut_once_a_row(spark):
    a = spark.createDataFrame([("f", 1, 1, "c", 5, "4M", "+"), ("f", 2, 1, "c", 9, "3M10N2M", "-"), ("g", 1, 1, "c", 7, "*", "-")], "fragment_id string, aln_no int, read_index int, chrom string, pos long, cigar string, strand string")
    got = alignments.blocks(a)
    assert sorted((r.fragment_id, r.aln_no, r.start, r.end, r.block_idx, r.last_block, r.aligned_len) for r in got.collect()) == [("f", 1, 5, 8, 0, 0, 4), ("f", 2, 9, 11, 0, 1, 3), ("f", 2, 22, 23, 1, 1, 2)]
    assert _plan(alignments.blocks(a)).count("RLIKE") == 1


def test_names_of_objects_are_not_broadcast(spark):
    objects = spark.range(30).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("object_id"))
    counts = spark.createDataFrame([("o3", 2.0), ("o4", 0.0)], "id string, count double")
    got = writers.count_table(counts, objects, nonzero=True)
    assert "Broadcast" not in _plan(got)
    assert [tuple(r) for r in got.collect()] == [("o3", 2.0)] and writers.count_table(counts, objects).count() == 30


def test_counting_moves_what_it_needs(spark):
    at = [("f", 1, 1, 11, 20, 0, 10), ("f", 2, 1, 11, 20, 0, 10), ("f", 3, 2, 31, 40, 0, 10), ("f", 4, 1, 15, 24, 0, 10)]
    cols = [F.lit("c").alias("chrom"), F.lit("+").alias("strand"), F.lit(False).alias("paired"), F.lit(0).alias("last_block"), F.lit(0).alias("ins"), F.lit(0).alias("del")]
    blocks = spark.createDataFrame(at, "fragment_id string, aln_no int, read_index int, start long, end long, block_idx int, aligned_len int").select("*", *cols)
    exons = spark.createDataFrame([("E1", "c", 1, 20, "+"), ("E2", "c", 31, 50, "-")], "exon_id string, chrom string, start long, end long, strand string")
    objects = spark.createDataFrame([("E1", "G"), ("E2", "H")], "exon_id string, object_id string")
    got = counting.quantify(blocks, exons, objects, "gene")
    assert {r.id: r["count"] for r in got.collect()} == {"G": 1.0, "H": 1.0}
    dealt = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "RepartitionByExpression" in x]
    below = got._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1].split("\n")[1]
    assert len(dealt) == 1 and "conform" in below and not any(x in below.split("[")[1].split(" AS ")[0] for x in ("aligned_len", "exon_end", "overlap"))


def test_rows_of_a_sam_file_are_placed_without_moving_them(spark, tmp_path):
    path = str(tmp_path / "sam")
    rows = [f"r{i:04d}\t0\tc\t{9 + i}\t20\t4M\t*\t0\t0\tACGT\tIIII" for i in range(700)]
    for part, few in enumerate((["@HD\tVN:1.6", *rows[:300], ""], [], rows[300:301], rows[301:])):
        (tmp_path / "sam").mkdir(exist_ok=True)
        (tmp_path / "sam" / f"part-0000{part}.txt").write_text("".join(r + "\n" for r in few))
    size, cost = (spark.conf.get(f"spark.sql.files.{k}") for k in ("maxPartitionBytes", "openCostInBytes"))
    for most, open_ in ((size, cost), ("3000", "10"), ("100000", "1")):  # files together, in splits, and both
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        spark.conf.set("spark.sql.files.openCostInBytes", open_)
        try:
            got = readers.sam_places(spark, path)
            assert {r.place: r.fragment_name for r in got.collect()} == {i + 1: f"r{i:04d}" for i in range(700)}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert not any(x in _plan(got) for x in ("rangepartitioning", "hashpartitioning(value", "SortMergeJoin"))
