"""What steps leave on disk: rows of a fragment are dealt once for all that compares them, and what was shuffled for a table goes with its writing."""

import time

from pyspark.sql import functions as F
from test_operators import HITS, hit

from readloom.operators import alignments, genome_alignments, intervals, projection
from readloom.plans import references
from readloom.sources.settled import settled


def exchanges(df) -> int:
    return sum(" Exchange " in x or "- Exchange " in x for x in df._jdf.queryExecution().executedPlan().toString().split("\n"))


def shuffle_files(spark) -> int:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def test_shuffles_go_with_the_table_they_were_made_for(spark):
    before, option = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had = spark.conf.get(option, None)
    got = settled(spark.range(1000).withColumn("k", F.col("id") % 7).repartition(3, "k"))
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert got.count() == 1000 and spark.conf.get(option, None) == had


BLOCKS = "fragment_id string, aln_no int, read_index int, paired boolean, kind string, chrom string, start long, end long, strand string, block_idx int, last_block int, ref_start long, ref_end long, exon_strand string, overlap long, g_chrom string, g_start long, g_end long, length_difference int, p_start long, p_end long, p_strand string"


def test_blocks_dealt_by_fragment_are_moved_where_they_are(spark):
    block = lambda f, kind, chrom, start, d: (f, 1, 1, False, kind, chrom, 1, 51, "+", 0, 0, 1, 60, "+", 51, "c", 1, 60, d, start, start + 50, "+")
    b = spark.createDataFrame([block("f", "transcript", "t1", 100, 3), block("f", "transcript", "t2", 102, 0), block("f", "genome", "c", 102, 3), block("g", "transcript", "t1", 100, 3)], BLOCKS)
    got = references.on_genome(b.repartition("fragment_id"))
    assert exchanges(got) == 1
    assert sorted((r.fragment_id, r.ref, r.chrom, r.start, r.end, r.length_difference) for r in got.collect()) == [("f", "c", "c", 1, 51, 3), ("f", "t1", "c", 102, 152, 0), ("f", "t2", "c", 102, 152, 0), ("g", "t1", "c", 100, 150, 3)]
    assert exchanges(projection.reorder(b.repartition("fragment_id"))) == 1


def test_hits_are_dealt_once_to_be_chosen_and_numbered(spark):
    hits = spark.createDataFrame([hit("f", "computed", 1, 1, 100, "50M"), hit("f", "direct", 1, 1, 101, "50M"), hit("lost", "direct", 1, 1, 7, "3M")], HITS)
    got = genome_alignments.reconstruct(hits, spark.createDataFrame([("f", 1), ("h", 2)], "fragment_id string, reads int"))
    assert exchanges(got) <= 7  # two of the overlap join, three of its answer, one of hits, marks and numbers of reads
    assert sorted((r.fragment_id, r.read_index, r.flag, r.pos, r.source) for r in got.collect()) == [("f", 1, 0, 100, "computed"), ("h", 1, 77, 0, "none"), ("h", 2, 141, 0, "none")]


def test_bins_of_levels_that_no_block_has_are_left_out(spark):
    b = spark.range(30).select(F.lit("c").alias("chrom"), (F.col("id") * 40 + 1).alias("start"), (F.col("id") * 40 + 60).alias("end"), F.lit("+").alias("strand"), F.col("id").alias("fragment_id"))
    e = spark.range(30).select(F.col("id").cast("string").alias("exon_id"), F.lit("c").alias("chrom"), (F.col("id") * 37 + 1).alias("start"), (F.col("id") * 37 + 90).alias("end"), F.lit("-").alias("strand"))
    long = e.where("exon_id < '2'").withColumns({"exon_id": F.concat("exon_id", F.lit("long")), "end": F.col("start") + 5000})
    rows = lambda df: sorted(tuple(r) for r in df.select("fragment_id", "exon_id", "overlap").collect())
    for exons in (e, long, e.unionByName(long)):
        assert rows(intervals.interval_join(b, exons, block_levels=intervals.levels(b))) == rows(intervals.plain_interval_join(b, exons))
        assert rows(intervals.interval_join(exons.drop("exon_id").withColumn("fragment_id", F.col("start")), e, block_levels=intervals.levels(exons))) == rows(intervals.plain_interval_join(exons.drop("exon_id").withColumn("fragment_id", F.col("start")), e))
    plan = lambda **o: intervals.interval_join(b, e, **o)._jdf.queryExecution().optimizedPlan().toJSON().count("ShiftRight")
    assert plan(block_levels=[0]) < plan()


SAM = "fragment_id string, row_no int, query_name string, ref string, pos long, mate_ref string, mate_pos long, read_index int, HI int, flag int"


def test_mates_are_found_where_their_fragment_is_dealt(spark):
    given = [("f", 1, "q", "c", 10, "c", 50, 1, None, 67), ("f", 2, "q", "c", 50, "c", 10, 2, None, 131), ("g", 1, "q", "c", 10, "*", 0, 1, None, 0), ("g", 2, "q", "c", 10, "*", 0, 1, None, 0), (None, 1, "q", "c", 10, "c", 50, 1, None, 67), (None, 2, "q", "c", 50, "c", 10, 2, None, 131)]
    r = spark.createDataFrame(given, SAM)
    pairs = alignments.mate_pairs(r)
    assert exchanges(pairs) == 1 and [tuple(x) for x in pairs.collect()] == [("f", 1, 2)]
    got = alignments.read_filter(r, pairs)
    assert exchanges(got) == 2
    key = lambda x: (x[0] or "", *x[1:])
    assert sorted((key((x.fragment_id, x.row_no, x.aln_no, x.paired)) for x in got.collect())) == [("", 1, 1, False), ("", 2, 2, False), ("f", 1, 1, True), ("f", 2, 1, True), ("g", 1, 1, False), ("g", 2, 2, False)]
