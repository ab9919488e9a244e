import pytest
from engine_helpers import rows
from pyspark.sql import functions as F

from readloom.operators import alignments, combine, counting, genome_alignments, intervals, junctions, projection, reads, tables, weights
from readloom.plans import genome_counts
from readloom.sources import readers

BLOCK = "fragment_id string, aln_no int, read_index int, paired boolean, chrom string, start long, end long, strand string, block_idx int, last_block int, aligned_len int, ins int, del int"
EXON = "exon_id string, chrom string, start long, end long, strand string"


def blocks(spark, *spans, fragment="f", aln=1, read=1, paired=False):
    out = []
    for i, (s, e) in enumerate(spans):
        out.append((fragment, aln, read, paired, "c", s, e, "+", i, len(spans) - 1, e - s + 1, 0, 0))
    return spark.createDataFrame(out, BLOCK)


def exons(spark, **spans):
    return spark.createDataFrame([(k, "c", s, e, "+") for k, (s, e) in spans.items()], EXON)


def objects(spark, **named):
    return spark.createDataFrame(list(named.items()), "exon_id string, object_id string")


def counted(df):
    return {r["id"]: round(r["count"], 6) for r in df.collect()}


def test_gene_mode_takes_conforming_exons_only(spark):
    e = exons(spark, E1=(100, 160), E2=(120, 200))
    b = blocks(spark, (105, 154))
    assert counted(counting.quantify(b, e, objects(spark, E1="G", E2="G"))) == {"G": 1.0}
    assert counted(counting.quantify(b, e, objects(spark, E1="A", E2="B"))) == {"A": 1.0}


def test_junction_mode_needs_a_run_of_two(spark):
    b = blocks(spark, (81, 100), (201, 230))
    m = objects(spark, A="J", B="J")
    assert counted(counting.quantify(b, exons(spark, A=(50, 100), B=(201, 300)), m, "junction")) == {"J": 1.0}
    assert counted(counting.quantify(b, exons(spark, A=(50, 100), B=(202, 300)), m, "junction")) == {}


def test_multi_mapping_weights(spark):
    b = blocks(spark, (101, 120)).unionByName(blocks(spark, (501, 520), aln=2))
    e, w = exons(spark, X=(100, 200), Y=(500, 600)), spark.createDataFrame([("f", 2)], "fragment_id string, n int")
    two, one = objects(spark, X="G", Y="H"), objects(spark, X="G", Y="G")
    assert counted(counting.quantify(b, e, two, weights=w)) == {"G": 0.5, "H": 0.5}
    assert counted(counting.quantify(b, e, two, weights=w, unambiguous=True)) == {}
    assert counted(counting.quantify(b, e, two, weights=w, threshold=0.6)) == {}
    assert counted(counting.quantify(b, e, one, weights=w)) == {"G": 1.0}
    with pytest.raises(Exception, match="without weight"):
        counting.quantify(b, e, two, weights=w.where("n = 0")).collect()


def test_pairs_intersect_in_gene_mode_and_unite_in_exon_mode(spark):
    b = blocks(spark, (101, 120), paired=True).unionByName(blocks(spark, (501, 520), read=2, paired=True))
    e, m = exons(spark, X=(100, 200), Y=(500, 600)), objects(spark, X="G", Y="H")
    assert counted(counting.quantify(b, e, m)) == {}
    assert counted(counting.quantify(b, e, m, "exon")) == {"G": 1.0, "H": 1.0}
    assert counted(counting.quantify(b, e, objects(spark, X="G", Y="G"))) == {"G": 1.0}


def test_all_objects_are_written(spark):
    from readloom.sources.writers import count_table

    m = spark.createDataFrame([("e1", "a"), ("e1", "b"), ("e2", "b")], "exon_id string, object_id string")
    none = spark.createDataFrame([], "id string, count double")
    assert [tuple(r) for r in count_table(none, m).collect()] == [("a", 0.0), ("b", 0.0)]
    assert count_table(none, m, nonzero=True).collect() == []


def test_weight_summary_of_single_hits(spark):
    a = spark.createDataFrame([("f", 1, 1, False, 1), ("f", 2, 1, False, 2), ("f", 3, 2, False, 0)], "fragment_id string, aln_no int, read_index int, paired boolean, nm int")
    assert rows(weights.summarize(a)) == [("f", 2, 3, "single-read (both)")]
    p = a.withColumn("paired", F.lit(True)).withColumn("aln_no", F.lit(1))
    assert rows(weights.summarize(p)) == [("f", 1, 3, "paired-end")]


def test_choice_between_sets(spark):
    s = "fragment_id string, num_alignments int, sum_edit_distance int, kind string"
    one = spark.createDataFrame([(k, 2, 2, "single-read") for k in "abc"] + [("d", 1, 5, "paired-end")], s)
    two = spark.createDataFrame([("a", 3, 3, "single-read"), ("b", 2, 2, "single-read"), ("c", 1, 0, "single-read"), ("d", 1, 0, "single-read"), ("e", 1, 0, "single-read")], s)
    assert rows(weights.choose(one, two), "fragment_id", "side") == [("a", 2), ("b", 1), ("c", 2), ("d", 1), ("e", 2)]


def test_interval_merges(spark):
    r = spark.createDataFrame([("g", "c", s, e) for s, e in ((1, 10), (5, 20), (21, 30), (40, 41))], "gene_id string, chrom string, start long, end long")
    assert rows(intervals.union_length(r, ["gene_id"])) == [("g", 32)]
    assert rows(intervals.merge(r, ["gene_id"], gap=1), "start", "end") == [(1, 30), (40, 41)]


def test_binned_join_equals_plain_join(spark):
    b = blocks(spark, (1, 5000)).unionByName(blocks(spark, (1023, 1024), (2048, 2050), aln=2)).unionByName(blocks(spark, (3000, 3001), aln=3))
    e = exons(spark, A=(1, 1), B=(1024, 1024), C=(900, 2049), D=(4999, 9000), E=(3001, 3001))
    for least in (1, 2, 5):
        columns = ("aln_no", "block_idx", "exon_id", "overlap")
        assert rows(intervals.interval_join(b, e, least), *columns) == rows(intervals.plain_interval_join(b, e, least), *columns)


def test_fpkm_and_matrix(spark):
    c = spark.createDataFrame([("g", "s1", 500.0), ("h", "s2", 4.0)], "id string, sample string, count double")
    n = spark.createDataFrame([("g", 2000)], "id string, length long")
    v = tables.fpkm(c, n, spark.createDataFrame([("s1", 10_000_000)], "sample string, reads long"))
    assert rows(v) == [("g", "s1", 25.0)]
    assert rows(tables.sample_matrix(c, ["s1", "s2"])) == [("g", 500.0, 0.0), ("h", 0.0, 4.0)]


def test_semi_and_anti_filter_split_the_input(spark):
    r = spark.createDataFrame([("a:1", 1), ("b:2", 2), ("c", 3)], "k string, v int")
    o = spark.createDataFrame([("a:9",), ("a:8",), ("c",)], "x string")
    semi = tables.key_filter(r, o, ["k"], ["x"], sub_separator=":")
    anti = tables.key_filter(r, o, ["k"], ["x"], invert=True, sub_separator=":")
    assert rows(semi) == [("a:1", 1), ("c", 3)] and rows(anti) == [("b:2", 2)]
    with pytest.raises(ValueError):
        tables.key_filter(r, o, ["k", "v"], ["x"])


def test_junction_ids(spark):
    j = spark.createDataFrame([("G-junction-3-4:1-2:5",)], "junction_id string")
    assert rows(junctions.expand_ids(j), "expanded") == [("G-junction-1-2",), ("G-junction-2-3",), ("G-junction-3-4",), ("G-junction-4-5",)]


def test_mates_pair_greedily_under_repeats(spark):
    kind = "fragment_id string, row_no int, query_name string, ref string, pos long, mate_ref string, mate_pos long, read_index int, HI int"
    r = spark.createDataFrame([("f", 1, "q", "c", 10, "c", 50, 1, None), ("f", 2, "q", "c", 10, "c", 50, 1, None), ("f", 3, "q", "c", 50, "c", 10, 2, None), ("g", 1, "q", "c", 1, "c", 2, 1, 7), ("g", 2, "q", "d", 9, "c", 1, 2, 7)], kind)
    assert rows(alignments.mate_pairs(r)) == [("f", 1, 3), ("g", 1, 2)]


def test_combining_fills_in_the_other_read(spark):
    s = "fragment_id string, aln_no int, read_index int, paired boolean, nm int"
    one = spark.createDataFrame([("f", 1, 1, False, 0), ("g", 1, 1, True, 0), ("g", 1, 2, True, 0)], s)
    two = spark.createDataFrame([("f", 1, 1, False, 3), ("f", 2, 1, False, 3), ("h", 1, 2, False, 0)], s)
    three = spark.createDataFrame([("f", 5, 2, False, 3)], s)
    assert rows(combine.combine(one, two), "fragment_id", "aln_no", "source") == [("f", 1, 1), ("g", 1, 1), ("g", 1, 1), ("h", 1, 2)]
    assert rows(combine.combine(one, three).where("fragment_id = 'f'"), "aln_no", "source") == [(1, 1), (5, 2)]
    assert rows(combine.subtract(one, two), "fragment_id") == [("f",), ("g",), ("g",)]
    assert rows(combine.merge_first(one, two), "fragment_id", "source") == [("f", 1), ("g", 1), ("g", 1), ("h", 2)]


def test_tiles_and_short_reads(spark):
    r = spark.createDataFrame([("f", 1, "ACGTACGTAC"), ("g", 1, "AC")], "fragment_id string, read_index int, seq string")
    assert rows(reads.tile(r, 6, 2), "start", "tile_id") == [(0, "f-0/1"), (2, "f-2/1")]
    assert rows(reads.shorten(r, 4), "seq") == [("AC",), ("ACGT",)]
    with pytest.raises(Exception, match="shorter"):
        reads.shorten(r, 4, strict=True).collect()


def test_projection_counts_from_the_nearer_end(spark):
    base = {"start": 3, "end": 12, "strand": "+", "block_idx": 0, "last_block": 0, "overlap": 10, "ref_start": 1, "ref_end": 100, "g_start": 1001, "g_end": 1100, "exon_strand": "+", "kind": "transcript"}
    cases = [base, base | {"exon_strand": "-"}, base | {"start": 91, "end": 100}]
    df = spark.createDataFrame(cases)
    got = {(r.exon_strand, r.start): (r.p_start, r.p_end, r.p_strand) for r in projection.project(df).collect()}
    assert got == {("+", 3): (1003, 1012, "+"), ("-", 3): (1089, 1098, "-"), ("+", 91): (1091, 1100, "+")}


def test_snapping_moves_to_the_smaller_difference(spark):
    b = spark.createDataFrame([("f", 1, "t1", "c", 100, 150, 3), ("f", 1, "t2", "c", 102, 152, 0), ("g", 1, "t1", "c", 100, 150, 1), ("g", 1, "t2", "c", 105, 155, 0)], "fragment_id string, side int, ref string, chrom string, start long, end long, length_difference int")
    assert rows(projection.snap(b), "fragment_id", "ref", "start") == [("f", "t1", 102), ("f", "t2", 102), ("g", "t1", 100), ("g", "t2", 105)]


HITS = "fragment_id string, source string, hit long, read_index int, paired boolean, chrom string, strand string, mapq int, pos long, end long, cigar string, seq string, qual string"


def hit(fragment, source, number, read, pos, text, strand="+", paired=False, mapq=20, chrom="c"):
    import re

    end = pos - 1 + sum(int(n) for n, o in re.findall(r"(\d+)([MDN])", text))
    return (fragment, source, number, read, paired, chrom, strand, mapq, pos, end, text, "*", "*")


def given(spark, hits, reads):
    df = spark.createDataFrame(hits, HITS)
    return rows(genome_alignments.reconstruct(df, spark.createDataFrame(reads, "fragment_id string, reads int")), "fragment_id", "read_index", "flag", "pos", "mapq", "cigar", "nh", "hit", "source", "mate_pos")


def test_genome_alignments_pairs_come_first(spark):
    hits = [hit("f", "computed", 1, 1, 1, "10M10N10M", mapq=3, paired=True), hit("f", "computed", 1, 2, 50, "10M", "-", True), hit("f", "direct", 1, 1, 900, "10M"), hit("g", "direct", 1, 1, 7, "3M", mapq=9)]
    assert given(spark, hits, [("f", 2), ("g", 2), ("h", 1)]) == [
        ("f", 1, 1 + 2 + 32 + 64, 1, 10, "10M10N10M", 1, 1, "computed", 50), ("f", 2, 1 + 2 + 16 + 128, 50, 20, "10M", 1, 1, "computed", 1),
        ("g", 1, 1 + 8 + 64, 7, 10, "3M", 1, 1, "direct", 0), ("g", 2, 4 + 1 + 128, 0, 0, "*", 0, 0, "none", 0), ("h", 1, 4, 0, 0, "*", 0, 0, "none", 0),
    ]


def test_genome_alignments_near_duplicates(spark):
    """A direct hit one base beside a computed one goes; equal ones leave the direct one; of pairs both reads must be near."""
    hits = [
        hit("near", "computed", 1, 1, 100, "50M"), hit("near", "direct", 1, 1, 101, "50M"), hit("near", "direct", 2, 1, 400, "50M"), hit("near", "direct", 3, 1, 100, "50M", chrom="d"),
        hit("same", "computed", 1, 1, 100, "50M"), hit("same", "direct", 4, 1, 100, "50M"), hit("same", "direct", 5, 1, 101, "50M"),
        hit("pair", "computed", 1, 1, 100, "20M60N30M", paired=True), hit("pair", "computed", 1, 2, 300, "50M", "-", True), hit("pair", "direct", 1, 1, 100, "22M60N28M", paired=True), hit("pair", "direct", 1, 2, 301, "50M", "-", True),
        hit("pair", "direct", 2, 1, 100, "50M", paired=True), hit("pair", "direct", 2, 2, 900, "50M", "-", True), hit("pair", "direct", 3, 1, 5000, "50M"),
        hit("third", "computed", 1, 1, 100, "50M"), hit("third", "direct", 1, 1, 115, "50M"), hit("third", "direct", 2, 1, 116, "50M"),
    ]
    got = [(r[0], r[1], r[3], r[5], r[6], r[8], r[2] >= 256) for r in given(spark, hits, [("near", 1), ("same", 1), ("pair", 2), ("third", 1)])]
    assert sorted(got) == sorted([
        ("near", 1, 100, "50M", 3, "computed", False), ("near", 1, 400, "50M", 3, "direct", True), ("near", 1, 100, "50M", 3, "direct", True), ("same", 1, 100, "50M", 2, "direct", False), ("same", 1, 101, "50M", 2, "direct", True),
        ("pair", 1, 100, "20M60N30M", 2, "computed", False), ("pair", 2, 300, "50M", 2, "computed", False), ("pair", 1, 100, "50M", 2, "direct", True), ("pair", 2, 900, "50M", 2, "direct", True), ("third", 1, 100, "50M", 2, "computed", False), ("third", 1, 116, "50M", 2, "direct", True),
    ])


def test_genome_alignments_keep_operations_bases_and_qualities(spark):
    """A direct hit stays as it is; a read on a transcript of the reverse strand is turned and cut at its exons."""
    from readloom.plans import references

    seq, qual = "AACCGGTTACGTAC", "ABCDEFGHIJKLMN"
    exons = spark.createDataFrame([("e1", "t1", 1, 10, "-", "c", 201, 210), ("e2", "t1", 11, 30, "-", "c", 101, 120)], "exon_id string, chrom string, start long, end long, strand string, g_chrom string, g_start long, g_end long")
    reads_ = [("f", 1, 1, False, "transcript", "t1", 6, "2S3M1I3M2D5M", "+", 0, 20, seq, qual), ("g", 1, 1, False, "genome", "c", 500, "3S10M4D1M", "-", 0, 20, seq, qual)]
    df = spark.createDataFrame(reads_, "fragment_id string, aln_no int, read_index int, paired boolean, kind string, chrom string, pos long, cigar string, strand string, nm int, mapq int, seq string, qual string")
    got = rows(references.genome_rows(df, exons, spark.createDataFrame([("f", 1), ("g", 1)], "fragment_id string, reads int")), "fragment_id", "flag", "pos", "cigar", "seq", "qual")
    # Bases 6 to 10 of the transcript lie at 205 down to 201, 11 to 18 at 120 down to 113; the leading clip belongs to no base.
    assert got == [("f", 16, 113, "5M2D1M80N2M1I3M2S", "GTACGTAACCGGTT", qual[::-1]), ("g", 16, 500, "3S10M4D1M", seq, qual)]


SAM = ["@SQ\tSN:c\tLN:1000", "r1\t0\tc\t105\t60\t50M\t*\t0\t0\t" + "A" * 50 + "\t" + "I" * 50 + "\tNM:i:1", "r2\t0\tc\t105\t60\t50M\t*\t0\t0\t" + "A" * 50 + "\t*\tNM:i:9", "r3\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII"]


def test_sam_to_counts(spark, tmp_path):
    (tmp_path / "a.sam").write_text("\n".join(SAM) + "\n")
    (tmp_path / "map.txt").write_text("Exon Id\tObject Id\nc/100/160/+\tG\nc/700/760/+\tH\n")
    rows_, objects_ = readers.sam(spark, str(tmp_path / "a.sam")), readers.object_map(spark, str(tmp_path / "map.txt"))
    assert rows_.count() == 2
    assert counted(genome_counts.from_sam(rows_, objects_)) == {"G": 2.0}
    assert counted(genome_counts.from_sam(rows_, objects_, max_edits=3)) == {"G": 1.0}
    genome_counts.run(spark, str(tmp_path / "a.sam"), str(tmp_path / "map.txt"), str(tmp_path / "out"))
    assert [tuple(r) for r in readers.tsv(spark, str(tmp_path / "out"), "id string, n double").collect()] == [("G", 2.0), ("H", 0.0)]
    assert rows(readers.lengths(spark, str(tmp_path / "a.sam"))) == [("c", 1000)]


def test_bad_sam_rows_raise(spark):
    for line in ("a\t0\tc", SAM[1].replace("I" * 50, "I"), SAM[1].replace("r1\t0", "r1/1\t129")):
        with pytest.raises(Exception, match="SAM row|differ"):
            readers.parse_sam(spark.createDataFrame([(line,)], "value string")).collect()


def test_other_sources(spark, tmp_path):
    (tmp_path / "x.fastq").write_text("@a/1 3\nacgt\n+\nIIII\n@b/2\nAC\n+\nII\n")
    got = readers.fastq(spark, str(tmp_path / "x.fastq"))
    assert rows(got, "fragment_id", "read_index", "multiplicity", "seq", "qual") == [("a", 1, 3, "ACGT", "IIII"), ("b", 2, 1, "AC", "II")]
    (tmp_path / "x.gtf").write_text('c\ts\texon\t5\t9\t.\t+\t.\tgene_id "g"; transcript_id "t"; exon_number 2;\n')
    assert rows(readers.gtf(spark, str(tmp_path / "x.gtf")), "gene_id", "transcript_id", "exon_number", "exon_id") == [("g", "t", 2, "c/5/9/+")]
    (tmp_path / "w.txt").write_text("f/1/1\t2\t3\tsingle-read\n")
    assert rows(readers.weights(spark, str(tmp_path / "w.txt")), "fragment", "multiplicity") == [("f/1", 1)]
    (tmp_path / "b.bed").write_text("c\t0\t20\tf-A00001-L20-I0-D0-F0-1/P1\t0\t+\n")
    r = readers.bed6(spark, str(tmp_path / "b.bed")).first()
    assert (r.start, r.end, r.block.fragment_id, r.block.last_block, r.block.paired) == (1, 20, "f", 1, True)
    (tmp_path / "s.txt").write_text("Sample Name\tFastq Path\tFASTQ name\ns1\tp\ta.fq\ns1\tp\tb.fq\ns2\tp\tc.fq\n")
    assert rows(readers.samples(spark, str(tmp_path / "s.txt")), "link") == [("s1_1",), ("s1_2",), ("s2",)]


def test_renumbered_fragments_do_not_depend_on_partitions(spark):
    r = spark.createDataFrame([(f"n{i:03d}",) for i in range(100)], "fragment_name string")
    a, b = (dict(rows(readers.rename_fragments(r.repartition(k)), "fragment_name", "fragment_id")) for k in (1, 7))
    assert a == b and a["n000"] == "F000000001" and a["n099"] == "F000000100"


def test_blocks_find_their_rows(spark):
    b = spark.createDataFrame([("f", "c", 5, 1)], "fragment_id string, ref string, pos long, read_index int")
    r = spark.createDataFrame([("f", "c", 5, 1, "AC"), ("f", "c", 9, 1, "GT")], "fragment_id string, ref string, pos long, read_index int, seq string")
    assert rows(alignments.attach_rows(b, r, ["seq"]), "seq") == [("AC",)]
    with pytest.raises(Exception, match="without its alignment"):
        alignments.attach_rows(b.withColumn("pos", F.lit(7).cast("long")), r, ["seq"]).collect()


def test_numbers_raise_with_their_text(spark):
    from readloom.functions.names import to_double, to_int

    df = spark.createDataFrame([("12", "1.5e3")], "a string, b string")
    assert rows(df.select(to_int(F.col("a")), to_double(F.col("b")))) == [(12, 1500.0)]
    with pytest.raises(Exception, match="x1"):
        df.select(to_int(F.lit("x1"))).collect()


def test_transcript_versions_and_chromosome_check(spark):
    e = spark.createDataFrame([("tr-A.1",), ("tr-A.2",), ("c",)], "chrom string")
    r = spark.createDataFrame([("tr-A", 1), ("c", 2), ("d", 3)], "chrom string, v int")
    assert rows(alignments.expand_versions(r, e)) == [("c", 2), ("d", 3), ("tr-A.1", 1), ("tr-A.2", 1)]
    assert rows(alignments.chromosome_check(r, e)) == [("c", True), ("d", False), ("tr-A", False)]
    with pytest.raises(ValueError):
        alignments.chromosome_check(r.where("chrom = 'd'"), e)


def test_fastq_in_small_splits(spark, tmp_path):
    text = "".join(f"@r{i}/{1 + i % 2}\n{'acgtn' * (1 + i % 4)}\n+\n{'@>+II' * (1 + i % 4)}\n" for i in range(300))
    (tmp_path / "a.fastq").write_text(text)
    (tmp_path / "b.fa").write_text("".join(f">s{i}\nACGT\n" for i in range(50)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = readers.fastq(spark, [str(tmp_path / "a.fastq"), str(tmp_path / "b.fa")])
        found = {r.full_id: (r.record, r.seq, r.qual) for r in got.collect()}
        assert len(found) == 350 and found["r299/2"] == (299, "ACGTN" * 4, "@>+II" * 4) and found["s7"] == (7, "ACGT", "*")
        for name, body, why in (("c", "@a\nACGT\n+\nIII\n", "malformed"), ("d", "@a\nACGT\n+\nIIII\n@b\nA\n", "cut off"), ("e", "a\nACGT\n+\nIIII\n", "malformed")):
            (tmp_path / f"{name}.fastq").write_text(body)
            with pytest.raises(Exception, match=why):
                readers.fastq(spark, str(tmp_path / f"{name}.fastq")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_identical_rows_stay_apart(spark, tmp_path):
    row = "q\t0\tc\t105\t20\t50M\t*\t0\t0\t*\t*\tNM:i:0\n"
    (tmp_path / "x.sam").write_text("@SQ\tSN:c\tLN:999\n" + row * 2)
    parsed = readers.sam(spark, str(tmp_path / "x.sam"))
    assert parsed.select("row_no").distinct().count() == 2
    m = spark.createDataFrame([("c/100/160/+", "G")], "exon_id string, object_id string")
    for r in (parsed, parsed.drop("row_no")):
        assert counted(genome_counts.from_sam(r, m)) == {"G": 0.5}


def test_count_driver_writes_maps_of_three_columns(spark, tmp_path):
    (tmp_path / "x.sam").write_text("q\t0\tc\t105\t20\t50M\t*\t0\t0\t*\t*\tNM:i:0\n")
    (tmp_path / "m.txt").write_text("c/100/160/+\tout1\tin\nc/100/160/+\tout2\tin\nc/900/960/+\tout3\tother\n")
    (tmp_path / "w.txt").write_text("q\t4\t0\tsingle-read\n")
    genome_counts.run(spark, str(tmp_path / "x.sam"), str(tmp_path / "m.txt"), str(tmp_path / "o"), weight_file=str(tmp_path / "w.txt"))
    got = readers.counts(spark, str(tmp_path / "o"))
    assert rows(got, "id", "count") == [("out1", 0.25), ("out2", 0.25), ("out3", 0.0)]


def test_tables_that_exist_are_not_made_again(spark, tmp_path):
    from readloom.sources import settled

    made = []

    def make():
        made.append(1)
        return spark.range(3)

    path = f"file://{tmp_path}/t"
    assert [settled.kept(spark, path, make).count() for _ in range(2)] == [3, 3] and len(made) == 1
    assert settled.kept(spark, path, make, again=True).count() == 3 and len(made) == 2
