from pyspark.sql import functions as F

from readloom.functions import cigar, estimators, flags, names, sequence
from readloom.functions.intervals import blocks_overlap, contains, distance


def one(spark, **columns):
    """First row of columns computed over a one-row frame."""
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_blocks_of_one_gap(spark):
    ops = cigar.parse(F.lit("20M100N30M"))
    r = one(spark, b=cigar.blocks(F.lit(1), ops), i=cigar.introns(F.lit(1), ops), e=cigar.end_position(F.lit(1), ops))
    assert [(b["start"], b["end"], b["aligned_len"], b["ins"], b["del"]) for b in r.b] == [(1, 20, 20, 0, 0), (121, 150, 30, 0, 0)]
    assert [(i["start"], i["end"]) for i in r.i] == [(21, 120)]
    assert r.e == 150


def test_blocks_of_two_gaps_and_an_insertion(spark):
    ops = cigar.parse(F.lit("54M3509N12M336N29M1I4M"))
    r = one(spark, b=cigar.blocks(F.lit(123485490), ops), i=cigar.introns(F.lit(123485490), ops), n=cigar.read_length(ops))
    assert [(b["start"], b["end"]) for b in r.b] == [(123485490, 123485543), (123489053, 123489064), (123489401, 123489433)]
    assert (r.b[2]["aligned_len"], r.b[2]["ins"], r.b[2]["del"], r.b[2]["ref_len"]) == (34, 1, 0, 33)
    assert [(i["start"], i["end"]) for i in r.i] == [(123485544, 123489052), (123489065, 123489400)]
    assert sum(b["aligned_len"] for b in r.b) == r.n == 100


def test_cigar_append_merges(spark):
    add = lambda a, b: cigar.render(cigar.append(cigar.parse(F.lit(a)), cigar.parse(F.lit(b))))
    r = one(spark, same=add("10M", "5M"), gap=add("10M2D", "5N3M"), back=add("10M5N", "2D3M"), none=add("10M", "0I4M"), invert=cigar.render(cigar.invert(cigar.parse(F.lit("3S5M")))))
    assert (r.same, r.gap, r.back, r.none, r.invert) == ("15M", "10M7N3M", "10M7N3M", "14M", "5M3S")


def test_cigar_cut(spark):
    seq = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    cases = [("10M5N10M", 6, 20, True, False, "5M5N5M", "FGHIJKLMNO"), ("3S10M4D10M2S", 1, 10, True, False, "10M", "DEFGHIJKLM"), ("3S10M4D10M2S", 1, 24, True, False, "10M4D10M2S", seq[3:25]), ("10M2I10M", 1, 10, True, False, "10M2I", seq[:12]), ("10M2I10M", 11, 20, True, False, "10M", seq[12:22]), ("10M2I10M", 5, 12, False, False, "6I2I2I", seq[4:14]), ("10M2D10M", 9, 14, False, True, "2S2D2S", seq[8:12]), ("10M", 11, 12, True, False, "", ""), ("5M3D5M", 6, 8, True, False, "3D", "")]
    df = spark.createDataFrame(cases, "c string, l int, r int, placed boolean, margin boolean, want string, bases string")
    x = df.select("want", "bases", cigar.cut(cigar.parse(F.col("c")), F.col("l"), F.col("r"), F.col("placed"), F.col("margin")).alias("x")).select("want", "bases", cigar.render(F.col("x.ops")).alias("got"), F.col("x.begin").alias("begin"), F.col("x.bases").alias("n"))
    for r in x.collect():
        assert (r.got, seq[r.begin : r.begin + r.n]) == (r.want, r.bases)


def test_spans_are_cleaned_and_stitched(spark):
    """Exons that share bases of the reference, one that its neighbour covers, one without a place on the genome."""
    from readloom.functions import spans

    s = lambda a, b, c, x, y, o: {"ref_start": a, "ref_end": b, "chrom": c, "start": x, "end": y, "overlap": o}
    seq = "ACGTACGTAC" * 3
    cases = [
        ("shared", [s(1, 16, "c", 101, 116, 16), s(11, 40, "c", 201, 220, 20)], "30M"),
        ("covered", [s(1, 20, "c", 101, 120, 20), s(17, 20, "c", 151, 154, 4), s(21, 30, "c", 201, 207, 7)], "20M2I7M1S"),
        ("covers", [s(1, 4, "c", 101, 104, 4), s(1, 20, "c", 201, 220, 20)], "20M"),
        ("elsewhere", [s(1, 5, "tr-x", 1, 5, 5), s(6, 20, "c", 11, 25, 15)], "5M3D17M"),
    ]
    df = spark.createDataFrame(cases, f"name string, v array<{spans.SPAN}>, c string")
    kept = spans.cleaned(F.col("v"))
    got = {r.name: r for r in df.select("name", spans.total_shared(F.col("v")).alias("shared"), F.size(kept).alias("n"), spans.stitched(kept, cigar.parse(F.col("c")), F.lit(seq), F.lit("*")).alias("x")).collect()}
    assert {k: r.n for k, r in got.items()} == {"shared": 2, "covered": 2, "covers": 1, "elsewhere": 2}
    assert got["shared"].x.cigar == "16M84N20M" and got["shared"].shared == 6 and got["shared"].x.seq == seq[:16] + seq[10:30]
    assert got["covered"].x.cigar == "20M2I80N7M1S" and got["covered"].x.seq == seq[:30] and got["covered"].x.qual == "*"
    assert got["covers"].x.cigar == "20M"
    assert got["elsewhere"].x.cigar == "5S3D12M" and got["elsewhere"].x.seq == seq[:17]


def test_reverse_complement_and_homopolymer(spark):
    r = one(spark, rc=sequence.reverse_complement(F.lit("acgtn")), bad=sequence.is_homopolymer(F.lit("AAAAAAAATG")), off=sequence.is_homopolymer(F.lit("AAAA"), 0))
    assert (r.rc, r.bad, r.off) == ("NACGT", True, False)


def test_tiles_end_strictly_before_the_end(spark):
    assert one(spark, t=sequence.tiles(F.lit("A" * 10), 6, 2)).t == [0, 2]


def test_flags(spark):
    f = F.lit(1 + 2 + 16 + 128 + 256)
    r = one(spark, mate=flags.has_mate(f), index=flags.read_index(f, F.lit("r/1")), single=flags.read_index(F.lit(0), F.lit("r/2")), none=flags.read_index(F.lit(0), F.lit("r")), off=flags.with_bit(f, "secondary", False), strand=flags.fragment_strand(flags.strand(f), F.lit(2), "forward"))
    assert (r.mate, r["index"], r.single, r.none, r.off, r.strand) == (True, 2, 2, 1, 147, "+")


def test_names(spark):
    r = one(
        spark, frag=names.fragment_name(F.lit("r1/2 extra")), j=names.simplify_junction(F.lit("g-junction-1-2:3:4")), b=names.base_object(F.lit("g-exon1")), nm=names.tag(F.lit("AS:i:-3\tNM:i:2"), "NM"), no=names.tag(F.lit("XX:i:1"), "NM"),
        new=names.set_tag(F.lit("NM:i:2\tHI:i:1"), "HI", "i", F.lit(7)), add=names.set_tag(F.lit("NM:i:2"), "HI", "i", F.lit(7)), cut=names.modify_fragment(F.lit("runX:abc"), "X:", "X:a"), c=names.counter(F.lit(12)), e=names.parse_exon(F.lit("g1/chr2/0/50/-.inv-strand")), t=names.parse_exon(F.lit("tr-ENST1.4/5/9")),
    )
    assert (r.frag, r.j, r.b, r.nm, r.no, r.new, r["add"], r.cut, r.c) == ("r1", "g-junction-1-2", "g", 2, None, "NM:i:2\tHI:i:7", "NM:i:2\tHI:i:7", "bc", "F000000012")
    assert tuple(r.e) == ("g1", "chr2", 1, 50, "+", False)
    assert tuple(r.t) == (None, "tr-ENST1", 5, 9, "+", True)


def test_interval_functions(spark):
    blocks = F.array(F.struct(F.lit(1).alias("start"), F.lit(10).alias("end")), F.struct(F.lit(21).alias("start"), F.lit(30).alias("end")))
    r = one(spark, o=blocks_overlap(blocks, F.lit(6), F.lit(25)), any=contains(F.lit(1), F.lit(5), F.lit(9), F.lit(0)), no=contains(F.lit(1), F.lit(5), F.lit(2), F.lit(6)), d=distance(F.lit("a"), F.lit(1), F.lit(9), F.lit("a"), F.lit(4), F.lit(10)), far=distance(F.lit("a"), F.lit(1), F.lit(9), F.lit("b"), F.lit(4), F.lit(10)))
    assert (r.o, r.any, r.no, r.d, r.far) == (10, True, False, 3, -1)


def test_effective_length_is_the_first_number_whose_expectation_reaches_the_observed(spark):
    cases = [(10, 20, 1000), (50, 60, 200), (5, 5, 100), (3, 100, 1000), (0, 0, 50), (37, 90, 37)]
    df = spark.createDataFrame(cases, "d long, n long, l long").select("d", "n", "l", estimators.effective_length(F.col("d"), F.col("n"), F.col("l")).alias("m"))
    for d, n, length, m in df.collect():
        if d in (0, n, length):
            assert m == d
        else:
            e = lambda x: x * (1 - (1 - 1 / x) ** n)  # noqa: B023, E731
            assert m == next(x for x in range(1, length + 1) if e(x) >= d)


def test_minimum_start(spark):
    assert one(spark, a=estimators.minimum_start(F.lit(20), F.lit(100), F.lit(9))).a == 12
