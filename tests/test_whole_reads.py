"""The reads of the registered queries are made from whole texts."""

import re

import pytest

from readloom.plans import catalog

HEAD = "the cat, " * 60  # more than 400 characters
TEXTS = [HEAD + "gattaca", HEAD + "tagacat", HEAD + "gattaca", "T" * 500 + "acg" * 3, "x" * 400 + "acgtnACGT" * 9, "a" * 420, "", None]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    return d


def found(spark, folder, name, *columns):
    return sorted((tuple(r[c] for c in columns) for r in catalog.QUERIES[name](spark, folder).collect()), key=repr)


def letters():
    return [(i // 2, 1 + i % 2, None if t is None else re.sub("[^ACGT]", "", re.sub("[^ACGTacgt]", "", t).upper())) for i, t in enumerate(TEXTS)]


def test_reads_are_whole(spark, folder):
    swap = str.maketrans("ACGT", "TGCA")
    want = sorted(((f, r, None if s is None else s.translate(swap)[::-1]) for f, r, s in letters()), key=repr)
    assert found(spark, folder, "reverse_complement", "fragment_id", "read_index", "rc") == want


def test_copies_are_equal_to_the_end(spark, folder):
    s = letters()[0][2]
    assert found(spark, folder, "duplicate_reads", "seq", "multiplicity") == [(s, 2)]


def test_homopolymers_are_judged_by_all_letters(spark, folder):
    bad = {f for f, _, s in letters() if s is not None and (len(s.replace("A", "")) < 5 or len(s.replace("T", "")) < 5)}
    kept = [(f, r, s) for f, r, s in letters() if f not in bad]
    assert bad == {2, 3} and found(spark, folder, "homopolymer_filter", "fragment_id", "read_index", "seq") == sorted(kept, key=repr)
    assert {x[0] for x in found(spark, folder, "fastq_renumber", "fragment_id")} == {0, 1}


def test_tiles_reach_the_end(spark, folder):
    want = [(f, r, a, s[a : a + 20]) for f, r, s in letters() if s for a in range(0, len(s) - 20, 5)]
    assert found(spark, folder, "fastq_tiles", "fragment_id", "read_index", "start", "seq") == sorted(want, key=repr)


def test_short_reads_take_letters_from_anywhere(spark, folder):
    want = [(f, r, None if s is None else s[:50]) for f, r, s in letters()]
    assert found(spark, folder, "fastq_shorten", "fragment_id", "read_index", "seq") == sorted(want, key=repr)


def test_multiplicities_hold_for_both_mates(spark):
    from readloom.operators import reads

    given = [("a", 1, "AC"), ("a", 2, "GG"), ("b", 1, "AC"), ("b", 2, "GG"), ("c", 1, "AC"), ("c", 2, "GT"), ("d", 1, "AC"), ("e", 1, None), ("f", 1, "")]
    r = spark.createDataFrame(given, "fragment_id string, read_index int, seq string")
    got = {(x.fragment_id, x.read_index): (x.multiplicity, x.first) for x in reads.with_multiplicity(r).select("fragment_id", "read_index", "multiplicity", "first").collect()}
    assert got == {("a", 1): (2, True), ("a", 2): (2, True), ("b", 1): (2, False), ("b", 2): (2, False), ("c", 1): (1, True), ("c", 2): (1, True), ("d", 1): (1, True), ("e", 1): (2, True), ("f", 1): (2, False)}
    assert sorted(x.fragment_id for x in reads.repeated(r).collect()) == ["a", "a", "b", "b", "e", "f"]
    assert sorted(x.fragment_id for x in reads.without_duplicates(r).collect()) == ["a", "a", "c", "c", "d", "e"]
    assert reads.with_multiplicity(r.limit(0)).count() == 0


def test_chunk_files_are_one_per_chunk_and_read_in_order(spark, tmp_path):
    import gzip

    from readloom.operators import reads
    from readloom.sources import readers, writers

    given = [(f"n{i:03d}", k, "ACGTACGTGC"[i % 7 :] + "ACGTGTCAGC", "I" * (20 - i % 7)) for i in range(50) for k in (1, 2)]
    r = spark.createDataFrame(given, "fragment_id string, read_index int, seq string, qual string").repartition(5)
    new = reads.renumber(r, chunk_size=20, least=1)
    writers.fastq_chunks(new, f"{tmp_path}/out", "s")
    files = sorted(p.name for p in (tmp_path / "out").iterdir() if p.name[0] not in "._")
    assert files == sorted(f"s_{k}-C{c:03d}.fastq.gz" for c in range(3) for k in (1, 2))
    for c, k in ((0, 1), (1, 2), (2, 1)):
        lines = gzip.open(f"{tmp_path}/out/s_{k}-C{c:03d}.fastq.gz", "rt").read().splitlines()
        assert lines[::4] == [f"@F{n + 1:09d}/{k}" for n in range(20 * c, min(50, 20 * c + 20))]
    back = readers.fastq(spark, f"{tmp_path}/out")
    assert sorted((x.read_id, x.seq, x.qual) for x in back.collect()) == sorted((f"F{int(f[1:]) + 1:09d}/{k}", s, q) for f, k, s, q in given)
