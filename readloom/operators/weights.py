"""Weight tables: how many alignments a fragment has, and which of two sets is the better one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.sources.readers import multiplicity

#: How much better a mean edit distance has to be, and how many more alignments count as more.
SLACK, MORE = 0.25, 1.1


def summarize(alignments: DataFrame, by_read: bool = False, chroms: DataFrame | None = None, extras: bool = False) -> DataFrame:
    """Weight rows of SAM alignments, one row of input per read and hit (aln_no), ``paired`` for mates.

    A pair adds one alignment and both edit distances; a single read adds one to its own side; the number
    is pairs plus the larger side. A missing edit distance counts -1. ``by_read`` keys on fragment and read.
    ``chroms`` restricts to listed references. ``extras`` adds spliced alignments and soft-clipped bases.
    """
    rows = alignments if chroms is None else alignments.join(chroms.select("chrom").distinct(), "chrom", "left_semi")
    key = ["fragment_id", "read_index"] if by_read else ["fragment_id"]
    nm = F.coalesce(F.col("nm"), F.lit(-1))
    more = []
    if extras:
        from readloom.functions import cigar

        ops = cigar.parse(F.col("cigar"))
        more = [F.sum(cigar.is_spliced(F.col("cigar")).cast("int")).alias("spliced"), F.sum(cigar.total(ops, ("S",))).alias("soft_clipped")]
    # Hits are ranked by kind and number in one sort by fragment, so that those of a kind have ranks without gaps; distinct
    # counts would repeat the rows and hold them all in tables.
    mark = F.when(F.col("aln_no").isNull(), None).when(F.col("paired"), 0).when(~F.col("paired"), F.col("read_index"))
    ranked = rows.withColumn("_mark", mark).withColumn("_rank", F.dense_rank().over(Window.partitionBy(*key).orderBy("_mark", "aln_no")).cast("long"))
    of = lambda k: F.when(F.col("_mark") == k, F.col("_rank"))
    most = lambda k: F.coalesce(F.max(of(k)) - F.min(of(k)) + 1, F.lit(0).cast("long"))
    got = ranked.groupBy(*key).agg(most(0).alias("_p"), most(1).alias("_1"), most(2).alias("_2"), F.sum(nm).alias("sum_edit_distance"), *more)
    kind = F.when(F.col("_p") > 0, "paired-end").when((F.col("_1") > 0) & (F.col("_2") > 0), "single-read (both)").otherwise("single-read")
    return got.select(*key, (F.col("_p") + F.greatest("_1", "_2")).alias("num_alignments"), "sum_edit_distance", kind.alias("kind"), *(["spliced", "soft_clipped"] if extras else []))


def compare_edits(m1: Column, n1: Column, e1: Column, m2: Column, n2: Column, e2: Column) -> Column:
    """1 or 2: which side has the better alignments.

    Higher multiplicity wins. Else side 2 wins with a mean edit distance no larger and clearly more
    alignments, or with one smaller by more than the slack (twice that for pairs); else side 1.
    """
    mean1, mean2 = e1 / n1, e2 / n2
    slack = F.when(m1 == 3, 2 * SLACK).otherwise(SLACK)
    second = ((mean2 <= mean1) & (n2 > MORE * n1)) | (mean2 < mean1 - slack)
    return F.when(m1 > m2, 1).when(m2 > m1, 2).when(second, 2).otherwise(1)


def _sides(one: DataFrame, two: DataFrame, key: str) -> DataFrame:
    part = lambda t, k: t.select(key, F.col("num_alignments").alias(f"n{k}"), F.col("sum_edit_distance").alias(f"e{k}"), multiplicity(F.col("kind")).alias(f"m{k}"), F.col("kind").alias(f"kind{k}"))
    return part(one, 1).join(part(two, 2), key, "full_outer")


def choose(one: DataFrame, two: DataFrame, key: str = "fragment_id", edits: bool = True, max_mean: float | None = None) -> DataFrame:
    """Both sides of every fragment and ``side``, the better one (null where ``max_mean`` rules both out)."""
    both = _sides(one, two, key)
    if max_mean is not None:
        reads = lambda k: F.when(F.col(f"m{k}") == 3, 2).otherwise(1)
        for k in (1, 2):
            far = F.col(f"e{k}") / F.col(f"n{k}") / reads(k) > max_mean
            both = both.withColumns({c: F.when(~far, F.col(c)) for c in (f"n{k}", f"e{k}", f"m{k}")})
    c = F.col
    rule = compare_edits(c("m1"), c("n1"), c("e1"), c("m2"), c("n2"), c("e2")) if edits else F.when(c("m1") > c("m2"), 1).when(c("m2") > c("m1"), 2).when(c("n2") > c("n1"), 2).otherwise(1)
    return both.withColumn("side", F.when(c("n1").isNull() & c("n2").isNull(), F.lit(None).cast("int")).when(c("n2").isNull(), 1).when(c("n1").isNull(), 2).otherwise(rule))


def combine_tables(one: DataFrame, two: DataFrame, key: str = "fragment_id", edits: bool = False, auxiliary: DataFrame | None = None, cap: int | None = None) -> DataFrame:
    """One weight row per fragment of two tables.

    With ``auxiliary`` its multiplicity for the fragment against that of the second table decides where
    they differ. Else the larger number of alignments wins, the first table on a tie, or with ``edits``
    the comparison of edit distances. ``cap`` leaves out rows with more alignments.
    """
    if cap is not None:
        one, two = one.where(F.col("num_alignments") <= cap), two.where(F.col("num_alignments") <= cap)
    c = F.col
    both = _sides(one, two, key)
    rule = compare_edits(c("m1"), c("n1"), c("e1"), c("m2"), c("n2"), c("e2")) if edits else F.when(c("n2") > c("n1"), 2).otherwise(1)
    if auxiliary is not None:
        both = both.join(auxiliary.select(key, multiplicity(F.col("kind")).alias("_aux")), key, "left")
        rule = F.when(c("_aux") > c("m2"), 1).when(c("_aux") < c("m2"), 2).otherwise(rule)
    side = F.when(c("n2").isNull(), 1).when(c("n1").isNull(), 2).otherwise(rule)
    pick = lambda a: F.when(side == 1, c(f"{a}1")).otherwise(c(f"{a}2"))
    return both.select(key, pick("n").alias("num_alignments"), pick("e").alias("sum_edit_distance"), pick("kind").alias("kind"))


def gene_multiplicity(pairs: DataFrame) -> DataFrame:
    """(fragment_id, n_genes, weight): the reciprocal of the number of genes of a fragment."""
    return pairs.select("fragment_id", "gene_id").distinct().groupBy("fragment_id").agg(F.count("*").alias("n_genes")).withColumn("weight", 1.0 / F.col("n_genes"))
