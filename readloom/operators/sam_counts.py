"""Gene counts straight from alignments to transcripts, and where reads start on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.estimators import effective_length, minimum_start
from readloom.functions.intervals import contains
from readloom.functions.names import simplify_junction
from readloom.operators.weights import gene_multiplicity


def fragment_genes(rows: DataFrame, transcript_map: DataFrame, keep_unknown: bool = False, primary: bool = False, window: int = 0) -> DataFrame:
    """(fragment_id, gene_id) of alignments to transcripts.

    ``rows`` has fragment_id, ref, start, end and, for ``primary``, secondary; ``transcript_map`` has
    transcript_id, gene_id and optionally position. With a position p and a ``window`` v the read must
    hold [max(p - v + 1, 1), p + v]. ``keep_unknown`` lets transcripts without gene stand for themselves.
    """
    rows = rows.where("not secondary") if primary else rows
    r = rows.withColumn("transcript_id", simplify_junction(F.col("ref")))
    j = r.join(transcript_map, "transcript_id", "left" if keep_unknown else "inner")
    if keep_unknown:
        j = j.withColumn("gene_id", F.coalesce("gene_id", "transcript_id"))
    if window and "position" in transcript_map.columns:
        p = F.col("position")
        j = j.where(p.isNull() | contains(F.col("start"), F.col("end"), F.greatest(p - window + 1, F.lit(1)), p + window))
    return j.select("fragment_id", "gene_id").distinct()


def gene_counts(pairs: DataFrame, weights: DataFrame | None = None, unambiguous: bool = False, by_multiplicity: bool = False, threshold: float = 0.01) -> DataFrame:
    """(id, count): each fragment adds its weight once to each of its genes.

    The weight is 1/n of ``weights`` (fragment_id, n), 1 where that lacks the fragment, or with
    ``by_multiplicity`` the reciprocal of the number of its genes. ``unambiguous`` takes fragments of one
    gene only.
    """
    genes = gene_multiplicity(pairs)
    w = genes
    if not by_multiplicity:
        w = genes.drop("weight")
        w = w.join(weights.select("fragment_id", "n"), "fragment_id", "left").withColumn("weight", 1.0 / F.coalesce("n", F.lit(1))).drop("n") if weights is not None else w.withColumn("weight", F.lit(1.0))
    w = w.where(F.col("weight") >= threshold)
    w = w.where("n_genes = 1") if unambiguous else w
    return pairs.distinct().join(w, "fragment_id").groupBy(F.col("gene_id").alias("id")).agg(F.sum("weight").alias("count"))


def start_positions(rows: DataFrame) -> DataFrame:
    """(id, n_starts, min_start) of each transcript: distinct starts, a pair counting with its leftmost mate.

    ``rows`` has fragment_id, aln_no, ref and start. Of full references with one simplified id that with
    most starts counts, then the smallest reference.
    """
    left = rows.groupBy("ref", "fragment_id", "aln_no").agg(F.min("start").alias("start"))
    per = left.groupBy("ref").agg(F.count_distinct("start").alias("n_starts"), F.min("start").alias("min_start"))
    best = per.withColumn("id", simplify_junction(F.col("ref"))).groupBy("id").agg(F.min_by(F.struct("n_starts", "min_start"), F.struct((-F.col("n_starts")).alias("a"), F.col("ref").alias("b"))).alias("s"))
    return best.select("id", "s.n_starts", "s.min_start")


def start_estimates(starts: DataFrame, counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """Starts with transcript length, count, effective length and estimated first start."""
    j = starts.join(counts.select("id", "count"), "id").join(lengths.select("id", "length"), "id")
    n = F.col("count").cast("long")
    return j.select("*", effective_length(F.col("n_starts"), n, F.col("length")).alias("effective_length"), minimum_start(F.col("min_start"), F.col("length"), F.col("count")).alias("estimated_start"))
