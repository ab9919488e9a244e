"""Preparation of sequencing reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import sequence
from readloom.functions.names import counter
from readloom.sources.readers import with_number


def homopolymer_filter(reads: DataFrame, least: int = 5) -> DataFrame:
    """Fragments of which no read is nearly all A or nearly all T; a pair goes as a whole."""
    bad = reads.where(sequence.is_homopolymer(F.col("seq"), least)).select("fragment_id").distinct()
    return reads.join(bad, "fragment_id", "left_anti") if least > 0 else reads


def renumber(reads: DataFrame, chunk_size: int = 25_000_000, least: int = 5) -> DataFrame:
    """Reads that pass the homopolymer filter, with new ids ``F%09d/<read>`` and chunks ``-C%03d`` of fragments."""
    kept = homopolymer_filter(reads, least)
    ids = with_number(kept.select("fragment_id").distinct(), "fragment_id")
    new = counter(F.col("number"))
    chunk = F.concat(F.lit("-C"), F.lpad(F.floor((F.col("number") - 1) / chunk_size).cast("string"), 3, "0"))
    return kept.join(ids, "fragment_id").select("*", F.concat(new, F.lit("/"), F.col("read_index").cast("string")).alias("new_id"), chunk.alias("chunk")).drop("number")


def shorten(reads: DataFrame, length: int, strict: bool = False) -> DataFrame:
    """Reads cut to ``length``; shorter ones stay whole, or raise with ``strict``."""
    short = F.length("seq") < length
    seq = F.when(short, F.raise_error(F.concat(F.lit("read is shorter than the prefix: "), F.col("fragment_id").cast("string"))).cast("string")) if strict else F.when(short, F.col("seq"))
    out = reads.withColumn("seq", seq.otherwise(F.substring("seq", 1, length)))
    return out.withColumn("qual", F.substring("qual", 1, length)) if "qual" in reads.columns else out


def tile(reads: DataFrame, length: int, increment: int = 5) -> DataFrame:
    """Windows of reads: fragment_id, read_index, start (from 0), seq and a new id ``<fragment>-<start>/<read>``."""
    w = reads.select("fragment_id", "read_index", "seq", F.explode(sequence.tiles(F.col("seq"), length, increment)).alias("start"))
    return w.select("fragment_id", "read_index", "start", F.substr("seq", F.col("start") + 1, F.lit(length)).alias("seq"), F.concat(F.col("fragment_id").cast("string"), F.lit("-"), F.col("start").cast("string"), F.lit("/"), F.col("read_index").cast("string")).alias("tile_id"))


def unaligned(reads: DataFrame, weights: DataFrame) -> DataFrame:
    """Reads whose fragment has no alignment."""
    return reads.join(weights.select("fragment_id").distinct(), "fragment_id", "left_anti")


def duplicates(reads: DataFrame, least: int = 2) -> DataFrame:
    """(seq, multiplicity) of sequences that occur ``least`` times or more."""
    return reads.groupBy("seq").agg(F.count("*").alias("multiplicity")).where(F.col("multiplicity") >= least)


def with_multiplicity(reads: DataFrame) -> DataFrame:
    """Adds how many fragments have the same sequences (``multiplicity``) and whether a fragment is the first of these (``first``).

    Reads 1 are compared with reads 1 and reads 2 with reads 2; a null sequence is an empty one. What is shuffled by content are
    SHA-256 digests, and a class of any size is one row of an aggregate that is joined back.
    """
    own = F.array_sort(F.collect_list(F.struct("read_index", F.coalesce("seq", F.lit("")).alias("seq"))))
    text = F.array_join(F.transform(own, lambda r: F.concat(r["read_index"].cast("string"), F.lit(":"), r["seq"])), "/")
    fragments = reads.groupBy("fragment_id").agg(F.unhex(F.sha2(text, 256)).alias("digest"))
    classes = fragments.groupBy("digest").agg(F.count("*").alias("multiplicity"), F.min("fragment_id").alias("least"))
    of = fragments.join(classes, "digest").select("fragment_id", "multiplicity", (F.col("fragment_id") == F.col("least")).alias("first"))
    return reads.join(of, "fragment_id")


def repeated(reads: DataFrame, least: int = 2) -> DataFrame:
    """All reads of fragments whose sequences occur ``least`` times or more."""
    return with_multiplicity(reads).where(F.col("multiplicity") >= least).select(*reads.columns)


def without_duplicates(reads: DataFrame) -> DataFrame:
    """All reads of the first fragment of each class of equal ones."""
    return with_multiplicity(reads).where("first").select(*reads.columns)
