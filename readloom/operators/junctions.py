"""Introns, junctions and the maps between exons and junctions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def intron_support(introns: DataFrame, least: int = 1) -> DataFrame:
    """(chrom, start, end, support): distinct fragments of each gap."""
    return introns.groupBy("chrom", "start", "end").agg(F.count_distinct("fragment_id").alias("support")).where(F.col("support") >= least)


def fragment_junctions(introns: DataFrame) -> DataFrame:
    """(fragment_id, n): distinct gaps of each fragment."""
    return introns.groupBy("fragment_id").agg(F.count_distinct("chrom", "start", "end").alias("n"))


def exon_pairs(introns: DataFrame, exons: DataFrame, quantify: bool = False) -> DataFrame:
    """Gaps with the exons that end before and start after them; in quantify mode an unmatched side is ``unknown``."""
    how = "left" if quantify else "inner"
    left = exons.select("chrom", (F.col("end") + 1).alias("start"), F.col("exon_id").alias("left_exon")).distinct()
    right = exons.select("chrom", (F.col("start") - 1).alias("end"), F.col("exon_id").alias("right_exon")).distinct()
    out = introns.join(left, ["chrom", "start"], how).join(right, ["chrom", "end"], how)
    return out.na.fill("unknown", ["left_exon", "right_exon"]) if quantify else out


def match_tally(pairs: DataFrame) -> DataFrame:
    """Gaps by how many of their sides match an exon: (matched, gaps)."""
    known = (F.col("left_exon") != "unknown").cast("int") + (F.col("right_exon") != "unknown").cast("int")
    return pairs.groupBy("chrom", "start", "end").agg(F.max(known).alias("matched")).groupBy("matched").agg(F.count("*").alias("gaps"))


def expand_ids(junctions: DataFrame, column: str = "junction_id") -> DataFrame:
    """(junction_id, expanded): ``gene-junction-a-b:l1-l2:r1-r2`` as all neighbouring pairs of l…, a, b, r…, distinct."""
    j = F.col(column)
    head = F.regexp_extract(j, r"^(.*-junction)-", 1)
    core = F.split(F.regexp_extract(j, r"-junction-([^:]*)", 1), "-")
    side = lambda k: F.filter(F.split(F.coalesce(F.get(F.split(j, ":"), F.lit(k)), F.lit("")), "-"), lambda x: x != "")
    chain = F.concat(side(1), core, side(2))
    pairs = F.transform(F.sequence(F.lit(0), F.size(chain) - 2), lambda i: F.concat_ws("-", head, F.get(chain, i), F.get(chain, i + 1)))
    return junctions.select(j.alias("_id"), F.explode(pairs).alias("expanded")).distinct().withColumnRenamed("_id", "junction_id")


def filter_maps(seen: DataFrame, junction_exons: DataFrame, exon_junctions: DataFrame) -> DataFrame:
    """Rows of the exon-to-junction map whose junction has an exon pair that was seen.

    ``seen`` has left_exon and right_exon, ``junction_exons`` also junction_id; ``exon_junctions`` has
    exon_id and junction_id.
    """
    kept = junction_exons.join(seen.select("left_exon", "right_exon").distinct(), ["left_exon", "right_exon"], "left_semi").select("junction_id").distinct()
    return exon_junctions.join(kept, "junction_id", "left_semi")


def filter_junction_map(references: DataFrame, junction_map: DataFrame, equivalent: DataFrame, exon_map: DataFrame, transcript_map: DataFrame) -> DataFrame:
    """(exon_id, object_id) of junctions whose references were hit, and of transcripts.

    References (junction_id) are expanded to neighbouring pairs and looked up in ``junction_map``
    (junction_id, external_id); ``equivalent`` (external_id, other_id) adds their equals; rows of
    ``exon_map`` (exon_id, object_id) with these objects are joined by all of ``transcript_map``.
    """
    ids = expand_ids(references).select(F.col("expanded").alias("junction_id")).distinct()
    external = junction_map.join(ids, "junction_id", "left_semi").select("external_id").distinct()
    more = equivalent.join(external, "external_id", "left_semi").select(F.col("other_id").alias("external_id"))
    every = external.unionByName(more).distinct().select(F.col("external_id").alias("object_id"))
    return exon_map.join(every, "object_id", "left_semi").select("exon_id", "object_id").unionByName(transcript_map.select("exon_id", "object_id")).distinct()
