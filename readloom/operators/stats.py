"""Read totals, percentages and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aligned_numbers(rows: DataFrame, keys: list[str], listed: DataFrame | None = None) -> DataFrame:
    """(keys, aligned): distinct names of mapped rows; keys already ``listed`` are left out."""
    rows = rows if listed is None else rows.join(listed.select(*keys).distinct(), keys, "left_anti")
    return rows.groupBy(*keys).agg(F.count_distinct("query_name").alias("aligned"))


def unique_fraction(weights: DataFrame) -> DataFrame:
    """One row: the percentage, cut to two decimals, of aligned fragments that align once."""
    one, some = F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") != 0).cast("long"))
    return weights.agg((F.floor(one * 10000 / some) / 100).alias("percent"))


def read_percentages(reads: DataFrame, mapped: DataFrame, expressed: DataFrame) -> DataFrame:
    """(sample, reads, mapped, expressed, mapped_percent, expressed_percent), percentages without decimals."""
    j = reads.join(mapped, "sample", "left").join(expressed, "sample", "left").na.fill(0)
    cut = lambda c: F.floor(100 * F.col(c) / F.col("reads")).cast("int")
    return j.select("sample", "reads", "mapped", "expressed", cut("mapped").alias("mapped_percent"), cut("expressed").alias("expressed_percent"))


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def log_parameters(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, name, value) of ``NAME=value`` lines."""
    name, value = F.regexp_extract("line", r"^([A-Z][A-Z0-9_]*)=(.*)$", 1), F.regexp_extract("line", r"^([A-Z][A-Z0-9_]*)=(.*)$", 2)
    return lines.where(name != "").select(*keys, name.alias("name"), value.alias("value"))


def inconsistent_parameters(parameters: DataFrame, sample: str = "sample") -> DataFrame:
    """(sample, name, n): parameters on which the chunks of a sample disagree."""
    return parameters.groupBy(sample, "name").agg(F.count_distinct("value").alias("n")).where("n > 1")


def keyword_totals(rows: DataFrame, keywords: list[str], sample: str = "sample") -> DataFrame:
    """One row per sample with the sum of each keyword's counter over its chunks."""
    return rows.groupBy(sample).pivot("keyword", keywords).agg(F.sum("count")).na.fill(0)


def running_totals(rows: DataFrame) -> DataFrame:
    """One row: rows, mapped rows, fragments and mapped fragments, with percentages."""
    got = rows.agg(F.count("*").alias("reads"), F.sum(F.col("mapped").cast("long")).alias("mapped_reads"), F.count_distinct("fragment_id").alias("fragments"), F.count_distinct(F.when(F.col("mapped"), F.col("fragment_id"))).alias("mapped_fragments"))
    return got.select("*", F.round(100 * F.col("mapped_reads") / F.col("reads"), 2).alias("read_percent"), F.round(100 * F.col("mapped_fragments") / F.col("fragments"), 2).alias("fragment_percent"))


def references(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, references, reads): distinct references that were hit, and distinct reads that hit one."""
    return rows.groupBy(*(keys or [])).agg(F.count_distinct("chrom").alias("references"), F.count_distinct("fragment_id", "read_index").alias("reads"))
