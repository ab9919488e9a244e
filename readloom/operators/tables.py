"""Count tables, matrices and expression values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chunk_sum(chunks: list[DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Sum by id of the count tables of chunks; raises unless all have the same columns."""
    columns = columns or [c for c in chunks[0].columns if c != "id"]
    for t in chunks:
        if set(t.columns) != {"id", *columns}:
            raise ValueError(f"count tables differ in columns: {t.columns}")
    every = chunks[0]
    for t in chunks[1:]:
        every = every.unionByName(t)
    return every.groupBy("id").agg(*[F.sum(c).alias(c) for c in columns])


def sample_matrix(counts: DataFrame, samples: list[str], nonzero: bool = False) -> DataFrame:
    """(id, one column per sample) from (id, sample, count); missing cells are 0."""
    wide = counts.groupBy("id").pivot("sample", samples).agg(F.sum("count")).na.fill(0)
    if nonzero:
        some = F.lit(False)
        for s in samples:
            some = some | (F.col(f"`{s}`") != 0)
        wide = wide.where(some)
    return wide


def join_matrices(tables: list[DataFrame]) -> DataFrame:
    """Matrices with equal ids side by side; raises where an id is missing in one."""
    out = tables[0]
    for t in tables[1:]:
        off = out.select("id").join(t.select("id", F.lit(1).alias("_t")), "id", "full_outer").where("_t is null").unionByName(t.select("id").join(out.select("id"), "id", "left_anti").withColumn("_t", F.lit(1)))
        if not off.isEmpty():
            raise ValueError("the tables differ in their ids")
        out = out.join(t, "id")
    return out


def with_lengths(counts: DataFrame, lengths: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Counts with the length of their id, from ``lengths`` or else ``fallback``; ids without one go."""
    out = counts.join(lengths.select("id", "length"), "id", "left")
    if fallback is not None:
        out = out.join(fallback.select("id", F.col("length").alias("_other")), "id", "left").withColumn("length", F.coalesce("length", "_other")).drop("_other")
    return out.where("length is not null")


def fpkm(counts: DataFrame, lengths: DataFrame, reads: DataFrame | None = None, fallback: DataFrame | None = None) -> DataFrame:
    """(id, sample, fpkm): counts per kilobase and million reads; reads of a sample default to its sum of counts."""
    if reads is None:
        reads = counts.groupBy("sample").agg(F.sum("count").alias("reads"))
    base = with_lengths(counts, lengths, fallback).join(reads.select("sample", "reads"), "sample")
    return base.select("id", "sample", (F.col("count") / (F.col("length") / 1000.0) / (F.col("reads") / 1e6)).alias("fpkm"))


def control_mean(values: DataFrame, samples: list[str], controls: list[str] | None = None) -> DataFrame:
    """(id, fpkm): mean over the control samples, or all; a sample without the id counts 0."""
    use = controls or samples
    return values.where(F.col("sample").isin(use)).groupBy("id").agg((F.sum("fpkm") / len(use)).alias("fpkm"))


def key_filter(rows: DataFrame, other: DataFrame, columns: list[str], other_columns: list[str] | None = None, invert: bool = False, sub_separator: str | None = None) -> DataFrame:
    """Rows whose composite key is (not, with ``invert``) among the other table's; fields may be cut at a sub-separator."""
    other_columns = other_columns or columns
    if len(columns) != len(other_columns):
        raise ValueError("both sides need as many key columns")
    cut = lambda c: F.substring_index(F.col(c).cast("string"), sub_separator, 1) if sub_separator else F.col(c)
    keys = [f"_k{i}" for i in range(len(columns))]
    right = other.select(*[cut(c).alias(k) for c, k in zip(other_columns, keys)]).distinct()
    left = rows.withColumns({k: cut(c) for c, k in zip(columns, keys)})
    return left.join(right, keys, "left_anti" if invert else "left_semi").drop(*keys)


def distinct_lines(rows: DataFrame, columns: list[str], order: str) -> DataFrame:
    """Each distinct line at its first place, in the order of the input."""
    return rows.groupBy(*columns).agg(F.min(order).alias(order)).orderBy(order)


def chunk_numbers(rows: DataFrame, order: str, size: int) -> DataFrame:
    """Adds ``chunk``: a new one begins after every ``size`` rows in the order of a unique column."""
    from readloom.sources.readers import with_number

    return with_number(rows, order).withColumn("chunk", F.floor((F.col("number") - 1) / size)).drop("number")


def ordinals(rows: DataFrame, keys: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
