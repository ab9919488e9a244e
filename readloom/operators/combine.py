"""Combining, subtracting and merging alignment sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators.weights import choose, summarize


def combine(one: DataFrame, two: DataFrame, key: str = "fragment_id", max_mean: float | None = None) -> DataFrame:
    """Rows of the better set of each fragment, with ``source`` 1 or 2.

    Both sets have read_index, aln_no, paired and nm. If the better set has only one of the reads and
    neither set has pairs, the other read's rows of the other set come along.
    """
    w = choose(summarize(one), summarize(two), key, max_mean=max_mean)
    reads = lambda t, k: t.groupBy(key).agg(F.collect_set("read_index").alias(f"r{k}"))
    w = w.join(reads(one, 1), key, "left").join(reads(two, 2), key, "left").where("side is not null")
    win, lose = F.when(F.col("side") == 1, F.col("r1")).otherwise(F.col("r2")), F.when(F.col("side") == 1, F.col("r2")).otherwise(F.col("r1"))
    pairs = F.greatest(F.coalesce("m1", F.lit(0)), F.coalesce("m2", F.lit(0))) == 3
    lost = F.when(~pairs & (F.size(win) == 1) & F.col("n1").isNotNull() & F.col("n2").isNotNull(), F.array_except(lose, win)).otherwise(F.expr("cast(array() as array<int>)"))
    plan = w.select(key, "side", lost.alias("_also"))
    take = lambda t, k: t.join(plan, key).where((F.col("side") == k) | F.array_contains("_also", F.col("read_index"))).drop("side", "_also").withColumn("source", F.lit(k))
    return take(one, 1).unionByName(take(two, 2))


def subtract(one: DataFrame, two: DataFrame, key: str = "fragment_id") -> DataFrame:
    """Rows of fragments of the first set that the second lacks, or has worse when it is favoured."""
    w = choose(summarize(two), summarize(one), key)  # the favoured set stands first
    keep = w.where("n2 is not null and (n1 is null or side = 2)").select(key)
    return one.join(keep, key, "left_semi")


def merge_first(one: DataFrame, two: DataFrame, key: str = "fragment_id") -> DataFrame:
    """The first set's rows of a fragment if it has any, else the second's."""
    rest = two.join(one.select(key).distinct(), key, "left_anti")
    return one.withColumn("source", F.lit(1)).unionByName(rest.withColumn("source", F.lit(2)))


def merge_both(one: DataFrame, two: DataFrame, key: str = "fragment_id", order: str = "row_no") -> DataFrame:
    """Rows of both sets side by side, suffixed ``/1`` and ``/2``; raises unless both have the same fragments in the same order."""
    a, b = one.select(F.col(key).alias("a"), F.col(order).alias("o")), two.select(F.col(key).alias("b"), F.col(order).alias("o"))
    off = a.join(b, "o", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    if not off.isEmpty():
        raise ValueError("the sets differ in their fragments or in the order of them")
    name = lambda t, k: t.withColumn(key, F.concat(F.col(key).cast("string"), F.lit(f"/{k}")))
    return name(one, 1).unionByName(name(two, 2))


def near_duplicates(computed: DataFrame, direct: DataFrame, close: float = 0.93, share: float = 0.3) -> DataFrame:
    """Direct hits without those that a computed hit of the fragment and read overlaps almost wholly.

    Both have fragment_id, read_index, chrom, start, end and hit. A hit is dropped when the overlap reaches
    ``close`` of its length, or ``share`` with both ends no farther than ``share`` of the length apart; of a
    pair both reads must pass one and the same test.
    """
    c = computed.select("fragment_id", "read_index", "chrom", F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("hit").alias("_hit"))
    j = direct.join(c, ["fragment_id", "read_index", "chrom"])
    n = F.col("end") - F.col("start") + 1
    both = F.greatest(F.lit(0), F.least("end", "_e") - F.greatest("start", "_s") + 1)
    near = (both >= share * n) & (F.abs(F.col("start") - F.col("_s")) <= share * n) & (F.abs(F.col("end") - F.col("_e")) <= share * n)
    per = j.groupBy("fragment_id", "hit", "_hit").agg(F.min((both >= close * n).cast("int")).alias("a"), F.min(near.cast("int")).alias("b"), F.count_distinct("read_index").alias("reads"))
    size = direct.groupBy("fragment_id", "hit").agg(F.count_distinct("read_index").alias("all"))
    gone = per.join(size, ["fragment_id", "hit"]).where("reads = all and (a = 1 or b = 1)").select("fragment_id", "hit").distinct()
    return direct.join(gone, ["fragment_id", "hit"], "left_anti")
