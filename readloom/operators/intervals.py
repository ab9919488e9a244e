"""Interval joins, unions and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.intervals import overlap

#: Widths of bins, as powers of two, finest first: an interval's own level is the first that is no narrower than it, so it
#: touches two bins there at most. The last is wider than any interval.
LEVELS = (10, 13, 16, 19, 22, 25, 28, 62)
#: How two intervals meet: both at their own level, or one at its own and the other, finer one, at that level.
BOTH, LEFT_UP, RIGHT_UP = 0, 1, 2


def level(start: Column, end: Column) -> Column:
    """Index of the own level of an interval."""
    found = F.lit(len(LEVELS) - 1)
    for i in reversed(range(len(LEVELS) - 1)):
        found = F.when(end - start < 1 << LEVELS[i], i).otherwise(found)
    return found


def binned(rows: DataFrame, start: str, end: str, own: dict[int, list[int]], above: tuple[int, list[int]], first: str) -> DataFrame:
    """A row for each bin in which an interval may meet others: ``_bin``, and ``first``, the first of them of that kind.

    ``own`` says at which levels an interval whose own level this is has rows of a kind, ``above`` the kind of the rows
    that it has at coarser levels, and at which. Level and kind are part of the bin's number.
    """
    rows_ = rows.withColumn("_level", level(F.col(start), F.col(end)))
    width = F.element_at(F.array(*map(F.lit, LEVELS)), F.col("_level") + 1)
    places = [(kind, F.col("_level").isin(levels), F.col("_level"), width) for kind, levels in own.items() if levels]
    places += [(above[0], F.col("_level") < i, F.lit(i), F.lit(LEVELS[i])) for i in above[1]]
    at = []
    for kind, fits, i, bits in places:
        number = lambda c, kind=kind, i=i, bits=bits: (F.call_function("shiftright", F.col(c), bits) * len(LEVELS) + i) * 3 + kind
        low, high = number(start), number(end)
        at += [F.when(fits, F.struct(low.alias("bin"), low.alias("first"))), F.when(fits & (high > low), F.struct(high.alias("bin"), low.alias("first")))]
    return rows_.withColumn("_at", F.explode(F.array(*at))).where("_at is not null").select(*rows.columns, F.col("_at.bin").alias("_bin"), F.col("_at.first").alias(first))


def levels(rows: DataFrame) -> list[int]:
    """The own levels that the intervals (start, end) of a frame have: as many numbers as there are levels at most."""
    return sorted(r[0] for r in rows.select(level(F.col("start").cast("long"), F.col("end").cast("long")).alias("level")).distinct().collect())


def interval_join(blocks: DataFrame, exons: DataFrame, least: int = 1, stranded: bool = False, carry: tuple[str, ...] = (), block_levels: list[int] | None = None) -> DataFrame:
    """Pairs of blocks and exons of one chromosome that share ``least`` bases or more, with ``overlap``.

    ``exons`` has exon_id, chrom, start, end, strand, which become exon_id, exon_start, exon_end and exon_strand, and the
    columns to ``carry``. An equi-join on (chrom, bin) over bins of several widths: two intervals meet at the level of the
    longer one only, and are kept in the later of their first bins, so nothing is deduplicated, and an interval of any size
    has a few rows per level. Which levels exons have is asked first; blocks have rows at these only. Exons have one at each
    coarser level of the ``block_levels``, or where these are not known at all coarser ones. AQE splits bins that
    many blocks share. Neither side is broadcast: the planner would judge exons by the size of their files, which says nothing
    of their rows in bins.
    """
    start, end = F.col("start").cast("long"), F.col("end").cast("long")
    have = levels(exons) or [0]
    every = range(len(LEVELS)) if block_levels is None else block_levels
    coarser, finer = [i for i in every if i > have[0]], [i for i in have if i > min(every, default=0)]
    e = exons.select("exon_id", "chrom", start.alias("exon_start"), end.alias("exon_end"), F.col("strand").alias("exon_strand"), *carry)
    e = binned(e, "exon_start", "exon_end", {BOTH: have, LEFT_UP: finer}, (RIGHT_UP, coarser), "_exon_first")
    b = blocks.withColumns({"_start": start, "_end": end})
    b = binned(b, "_start", "_end", {BOTH: have, RIGHT_UP: coarser}, (LEFT_UP, finer), "_first").drop("_start", "_end")
    keys = ["chrom", "_bin"]
    if stranded:
        e, b, keys = e.withColumn("_strand", F.col("exon_strand")), b.withColumn("_strand", F.col("strand")), [*keys, "_strand"]
    shared = overlap(F.col("start"), F.col("end"), F.col("exon_start"), F.col("exon_end"))
    joined = b.join(e.hint("merge"), keys).where((F.col("_bin") == F.greatest("_first", "_exon_first")) & (shared >= least))
    return joined.withColumn("overlap", shared).drop("_bin", "_strand", "_first", "_exon_first")


def plain_interval_join(blocks: DataFrame, exons: DataFrame, least: int = 1) -> DataFrame:
    """The same pairs by chromosome equality and a range test; for tests of the binned join."""
    e = exons.select("exon_id", F.col("chrom").alias("_chrom"), F.col("start").alias("exon_start"), F.col("end").alias("exon_end"), F.col("strand").alias("exon_strand"))
    shared = overlap(F.col("start"), F.col("end"), F.col("exon_start"), F.col("exon_end"))
    return blocks.join(e, F.col("chrom") == F.col("_chrom")).where(shared >= least).withColumn("overlap", shared).drop("_chrom")


def merge(rows: DataFrame, keys: list[str], gap: int = 0) -> DataFrame:
    """Merged intervals of each key: (keys, start, end, n). ``gap`` 1 also joins neighbours without space between."""
    along = Window.partitionBy(*keys).orderBy("start", "end")
    before = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("start") > before + gap), 1).otherwise(0)
    island = rows.withColumn("_new", new).withColumn("_island", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("_island")


def union_length(rows: DataFrame, keys: list[str], chrom: str = "chrom") -> DataFrame:
    """(keys, length): bases covered on each chromosome, of which the largest counts."""
    per = merge(rows, [*keys, chrom]).groupBy(*keys, chrom).agg(F.sum(F.col("end") - F.col("start") + 1).alias("length"))
    return per.groupBy(*keys).agg(F.max("length").alias("length"))


def combined_exons(exons: DataFrame, gene: str = "gene_id") -> DataFrame:
    """Merged exons of each gene, chromosome and strand with their ids: rows for BED and for the exon-to-gene map."""
    from readloom.functions.names import render_exon

    merged = merge(exons, [gene, "chrom", "strand"], gap=1)
    return merged.withColumn("exon_id", render_exon(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand"), F.col(gene)))


def within(start: Column, end: Column, outer_start: Column, outer_end: Column) -> Column:
    return (outer_start <= start) & (end <= outer_end)
