"""Closed intervals as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Bases that two closed intervals share."""
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start) + 1)


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start <= b_end) & (b_start <= a_end)


def contains(start: Column, end: Column, left: Column, right: Column) -> Column:
    """Whether [start, end] holds [left, right]; true where no interval is asked for (right of 0 or less)."""
    return (right <= 0) | ((start <= left) & (right <= end))


def hull(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return F.struct(F.least(a_start, b_start).alias("start"), F.greatest(a_end, b_end).alias("end"))


def distance(a_chrom: Column, a_start: Column, a_end: Column, b_chrom: Column, b_start: Column, b_end: Column) -> Column:
    """Larger of the differences of starts and of ends, -1 between chromosomes."""
    return F.when(a_chrom != b_chrom, -1).otherwise(F.greatest(F.abs(a_start - b_start), F.abs(a_end - b_end)))


def blocks_overlap(blocks: Column, start: Column, end: Column) -> Column:
    """Bases that the blocks of a spliced read share with a contiguous read."""
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + overlap(b["start"], b["end"], start, end).cast("long"))
