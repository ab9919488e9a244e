"""Closed-form and iterative estimators of transcript length and start."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def effective_length(distinct: Column, reads: Column, length: Column) -> Column:
    """The number m of possible start positions for which ``reads`` draws are expected to give ``distinct`` ones.

    Inverts m (1 - (1 - 1/m)^n) by an integer bisection of [distinct, length], in array functions: the
    result is the smallest m whose expectation reaches the observed number. No draws give 0, and as many
    distinct starts as reads (or as positions) give the number of distinct starts.
    """
    expected = lambda m: m * (1 - F.pow(1 - 1 / m, reads))
    start = F.struct(distinct.cast("long").alias("low"), length.cast("long").alias("high"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["low"] + s["high"]) / 2).cast("long")
        reached = expected(mid.cast("double")) >= distinct
        go = s["low"] < s["high"]
        return F.struct(F.when(go & ~reached, mid + 1).otherwise(s["low"]).alias("low"), F.when(go & reached, mid).otherwise(s["high"]).alias("high"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(40)), start, halve, lambda s: s["low"])
    return F.when(distinct <= 0, F.lit(0).cast("long")).when((distinct >= reads) | (distinct >= length), distinct.cast("long")).otherwise(found)


def minimum_start(smallest: Column, length: Column, reads: Column) -> Column:
    """Start estimated from the smallest observed one and the mean gap between reads; halves round up."""
    gap = F.floor((length - smallest + 1) / reads + 0.5).cast("long") - 1
    return F.greatest(F.lit(1).cast("long"), smallest - F.greatest(F.lit(0).cast("long"), gap))
