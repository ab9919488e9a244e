"""CIGAR strings as arrays of (length, op), in built-in array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPS = "MIDNSHPX="
MATCHING = ("M", "X", "=")
KIND = "array<struct<len:int,op:string>>"


def parse(cigar: Column) -> Column:
    """array<struct<len:int, op:string>>; raises on text that is not a CIGAR, gives an empty array for ``*`` and null."""
    lens = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1))
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    pairs = F.transform(F.arrays_zip(lens.alias("len"), ops.alias("op")), lambda x: F.struct(x["len"].cast("int").alias("len"), x["op"].alias("op")))
    empty = F.expr("cast(array() as array<struct<len:int,op:string>>)")
    wrong = F.raise_error(F.concat(F.lit("not a CIGAR: "), cigar)).cast("array<struct<len:int,op:string>>")
    return F.when(cigar.isNull() | cigar.isin("*", ""), empty).when(~cigar.rlike(r"^(\d+[MIDNSHP=X])+$"), wrong).otherwise(pairs)


def total(ops: Column, kinds: tuple[str, ...]) -> Column:
    """Sum of the lengths of operations of some kinds."""
    return F.aggregate(F.filter(ops, lambda x: x["op"].isin(*kinds)), F.lit(0), lambda n, x: n + x["len"])


def matching(ops: Column) -> Column:
    return total(ops, MATCHING)


def reference_length(ops: Column) -> Column:
    """Bases of the reference without gaps: matches and deletions."""
    return total(ops, (*MATCHING, "D"))


def read_length(ops: Column, hard: bool = False) -> Column:
    return total(ops, (*MATCHING, "I", "S", *(("H",) if hard else ())))


def is_spliced(cigar: Column) -> Column:
    return F.instr(cigar, "N") > 1


def render(ops: Column) -> Column:
    return F.array_join(F.transform(ops, lambda x: F.concat(x["len"].cast("string"), x["op"])), "")


def append(ops: Column, more: Column) -> Column:
    """Concatenation in which equal neighbours are merged, a deletion beside a gap becomes part of it, and lengths of 0 or less are left out."""

    def add(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        gap = (last["op"].isin("D", "N") & x["op"].isin("D", "N")) & ((last["op"] == "N") | (x["op"] == "N"))
        merged = F.struct((last["len"] + x["len"]).alias("len"), F.when(gap, "N").otherwise(x["op"]).alias("op"))
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(merged))
        return F.when(x["len"] <= 0, acc).when((F.size(acc) > 0) & ((last["op"] == x["op"]) | gap), joined).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.concat(ops, more), F.expr(f"cast(array() as {KIND})"), add)


def invert(ops: Column) -> Column:
    return F.reverse(ops)


def blocks(pos: Column, ops: Column) -> Column:
    """Blocks between gaps: array<struct<start, end, aligned_len, ins, del, ref_len>>, 1-based closed.

    ``aligned_len`` counts M, X, =, I and S, ``ins`` counts I and S. Blocks without read bases are left out.
    """
    state = F.struct(pos.cast("long").alias("at"), F.lit(0).alias("ref"), F.lit(0).alias("ins"), F.lit(0).alias("del"), F.lit(0).alias("match"), F.expr("cast(array() as array<struct<start:bigint,end:bigint,aligned_len:int,ins:int,del:int,ref_len:int>>)").alias("out"))

    def close(s: Column) -> Column:
        block = F.struct(s["at"].alias("start"), (s["at"] + s["ref"] - 1).alias("end"), (s["match"] + s["ins"]).alias("aligned_len"), s["ins"].alias("ins"), s["del"].alias("del"), s["ref"].alias("ref_len"))
        return F.when(s["match"] + s["ins"] > 0, F.concat(s["out"], F.array(block))).otherwise(s["out"])

    def step(s: Column, x: Column) -> Column:
        n, op = x["len"], x["op"]
        gap = op == "N"
        on = lambda *k: F.when(op.isin(*k), n).otherwise(0)
        keep = lambda c, more: F.when(gap, 0).otherwise(c + more)
        return F.struct(
            F.when(gap, s["at"] + s["ref"] + n).otherwise(s["at"]).alias("at"), keep(s["ref"], on(*MATCHING, "D")).alias("ref"), keep(s["ins"], on("I", "S")).alias("ins"),
            keep(s["del"], on("D")).alias("del"), keep(s["match"], on(*MATCHING)).alias("match"), F.when(gap, close(s)).otherwise(s["out"]).alias("out"),
        )

    return F.aggregate(ops, state, step, close)


def introns(pos: Column, ops: Column) -> Column:
    """Gaps: array<struct<start, end>>, 1-based closed."""
    state = F.struct(pos.cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("out"))

    def step(s: Column, x: Column) -> Column:
        n, op = x["len"], x["op"]
        moved = s["at"] + F.when(op.isin(*MATCHING, "D", "N"), n).otherwise(0)
        gap = F.struct(s["at"].alias("start"), (s["at"] + n - 1).alias("end"))
        return F.struct(moved.alias("at"), F.when(op == "N", F.concat(s["out"], F.array(gap))).otherwise(s["out"]).alias("out"))

    return F.aggregate(ops, state, step, lambda s: s["out"])


def end_position(pos: Column, ops: Column) -> Column:
    """Last reference base of the last block."""
    return F.element_at(blocks(pos, ops), -1)["end"]


def cut(ops: Column, left: Column, right: Column, placed: Column | bool = True, margin: Column | bool = False) -> Column:
    """Operations inside bases [left, right] of an alignment's reference: struct<ops, begin, bases>.

    Bases are counted from 1 at the alignment's first. What takes no reference (I, S, H, P) belongs to the base before
    it, so at the left edge it stays out and at the right edge it comes along. ``begin`` and ``bases`` say which bases of
    the read these are (from 0). Where the interval is not ``placed`` on the genome its bases are an insertion, or at the
    ``margin`` of the alignment soft clipping; deletions and gaps stay.
    """
    lit = lambda x: F.lit(x) if isinstance(x, bool) else x
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("read"), F.lit(-1).alias("begin"), F.lit(0).alias("bases"), F.expr(f"cast(array() as {KIND})").alias("ops"))

    def step(s: Column, x: Column) -> Column:
        n, op, at = x["len"], x["op"], s["at"]
        on_ref, on_read = op.isin(*MATCHING, "D", "N"), op.isin(*MATCHING, "I", "S")
        inside = F.when(on_ref, F.least(at + n, right) - F.greatest(at + 1, left) + 1).when((left <= at) & (at <= right), n).otherwise(0)
        k = F.greatest(inside, F.lit(0)).cast("int")
        skipped = F.when(on_ref & on_read, F.greatest(left - at - 1, F.lit(0))).otherwise(0)
        name = F.when(lit(placed) | op.isin("D", "N"), op).when(lit(margin), "S").otherwise("I")
        return F.struct(
            (at + F.when(on_ref, n).otherwise(0)).alias("at"), (s["read"] + F.when(on_read, n).otherwise(0)).alias("read"), F.when((s["begin"] < 0) & (k > 0), (s["read"] + skipped).cast("int")).otherwise(s["begin"]).alias("begin"),
            (s["bases"] + F.when(on_read, k).otherwise(0)).alias("bases"), F.when(k > 0, F.concat(s["ops"], F.array(F.struct(k.alias("len"), name.alias("op"))))).otherwise(s["ops"]).alias("ops"),
        )

    return F.aggregate(ops, state, step, lambda s: F.struct(s["ops"].alias("ops"), F.greatest(s["begin"], F.lit(0)).alias("begin"), s["bases"].alias("bases")))
