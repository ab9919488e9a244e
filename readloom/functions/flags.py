"""SAM FLAG bits as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of the FLAG field in the SAM format.
BITS = {
    "paired": 1, "proper_pair": 2, "unmapped": 4, "mate_unmapped": 8, "reverse": 16, "mate_reverse": 32,
    "first": 64, "second": 128, "secondary": 256, "qc_fail": 512, "duplicate": 1024, "supplementary": 2048,
}


def has(flag: Column, name: str) -> Column:
    return flag.bitwiseAND(F.lit(BITS[name])) != 0


def with_bit(flag: Column, name: str, on: Column | bool = True) -> Column:
    """The flag with one bit set or cleared."""
    on = F.lit(on) if isinstance(on, bool) else on
    return F.when(on, flag.bitwiseOR(F.lit(BITS[name]))).otherwise(flag.bitwiseAND(F.lit(4095 - BITS[name])))


def has_mate(flag: Column) -> Column:
    return has(flag, "paired") & has(flag, "proper_pair")


def is_mapped(flag: Column, pos: Column) -> Column:
    return ~has(flag, "unmapped") & (pos >= 0)


def read_index(flag: Column, name: Column) -> Column:
    """1 or 2: from the FLAG of a paired read, else from a ``/1`` or ``/2`` at the end of its name, else 1."""
    suffix = F.regexp_extract(name, r"/([12])$", 1)
    by_flag = F.when(has(flag, "first"), 1).when(has(flag, "second"), 2)
    return F.coalesce(F.when(has(flag, "paired"), by_flag), F.when(suffix != "", suffix.cast("int")), F.lit(1))


def strand(flag: Column) -> Column:
    return F.when(has(flag, "reverse"), "-").otherwise("+")


def fragment_strand(strand_: Column, index: Column, direction: str) -> Column:
    """Strand of the fragment: the second read is turned in ``forward`` mode, the first in ``backward`` mode."""
    if direction not in ("none", "forward", "backward"):
        raise ValueError(f"direction is none, forward or backward, not {direction!r}")
    turned = F.when(strand_ == "+", "-").otherwise("+")
    return strand_ if direction == "none" else F.when(index == (2 if direction == "forward" else 1), turned).otherwise(strand_)
