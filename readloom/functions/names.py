"""Ids and names: exons, junctions, fragments, SAM tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRANSCRIPT_PREFIX = "tr-"
INVERTED = ".inv-strand"


def fragment_name(query_name: Column) -> Column:
    """Read name up to the first blank, without ``/1`` or ``/2``."""
    return F.regexp_replace(F.substring_index(F.substring_index(query_name, " ", 1), "\t", 1), r"/[12]$", "")


def simplify_junction(name: Column) -> Column:
    """``gene-junction-a-b:left:right`` loses what follows the colon; other names stay."""
    return F.when(F.contains(name, F.lit("-junction")), F.substring_index(name, ":", 1)).otherwise(name)


def base_object(name: Column) -> Column:
    """Object id without its ``-exon…`` or ``-junction…`` part."""
    return F.regexp_replace(name, r"-(exon|junction).*$", "")


def modify_fragment(name: Column, cut_off: str = "", prefix: str = "") -> Column:
    """Drops everything before the first ``cut_off`` text, then a common ``prefix``."""
    if cut_off:
        name = F.when(F.instr(name, cut_off) > 0, F.substr(name, F.instr(name, cut_off), F.length(name))).otherwise(name)
    return F.when(F.startswith(name, F.lit(prefix)), F.substring(name, len(prefix) + 1, 2**31 - 1)).otherwise(name) if prefix else name


def tag(tags: Column, name: str, kind: str = "i") -> Column:
    """Value of an optional SAM tag, null if absent."""
    pattern = rf"(?i)(?:^|\t){name}:{kind}:([^\t]*)" if name == "NM" else rf"(?:^|\t){name}:{kind}:([^\t]*)"
    found = F.regexp_extract(tags, pattern, 1)
    value = F.when(found != "", found)
    return value.cast("int") if kind == "i" else value


def set_tag(tags: Column, name: str, kind: str, value: Column) -> Column:
    """Tags with one of them replaced, or appended where it is absent."""
    new = F.concat(F.lit(f"{name}:{kind}:"), value.cast("string"))
    there = tags.rlike(rf"(^|\t){name}:{kind}:")
    replaced = F.regexp_replace(tags, F.lit(rf"(^|\t){name}:{kind}:[^\t]*"), F.concat(F.lit("$1"), new))
    return F.when(there, replaced).when((tags == "") | tags.isNull(), new).otherwise(F.concat_ws("\t", tags, new))


def parse_exon(exon_id: Column) -> Column:
    """struct<gene, chrom, start, end, strand, transcript> of ``[gene/]chrom/start/end[/strand]``.

    The strand is ``+`` if absent and turned by a trailing ``.inv-strand``; a start of 0 becomes 1; the
    version suffix of a transcript reference goes.
    """
    turned = F.endswith(exon_id, F.lit(INVERTED))

    def named(parts: Column, strand: Column) -> Column:
        core = F.when(strand.isNotNull(), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
        return _let(core, lambda core: _let(strip_version(F.get(core, F.size(core) - 3)), lambda chrom: fields(core, chrom, strand)))

    def fields(core: Column, chrom: Column, strand: Column) -> Column:
        gene = F.when(F.size(core) == 4, F.get(core, F.lit(0)))
        at = F.size(core) - 3
        plain = F.coalesce(strand, F.lit("+"))
        flipped = F.when(turned & (plain == "+"), "-").when(turned & (plain == "-"), "+").otherwise(plain)
        return F.struct(gene.alias("gene"), chrom.alias("chrom"), F.greatest(F.get(core, at + 1).cast("long"), F.lit(1)).alias("start"), F.get(core, at + 2).cast("long").alias("end"), flipped.alias("strand"), F.startswith(chrom, F.lit(TRANSCRIPT_PREFIX)).alias("transcript"))

    own = lambda parts: F.when(F.element_at(parts, -1).isin("+", "-", "*"), F.element_at(parts, -1))
    return _let(F.split(F.regexp_replace(exon_id, r"\.inv-strand$", ""), "/"), lambda parts: _let(own(parts), lambda strand: named(parts, strand)))


def _let(value: Column, f) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip_version(name: Column) -> Column:
    """A transcript reference without its ``.N``."""
    return F.when(F.startswith(name, F.lit(TRANSCRIPT_PREFIX)), F.regexp_replace(name, r"\.\d+$", "")).otherwise(name)


def render_exon(chrom: Column, start: Column, end: Column, strand: Column, gene: Column | None = None, sep: str = "/") -> Column:
    return F.concat_ws(sep, *([gene] if gene is not None else []), chrom, start.cast("string"), end.cast("string"), strand)


def counter(number: Column, digits: int = 9, prefix: str = "F") -> Column:
    """Zero-filled number; raises when it needs more digits."""
    text = number.cast("string")
    return F.when(F.length(text) > digits, F.raise_error(F.concat(F.lit("counter overflow: "), text)).cast("string")).otherwise(F.concat(F.lit(prefix), F.lpad(text, digits, "0")))


def to_int(text: Column, what: str = "value") -> Column:
    """Integer of a text; raises with the text where it is none."""
    value = text.try_cast("long")
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit(f"no integer for {what}: "), text)).cast("long")).otherwise(value)


def to_double(text: Column, what: str = "value") -> Column:
    """Number of a text; raises with the text where it is none."""
    number = text.try_cast("double")
    return F.when(text.isNotNull() & number.isNull(), F.raise_error(F.concat(F.lit(f"no number for {what}: "), text)).cast("double")).otherwise(number)
