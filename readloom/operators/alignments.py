"""From SAM rows to mate pairs and blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import cigar, flags
from readloom.sources.readers import once

PAIR_COLUMNS = ["query_name", "ref", "pos", "mate_ref", "mate_pos", "read_index", "HI"]


def mate_pairs(rows: DataFrame, key: str = "fragment_id", order: str = "row_no") -> DataFrame:
    """(key, first, second): row numbers of mates inside a fragment, one to one.

    Mates have equal HI tags, else opposite read indices, equal names and each other's positions. Rows
    pair greedily in order. Pairs are first sought by a join; in fragments in which a row has more than one
    candidate they are taken by a fold over the sorted candidates. Rows are dealt by fragment once.
    """
    c = F.col
    own, mate = F.concat_ws(":", "ref", "pos"), F.concat_ws(":", "mate_ref", "mate_pos")
    # Rows that cannot match share no place: they meet by the unordered pair of places, or by the tag.
    place = F.array_join(F.array_sort(F.array(own, mate)), "|")
    meets = F.explode(F.array_compact(F.array(F.concat(F.lit("h"), c("HI").cast("string")), F.concat(F.lit("p"), place))))
    row = F.struct(c(order).alias("row"), *PAIR_COLUMNS)
    met = rows.where(c(key).isNotNull()).select(key, order, *PAIR_COLUMNS).repartition(key).select(key, row.alias("_row"), meets.alias("_k")).groupBy(key, "_k").agg(F.collect_list("_row").alias("_rows")).where("size(_rows) > 1")
    a = c("_a")

    def fits(b):
        by_tag = a["HI"].isNotNull() & b["HI"].isNotNull()
        by_place = (a["read_index"] != b["read_index"]) & (a["query_name"] == b["query_name"]) & (a["mate_ref"] == b["ref"]) & (a["mate_pos"] == b["pos"]) & (b["mate_ref"] == a["ref"]) & (b["mate_pos"] == a["pos"])
        return (a["row"] < b["row"]) & F.when(by_tag, a["HI"] == b["HI"]).otherwise(by_place)

    pairs = met.select(key, "_rows", F.explode("_rows").alias("_a")).select(key, a["row"].alias("first"), F.explode(F.filter("_rows", fits)).alias("_b")).select(key, "first", c("_b.row").alias("second")).distinct()
    ends = pairs.select("*", F.explode(F.array("first", "second")).alias("_end"))
    ends = ends.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key, "_end"))).withColumn("_mixed", (F.max("_n").over(Window.partitionBy(key)) > 1)).where(c("_end") == c("first"))

    # In order, a pair is taken where neither row has been.
    state = F.struct(F.expr("cast(array() as array<bigint>)").alias("used"), F.expr("cast(array() as array<struct<first:bigint,second:bigint>>)").alias("taken"))

    def step(s, x):
        free = ~(F.array_contains(s["used"], x["first"]) | F.array_contains(s["used"], x["second"]))
        return F.when(free, F.struct(F.concat(s["used"], F.array(x["first"], x["second"])).alias("used"), F.concat(s["taken"], F.array(x)).alias("taken"))).otherwise(s)

    sought = F.struct(c("first").cast("long").alias("first"), c("second").cast("long").alias("second"))
    units = ends.groupBy(key, F.when(~c("_mixed"), c("first")).alias("_unit")).agg(F.array_sort(F.collect_list(sought)).alias("_c"))
    taken = units.select(key, F.explode(F.when(c("_unit").isNotNull(), c("_c")).otherwise(F.aggregate("_c", state, step, lambda s: s["taken"]))).alias("_p"))
    return taken.select(key, *[c(f"_p.{x}").cast(rows.schema[order].dataType).alias(x) for x in ("first", "second")])


def read_filter(rows: DataFrame, pairs: DataFrame, max_edits: int | None = None, min_score: int | None = None, primary: bool = False, key: str = "fragment_id", order: str = "row_no") -> DataFrame:
    """Alignments (one row per read and hit) that pass, with ``aln_no`` and ``paired``.

    A read passes when its edit distance and score do; a missing tag passes. Of a pair of which one mate
    fails the other stays, alone but still labelled by its own FLAG; with ``primary`` only primary rows stay. The
    alignments are dealt by fragment.
    """
    ok = F.lit(True)
    if max_edits is not None:
        ok = ok & (F.coalesce("NM", F.lit(-1)) <= max_edits)
    if min_score is not None:
        ok = ok & (F.coalesce("AS", F.lit(2**31 - 2)) >= min_score)
    if primary:
        ok = ok & ~flags.has(F.col("flag"), "secondary")
    mates = pairs.select(key, F.explode(F.array("first", "second")).alias(order), F.col("first").alias("_pair"))
    # Pairs go to their rows where the fragment is dealt, so that a window finds them.
    both = rows.where(ok).unionByName(mates.withColumn("_mark", F.lit(True)), allowMissingColumns=True).repartition(key)
    kept = both.withColumn("_pair", F.max("_pair").over(Window.partitionBy(key, order))).where("_mark is null").drop("_mark")
    unit = F.coalesce("_pair", order)
    numbered = kept.withColumn("aln_no", F.dense_rank().over(Window.partitionBy(key).orderBy(unit)))
    return numbered.withColumn("paired", F.col("_pair").isNotNull() & flags.has_mate(F.col("flag"))).drop("_pair")


def blocks(rows: DataFrame, direction: str = "none", split: bool = True) -> DataFrame:
    """Blocks of alignments: a row per part of a read between gaps.

    ``rows`` has ref, pos, cigar and strand (or flag) besides the columns to keep. ``split`` false gives
    one block from the first base to the last. Raises where blocks do not add up to the read's length.
    """
    ops = cigar.parse(F.col("cigar"))
    strand = F.col("strand") if "strand" in rows.columns else flags.strand(F.col("flag"))
    strand = flags.fragment_strand(strand, F.col("read_index"), direction) if direction != "none" else strand
    found = once(once(rows, _ops=ops), _blocks=cigar.blocks(F.col("pos"), F.col("_ops")))  # else the CIGAR is cut for each use
    if not split:
        whole = F.struct(F.get("_blocks", F.lit(0))["start"].alias("start"), F.element_at("_blocks", -1)["end"].alias("end"), cigar.read_length(F.col("_ops")).alias("aligned_len"), cigar.total(F.col("_ops"), ("I", "S")).alias("ins"), cigar.total(F.col("_ops"), ("D",)).alias("del"), cigar.reference_length(F.col("_ops")).alias("ref_len"))
        found = found.withColumn("_blocks", F.array(whole))
    if "seq" in rows.columns:
        total = F.aggregate("_blocks", F.lit(0), lambda n, b: n + b["aligned_len"])
        found = found.withColumn("_blocks", F.when((F.col("seq") == "*") | (total == F.length("seq")), F.col("_blocks")).otherwise(F.raise_error(F.concat(F.lit("blocks differ from the read's length: "), "cigar")).cast(found.schema["_blocks"].dataType)))
    keep = [c for c in rows.columns if c not in ("strand", "cigar", "pos", "ref", "seq", "qual", "tags", "chrom")]
    chrom = F.col("chrom") if "chrom" in rows.columns else F.col("ref")
    out = found.select(*keep, chrom.alias("chrom"), strand.alias("strand"), (F.size("_blocks") - 1).alias("last_block"), F.posexplode("_blocks").alias("block_idx", "_b"))
    return out.select(*keep, "chrom", F.col("_b.start").alias("start"), F.col("_b.end").alias("end"), "strand", "block_idx", "last_block", F.col("_b.aligned_len").alias("aligned_len"), F.col("_b.ins").alias("ins"), F.col("_b.del").alias("del"))


def introns(rows: DataFrame) -> DataFrame:
    """Gaps of alignments: a row per gap, with the other columns of ``rows``."""
    keep = [c for c in rows.columns if c not in ("cigar", "pos")]
    return rows.where(cigar.is_spliced(F.col("cigar"))).select(*keep, F.explode(cigar.introns(F.col("pos"), cigar.parse(F.col("cigar")))).alias("_i")).select(*keep, F.col("_i.start").alias("start"), F.col("_i.end").alias("end"))


def spliced_fragments(rows: DataFrame, key: str = "fragment_id", unit: str = "aln_no") -> DataFrame:
    """All rows of a hit of which either read is spliced."""
    mark = F.max(cigar.is_spliced(F.col("cigar")).cast("int")).over(Window.partitionBy(key, unit))
    return rows.withColumn("_spliced", mark).where("_spliced = 1").drop("_spliced")


def expand_versions(rows: DataFrame, exons: DataFrame, ref: str = "chrom") -> DataFrame:
    """Rows on unversioned transcript references, repeated for each versioned reference among the exons' chromosomes."""
    versions = exons.select(F.col("chrom").alias("_versioned"), F.regexp_replace("chrom", r"\.\d+$", "").alias(ref)).distinct()
    return rows.join(versions, ref, "left").withColumn(ref, F.coalesce("_versioned", ref)).drop("_versioned")


def sort_by_name(rows: DataFrame) -> DataFrame:
    return rows.orderBy("fragment_name", "read_index", "ref", "pos")


def sort_by_place(rows: DataFrame) -> DataFrame:
    return rows.orderBy("ref", "pos", "fragment_name", "read_index")


def merge_sets(*sets: DataFrame) -> DataFrame:
    """All rows of several alignment sets; sort the result where an order is needed."""
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s)
    return out


def attach_rows(blocks: DataFrame, rows: DataFrame, keep: list[str], key: str = "fragment_id") -> DataFrame:
    """Blocks with columns of the SAM row they come from, found by (key, ref, pos, read_index); raises for blocks without one."""
    side = rows.select(key, "ref", "pos", "read_index", *keep, F.lit(1).alias("_there")).dropDuplicates([key, "ref", "pos", "read_index"])
    joined = blocks.join(side, [key, "ref", "pos", "read_index"], "left")
    lost = F.raise_error(F.concat(F.lit("block without its alignment: "), F.col(key).cast("string"))).cast("int")
    return joined.withColumn("_there", F.when(F.col("_there").isNull(), lost).otherwise(F.col("_there"))).where("_there = 1").drop("_there")


def iterate_groups(rows: DataFrame, key: str, f, schema: str) -> DataFrame:
    """A processor of the rows of each fragment: ``f`` gets a pandas frame and gives one."""
    return rows.groupBy(key).applyInPandas(f, schema)


def chromosome_check(rows: DataFrame, exons: DataFrame) -> DataFrame:
    """(chrom, known): references of the alignments, and whether the annotation has them. Raises if it has none."""
    known = exons.select("chrom", F.lit(True).alias("known")).distinct()
    found = rows.select("chrom").distinct().join(known, "chrom", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    if found.where("known").isEmpty():
        raise ValueError("alignments and annotation share no reference name")
    return found


