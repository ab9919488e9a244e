"""From blocks and exons to counts of genes, exons and junctions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators.intervals import interval_join

#: Smallest weight that still counts: fragments with up to 100 alignments.
LEAST_WEIGHT = 0.01


@dataclass(frozen=True)
class Mode:
    """How blocks qualify an object.

    ``required`` is a number of blocks, or ``all``; ``consecutive`` asks for a run of blocks; ``mates``
    is how the two reads of a pair combine; ``ambiguity`` is where unambiguous counting looks.
    """

    required: int | str
    consecutive: bool = False
    mates: str = "union"
    ambiguity: str = "fragment"
    splice: bool = True
    contain: bool = False
    overlap: int = 1


MODES = {
    "gene": Mode("all", mates="intersection"),
    "exon": Mode(1, ambiguity="block", overlap=5),
    "junction": Mode(2, consecutive=True, overlap=8),
    "intron": Mode(1, splice=False),
    "gene-overlap": Mode(1, ambiguity="block"),
}
ALIGNMENT = ["fragment_id", "aln_no"]


def conforms(mode: Mode, stranded: bool = False, slack: int = 0, mixed: bool = False) -> Column:
    """Whether a joined block and exon conform.

    With ``mixed`` there is a ``kind`` (genome, transcript or junction): reads on transcripts and junctions
    are spliced as they are and always do. On the genome, without splice rules
    any block does, or one inside its exon where containment is asked for. With them the block lies wholly
    in the exon; a first block may start later than the exon, a last block end earlier, and other ends
    coincide up to ``slack``. The overlap reaches the threshold or the whole exon.
    """
    c = F.col
    first, last = c("block_idx") == 0, c("block_idx") == c("last_block")
    whole = c("aligned_len") - c("ins") + c("del") == c("overlap")
    start = F.when(first, c("exon_start") <= c("start")).otherwise(F.abs(c("exon_start") - c("start")) <= slack)
    end = F.when(last, c("exon_end") >= c("end")).otherwise(F.abs(c("exon_end") - c("end")) <= slack)
    if mode.splice:
        genome = whole & start & end
    else:
        genome = (c("exon_start") <= c("start")) & (c("exon_end") >= c("end")) if mode.contain else F.lit(True)
    enough = c("overlap") >= F.least(F.lit(mode.overlap), c("exon_end") - c("exon_start") + 1)
    ok = ((c("kind") != "genome") | genome if mixed else genome) & enough
    return ok & (c("exon_strand") == c("strand")) if stranded else ok


def distinct_alignments(hits: DataFrame) -> DataFrame:
    """Hits with ``canonical``: the sorted places of an alignment's blocks, equal for alignments that are the same.

    Of alignments with one canonical form that with the smallest number stays; its exons are those of all.
    """
    place = F.concat_ws("/", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "strand")
    side = F.when(F.col("paired"), F.lit("p")).otherwise(F.concat(F.lit("r"), F.col("read_index").cast("string")))
    of = Window.partitionBy(*ALIGNMENT)
    block = F.concat(F.col("read_index").cast("string"), F.lit("@"), F.lpad("block_idx", 4, "0"), F.lit("@"), place)
    form = hits.withColumn("side", F.min(side).over(of)).withColumn("canonical", F.concat("side", F.lit(":"), F.array_join(F.sort_array(F.collect_set(block).over(of)), ":")))
    return form.withColumn("aln_no", F.min("aln_no").over(Window.partitionBy("fragment_id", "canonical")))


def checked(hits: DataFrame) -> DataFrame:
    """The hits as they are; raises where those of one read's alignment contradict each other.

    They have one strand, one reference and one number of a last block that no block passes; each block has one interval,
    one length and one number of insertions and deletions. A read on a transcript or junction (``kind``) has one interval
    and meets an exon once.
    """
    read = ["fragment_id", "aln_no", "read_index", "kind"]

    def one(column, *keys):
        of = Window.partitionBy(*read, *keys)
        return F.min(column).over(of) == F.max(column).over(of)

    far = F.col("kind") != "genome"
    block = F.struct("start", "end", "aligned_len", "ins", "del")
    marks = {"_block": one(block, "block_idx"), "_read": one(F.struct("chrom", "strand", "last_block"))}
    marks["_far"] = ~far | (one(block) & (F.count(F.lit(1)).over(Window.partitionBy(*read, "exon_id", "exon_start")) == 1))
    good = F.col("_block") & F.col("_read") & F.col("_far") & (F.col("block_idx") <= F.col("last_block"))
    what = F.raise_error(F.concat(F.lit("blocks contradict each other: "), F.to_json(F.struct(*read)))).cast("boolean")
    return hits.withColumns(marks).where(F.when(good, True).otherwise(what)).drop(*marks)


def alignment_numbers(hits: DataFrame) -> DataFrame:
    """(fragment_id, n): distinct alignments of each fragment, the larger of both sides; pairs count on the first side."""
    sides = hits.select("fragment_id", "canonical", F.when(F.col("side") == "r2", 2).otherwise(1).alias("s")).distinct()
    return sides.groupBy("fragment_id").agg(F.greatest(F.sum(F.when(F.col("s") == 1, 1).otherwise(0)), F.sum(F.when(F.col("s") == 2, 1).otherwise(0))).alias("n"))


def longest_run(indices: Column) -> Column:
    """Length of the longest run of consecutive numbers in an array of distinct numbers."""
    state = F.struct(F.lit(-2).alias("at"), F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        now = F.when(x == s["at"] + 1, s["now"] + 1).otherwise(1)
        return F.struct(x.cast("int").alias("at"), now.alias("now"), F.greatest(s["best"], now).alias("best"))

    return F.aggregate(F.array_sort(indices), state, step, lambda s: s["best"])


def with_objects(exons: DataFrame, objects: DataFrame) -> DataFrame:
    """Exons with the array of their objects; exons without one stand for themselves. A map of any size is never broadcast."""
    named = objects.groupBy("exon_id").agg(F.collect_set("object_id").alias("objects"))
    return exons.join(named.hint("merge"), "exon_id", "left").withColumn("objects", F.coalesce("objects", F.array("exon_id")))


def with_numbers(hits: DataFrame) -> DataFrame:
    """Adds ``n``, what ``alignment_numbers`` gives for the row's fragment: forms are counted where they begin, in the sort that told them apart."""
    along, of = Window.partitionBy("fragment_id").orderBy("canonical"), Window.partitionBy("fragment_id")
    new = (F.row_number().over(along) == 1) | ~F.lag("canonical").over(along).eqNullSafe(F.col("canonical"))
    second = F.coalesce(F.col("side") == "r2", F.lit(False))
    number = lambda on: F.coalesce(F.sum(F.when(F.col("_new") & on, 1)).over(of), F.lit(0))
    return hits.withColumn("_new", new).withColumn("n", F.greatest(number(second), number(~second)).cast("int")).drop("_new")


def _alone(rows: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Rows of the keys that have one value of a column only."""
    of = Window.partitionBy(*keys)
    return rows.withColumns({"_least": F.min(column).over(of), "_most": F.max(column).over(of)}).where("_least = _most").drop("_least", "_most")


def qualified(hits: DataFrame, mode: Mode, unambiguous: bool = False, stranded: bool = False, carry: tuple[str, ...] = (), objects: DataFrame | None = None) -> DataFrame:
    """(fragment_id, aln_no, side, object_id): objects of each distinct alignment.

    ``hits`` carry the ``objects`` of their exons, or these come from a map (exon_id, object_id), which only hits that
    conform then meet; columns to ``carry`` have one value per fragment. ``conform`` says which hits do where it was decided
    before.
    """
    mixed = "kind" in hits.columns
    ok = hits.where("conform" if "conform" in hits.columns else conforms(mode, stranded, mixed=mixed))
    block = ["fragment_id", "aln_no", "side", "read_index", "block_idx"]
    if mixed:  # of the exons of a place on transcripts and junctions those with the largest overlap
        most = F.max(F.when(F.col("kind") != "genome", F.col("overlap"))).over(Window.partitionBy(*block))
        ok = ok.withColumn("_most", most).where((F.col("kind") == "genome") | (F.col("overlap") == F.col("_most"))).drop("_most")
    if unambiguous and mode.ambiguity == "block":
        ok = _alone(ok, "exon_id", block)
    if objects is not None:
        ok = with_objects(ok.select(*block, "exon_id", "last_block", *carry), objects).repartition("fragment_id")
    named = ok.withColumn("object_id", F.explode("objects"))
    read = ["fragment_id", "aln_no", "side", "read_index", "object_id", *carry]
    per = named.groupBy(*read).agg(F.collect_set(F.when(F.col("block_idx") >= 0, F.col("block_idx"))).alias("_blocks"), F.max("last_block").alias("_last"))
    reach = longest_run(F.col("_blocks")) if mode.consecutive else F.size("_blocks")
    need = F.col("_last") + 1 if mode.required == "all" else F.lit(mode.required)
    found = per.where(reach >= need)
    per_alignment = found.groupBy("fragment_id", "aln_no", "side", "object_id", *carry).agg(F.min("read_index").alias("_least"), F.max("read_index").alias("_most"))
    if mode.mates == "intersection":
        per_alignment = per_alignment.where("side <> 'p' or _least < _most")
    out = per_alignment.drop("_least", "_most")
    if unambiguous and mode.ambiguity == "fragment":
        out = _alone(out, "object_id", ["fragment_id"])
    return out


def with_weights(found: DataFrame, weights: DataFrame | None) -> DataFrame:
    """Adds ``weight``: 1, or with a table of alignment numbers (fragment_id, n) the smaller reciprocal of it and of ``n``."""
    if weights is None:
        return found.withColumn("weight", F.lit(1.0))
    joined = found.join(weights.select("fragment_id", F.col("n").alias("_table")), "fragment_id", "left")
    missing = F.raise_error(F.concat(F.lit("fragment without weight: "), F.to_json(F.struct("fragment_id")))).cast("double")
    return joined.withColumn("weight", F.when(F.col("_table").isNull(), missing).otherwise(F.least(1.0 / F.col("_table"), 1.0 / F.col("n")))).drop("_table")


def fragment_counts(found: DataFrame, threshold: float = LEAST_WEIGHT, use_weights: bool = True) -> DataFrame:
    """(fragment_id, object_id, count): weights of a fragment's alignments with an object, the larger side, 1 at most."""
    w = found.where(F.col("weight") >= threshold)
    w = w if use_weights else w.withColumn("weight", F.lit(1.0))
    side = F.when(F.col("side") == "r2", 2).otherwise(1)
    total = lambda s: F.coalesce(F.sum(F.when(side == s, F.col("weight"))), F.lit(0.0))
    return w.groupBy("fragment_id", "object_id").agg(F.least(F.lit(1.0), F.greatest(total(1), total(2))).alias("count"))


def fragment_hits(blocks: DataFrame, exons: DataFrame, objects: DataFrame, stranded: bool = False, mode: Mode | None = None) -> DataFrame:
    """Joined blocks and exons with the exons' objects, dealt by fragment once for all that follows.

    With a ``mode`` it is decided before the exchange which hits ``conform``, so that lengths and the exons' places need not
    go along, nor objects of hits that do not.
    """
    joined = interval_join(blocks, with_objects(exons, objects), stranded=stranded, carry=("objects",))
    if mode is not None:
        joined = joined.withColumn("conform", conforms(mode, stranded)).withColumn("objects", F.when(F.col("conform"), F.col("objects")))
    return distinct_alignments(joined.repartition("fragment_id"))


def quantify(blocks: DataFrame, exons: DataFrame, objects: DataFrame, mode: str | Mode = "gene", weights: DataFrame | None = None, unambiguous: bool = False, stranded: bool = False, threshold: float = LEAST_WEIGHT, use_weights: bool = True) -> DataFrame:
    """(id, count) of every object that fragments count for.

    ``blocks`` has fragment_id, aln_no, read_index, paired, chrom, start, end, strand, block_idx, last_block,
    aligned_len, ins and del. Everything after the interval join is keyed on the fragment.
    """
    mode = MODES[mode] if isinstance(mode, str) else mode
    return quantify_hits(fragment_hits(blocks, exons, objects, stranded, mode), mode, weights, unambiguous, stranded, threshold, use_weights)


def quantify_hits(hits: DataFrame, mode: str | Mode = "gene", weights: DataFrame | None = None, unambiguous: bool = False, stranded: bool = False, threshold: float = LEAST_WEIGHT, use_weights: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """(id, count) from hits of distinct alignments that carry the objects of their exons.

    With ``by`` the fragment_id is a struct, and counts are kept apart by these of its fields.
    """
    mode = MODES[mode] if isinstance(mode, str) else mode
    found = qualified(with_numbers(hits), mode, unambiguous, stranded, carry=("n",))
    per = fragment_counts(with_weights(found, weights), threshold, use_weights)
    return per.groupBy(*[F.col(f"fragment_id.{c}").alias(c) for c in by], F.col("object_id").alias("id")).agg(F.sum("count").alias("count"))


def overlap_counts(blocks: DataFrame, exons: DataFrame, objects: DataFrame, least: int = 3, weights: DataFrame | None = None, by_read: bool = False) -> DataFrame:
    """(id, count) without splice rules: objects that a fragment (or read) overlaps, each 1/n of it; n is 1 where unknown."""
    hits = interval_join(blocks, exons, least=least)
    unit = ["fragment_id", "read_index"] if by_read else ["fragment_id"]
    found = hits.join(objects.select("exon_id", "object_id").distinct(), "exon_id").select(*unit, "object_id").distinct()
    if weights is not None:
        found = found.join(weights.select("fragment_id", F.col("n").alias("_n")), "fragment_id", "left")
    n = F.coalesce("_n", F.lit(1)) if weights is not None else F.lit(1)
    return found.withColumn("_w", 1.0 / n).groupBy(F.col("object_id").alias("id")).agg(F.sum("_w").alias("count"))


def bookkeeping(hits: DataFrame, per: DataFrame) -> DataFrame:
    """Fragments seen, counted and left out, and the sum of what was contributed: one row."""
    seen = hits.select("fragment_id").distinct().select(F.lit(1).alias("seen"), F.lit(0).alias("counted"), F.lit(0.0).alias("count"))
    done = per.groupBy("fragment_id").agg(F.sum("count").alias("count")).select(F.lit(0).alias("seen"), F.lit(1).alias("counted"), "count")
    every = seen.unionByName(done).agg(F.coalesce(F.sum("seen"), F.lit(0)).cast("long").alias("seen"), F.coalesce(F.sum("counted"), F.lit(0)).cast("long").alias("counted"), F.coalesce(F.sum("count"), F.lit(0.0)).alias("total"))
    return every.select("seen", "counted", (F.col("seen") - F.col("counted")).alias("excluded"), "total")
