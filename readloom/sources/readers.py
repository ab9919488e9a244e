"""Readers of the domain's text formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom import schemas
from readloom.functions import flags, names
from readloom.sources.settled import settled


def tsv(spark: SparkSession, path: str | list[str], schema: str, header: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").option("header", header).csv(path)


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def parse_sam(rows: DataFrame) -> DataFrame:
    """SAM rows from ``value`` lines; header and blank lines are skipped, other columns come along.

    Adds fragment_name, read_index, NM, AS and HI (null where absent), with ``=`` of the mate resolved.
    Raises on too few fields, on sequence and quality of different lengths and on a name whose suffix
    contradicts the FLAG.
    """
    f = F.split("value", "\t")
    body = rows.where("value <> '' and not startswith(value, '@')")
    bad = lambda why: F.raise_error(F.concat(F.lit(why + ": "), F.col("value")))
    get = lambda i: F.get(f, F.lit(i))
    seq, qual = get(9), get(10)
    checked = F.when(F.size(f) < 11, bad("SAM row of fewer than 11 fields").cast("string")).when((qual != "*") & (F.length(seq) != F.length(qual)), bad("sequence and quality differ in length").cast("string")).otherwise(get(0))
    flag = get(1).cast("int")
    suffix = F.regexp_extract(get(0), r"/([12])$", 1)
    contrary = flags.has(flag, "paired") & ((suffix == "1") & flags.has(flag, "second") | (suffix == "2") & flags.has(flag, "first"))
    name = F.when(contrary, bad("read index of name and FLAG differ").cast("string")).otherwise(checked)
    tags = F.array_join(F.slice(f, 12, F.greatest(F.size(f) - 11, F.lit(0))), "\t")
    out = body.select(
        name.alias("query_name"), flag.alias("flag"), get(2).alias("ref"), get(3).cast("long").alias("pos"), get(4).cast("int").alias("mapq"), get(5).alias("cigar"),
        F.when(get(6) == "=", get(2)).otherwise(get(6)).alias("mate_ref"), get(7).cast("long").alias("mate_pos"), get(8).alias("insert_size"), seq.alias("seq"), qual.alias("qual"), tags.alias("tags"), *[c for c in rows.columns if c != "value"],
    )
    return out.select("*", names.fragment_name(F.col("query_name")).alias("fragment_name"), flags.read_index(F.col("flag"), F.col("query_name")).alias("read_index"), *[names.tag(F.col("tags"), t).alias(t) for t in ("NM", "AS", "HI")])


def sam(spark: SparkSession, path: str | list[str], mapped_only: bool = True) -> DataFrame:
    """SAM rows with ``row_no``, which ascends in the order of the files' lines."""
    rows = parse_sam(lines(spark, path).withColumn("row_no", F.monotonically_increasing_id()))
    return rows.where(flags.is_mapped(F.col("flag"), F.col("pos")) & (F.col("ref") != "*")) if mapped_only else rows


def sam_places(spark: SparkSession, path: str) -> DataFrame:
    """SAM rows with ``place`` from 1 in the order of the lines, files in the order of their paths being one.

    A row's place is that in its split and the rows of the splits before. These are one small row per split, which is all
    that is broadcast; the rows themselves are neither moved nor sorted.
    """
    from pyspark.sql import Window

    body = lines(spark, path).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_split"))
    body = body.where("value <> '' and not startswith(value, '@')").withColumn("_id", F.monotonically_increasing_id())
    splits = body.groupBy("_path", "_split").agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    before = F.sum("_rows").over(Window.orderBy("_path", "_split").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("_path", "_split", (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    rows = parse_sam(body.join(F.broadcast(splits), ["_path", "_split"]))
    return rows.withColumn("place", F.col("_id") + F.col("_shift")).drop("_path", "_split", "_id", "_shift")


def sam_header(rows: DataFrame) -> DataFrame:
    """(id, length) of the ``@SQ`` lines."""
    return rows.where("startswith(value, '@SQ')").select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("id"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("length"))


def rename_fragments(rows: DataFrame, order: str = "fragment_name") -> DataFrame:
    """Adds fragment_id ``F%09d`` by the rank of the fragment's name; names of that shape stay.

    Ranks are counted per range of names and then shifted, so no task holds all fragments.
    """
    ids = rows.select(F.col(order).alias("name")).distinct()
    return rows.join(with_number(ids, "name").select(F.col("name").alias(order), F.when(F.col("name").rlike(r"^F\d{9}$"), F.col("name")).otherwise(names.counter(F.col("number"))).alias("fragment_id")), order)


def with_number(rows: DataFrame, by: str) -> DataFrame:
    """Adds ``number`` from 1 in ascending order of a unique column, by range partitions and their offsets.

    The partitions are written once, so that rows are counted and numbered in the same ones.
    """
    from pyspark.sql import Window

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = settled(rows.repartitionByRange(parts, by).withColumn("_part", F.spark_partition_id()), "numbered")
    placed = placed.withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy(by)))
    sizes = placed.groupBy("_part").count()  # a row per partition
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return placed.join(offsets.select("_part", "_before"), "_part").withColumn("number", F.col("_row") + F.col("_before")).drop("_part", "_row", "_before")


def bed6(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """BED rows, ``start`` and ``end`` 1-based closed, with the block grammar of the name parsed where it is there."""
    rows = tsv(spark, path, schemas.BED6)
    return once(rows, block=parse_block_name(F.col("name"))).select((F.col("start0") + 1).alias("start"), F.col("end0").alias("end"), *[c for c in rows.columns if c not in ("start0", "end0")], "block")


# Fixed value: the grammar of block names in BED files.
BLOCK_NAME = r"^(.*?)-A(\d{5})-L(\d+)-I(\d+)-D(\d+)-F(\d+)-(\d+)/([PS])([12])$"


def parse_block_name(name: Column) -> Column:
    """The parts of a block's name. The grammar is tried once; as none but the first part may have a dash, the others are cut at these."""
    tail = F.substring_index(name, "-", -6)
    parts, end = F.split(tail, "-"), F.substring_index(tail, "/", -1)
    number = lambda i: F.substring(F.get(parts, F.lit(i)), 2, 2**31 - 1).cast("int")
    last = F.substring_index(F.get(parts, F.lit(5)), "/", 1).cast("int")
    fragment = F.left(name, F.length(name) - F.length(tail) - 1)
    parsed = F.struct(fragment.alias("fragment_id"), number(0).alias("aln_no"), number(1).alias("aligned_len"), number(2).alias("ins"), number(3).alias("del"), number(4).alias("block_idx"), last.alias("last_block"), (F.left(end, F.lit(1)) == "P").alias("paired"), F.substring(end, 2, 1).cast("int").alias("read_index"))
    return F.when(name.rlike(BLOCK_NAME), parsed)


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows with structs that are made once a row, however many of their fields are used afterwards."""
    return rows.select("*", F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("_once")).select(*rows.columns, *[F.col(f"_once.{name}").alias(name) for name in columns])


def intersections(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of read block by exon; raises where the two references differ."""
    rows = tsv(spark, path, schemas.INTERSECTION)
    same = F.when(F.col("chrom") == F.col("exon_chrom"), F.col("chrom")).otherwise(F.raise_error(F.concat(F.lit("references differ: "), "chrom", F.lit(" "), "exon_chrom")).cast("string"))
    return rows.withColumn("chrom", same)


def block_intersections(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of read block by exon with ``block``, the parts of the block's name; null where a name has none."""
    return once(intersections(spark, path), block=parse_block_name(F.col("name")))


def weights(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Weight rows; ``/1/1`` and ``/2/2`` are written once, ``/1/2`` raises."""
    rows = tsv(spark, path, schemas.WEIGHTS)
    f = F.col("fragment")
    clean = F.when(f.rlike(r"/1/2$|/2/1$"), F.raise_error(F.concat(F.lit("contradicting read index: "), f)).cast("string")).otherwise(F.regexp_replace(f, r"/([12])/\1$", "/$1"))
    return rows.withColumn("fragment", clean).withColumn("multiplicity", multiplicity(F.col("kind")))


def multiplicity(kind: Column) -> Column:
    """3 for paired-end, 2 for both reads singly, 1 for one read."""
    from functools import reduce

    ranks = list(enumerate(schemas.KINDS, 1))
    return reduce(lambda c, k: c.when(kind == k[1], k[0]), ranks[1:], F.when(kind == ranks[0][1], ranks[0][0]))


def object_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Exon to object; a third column is the internal object, else the object itself. The header row is skipped."""
    return tsv(spark, path, schemas.OBJECT_MAP).where("exon_id <> 'Exon Id'").withColumn("internal_id", F.coalesce("internal_id", "object_id"))


def transcript_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    rows = tsv(spark, path, schemas.TRANSCRIPT_MAP)
    return rows.withColumn("transcript_ref", F.col("transcript_id")).withColumn("transcript_id", names.simplify_junction(F.col("transcript_id")))


def lengths(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(id, length) from a table, or from the ``@SQ`` lines of a SAM header."""
    rows = lines(spark, path)
    parts = F.split("value", "\t")
    table = rows.where("not startswith(value, '@')").where(F.size(parts) == 2).select(F.get(parts, F.lit(0)).alias("id"), F.try_to_number(F.get(parts, F.lit(1)), F.lit("999999999999")).cast("long").alias("length")).where("length is not null")
    return sam_header(rows).unionByName(table)


def parse_gtf(rows: DataFrame) -> DataFrame:
    """GTF rows with gene_id, transcript_id, exon_number and exon_id (``chrom/start/end/strand`` where absent)."""
    a = F.col("attributes")
    value = lambda k: F.nullif(F.regexp_extract(a, rf'(?:^|;)\s*{k}\s+"?([^";]*)"?', 1), F.lit(""))
    own = names.render_exon(F.col("seqname"), F.col("start"), F.col("end"), F.col("strand"))
    number = F.coalesce(value("exon_number"), value("exonNumber")).cast("int")
    return rows.where("not startswith(seqname, '#')").select(*[c for c in rows.columns if c != "attributes"], value("gene_id").alias("gene_id"), value("transcript_id").alias("transcript_id"), number.alias("exon_number"), F.coalesce(value("exon_id"), own).alias("exon_id"))


def gtf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_gtf(tsv(spark, path, schemas.GTF))


def fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """FASTQ (four lines) or FASTA (two lines) entries: path, record (from 0), full_id, seq, qual and what the id says.

    Files are read in splits of any size. A line's number in its file is its place in its split and the
    lines of the splits before, which are one small row per split; the lines of an entry meet by it. Raises
    for entries that are malformed or cut off.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"))
    return with_fastq_ids(fastq_entries(lines))


def fastq_entries(lines: DataFrame) -> DataFrame:
    """Entries of lines (value) in ascending ``id`` without gaps inside each split of a path."""
    from pyspark.sql import Window

    of = Window.partitionBy("path").orderBy("split")
    splits = lines.groupBy("path", "split").agg(F.count("*").alias("lines"), F.min("id").alias("first"), F.min_by(F.substring("value", 1, 1), "id").alias("head"))
    splits = splits.select("path", "split", "first", F.coalesce(F.sum("lines").over(of.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.when(F.first("head").over(of) == ">", 2).otherwise(4).alias("size"))
    number = F.col("id") - F.col("first") + F.col("before")
    placed = lines.join(splits, ["path", "split"]).select("path", "size", F.floor(number / F.col("size")).alias("record"), (number % F.col("size")).alias("field"), "value")
    line = lambda k: F.max(F.when(F.col("field") == k, F.col("value")))
    entry = placed.groupBy("path", "size", "record").agg(F.count("*").alias("lines"), line(0).alias("head"), F.upper(line(1)).alias("seq"), line(3).alias("last"))
    bad = lambda why: F.raise_error(F.concat("path", F.lit(": entry "), (F.col("record") + 1).cast("string"), F.lit(why), "head")).cast("string")
    qual = F.when(F.col("size") == 4, F.col("last")).otherwise("*")
    wrong = ~F.substring("head", 1, 1).isin("@", ">") | ((F.col("size") == 4) & (F.length("last") != F.length("seq")))
    full = F.when(F.col("lines") < F.col("size"), bad(" is cut off: ")).when(wrong, bad(" is malformed: ")).otherwise(F.substring("head", 2, 2**31 - 1))
    return entry.select("path", "record", full.alias("full_id"), "seq", qual.alias("qual"))


def with_fastq_ids(rows: DataFrame) -> DataFrame:
    """Adds read_id (up to a blank), fragment_id, read_index and multiplicity (after the blank, 1 if absent)."""
    read = F.substring_index("full_id", " ", 1)
    rest = F.regexp_extract("full_id", r" (\d+)", 1)
    return rows.select("*", read.alias("read_id"), F.regexp_replace(read, r"/[12]$", "").alias("fragment_id"), F.coalesce(F.nullif(F.regexp_extract(read, r"/([12])$", 1), F.lit("")).cast("int"), F.lit(1)).alias("read_index"), F.when(rest == "", 1).otherwise(rest.cast("int")).alias("multiplicity"))


def fastq_base(path: Column) -> Column:
    """File name without ``.fastq`` or ``.fq`` and ``.gz``; raises for other names."""
    base = F.regexp_extract(path, r"([^/]+)\.(?:fastq|fq)(?:\.gz)?$", 1)
    return F.when(base == "", F.raise_error(F.concat(F.lit("no FASTQ file name: "), path)).cast("string")).otherwise(base)


def counts(spark: SparkSession, path: str | list[str], suffix: str = "", nonzero: bool = False) -> DataFrame:
    """(id, sample, count) of two-column count files; the sample is the file name without ``suffix``."""
    rows = tsv(spark, path, "id string, count double").where("id <> 'Id' and count is not null")
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    rows = rows.select("id", F.regexp_replace(name, rf"{suffix}(?:\.gz)?$" if suffix else r"\.gz$", "").alias("sample"), "count")
    return rows.where("count <> 0") if nonzero else rows


def read_numbers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(sample, reads): two columns, or three with chunks that are summed."""
    rows = tsv(spark, path, "sample string, second string, third string")
    return rows.select("sample", F.coalesce("third", "second").cast("long").alias("reads")).where("reads is not null").groupBy("sample").agg(F.sum("reads").alias("reads"))


def chromosomes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct first fields of an index of references."""
    return lines(spark, path).select(F.substring_index("value", "\t", 1).alias("chrom")).distinct()


def samples(spark: SparkSession, path: str) -> DataFrame:
    """Sample annotation by header (any case): sample, fastq_path, fastq_name, insert_size, and a link name.

    Files of a sample are numbered only where there are several. Raises on characters other than
    letters, digits, dot, dash and underscore in a sample name.
    """
    from pyspark.sql import Window

    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    found = {c.strip().lower(): c for c in rows.columns}
    missing = [c for c in ("sample name", "fastq path", "fastq name") if c not in found]
    if missing:
        raise ValueError(f"sample annotation lacks {', '.join(missing)}")
    name = F.col(f"`{found['sample name']}`")
    checked = F.when(name.rlike(r"^[A-Za-z0-9._-]+$"), name).otherwise(F.raise_error(F.concat(F.lit("sample name: "), name)).cast("string"))
    size = F.col(f"`{found['library insert size (bp)']}`").cast("int") if "library insert size (bp)" in found else F.lit(None).cast("int")
    rows = rows.select(checked.alias("sample"), F.col(f"`{found['fastq path']}`").alias("fastq_path"), F.col(f"`{found['fastq name']}`").alias("fastq_name"), size.alias("insert_size"))
    return link_names(rows, Window.partitionBy("sample"))


def link_names(rows: DataFrame, of) -> DataFrame:
    number = F.row_number().over(of.orderBy("fastq_path", "fastq_name"))
    return rows.withColumn("link", F.when(F.count("*").over(of) > 1, F.concat("sample", F.lit("_"), number.cast("string"))).otherwise(F.col("sample")))
