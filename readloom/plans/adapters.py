"""Domain-shaped views of the supplied star-schema tables.

There are no sequencing data here, so orders stand for fragments, their lines for alignments and parts
for exons. All values are integer arithmetic of the tables' columns; ``SQL`` has the same views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alignments(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """fragment_id, aln_no, read_index, paired, chrom, pos, cigar, strand, nm, row_no."""
    li = table(spark, sf_dir, "lineitem")
    c = F.col
    hit = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    li = li.withColumn("aln_no", hit)
    li = li.where(c("l_linestatus") == status) if status else li
    size = c("l_quantity").cast("long").cast("string")
    spliced = F.concat(size, F.lit("M"), (10 + c("l_suppkey") % 50).cast("string"), F.lit("N"), (5 + c("l_linenumber")).cast("string"), F.lit("M"))
    return li.select(
        c("l_orderkey").alias("fragment_id"), "aln_no", (1 + (c("l_linenumber") - 1) % 2).cast("int").alias("read_index"), F.lit(False).alias("paired"), F.concat(F.lit("chr"), (c("l_partkey") % 5).cast("string")).alias("chrom"),
        (c("l_partkey") * 20 + c("l_suppkey") % 37 + 1).alias("pos"), F.when(c("l_linenumber") % 3 == 0, spliced).otherwise(F.concat(size, F.lit("M"))).alias("cigar"), F.when(c("l_returnflag") == "R", "-").otherwise("+").alias("strand"), F.round(c("l_discount") * 100).cast("int").alias("nm"),
    )


def paired_alignments(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """As ``alignments``, neighbouring lines of an order being the mates of one alignment; a last odd line is a single read."""
    a, of = alignments(spark, sf_dir, status).withColumnRenamed("aln_no", "row_no"), Window.partitionBy("fragment_id")
    # Without a status the lines of an order are numbered as they are; units follow from places and sizes, so nothing is sorted again.
    a = a.withColumns({"_at": F.row_number().over(of.orderBy("row_no")) if status else F.col("row_no"), "_n": F.count("*").over(of)})
    unit = F.floor((F.col("_at") - 1) / 2).cast("int") + 1
    paired = 2 * unit <= F.col("_n")
    index = F.when(paired, 1 + (F.col("_at") - 1) % 2).otherwise(1 + F.col("row_no") % 2).cast("int")
    a = a.withColumns({"aln_no": unit, "paired": paired, "read_index": index})
    return a.select("fragment_id", "aln_no", *[c for c in a.columns if c not in ("fragment_id", "aln_no", "_at", "_n", "row_no")], "row_no")


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """exon_id, chrom, start, end, strand, gene_id, name."""
    p, c = table(spark, sf_dir, "part"), F.col
    chrom, start = F.concat(F.lit("chr"), (c("p_partkey") % 5).cast("string")), c("p_partkey") * 20 + 1
    end, strand = start + c("p_size") * 4, F.when(c("p_partkey") % 2 == 0, "+").otherwise("-")
    return p.select(F.concat_ws("/", chrom, start.cast("string"), end.cast("string"), strand).alias("exon_id"), chrom.alias("chrom"), start.alias("start"), end.alias("end"), strand.alias("strand"), c("p_brand").alias("gene_id"), c("p_name").alias("name"))


def objects(spark: SparkSession, sf_dir: str, column: str = "gene_id") -> DataFrame:
    return exons(spark, sf_dir).select("exon_id", F.col(column).alias("object_id"))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fragment_id, read_index, seq: letters A, C, G and T of each text, as the reads of pairs."""
    d = table(spark, sf_dir, "documents")
    seq = F.upper(F.regexp_replace("text", "[^ACGTacgt]", ""))
    return d.select(F.floor(F.col("doc_id") / 2).alias("fragment_id"), (1 + F.col("doc_id") % 2).cast("int").alias("read_index"), seq.alias("seq"))


def sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, sample, count: lines of each part by the priority of their order."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.groupBy(F.col("l_partkey").alias("id"), F.col("o_orderpriority").alias("sample")).agg(F.count("*").cast("double").alias("count"))


#: The views as SQL common table expressions, by name.
SQL = {
    "aln0": """aln0 AS (SELECT l_orderkey AS fragment_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS aln_no,
 CAST(1 + (l_linenumber - 1) % 2 AS INTEGER) AS read_index, 'chr' || CAST(l_partkey % 5 AS VARCHAR) AS chrom, l_partkey * 20 + l_suppkey % 37 + 1 AS pos, CAST(l_quantity AS BIGINT) AS len,
 CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand, CAST(round(l_discount * 100) AS INTEGER) AS nm, l_linenumber % 3 = 0 AS spliced, 10 + l_suppkey % 50 AS gap, CAST(5 + l_linenumber AS BIGINT) AS len2, l_linestatus FROM lineitem)""",
    "aln": "aln AS (SELECT * FROM aln0)",
    "blk": """blk AS (SELECT fragment_id, aln_no, read_index, chrom, strand, nm, 0 AS block_idx, CASE WHEN spliced THEN 1 ELSE 0 END AS last_block, pos AS bs, pos + len - 1 AS be, len AS al FROM aln
 UNION ALL SELECT fragment_id, aln_no, read_index, chrom, strand, nm, 1, 1, pos + len + gap, pos + len + gap + len2 - 1, len2 FROM aln WHERE spliced)""",
    "alnp": """alnp0 AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY fragment_id ORDER BY aln_no) - 1) / 2) AS INTEGER) + 1 AS unit FROM aln0),
 alnp AS (SELECT * EXCLUDE (aln_no, read_index, unit), aln_no AS row_no, unit AS aln_no, count(*) OVER w = 2 AS paired, CASE WHEN count(*) OVER w = 2 THEN row_number() OVER (PARTITION BY fragment_id, unit ORDER BY aln_no) ELSE 1 + aln_no % 2 END AS read_index FROM alnp0 WINDOW w AS (PARTITION BY fragment_id, unit))""",
    "blkp": """blk AS (SELECT fragment_id, aln_no, read_index, paired, CASE WHEN paired THEN 'p' ELSE 'r' || CAST(read_index AS VARCHAR) END AS side, chrom, strand, nm, 0 AS block_idx, CASE WHEN spliced THEN 1 ELSE 0 END AS last_block, pos AS bs, pos + len - 1 AS be, len AS al FROM alnp
 UNION ALL SELECT fragment_id, aln_no, read_index, paired, CASE WHEN paired THEN 'p' ELSE 'r' || CAST(read_index AS VARCHAR) END, chrom, strand, nm, 1, 1, pos + len + gap, pos + len + gap + len2 - 1, len2 FROM alnp WHERE spliced)""",
    "intron": "intron AS (SELECT fragment_id, aln_no, chrom, pos + len AS s, pos + len + gap - 1 AS e FROM aln WHERE spliced)",
    "exon": """exon AS (SELECT 'chr' || CAST(p_partkey % 5 AS VARCHAR) || '/' || CAST(p_partkey * 20 + 1 AS VARCHAR) || '/' || CAST(p_partkey * 20 + 1 + p_size * 4 AS VARCHAR) || '/' || CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS exon_id,
 'chr' || CAST(p_partkey % 5 AS VARCHAR) AS chrom, p_partkey * 20 + 1 AS es, p_partkey * 20 + 1 + p_size * 4 AS ee, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS estrand, p_brand AS gene_id, p_name AS name FROM part)""",
    "hit": """hit AS (SELECT b.*, e.exon_id, e.es, e.ee, e.estrand, e.gene_id, e.name, least(b.be, e.ee) - greatest(b.bs, e.es) + 1 AS ov FROM blk b JOIN exon e ON b.chrom = e.chrom AND b.bs <= e.ee AND e.es <= b.be)""",
    "counts": "counts AS (SELECT l_partkey AS id, o_orderpriority AS sample, CAST(count(*) AS DOUBLE) AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)",
    "reads": "reads AS (SELECT CAST(floor(doc_id / 2) AS BIGINT) AS fragment_id, CAST(1 + doc_id % 2 AS INTEGER) AS read_index, upper(regexp_replace(text, '[^ACGTacgt]', '', 'g')) AS seq FROM documents)",
}

#: As alnp, mates being neighbours within one line status.
SQL["alnps"] = SQL["alnp"].replace("PARTITION BY fragment_id, unit", "PARTITION BY fragment_id, unit, l_linestatus").replace("PARTITION BY fragment_id ORDER", "PARTITION BY fragment_id, l_linestatus ORDER")


def sql(views: str, query: str) -> str:
    return "WITH " + ",\n".join(SQL[v] for v in views.split()) + "\n" + query
