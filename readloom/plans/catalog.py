"""Queries over the supplied tables, each with its SQL equivalent where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions import cigar, flags, names, sequence
from readloom.operators import alignments, combine, counting, intervals, junctions, projection, reads, sam_counts, stats, tables, weights
from readloom.plans import adapters
from readloom.plans.adapters import sql
from readloom.sources import writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    def register(f):
        QUERIES[name or f.__name__] = f
        if oracle:
            ORACLE_SQL[name or f.__name__] = oracle
        return f

    return register


def _long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.blocks(adapters.alignments(spark, sf))


def _weights(spark: SparkSession, sf: str) -> DataFrame:
    return weights.summarize(adapters.alignments(spark, sf)).select("fragment_id", F.col("num_alignments").alias("n"))


# --- counts -------------------------------------------------------------------------------------

_FORM = """form AS (SELECT fragment_id, aln_no, read_index, CAST(list_sort(list(DISTINCT CAST(block_idx AS VARCHAR) || '@' || chrom || '/' || CAST(bs AS VARCHAR) || '/' || CAST(be AS VARCHAR) || '/' || strand)) AS VARCHAR) AS form FROM hit {stranded} GROUP BY 1, 2, 3),
first AS (SELECT *, min(aln_no) OVER (PARTITION BY fragment_id, read_index, form) AS first FROM form),
h2 AS (SELECT h.*, f.first FROM hit h JOIN first f ON h.fragment_id = f.fragment_id AND h.aln_no = f.aln_no AND h.read_index = f.read_index {stranded}),
num AS (SELECT fragment_id, greatest(count(DISTINCT CASE WHEN read_index = 1 THEN form END), count(DISTINCT CASE WHEN read_index = 2 THEN form END)) AS n FROM form GROUP BY 1),
tab AS (SELECT fragment_id, greatest(sum(CASE WHEN read_index = 1 THEN 1 ELSE 0 END), sum(CASE WHEN read_index = 2 THEN 1 ELSE 0 END)) AS n FROM aln GROUP BY 1)"""
_SPLICE = "al = ov AND (CASE WHEN block_idx = 0 THEN es <= bs ELSE es = bs END) AND (CASE WHEN block_idx = last_block THEN ee >= be ELSE ee = be END)"


def _count_sql(mode: str, unambiguous: bool = False, stranded: bool = False, weighted: bool = True, contain: bool = False, column: str = "gene_id", tail: str | None = None) -> str:
    m = counting.MODES[mode]
    ok = _SPLICE if m.splice and not contain else "es <= bs AND ee >= be" if contain else "TRUE"
    need = {"all": "max(last_block) + 1"}.get(m.required, str(m.required))
    strand = "WHERE estrand = strand" if stranded else ""
    good = f"ok0 AS (SELECT * FROM h2 WHERE {ok} AND ov >= least({m.overlap}, ee - es + 1))"
    if unambiguous and m.ambiguity == "block":
        good += ", ok AS (SELECT o.* FROM ok0 o JOIN (SELECT fragment_id, first, read_index, block_idx FROM ok0 GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT exon_id) = 1) u USING (fragment_id, first, read_index, block_idx))"
    else:
        good += ", ok AS (SELECT * FROM ok0)"
    found = f"obj0 AS (SELECT fragment_id, first, read_index, {column} AS object_id FROM ok GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT block_idx) >= {need})"
    one = "JOIN (SELECT fragment_id FROM obj0 GROUP BY 1 HAVING count(DISTINCT object_id) = 1) u USING (fragment_id)" if unambiguous and m.ambiguity == "fragment" else ""
    w = "least(1.0 / t.n, 1.0 / n.n)" if weighted else "1.0"
    body = _FORM.format(stranded=strand) + f""",
{good}, {found}, obj AS (SELECT obj0.* FROM obj0 {one}),
wgt AS (SELECT n.fragment_id, CAST({w} AS DOUBLE) AS w FROM num n JOIN tab t ON n.fragment_id = t.fragment_id),
per AS (SELECT o.fragment_id, object_id, least(1.0, greatest(coalesce(sum(CASE WHEN read_index = 1 THEN w END), 0), coalesce(sum(CASE WHEN read_index = 2 THEN w END), 0))) AS c FROM obj o JOIN wgt w ON o.fragment_id = w.fragment_id WHERE w >= 0.01 GROUP BY 1, 2),
cnt AS (SELECT object_id AS id, CAST(sum(c) AS DOUBLE) AS count FROM per GROUP BY 1)
"""
    return sql("aln0 aln blk exon hit", "").rstrip() + ",\n" + body + (tail or "SELECT id, round(count, 6) AS count FROM cnt")


def _count(mode: str, weighted: bool = True, column: str = "gene_id", **options):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        w = _weights(spark, sf) if weighted else None
        return _rounded(counting.quantify(_blocks(spark, sf), adapters.exons(spark, sf), adapters.objects(spark, sf, column), mode, w, **options), "count")

    return run


query(_count_sql("gene"), "gene_counts")(_count("gene"))
query(_count_sql("gene", weighted=False), "gene_counts_unweighted")(_count("gene", False))
query(_count_sql("exon", column="exon_id"), "exon_counts")(_count("exon", column="exon_id"))
query(_count_sql("junction"), "junction_counts")(_count("junction"))
query(_count_sql("intron"), "intron_counts")(_count("intron"))
query(_count_sql("gene-overlap"), "gene_overlap_mode_counts")(_count("gene-overlap"))
query(_count_sql("gene", stranded=True), "gene_counts_stranded")(_count("gene", stranded=True))
query(_count_sql("gene", unambiguous=True), "gene_counts_unambiguous")(_count("gene", unambiguous=True))
query(_count_sql("exon", unambiguous=True, column="exon_id"), "exon_counts_unambiguous")(_count("exon", column="exon_id", unambiguous=True))


@query(_count_sql("intron", contain=True).replace(">= 1)", ">= max(last_block) + 1)"))
def gene_counts_containment(spark, sf):
    mode = counting.Mode("all", mates="intersection", splice=False, contain=True)
    return _rounded(counting.quantify(_blocks(spark, sf), adapters.exons(spark, sf), adapters.objects(spark, sf), mode, _weights(spark, sf)), "count")


@query(_count_sql("junction", column="name", tail="SELECT e.id, round(coalesce(c.count, 0.0), 6) AS count FROM (SELECT DISTINCT name AS id FROM exon) e LEFT JOIN cnt c ON e.id = c.id"))
def counts_all_ids(spark, sf):
    objects = adapters.objects(spark, sf, "name")
    got = counting.quantify(_blocks(spark, sf), adapters.exons(spark, sf), objects, "junction", _weights(spark, sf))
    return _rounded(writers.count_table(got, objects), "count")


@query(_count_sql("junction", column="name", tail="SELECT id, round(count, 6) AS count FROM cnt WHERE count <> 0"))
def counts_nonzero(spark, sf):
    objects = adapters.objects(spark, sf, "name")
    got = counting.quantify(_blocks(spark, sf), adapters.exons(spark, sf), objects, "junction", _weights(spark, sf))
    return _rounded(writers.count_table(got, objects, nonzero=True), "count")


@query(_count_sql("exon", tail="SELECT e.id, round(coalesce(c.count, 0.0), 6) AS count FROM (SELECT DISTINCT name AS id, gene_id FROM exon) e LEFT JOIN cnt c ON e.gene_id = c.id"))
def counts_3col_map(spark, sf):
    """Three-column map: counted by the internal id, written under the output id."""
    e = adapters.exons(spark, sf)
    got = counting.quantify(_blocks(spark, sf), e, adapters.objects(spark, sf), "exon", _weights(spark, sf))
    ids = e.select(F.col("name").alias("id"), F.col("gene_id")).distinct()
    return _rounded(ids.join(got.withColumnRenamed("id", "gene_id"), "gene_id", "left").select("id", F.coalesce("count", F.lit(0.0)).alias("count")), "count")


@query(sql("aln0 aln blk exon hit", ", tab AS (SELECT fragment_id, greatest(sum(CASE WHEN read_index = 1 THEN 1 ELSE 0 END), sum(CASE WHEN read_index = 2 THEN 1 ELSE 0 END)) AS n FROM aln GROUP BY 1) SELECT gene_id AS id, round(sum(1.0 / n), 6) AS count FROM (SELECT DISTINCT fragment_id, gene_id FROM hit WHERE ov >= 3) h JOIN tab USING (fragment_id) GROUP BY 1"))
def overlap_counts(spark, sf):
    return _rounded(counting.overlap_counts(_blocks(spark, sf), adapters.exons(spark, sf), adapters.objects(spark, sf), weights=_weights(spark, sf)), "count")


_JOIN = "SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, CAST(block_idx AS BIGINT) AS block_idx, exon_id, CAST(ov AS BIGINT) AS overlap FROM hit WHERE ov >= {n}"


def _join_query(least: int):
    def run(spark, sf):
        j = intervals.interval_join(_blocks(spark, sf), adapters.exons(spark, sf), least=least)
        return _long(j.select("fragment_id", "aln_no", "block_idx", "exon_id", "overlap"), "aln_no", "block_idx", "overlap")

    return run


query(sql("aln0 aln blk exon hit", _JOIN.format(n=1)), "interval_join")(_join_query(1))
query(sql("aln0 aln blk exon hit", _JOIN.format(n=5)), "interval_join_min_overlap")(_join_query(5))


# --- alignments ---------------------------------------------------------------------------------


@query(sql("aln0 aln blk", "SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, CAST(block_idx AS BIGINT) AS block_idx, CAST(last_block AS BIGINT) AS last_block, chrom, bs AS block_start, be AS block_end, al AS aligned_len FROM blk"))
def cigar_blocks(spark, sf):
    b = _blocks(spark, sf).select("fragment_id", "aln_no", "block_idx", "last_block", "chrom", F.col("start").alias("block_start"), F.col("end").alias("block_end"), "aligned_len")
    return _long(b, "aln_no", "block_idx", "last_block", "aligned_len")


@query(sql("aln0 aln", "SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, CASE WHEN spliced THEN len + len2 ELSE len END AS matching, CASE WHEN spliced THEN len + len2 ELSE len END AS read_len, CASE WHEN spliced THEN pos + len + gap + len2 - 1 ELSE pos + len - 1 END AS end_pos, CAST(spliced AS BIGINT) AS spliced FROM aln"))
def cigar_lengths(spark, sf):
    a = adapters.alignments(spark, sf).withColumn("ops", cigar.parse(F.col("cigar")))
    return _long(a.select("fragment_id", "aln_no", cigar.matching(F.col("ops")).alias("matching"), cigar.read_length(F.col("ops")).alias("read_len"), cigar.end_position(F.col("pos"), F.col("ops")).alias("end_pos"), cigar.is_spliced(F.col("cigar")).cast("int").alias("spliced")), "aln_no", "matching", "read_len", "spliced")


@query(sql("aln0 aln intron", "SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, chrom, s AS intron_start, e AS intron_end FROM intron"))
def introns(spark, sf):
    got = alignments.introns(adapters.alignments(spark, sf).select("fragment_id", "aln_no", "chrom", "pos", "cigar"))
    return _long(got.select("fragment_id", "aln_no", "chrom", F.col("start").alias("intron_start"), F.col("end").alias("intron_end")), "aln_no")


def _introns(spark, sf):
    return alignments.introns(adapters.alignments(spark, sf).select("fragment_id", "aln_no", "chrom", "pos", "cigar"))


@query(sql("aln0 aln intron", "SELECT chrom, s AS intron_start, e AS intron_end, count(DISTINCT fragment_id) AS support FROM intron GROUP BY 1, 2, 3"))
def intron_support(spark, sf):
    return junctions.intron_support(_introns(spark, sf)).select("chrom", F.col("start").alias("intron_start"), F.col("end").alias("intron_end"), "support")


@query(sql("aln0 aln intron", "SELECT fragment_id, count(DISTINCT chrom || ':' || CAST(s AS VARCHAR) || '-' || CAST(e AS VARCHAR)) AS n FROM intron GROUP BY 1"))
def fragment_junctions(spark, sf):
    return junctions.fragment_junctions(_introns(spark, sf))


_PAIRS = "pairs AS (SELECT i.fragment_id, i.chrom, i.s, i.e, l.exon_id AS left_exon, r.exon_id AS right_exon FROM intron i {how} JOIN exon l ON i.chrom = l.chrom AND l.ee + 1 = i.s {how} JOIN exon r ON i.chrom = r.chrom AND r.es - 1 = i.e)"


@query(sql("aln0 aln intron exon", ", " + _PAIRS.format(how="LEFT") + " SELECT fragment_id, chrom, s AS intron_start, e AS intron_end, coalesce(left_exon, 'unknown') AS left_exon, coalesce(right_exon, 'unknown') AS right_exon FROM pairs"))
def exon_pair_junctions(spark, sf):
    p = junctions.exon_pairs(_introns(spark, sf), adapters.exons(spark, sf), quantify=True)
    return p.select("fragment_id", "chrom", F.col("start").alias("intron_start"), F.col("end").alias("intron_end"), "left_exon", "right_exon")


@query(sql("aln0 aln intron exon", ", " + _PAIRS.format(how="LEFT") + ", m AS (SELECT chrom, s, e, max(CAST(left_exon IS NOT NULL AS INT) + CAST(right_exon IS NOT NULL AS INT)) AS matched FROM pairs GROUP BY 1, 2, 3) SELECT CAST(matched AS BIGINT) AS matched, count(*) AS gaps FROM m GROUP BY 1"))
def junction_match_tally(spark, sf):
    return _long(junctions.match_tally(junctions.exon_pairs(_introns(spark, sf), adapters.exons(spark, sf), quantify=True)), "matched")


@query(sql("aln0 aln intron exon", """, seen AS (SELECT DISTINCT l.exon_id AS left_exon FROM intron i JOIN exon l ON i.chrom = l.chrom AND l.ee + 1 = i.s)
, je AS (SELECT exon_id AS left_exon, gene_id AS junction_id FROM exon) SELECT exon_id, gene_id AS junction_id FROM exon WHERE gene_id IN (SELECT junction_id FROM je WHERE left_exon IN (SELECT left_exon FROM seen))"""))
def junction_map_filter(spark, sf):
    """Genes stand for junctions, an exon paired with itself for their exon pairs."""
    e = adapters.exons(spark, sf)
    seen = junctions.exon_pairs(_introns(spark, sf), e, quantify=True).where("left_exon <> 'unknown'").select("left_exon", F.col("left_exon").alias("right_exon"))
    je = e.select(F.col("exon_id").alias("left_exon"), F.col("exon_id").alias("right_exon"), F.col("gene_id").alias("junction_id"))
    return junctions.filter_maps(seen, je, e.select("exon_id", F.col("gene_id").alias("junction_id"))).select("exon_id", "junction_id")


@query("""WITH j AS (SELECT p_partkey AS k, 'g' || CAST(p_partkey AS VARCHAR) || '-junction-' AS head, list_concat(list_concat(CASE WHEN p_size % 2 = 0 THEN [1, 2] ELSE [2] END, [3, 4]), CASE WHEN p_size % 3 = 0 THEN [5] ELSE CAST([] AS INTEGER[]) END) AS c FROM part)
SELECT DISTINCT head || CAST(c[i] AS VARCHAR) || '-' || CAST(c[i + 1] AS VARCHAR) AS expanded FROM (SELECT head, c, unnest(range(1, len(c))) AS i FROM j)""")
def junction_id_expand(spark, sf):
    p, c = adapters.table(spark, sf, "part"), F.col
    ids = F.concat(F.lit("g"), c("p_partkey").cast("string"), F.lit("-junction-3-4:"), F.when(c("p_size") % 2 == 0, "1-2").otherwise("2"), F.when(c("p_size") % 3 == 0, ":5").otherwise(""))
    return junctions.expand_ids(p.select(ids.alias("junction_id"))).select("expanded")


@query(sql("aln0 aln", "SELECT a.fragment_id, CAST(a.aln_no AS BIGINT) AS aln_no, a.chrom, a.pos FROM aln a JOIN (SELECT DISTINCT fragment_id FROM aln WHERE spliced) s USING (fragment_id)"))
def spliced_fragments(spark, sf):
    a = adapters.alignments(spark, sf).withColumn("unit", F.lit(1))
    return _long(alignments.spliced_fragments(a, unit="unit").select("fragment_id", "aln_no", "chrom", "pos"), "aln_no")


_MATES = "m AS (SELECT l_orderkey AS fragment_id, l_partkey * 20 AS pos, l_suppkey AS other, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS k FROM lineitem)"


@query(f"WITH {_MATES} SELECT fragment_id, CAST(k AS BIGINT) AS first_row, CAST(k + 1 AS BIGINT) AS second_row FROM m WHERE k % 2 = 1 AND EXISTS (SELECT 1 FROM m n WHERE n.fragment_id = m.fragment_id AND n.k = m.k + 1)")
def mate_pairs(spark, sf):
    """Neighbouring lines of an order as mates that point at each other."""
    from pyspark.sql import Window

    li, c = adapters.table(spark, sf, "lineitem"), F.col
    of = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    rows = li.select(c("l_orderkey").alias("fragment_id"), F.row_number().over(of).alias("row_no"), c("l_partkey").alias("p"), F.lead("l_partkey").over(of).alias("after"), F.lag("l_partkey").over(of).alias("before"))
    odd, unit = c("row_no") % 2 == 1, F.floor((c("row_no") - 1) / 2)
    rows = rows.select("fragment_id", "row_no", F.concat_ws(":", c("fragment_id").cast("string"), unit.cast("string")).alias("query_name"), F.lit("chr1").alias("ref"), (c("p") * 20).alias("pos"), F.lit("chr1").alias("mate_ref"), (F.when(odd, c("after")).otherwise(c("before")) * 20).alias("mate_pos"), F.when(odd, 1).otherwise(2).alias("read_index"), F.lit(None).cast("int").alias("HI"))
    return _long(alignments.mate_pairs(rows).select("fragment_id", F.col("first").alias("first_row"), F.col("second").alias("second_row")), "first_row", "second_row")


@query("SELECT o_orderkey AS k, CAST(o_custkey % 4096 AS BIGINT) AS flag, CAST((o_custkey % 4096) & 1 <> 0 AS BIGINT) AS paired, CAST((o_custkey % 4096) & 16 <> 0 AS BIGINT) AS reverse, CAST((o_custkey % 4096) & 256 <> 0 AS BIGINT) AS secondary, CAST(CASE WHEN (o_custkey % 4096) & 1 <> 0 AND (o_custkey % 4096) & 64 <> 0 THEN 1 WHEN (o_custkey % 4096) & 1 <> 0 AND (o_custkey % 4096) & 128 <> 0 THEN 2 ELSE 1 END AS BIGINT) AS read_index FROM orders")
def flag_decode(spark, sf):
    o = adapters.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 4096).cast("int").alias("flag"))
    bit = lambda n: flags.has(F.col("flag"), n).cast("long").alias(n)
    return o.select("k", F.col("flag").cast("long").alias("flag"), bit("paired"), bit("reverse"), bit("secondary"), flags.read_index(F.col("flag"), F.lit("read")).cast("long").alias("read_index"))


# --- weights and sets ---------------------------------------------------------------------------

_W = "w{k} AS (SELECT fragment_id, greatest(sum(CASE WHEN read_index = 1 THEN 1 ELSE 0 END), sum(CASE WHEN read_index = 2 THEN 1 ELSE 0 END)) AS n, sum(nm) AS e, count(DISTINCT read_index) AS m FROM aln0 {where} GROUP BY 1)"
_BOTH = ", " + _W.format(k=1, where="WHERE l_linestatus = 'F'") + ", " + _W.format(k=2, where="WHERE l_linestatus = 'O'") + """
, b AS (SELECT coalesce(w1.fragment_id, w2.fragment_id) AS fragment_id, w1.n AS n1, w1.e AS e1, w1.m AS m1, w2.n AS n2, w2.e AS e2, w2.m AS m2 FROM w1 FULL OUTER JOIN w2 ON w1.fragment_id = w2.fragment_id)"""


def _edit_rule(a: int, b: int) -> str:
    return f"CASE WHEN n{b} IS NULL THEN {a} WHEN n{a} IS NULL THEN {b} WHEN m{a} > m{b} THEN {a} WHEN m{b} > m{a} THEN {b} WHEN (1.0 * e{b} / n{b} <= 1.0 * e{a} / n{a} AND n{b} > 1.1 * n{a}) OR 1.0 * e{b} / n{b} < 1.0 * e{a} / n{a} - 0.25 THEN {b} ELSE {a} END"


@query(sql("aln0", ", " + _W.format(k="", where="") + " SELECT fragment_id, CAST(n AS BIGINT) AS num_alignments, CAST(e AS BIGINT) AS sum_edit_distance, CASE WHEN m = 2 THEN 'single-read (both)' ELSE 'single-read' END AS kind FROM w"))
def read_weights_sam(spark, sf):
    return _long(weights.summarize(adapters.alignments(spark, sf)), "num_alignments", "sum_edit_distance")


@query(sql("aln0 aln blk exon hit", "").rstrip() + ",\n" + _FORM.format(stranded="") + " SELECT fragment_id, n FROM num")
def read_weights_bed(spark, sf):
    hits = counting.distinct_alignments(intervals.interval_join(_blocks(spark, sf), adapters.exons(spark, sf)))
    return _long(counting.alignment_numbers(hits), "n")


def _two(spark, sf):
    return adapters.alignments(spark, sf, "F"), adapters.alignments(spark, sf, "O")


_PICK = "SELECT fragment_id, CAST(CASE WHEN side = 1 THEN n1 ELSE n2 END AS BIGINT) AS num_alignments, CAST(CASE WHEN side = 1 THEN e1 ELSE e2 END AS BIGINT) AS sum_edit_distance FROM (SELECT *, {rule} AS side FROM b)"


def _combine_weights(edits: bool):
    def run(spark, sf):
        one, two = (weights.summarize(t) for t in _two(spark, sf))
        return _long(weights.combine_tables(one, two, edits=edits).select("fragment_id", "num_alignments", "sum_edit_distance"), "num_alignments", "sum_edit_distance")

    return run


query(sql("aln0", _BOTH + _PICK.format(rule="CASE WHEN n2 IS NULL THEN 1 WHEN n1 IS NULL THEN 2 WHEN n2 > n1 THEN 2 ELSE 1 END")), "combine_weights_n")(_combine_weights(False))
query(sql("aln0", _BOTH + _PICK.format(rule=_edit_rule(1, 2))), "combine_weights_edit")(_combine_weights(True))


@query(sql("aln0", _BOTH + f""", s AS (SELECT *, {_edit_rule(1, 2)} AS side FROM b),
r AS (SELECT fragment_id, l_linestatus, min(read_index) AS lo, max(read_index) AS hi FROM aln0 GROUP BY 1, 2),
p AS (SELECT s.fragment_id, side, w.lo AS lo, w.hi AS hi, n1 IS NOT NULL AND n2 IS NOT NULL AS two FROM s JOIN r w ON s.fragment_id = w.fragment_id AND w.l_linestatus = CASE WHEN side = 1 THEN 'F' ELSE 'O' END)
SELECT a.fragment_id, CAST(a.aln_no AS BIGINT) AS aln_no, CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS source FROM aln0 a JOIN p ON a.fragment_id = p.fragment_id
WHERE (l_linestatus = 'F') = (side = 1) OR (two AND lo = hi AND a.read_index <> lo)"""))
def combine_alignments(spark, sf):
    return _long(combine.combine(*_two(spark, sf)).select("fragment_id", "aln_no", "source"), "aln_no", "source")


@query(sql("aln0", _BOTH + f", s AS (SELECT *, {_edit_rule(2, 1)} AS side FROM b) SELECT a.fragment_id, CAST(a.aln_no AS BIGINT) AS aln_no FROM aln0 a JOIN s ON a.fragment_id = s.fragment_id WHERE l_linestatus = 'F' AND side = 1"))
def subtract_alignments(spark, sf):
    return _long(combine.subtract(*_two(spark, sf)).select("fragment_id", "aln_no"), "aln_no")


@query(sql("aln0", "SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS source FROM aln0 WHERE l_linestatus = 'F' OR fragment_id NOT IN (SELECT fragment_id FROM aln0 WHERE l_linestatus = 'F')"))
def merge_alignments(spark, sf):
    return _long(combine.merge_first(*_two(spark, sf)).select("fragment_id", "aln_no", "source"), "aln_no", "source")


@query(sql("aln0", """, c AS (SELECT *, pos + CASE WHEN spliced THEN len + gap + len2 ELSE len END - 1 AS e FROM aln0),
o AS (SELECT d.fragment_id, d.aln_no, d.read_index FROM c d JOIN c f ON f.l_linestatus = 'F' AND d.l_linestatus = 'O' AND d.fragment_id = f.fragment_id AND d.read_index = f.read_index AND d.chrom = f.chrom
 WHERE greatest(0, least(d.e, f.e) - greatest(d.pos, f.pos) + 1) >= 0.93 * (d.e - d.pos + 1) OR (greatest(0, least(d.e, f.e) - greatest(d.pos, f.pos) + 1) >= 0.3 * (d.e - d.pos + 1) AND abs(d.pos - f.pos) <= 0.3 * (d.e - d.pos + 1) AND abs(d.e - f.e) <= 0.3 * (d.e - d.pos + 1)))
SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no FROM c WHERE l_linestatus = 'O' AND NOT EXISTS (SELECT 1 FROM o WHERE o.fragment_id = c.fragment_id AND o.aln_no = c.aln_no)"""))
def near_duplicate_pairs(spark, sf):
    one, two = (t.select("fragment_id", "read_index", "chrom", F.col("pos").alias("start"), cigar.end_position(F.col("pos"), cigar.parse(F.col("cigar"))).alias("end"), F.col("aln_no").alias("hit")) for t in _two(spark, sf))
    return combine.near_duplicates(one, two).select("fragment_id", F.col("hit").cast("long").alias("aln_no"))


# --- gene counts from transcripts ---------------------------------------------------------------

_TG = "tg AS (SELECT DISTINCT o.l_orderkey AS fragment_id, p_brand AS gene_id FROM lineitem o JOIN part ON l_partkey = p_partkey), g AS (SELECT fragment_id, count(*) AS n_genes FROM tg GROUP BY 1)"


def _transcripts(spark, sf):
    a = adapters.table(spark, sf, "lineitem")
    rows = a.select(F.col("l_orderkey").alias("fragment_id"), F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("ref"), (F.col("l_suppkey") % 37 + 1).alias("start"), (F.col("l_suppkey") % 37 + F.col("l_quantity")).cast("long").alias("end"), F.xxhash64("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("aln_no"))
    p = adapters.table(spark, sf, "part").select(F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("transcript_id"), F.col("p_brand").alias("gene_id"))
    return rows, p


@query(f"WITH {_TG} SELECT gene_id AS id, CAST(count(*) AS DOUBLE) AS count FROM tg GROUP BY 1")
def sam_gene_counts(spark, sf):
    rows, p = _transcripts(spark, sf)
    return sam_counts.gene_counts(sam_counts.fragment_genes(rows, p))


@query(f"WITH {_TG} SELECT gene_id AS id, CAST(count(*) AS DOUBLE) AS count FROM tg JOIN g USING (fragment_id) WHERE n_genes = 1 GROUP BY 1")
def sam_gene_counts_unambiguous(spark, sf):
    rows, p = _transcripts(spark, sf)
    return sam_counts.gene_counts(sam_counts.fragment_genes(rows, p), unambiguous=True)


@query("WITH tg AS (SELECT DISTINCT l_orderkey AS fragment_id, p_brand AS gene_id FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey % 37 + 1 <= greatest(20 - 3 + 1, 1) AND l_suppkey % 37 + CAST(l_quantity AS BIGINT) >= 20 + 3) SELECT gene_id AS id, CAST(count(*) AS DOUBLE) AS count FROM tg GROUP BY 1")
def sam_gene_counts_window(spark, sf):
    rows, p = _transcripts(spark, sf)
    return sam_counts.gene_counts(sam_counts.fragment_genes(rows, p.withColumn("position", F.lit(20)), window=3))


@query(f"WITH {_TG} SELECT fragment_id, n_genes, round(1.0 / n_genes, 6) AS weight FROM g")
def gene_multiplicity_weights(spark, sf):
    rows, p = _transcripts(spark, sf)
    return _rounded(weights.gene_multiplicity(sam_counts.fragment_genes(rows, p)), "weight")


_STARTS = "st AS (SELECT 't' || CAST(l_partkey AS VARCHAR) AS id, count(DISTINCT l_suppkey % 37) AS n_starts, min(l_suppkey % 37 + 1) AS min_start, count(*) AS n FROM lineitem GROUP BY 1)"


@query(f"WITH {_STARTS} SELECT id, n_starts, min_start FROM st")
def start_positions(spark, sf):
    return sam_counts.start_positions(_transcripts(spark, sf)[0]).select("id", "n_starts", "min_start")


def _estimates(spark, sf):
    rows, _ = _transcripts(spark, sf)
    n = rows.groupBy(F.col("ref").alias("id")).agg(F.count("*").alias("count"))
    return sam_counts.start_estimates(sam_counts.start_positions(rows), n, n.select("id", F.lit(37).cast("long").alias("length")))


@query(f"""WITH {_STARTS}, m AS (SELECT unnest(range(1, 38)) AS m)
SELECT id, CAST(CASE WHEN n_starts >= n THEN n_starts ELSE coalesce((SELECT min(m) FROM m WHERE m >= n_starts AND m * (1 - pow(1 - 1.0 / m, n)) >= n_starts), 37) END AS BIGINT) AS effective_length FROM st""")
def effective_length(spark, sf):
    return _estimates(spark, sf).select("id", "effective_length")


@query(f"WITH {_STARTS} SELECT id, CAST(greatest(1, min_start - greatest(0, floor((37 - min_start + 1) / CAST(n AS DOUBLE) + 0.5) - 1)) AS BIGINT) AS estimated_start FROM st")
def min_start_estimate(spark, sf):
    return _estimates(spark, sf).select("id", "estimated_start")


# --- tables -------------------------------------------------------------------------------------

_SAMPLES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("SELECT l_partkey AS id, CAST(sum(l_quantity) AS DOUBLE) AS count FROM lineitem GROUP BY 1")
def chunk_sum(spark, sf):
    li = adapters.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_quantity").alias("count"), "l_linestatus")
    part = lambda s: li.where(F.col("l_linestatus") == s).groupBy("id").agg(F.sum("count").alias("count"))
    return tables.chunk_sum([part("F"), part("O")])


@query(sql("counts", "SELECT id, " + ", ".join(f"coalesce(sum(CASE WHEN sample = '{s}' THEN count END), 0.0) AS s{i}" for i, s in enumerate(_SAMPLES)) + " FROM counts GROUP BY 1"))
def sample_matrix(spark, sf):
    m = tables.sample_matrix(adapters.sample_counts(spark, sf), _SAMPLES)
    return m.select("id", *[F.col(f"`{s}`").alias(f"s{i}") for i, s in enumerate(_SAMPLES)])


def _lengths(spark, sf):
    return adapters.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 4 + 1).cast("long").alias("length"))


_FPKM = ", n AS (SELECT sample, sum(count) AS reads FROM counts GROUP BY 1), f AS (SELECT c.id, c.sample, c.count / ((p_size * 4 + 1) / 1000.0) / (reads / 1e6) AS fpkm FROM counts c JOIN n ON c.sample = n.sample JOIN part ON p_partkey = c.id)"


@query(sql("counts", _FPKM + " SELECT id, sample, round(fpkm, 6) AS fpkm FROM f"))
def fpkm(spark, sf):
    return _rounded(tables.fpkm(adapters.sample_counts(spark, sf), _lengths(spark, sf)), "fpkm")


@query(sql("counts", _FPKM + " SELECT id, round(sum(fpkm) / 2, 6) AS fpkm FROM f WHERE sample IN ('1-URGENT', '5-LOW') GROUP BY 1"))
def control_mean_fpkm(spark, sf):
    v = tables.fpkm(adapters.sample_counts(spark, sf), _lengths(spark, sf))
    return _rounded(tables.control_mean(v, _SAMPLES, ["1-URGENT", "5-LOW"]), "fpkm")


_ISLAND = """, x AS (SELECT *, max(ee) OVER (PARTITION BY gene_id, chrom{strand} ORDER BY es, ee ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM exon),
y AS (SELECT *, sum(CASE WHEN before IS NULL OR es > before + {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY gene_id, chrom{strand} ORDER BY es, ee ROWS UNBOUNDED PRECEDING) AS k FROM x),
z AS (SELECT gene_id, chrom{strand}, k, min(es) AS s, max(ee) AS e, count(*) AS n FROM y GROUP BY ALL)"""


@query(sql("exon", _ISLAND.format(strand="", gap=0) + ", l AS (SELECT gene_id, chrom, sum(e - s + 1) AS n FROM z GROUP BY 1, 2) SELECT gene_id, CAST(max(n) AS BIGINT) AS length FROM l GROUP BY 1"))
def interval_union_length(spark, sf):
    return intervals.union_length(adapters.exons(spark, sf), ["gene_id"])


@query(sql("exon", _ISLAND.format(strand=", estrand", gap=1) + " SELECT gene_id, chrom, estrand AS strand, s AS exon_start, e AS exon_end, n FROM z"))
def merged_exons(spark, sf):
    m = intervals.combined_exons(adapters.exons(spark, sf))
    return m.select("gene_id", "chrom", "strand", F.col("start").alias("exon_start"), F.col("end").alias("exon_end"), "n")


def _filter(invert: bool):
    def run(spark, sf):
        rows = adapters.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        other = adapters.table(spark, sf, "customer").where("c_nationkey < 5").select("c_custkey", F.concat("c_mktsegment", F.lit(":x")).alias("seg"))
        return tables.key_filter(rows, other, ["o_custkey"], ["c_custkey"], invert)

    return run


query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)", "semi_filter")(_filter(False))
query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)", "anti_filter")(_filter(True))


@query("SELECT event_id, event_type, user_id FROM events WHERE split_part(event_type || '_x', '_', 1) IN (SELECT split_part(lower(o_orderpriority) || '_y', '_', 1) FROM orders UNION SELECT split_part(event_type, '_', 1) FROM events WHERE user_id < 10)")
def composite_key_filter(spark, sf):
    """Keys are cut at a sub-separator on both sides."""
    e = adapters.table(spark, sf, "events")
    rows = e.select("event_id", "event_type", "user_id").withColumn("key", F.concat("event_type", F.lit("_x")))
    other = adapters.table(spark, sf, "orders").select(F.concat(F.lower("o_orderpriority"), F.lit("_y")).alias("k")).unionByName(e.where("user_id < 10").select(F.col("event_type").alias("k")))
    return tables.key_filter(rows, other, ["key"], ["k"], sub_separator="_").drop("key")


@query("SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def distinct_lines(spark, sf):
    return tables.distinct_lines(adapters.table(spark, sf, "events"), ["event_type", "user_id"], "event_id").select("event_type", "user_id", "event_id")


@query("SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) AS BIGINT) AS chunk FROM orders")
def chunk_numbers(spark, sf):
    return tables.chunk_numbers(adapters.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 1000)


# --- reads --------------------------------------------------------------------------------------

_HOMO = "bad AS (SELECT DISTINCT fragment_id FROM reads WHERE length(replace(seq, 'A', '')) < 5 OR length(replace(seq, 'T', '')) < 5), kept AS (SELECT * FROM reads WHERE fragment_id NOT IN (SELECT fragment_id FROM bad))"


@query(sql("reads", f", {_HOMO} SELECT fragment_id, CAST(read_index AS BIGINT) AS read_index, seq FROM kept"))
def homopolymer_filter(spark, sf):
    return _long(reads.homopolymer_filter(adapters.reads(spark, sf)).select("fragment_id", "read_index", "seq"), "read_index")


@query(sql("reads", f", {_HOMO}, ids AS (SELECT fragment_id, row_number() OVER (ORDER BY fragment_id) AS k FROM (SELECT DISTINCT fragment_id FROM kept)) SELECT fragment_id, 'F' || lpad(CAST(k AS VARCHAR), 9, '0') || '/' || CAST(read_index AS VARCHAR) AS new_id, '-C' || lpad(CAST(CAST(floor((k - 1) / 100) AS BIGINT) AS VARCHAR), 3, '0') AS chunk FROM kept JOIN ids USING (fragment_id)"))
def fastq_renumber(spark, sf):
    return reads.renumber(adapters.reads(spark, sf), chunk_size=100).select("fragment_id", "new_id", "chunk")


@query(sql("reads", "SELECT fragment_id, CAST(read_index AS BIGINT) AS read_index, substring(seq, 1, 50) AS seq FROM reads"))
def fastq_shorten(spark, sf):
    return _long(reads.shorten(adapters.reads(spark, sf), 50), "read_index")


@query(sql("reads", ", t AS (SELECT fragment_id, read_index, seq, unnest(range(0, length(seq) - 20, 5)) AS s FROM reads) SELECT fragment_id, CAST(read_index AS BIGINT) AS read_index, CAST(s AS BIGINT) AS start, substring(seq, CAST(s AS BIGINT) + 1, 20) AS seq, CAST(fragment_id AS VARCHAR) || '-' || CAST(s AS VARCHAR) || '/' || CAST(read_index AS VARCHAR) AS tile_id FROM t"))
def fastq_tiles(spark, sf):
    return _long(reads.tile(adapters.reads(spark, sf), 20, 5), "read_index", "start")


@query(sql("reads", "SELECT fragment_id, CAST(read_index AS BIGINT) AS read_index FROM reads WHERE fragment_id NOT IN (SELECT l_orderkey FROM lineitem)"))
def unaligned_reads(spark, sf):
    w = adapters.alignments(spark, sf).select("fragment_id")
    return _long(reads.unaligned(adapters.reads(spark, sf), w).select("fragment_id", "read_index"), "read_index")


@query(sql("reads", "SELECT seq, count(*) AS multiplicity FROM reads GROUP BY 1 HAVING count(*) >= 2"))
def duplicate_reads(spark, sf):
    return reads.duplicates(adapters.reads(spark, sf))


@query(sql("reads", ", f AS (SELECT fragment_id, string_agg(CAST(read_index AS VARCHAR) || ':' || seq, '/' ORDER BY read_index) AS own FROM reads GROUP BY 1), t AS (SELECT own, count(*) AS multiplicity, min(fragment_id) AS least FROM f GROUP BY 1) SELECT reads.fragment_id, CAST(read_index AS BIGINT) AS read_index, multiplicity, reads.fragment_id = least AS first FROM reads JOIN f ON f.fragment_id = reads.fragment_id JOIN t ON t.own = f.own"))
def read_multiplicity(spark, sf):
    return _long(reads.with_multiplicity(adapters.reads(spark, sf)).select("fragment_id", "read_index", "multiplicity", "first"), "read_index")


@query(sql("reads", "SELECT fragment_id, CAST(read_index AS BIGINT) AS read_index, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM reads"))
def reverse_complement(spark, sf):
    return _long(adapters.reads(spark, sf).select("fragment_id", "read_index", sequence.reverse_complement(F.col("seq")).alias("rc")), "read_index")


# --- statistics ---------------------------------------------------------------------------------


@query(sql("aln0 aln", ", t AS (SELECT fragment_id, greatest(sum(CASE WHEN read_index = 1 THEN 1 ELSE 0 END), sum(CASE WHEN read_index = 2 THEN 1 ELSE 0 END)) AS n FROM aln GROUP BY 1) SELECT floor(CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) * 10000 / CAST(sum(CASE WHEN n <> 0 THEN 1 ELSE 0 END) AS BIGINT)) / 100 AS percent FROM t"))
def unique_fraction(spark, sf):
    return stats.unique_fraction(_weights(spark, sf))


@query("""WITH r AS (SELECT o_orderpriority AS sample, count(*) AS reads, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS mapped, sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS expressed FROM orders GROUP BY 1)
SELECT sample, reads, CAST(mapped AS BIGINT) AS mapped, CAST(expressed AS BIGINT) AS expressed, CAST(floor(100.0 * mapped / reads) AS BIGINT) AS mapped_percent, CAST(floor(100.0 * expressed / reads) AS BIGINT) AS expressed_percent FROM r""")
def read_percentages(spark, sf):
    o = adapters.table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "sample")
    n = lambda c, name: o.where(c).groupBy("sample").agg(F.count("*").alias(name))
    return _long(stats.read_percentages(n("true", "reads"), n("o_orderstatus = 'F'", "mapped"), n("o_totalprice > 200000", "expressed")), "mapped_percent", "expressed_percent")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def latest_per_chunk(spark, sf):
    e = adapters.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return stats.latest(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id AS sample, 'K' || CAST(event_id % 3 AS VARCHAR) AS name, count(DISTINCT event_type) AS n FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) > 1")
def parameter_consistency(spark, sf):
    e = adapters.table(spark, sf, "events")
    lines = e.select(F.col("user_id").alias("sample"), F.concat(F.lit("K"), (F.col("event_id") % 3).cast("string"), F.lit("="), "event_type").alias("line"))
    return stats.inconsistent_parameters(stats.log_parameters(lines, ["sample"]))


@query("SELECT user_id AS sample, " + ", ".join(f"CAST(coalesce(sum(CASE WHEN event_id % 3 = {i} THEN 1 END), 0) AS BIGINT) AS k{i}" for i in range(3)) + " FROM events GROUP BY 1")
def keyword_totals(spark, sf):
    e = adapters.table(spark, sf, "events")
    rows = e.select(F.col("user_id").alias("sample"), F.concat(F.lit("k"), (F.col("event_id") % 3).cast("string")).alias("keyword"), F.lit(1).cast("long").alias("count"))
    return stats.keyword_totals(rows, ["k0", "k1", "k2"])


@query("SELECT o_orderpriority AS sample, count(DISTINCT o_custkey) AS aligned FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def aligned_numbers(spark, sf):
    o = adapters.table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    return stats.aligned_numbers(o.select(F.col("o_orderpriority").alias("sample"), F.col("o_custkey").alias("query_name")), ["sample"])


@query("SELECT count(*) AS reads, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS mapped_reads, count(DISTINCT l_orderkey) AS fragments, count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END) AS mapped_fragments FROM lineitem")
def running_totals(spark, sf):
    li = adapters.table(spark, sf, "lineitem")
    return stats.running_totals(li.select(F.col("l_orderkey").alias("fragment_id"), (F.col("l_linestatus") == "F").alias("mapped"))).drop("read_percent", "fragment_percent")


@query(_count_sql("gene", tail="SELECT (SELECT count(DISTINCT fragment_id) FROM hit) AS seen, (SELECT count(DISTINCT fragment_id) FROM per) AS counted, (SELECT count(DISTINCT fragment_id) FROM hit) - (SELECT count(DISTINCT fragment_id) FROM per) AS excluded, (SELECT round(CAST(sum(c) AS DOUBLE), 6) FROM per) AS total"))
def count_bookkeeping(spark, sf):
    hits = counting.fragment_hits(_blocks(spark, sf), adapters.exons(spark, sf), adapters.objects(spark, sf))
    found = counting.qualified(counting.with_numbers(hits), counting.MODES["gene"], carry=("n",))
    per = counting.fragment_counts(counting.with_weights(found, _weights(spark, sf)))
    return _rounded(counting.bookkeeping(hits, per), "total")


@query(sql("exon", "SELECT exon_id, chrom, es AS exon_start, ee AS exon_end, estrand AS strand FROM exon"))
def exon_id_parse(spark, sf):
    e = adapters.exons(spark, sf).select("exon_id", names.parse_exon(F.col("exon_id")).alias("p"))
    return e.select("exon_id", "p.chrom", F.col("p.start").alias("exon_start"), F.col("p.end").alias("exon_end"), "p.strand")


@query(sql("aln0 aln blk exon hit", "SELECT DISTINCT chrom || chr(9) || CAST(bs - 1 AS VARCHAR) || chr(9) || CAST(be AS VARCHAR) || chr(9) || CAST(fragment_id AS VARCHAR) || chr(9) || '0' || chr(9) || strand || chr(9) || chrom || chr(9) || CAST(es - 1 AS VARCHAR) || chr(9) || CAST(ee AS VARCHAR) || chr(9) || exon_id || chr(9) || '0' || chr(9) || estrand || chr(9) || CAST(ov AS VARCHAR) AS line FROM hit"))
def genomic_bed(spark, sf):
    return projection.genomic_bed(intervals.interval_join(_blocks(spark, sf), adapters.exons(spark, sf)))


def entry(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: weighted gene counts of all fragments, every gene listed."""
    objects = adapters.objects(spark, sf)
    got = counting.quantify(_blocks(spark, sf), adapters.exons(spark, sf), objects, "gene", _weights(spark, sf))
    return writers.count_table(got, objects)


