"""Further queries over the supplied tables: mates, reads on several references, single functions, text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions import cigar, flags, names
from readloom.functions.intervals import blocks_overlap, distance
from readloom.operators import alignments, combine, counting, intervals, junctions, projection, sam_counts, tables, weights
from readloom.plans import adapters, genome_counts, references
from readloom.plans.adapters import sql
from readloom.plans.catalog import _SPLICE, _TG, _count_sql, _long, _rounded, _transcripts, query
from readloom.sources import readers, settled, writers

# --- mates --------------------------------------------------------------------------------------


def _pair_count_sql(mode: str, unambiguous: bool = False, column: str = "gene_id") -> str:
    m = counting.MODES[mode]
    ok = _SPLICE if m.splice else "TRUE"
    need = {"all": "max(last_block) + 1"}.get(m.required, str(m.required))
    good = f"ok0 AS (SELECT * FROM h2 WHERE {ok} AND ov >= least({m.overlap}, ee - es + 1))"
    if unambiguous and m.ambiguity == "block":
        good += ", ok AS (SELECT o.* FROM ok0 o JOIN (SELECT fragment_id, first, side, read_index, block_idx FROM ok0 GROUP BY ALL HAVING count(DISTINCT exon_id) = 1) u USING (fragment_id, first, side, read_index, block_idx))"
    else:
        good += ", ok AS (SELECT * FROM ok0)"
    both = "HAVING side <> 'p' OR count(DISTINCT read_index) = 2" if m.mates == "intersection" else ""
    one = "JOIN (SELECT fragment_id FROM obj0 GROUP BY 1 HAVING count(DISTINCT object_id) = 1) u USING (fragment_id)" if unambiguous and m.ambiguity == "fragment" else ""
    return sql("aln0 alnp blkp exon hit", "").rstrip() + f""",
form AS (SELECT fragment_id, aln_no, side, CAST(list_sort(list(DISTINCT CAST(read_index AS VARCHAR) || '@' || CAST(block_idx AS VARCHAR) || '@' || chrom || '/' || CAST(bs AS VARCHAR) || '/' || CAST(be AS VARCHAR) || '/' || strand)) AS VARCHAR) AS form FROM hit GROUP BY 1, 2, 3),
first AS (SELECT *, min(aln_no) OVER (PARTITION BY fragment_id, side, form) AS first FROM form),
h2 AS (SELECT h.*, f.first FROM hit h JOIN first f USING (fragment_id, aln_no, side)),
num AS (SELECT fragment_id, greatest(count(DISTINCT CASE WHEN side <> 'r2' THEN side || form END), count(DISTINCT CASE WHEN side = 'r2' THEN form END)) AS n FROM form GROUP BY 1),
{_PAIR_WEIGHTS},
{good},
objr AS (SELECT fragment_id, first, side, read_index, {column} AS object_id FROM ok GROUP BY ALL HAVING count(DISTINCT block_idx) >= {need}),
obj0 AS (SELECT fragment_id, first, side, object_id FROM objr GROUP BY ALL {both}), obj AS (SELECT obj0.* FROM obj0 {one}),
wgt AS (SELECT n.fragment_id, CAST(least(1.0 / t.n, 1.0 / n.n) AS DOUBLE) AS w FROM num n JOIN wp t ON n.fragment_id = t.fragment_id),
per AS (SELECT fragment_id, object_id, least(1.0, greatest(coalesce(sum(CASE WHEN side <> 'r2' THEN w END), 0), coalesce(sum(CASE WHEN side = 'r2' THEN w END), 0))) AS c FROM obj JOIN wgt USING (fragment_id) WHERE w >= 0.01 GROUP BY 1, 2)
SELECT object_id AS id, round(CAST(sum(c) AS DOUBLE), 6) AS count FROM per GROUP BY 1"""


_PAIR_WEIGHTS = """wp AS (SELECT fragment_id, count(DISTINCT CASE WHEN paired THEN aln_no END) + greatest(count(DISTINCT CASE WHEN NOT paired AND read_index = 1 THEN aln_no END), count(DISTINCT CASE WHEN NOT paired AND read_index = 2 THEN aln_no END)) AS n, sum(nm) AS e,
 CASE WHEN bool_or(paired) THEN 'paired-end' WHEN count(DISTINCT read_index) = 2 THEN 'single-read (both)' ELSE 'single-read' END AS kind FROM alnp GROUP BY 1)"""


def _pair_count(mode: str, column: str = "gene_id", **options):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        a = adapters.paired_alignments(spark, sf)
        w = weights.summarize(a).select("fragment_id", F.col("num_alignments").alias("n"))
        return _rounded(counting.quantify(alignments.blocks(a), adapters.exons(spark, sf), adapters.objects(spark, sf, column), mode, w, **options), "count")

    return run


query(_pair_count_sql("gene"), "gene_counts_paired")(_pair_count("gene"))
query(_pair_count_sql("exon", column="exon_id"), "exon_counts_paired")(_pair_count("exon", "exon_id"))
query(_pair_count_sql("junction"), "junction_counts_paired")(_pair_count("junction"))
query(_pair_count_sql("gene", unambiguous=True), "gene_counts_paired_unambiguous")(_pair_count("gene", unambiguous=True))
query(_pair_count_sql("exon", unambiguous=True, column="exon_id"), "exon_counts_paired_unambiguous")(_pair_count("exon", "exon_id", unambiguous=True))


@query(sql("aln0 alnp", f", {_PAIR_WEIGHTS} SELECT fragment_id, CAST(n AS BIGINT) AS num_alignments, CAST(e AS BIGINT) AS sum_edit_distance, kind FROM wp"))
def read_weights_paired(spark, sf):
    return _long(weights.summarize(adapters.paired_alignments(spark, sf)), "num_alignments", "sum_edit_distance")


def _two(spark, sf):
    return adapters.paired_alignments(spark, sf, "F"), adapters.paired_alignments(spark, sf, "O")


_SIDES = "w{k} AS (SELECT fragment_id, count(DISTINCT CASE WHEN paired THEN aln_no END) + greatest(count(DISTINCT CASE WHEN NOT paired AND read_index = 1 THEN aln_no END), count(DISTINCT CASE WHEN NOT paired AND read_index = 2 THEN aln_no END)) AS n, sum(nm) AS e, CASE WHEN bool_or(paired) THEN 3 WHEN count(DISTINCT read_index) = 2 THEN 2 ELSE 1 END AS m FROM alnp WHERE l_linestatus = '{s}' GROUP BY 1)"
_BOTH = f", {_SIDES.format(k=1, s='F')}, {_SIDES.format(k=2, s='O')}, b0 AS (SELECT coalesce(w1.fragment_id, w2.fragment_id) AS fragment_id, w1.n AS n1, w1.e AS e1, w1.m AS m1, w2.n AS n2, w2.e AS e2, w2.m AS m2 FROM w1 FULL OUTER JOIN w2 ON w1.fragment_id = w2.fragment_id)"
_RULE = "CASE WHEN n1 IS NULL AND n2 IS NULL THEN NULL WHEN n2 IS NULL THEN 1 WHEN n1 IS NULL THEN 2 WHEN m1 > m2 THEN 1 WHEN m2 > m1 THEN 2 WHEN (1.0 * e2 / n2 <= 1.0 * e1 / n1 AND n2 > 1.1 * n1) OR 1.0 * e2 / n2 < 1.0 * e1 / n1 - CASE WHEN m1 = 3 THEN 0.5 ELSE 0.25 END THEN 2 ELSE 1 END"
_TAKE = f"""b2 AS (SELECT *, {_RULE} AS side, greatest(coalesce(m1, 0), coalesce(m2, 0)) = 3 AS pairs FROM b),
rd AS (SELECT fragment_id, l_linestatus, min(read_index) AS lo, max(read_index) AS hi FROM alnp GROUP BY 1, 2),
p AS (SELECT b2.*, rd.lo, rd.hi FROM b2 JOIN rd ON rd.fragment_id = b2.fragment_id AND rd.l_linestatus = CASE WHEN side = 1 THEN 'F' ELSE 'O' END WHERE side IS NOT NULL)
SELECT a.fragment_id, CAST(a.row_no AS BIGINT) AS row_no, CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS source FROM alnp a JOIN p ON a.fragment_id = p.fragment_id
WHERE (l_linestatus = 'F') = (side = 1) OR (NOT pairs AND n1 IS NOT NULL AND n2 IS NOT NULL AND lo = hi AND a.read_index <> lo)"""


@query(sql("aln0 alnps", f"{_BOTH}, b AS (SELECT * FROM b0), {_TAKE}"))
def combine_alignments_paired(spark, sf):
    return _long(combine.combine(*_two(spark, sf)).select("fragment_id", "row_no", "source"), "row_no", "source")


_FAR = ", ".join(f"CASE WHEN NOT (1.0 * e{k} / n{k} / CASE WHEN m{k} = 3 THEN 2 ELSE 1 END > 4) THEN {c}{k} END AS {c}{k}" for k in (1, 2) for c in "nem")


@query(sql("aln0 alnps", f"{_BOTH}, b AS (SELECT fragment_id, {_FAR} FROM b0), {_TAKE}"))
def combine_alignments_edit_cap(spark, sf):
    """Sides with a mean edit distance over the cap, per read, take no part."""
    return _long(combine.combine(*_two(spark, sf), max_mean=4).select("fragment_id", "row_no", "source"), "row_no", "source")


@query(sql("aln0", "SELECT CAST(fragment_id AS VARCHAR) || '/1' AS fragment_id, CAST(fragment_id * 100 + aln_no AS BIGINT) AS row_no, pos FROM aln0 UNION ALL SELECT CAST(fragment_id AS VARCHAR) || '/2', CAST(fragment_id * 100 + aln_no AS BIGINT), pos + 200 FROM aln0"))
def merge_both(spark, sf):
    one = adapters.alignments(spark, sf).select("fragment_id", (F.col("fragment_id") * 100 + F.col("aln_no")).cast("long").alias("row_no"), "pos")
    return combine.merge_both(one, one.withColumn("pos", F.col("pos") + 200))


@query("""WITH r AS (SELECT l_orderkey AS fragment_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS row_no, CAST(round(l_discount * 100) AS INTEGER) AS nm, CAST(l_quantity AS INTEGER) AS score, l_returnflag = 'A' AS secondary FROM lineitem),
u AS (SELECT *, CASE WHEN row_no % 2 = 0 THEN row_no - 1 WHEN EXISTS (SELECT 1 FROM r n WHERE n.fragment_id = r.fragment_id AND n.row_no = r.row_no + 1) THEN row_no END AS pair FROM r)
SELECT fragment_id, CAST(row_no AS BIGINT) AS row_no, CAST(dense_rank() OVER (PARTITION BY fragment_id ORDER BY coalesce(pair, row_no)) AS BIGINT) AS aln_no, pair IS NOT NULL AS paired FROM u WHERE nm <= 6 AND score >= 5 AND NOT secondary""")
def read_filter(spark, sf):
    """Reads by edit distance, score and primary rows; a mate that fails leaves the other alone, still labelled as paired."""
    c = F.col
    rows = adapters.table(spark, sf, "lineitem").withColumn("row_no", F.row_number().over(_lines()))
    rows = rows.select(c("l_orderkey").alias("fragment_id"), "row_no", F.round(c("l_discount") * 100).cast("int").alias("NM"), c("l_quantity").cast("int").alias("AS"), (F.lit(3) + F.when(c("l_returnflag") == "A", 256).otherwise(0)).alias("flag"))
    ends = rows.groupBy("fragment_id").agg(F.max("row_no").alias("n"))
    pairs = rows.where("row_no % 2 = 1").join(ends, "fragment_id").where("row_no < n").select("fragment_id", c("row_no").alias("first"), (c("row_no") + 1).alias("second"))
    got = alignments.read_filter(rows, pairs, max_edits=6, min_score=5, primary=True)
    return _long(got.select("fragment_id", "row_no", "aln_no", "paired"), "row_no", "aln_no")


def _lines():
    from pyspark.sql import Window

    return Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


# --- reads on transcripts, junctions and the genome ---------------------------------------------

_KINDS = """refs AS (SELECT 't' || CAST(p_partkey AS VARCHAR) AS chrom, 'transcript' AS kind, 1 AS es, 2 * p_size AS ee, 'chr' || CAST(p_partkey % 5 AS VARCHAR) AS g_chrom, p_partkey * 20 + 1 AS gs, p_partkey * 20 + 2 * p_size AS ge, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS estrand, p_brand AS gene_id FROM part
 UNION ALL SELECT 't' || CAST(p_partkey AS VARCHAR), 'transcript', 2 * p_size + 1, 4 * p_size + CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 0 END, 'chr' || CAST(p_partkey % 5 AS VARCHAR), p_partkey * 20 + 101 + 2 * p_size, p_partkey * 20 + 100 + 4 * p_size, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END, p_brand FROM part
 UNION ALL SELECT 'j' || CAST(p_partkey AS VARCHAR), 'junction', 1, p_size, 'chr' || CAST(p_partkey % 5 AS VARCHAR), p_partkey * 20 + 1 + p_size, p_partkey * 20 + 2 * p_size, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END, p_brand FROM part
 UNION ALL SELECT 'j' || CAST(p_partkey AS VARCHAR), 'junction', p_size + 1, 2 * p_size, 'chr' || CAST(p_partkey % 5 AS VARCHAR), p_partkey * 20 + 101 + 2 * p_size, p_partkey * 20 + 100 + 3 * p_size, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END, p_brand FROM part
 UNION ALL SELECT 'chr' || CAST(p_partkey % 5 AS VARCHAR), 'genome', p_partkey * 20 + 1, p_partkey * 20 + 2 * p_size, 'chr' || CAST(p_partkey % 5 AS VARCHAR), p_partkey * 20 + 1, p_partkey * 20 + 2 * p_size, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END, p_brand FROM part
 UNION ALL SELECT 'chr' || CAST(p_partkey % 5 AS VARCHAR), 'genome', p_partkey * 20 + 101 + 2 * p_size, p_partkey * 20 + 100 + 4 * p_size, 'chr' || CAST(p_partkey % 5 AS VARCHAR), p_partkey * 20 + 101 + 2 * p_size, p_partkey * 20 + 100 + 4 * p_size, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END, p_brand FROM part),
rex AS (SELECT *, g_chrom || '/' || CAST(gs AS VARCHAR) || '/' || CAST(ge AS VARCHAR) || '/' || estrand AS exon_id FROM refs),
kalns AS (SELECT fragment_id, aln_no, read_index, strand, nm, l_linenumber % 3 AS which, CASE l_linenumber % 3 WHEN 0 THEN 'transcript' WHEN 1 THEN 'junction' ELSE 'genome' END AS kind, CASE l_linenumber % 3 WHEN 0 THEN 't' || CAST(l_partkey AS VARCHAR) WHEN 1 THEN 'j' || CAST(l_partkey AS VARCHAR) ELSE chrom END AS chrom, CASE WHEN l_linenumber % 3 = 2 THEN pos ELSE l_suppkey % 37 + 1 END AS pos, len FROM kaln0),
khit AS (SELECT a.*, pos + len - 1 AS be, e.es, e.ee, e.g_chrom, e.gs, e.ge, e.estrand, e.gene_id, e.exon_id, least(pos + len - 1, e.ee) - greatest(pos, e.es) + 1 AS ov FROM kalns a JOIN rex e ON a.chrom = e.chrom AND a.pos <= e.ee AND e.es <= a.pos + a.len - 1),
kidx AS (SELECT *, CASE WHEN kind = 'genome' THEN 0 ELSE dense_rank() OVER (PARTITION BY fragment_id, aln_no, read_index, kind ORDER BY es, ee) - 1 END AS block_idx FROM khit),
klast AS (SELECT *, CASE WHEN kind = 'genome' THEN 0 ELSE max(block_idx) OVER (PARTITION BY fragment_id, aln_no, read_index, kind) END AS last_block, ge - gs + 1 AS g FROM kidx),
kclip AS (SELECT *, CASE WHEN kind <> 'genome' AND es = 1 AND ee - es + 1 < g THEN es - (g - (ee - es + 1)) ELSE es END AS ts0 FROM klast),
kd AS (SELECT *, ee - ts0 + 1 - g AS d FROM kclip),
kfit AS (SELECT *, CASE WHEN d = 0 THEN ts0 WHEN kind = 'junction' AND block_idx = 0 THEN ee - g + 1 WHEN block_idx = last_block THEN ts0 WHEN block_idx = 0 THEN ee - g + 1 ELSE ee - CAST(floor(g / 2) AS BIGINT) + 1 END AS ts,
 CASE WHEN d = 0 OR kind = 'junction' AND block_idx = 0 THEN ee WHEN block_idx = last_block THEN ts0 + g - 1 WHEN block_idx = 0 THEN ee ELSE ee - CAST(floor(g / 2) AS BIGINT) + 1 + (g - CAST(floor(g / 2) AS BIGINT)) - 1 END AS te FROM kd),
kend AS (SELECT *, abs(greatest(pos, ts) - ts) AS sd, abs(least(be, te) - te) AS ed, kind IN ('genome', 'junction') OR estrand = '+' AS plus FROM kfit),
kproj AS (SELECT *, CASE WHEN sd <= ed AND plus THEN gs + sd WHEN sd <= ed THEN greatest(1, ge - sd - ov + 1) WHEN plus THEN greatest(1, ge - ed - ov + 1) ELSE gs + ed END AS p_start, CASE WHEN sd <= ed AND plus THEN gs + sd + ov - 1 WHEN sd <= ed THEN ge - sd WHEN plus THEN ge - ed ELSE gs + ed + ov - 1 END AS p_end,
 CASE WHEN kind IN ('genome', 'junction') THEN strand WHEN estrand = strand THEN '+' ELSE '-' END AS p_strand FROM kend)"""

_KALN = "kaln0 AS (SELECT * FROM aln0 JOIN (SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS k FROM lineitem) x ON x.l_orderkey = aln0.fragment_id AND x.k = aln0.aln_no JOIN (SELECT l_orderkey AS o, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS k FROM lineitem) y ON y.o = aln0.fragment_id AND y.k = aln0.aln_no)"


def _references(spark, sf) -> DataFrame:
    """Exons of transcripts, junctions and chromosomes with their places on the genome."""
    p, c = adapters.table(spark, sf, "part"), F.col
    k, s = c("p_partkey"), c("p_size").cast("long")
    gs = k * 20 + 1
    exon = lambda ref, a, b, x, y: F.struct(ref.alias("chrom"), a.cast("long").alias("start"), b.cast("long").alias("end"), x.cast("long").alias("g_start"), y.cast("long").alias("g_end"))
    t, j, g = F.concat(F.lit("t"), k.cast("string")), F.concat(F.lit("j"), k.cast("string")), F.concat(F.lit("chr"), (k % 5).cast("string"))
    one, two = (gs, gs + 2 * s - 1), (gs + 100 + 2 * s, gs + 99 + 4 * s)
    rows = F.array(
        exon(t, F.lit(1), 2 * s, *one), exon(t, 2 * s + 1, 4 * s + F.when(k % 7 == 0, 2).otherwise(0), *two), exon(j, F.lit(1), s, gs + s, gs + 2 * s - 1), exon(j, s + 1, 2 * s, gs + 100 + 2 * s, gs + 99 + 3 * s),
        exon(g, *one, *one), exon(g, *two, *two),
    )
    e = p.select(g.alias("g_chrom"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"), c("p_brand").alias("gene_id"), F.explode(rows).alias("r")).select("g_chrom", "strand", "gene_id", "r.*")
    return e.select(names.render_exon(c("g_chrom"), c("g_start"), c("g_end"), c("strand")).alias("exon_id"), "chrom", "start", "end", "strand", "g_chrom", "g_start", "g_end", "gene_id")


def _kinds(spark, sf) -> DataFrame:
    """Lines of orders as reads on transcripts, junctions or the genome, by their line number."""
    c = F.col
    li = adapters.table(spark, sf, "lineitem").withColumn("aln_no", F.row_number().over(_lines()))
    which, k = c("l_linenumber") % 3, c("l_partkey").cast("string")
    chrom = F.when(which == 0, F.concat(F.lit("t"), k)).when(which == 1, F.concat(F.lit("j"), k)).otherwise(F.concat(F.lit("chr"), (c("l_partkey") % 5).cast("string")))
    pos = F.when(which == 2, c("l_partkey") * 20 + c("l_suppkey") % 37 + 1).otherwise(c("l_suppkey") % 37 + 1)
    return li.select(
        c("l_orderkey").alias("fragment_id"), "aln_no", (1 + (c("l_linenumber") - 1) % 2).cast("int").alias("read_index"), F.lit(False).alias("paired"), F.when(which == 0, "transcript").when(which == 1, "junction").otherwise("genome").alias("kind"), chrom.alias("chrom"),
        pos.cast("long").alias("pos"), F.concat(c("l_quantity").cast("long").cast("string"), F.lit("M")).alias("cigar"), F.when(c("l_returnflag") == "R", "-").otherwise("+").alias("strand"), F.round(c("l_discount") * 100).cast("int").alias("nm"), F.lit(20).alias("mapq"),
    )


@query(sql("aln0", f", {_KALN}, {_KINDS} SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, kind, exon_id, CAST(block_idx AS BIGINT) AS block_idx, CAST(last_block AS BIGINT) AS last_block, CAST(p_start AS BIGINT) AS p_start, CAST(p_end AS BIGINT) AS p_end, p_strand, CAST(d AS BIGINT) AS length_difference FROM kproj"))
def transcript_projection(spark, sf):
    hits = references.joined(_kinds(spark, sf), _references(spark, sf))
    return _long(hits.select("fragment_id", "aln_no", "kind", "exon_id", "block_idx", "last_block", "p_start", "p_end", "p_strand", "length_difference"), "aln_no", "block_idx", "last_block", "p_start", "p_end", "length_difference")


_SNAP = """ksrc AS (SELECT DISTINCT fragment_id, read_index AS side, chrom AS ref, g_chrom AS chrom, p_start AS s, p_end - p_start AS size, d FROM kproj WHERE kind <> 'genome'),
kmove AS (SELECT a.*, min_by(b.s, abs(b.d) * 1000000000 + b.s) AS ns, min_by(b.d, abs(b.d) * 1000000000 + b.s) AS nd FROM ksrc a JOIN ksrc b ON a.fragment_id = b.fragment_id AND a.side = b.side AND a.chrom = b.chrom AND a.size = b.size
 WHERE a.d > 0 AND b.ref <> a.ref AND b.s <> a.s AND abs(b.s - a.s) <= a.d AND (b.d < a.d OR (b.d = a.d AND b.s < a.s)) GROUP BY ALL),
ksnap AS (SELECT p.* EXCLUDE (chrom, d), p.chrom AS ref, CASE WHEN p.kind = 'genome' THEN p.chrom ELSE p.g_chrom END AS chrom, CASE WHEN p.kind = 'genome' THEN p.pos ELSE coalesce(m.ns, p.p_start) END AS bs, CASE WHEN p.kind = 'genome' THEN p.be ELSE coalesce(m.ns + m.size, p.p_end) END AS bend, CASE WHEN p.kind = 'genome' THEN p.strand ELSE p.p_strand END AS st
 FROM kproj p LEFT JOIN kmove m ON p.kind <> 'genome' AND m.fragment_id = p.fragment_id AND m.side = p.read_index AND m.ref = p.chrom AND m.chrom = p.g_chrom AND m.s = p.p_start AND m.size = p.p_end - p.p_start AND m.d = p.d)"""


@query(sql("aln0", f", {_KALN}, {_KINDS}, {_SNAP} SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, exon_id, ref, chrom, CAST(bs AS BIGINT) AS block_start, CAST(bend AS BIGINT) AS block_end, st AS strand FROM ksnap"))
def snapped_blocks(spark, sf):
    b = references.on_genome(references.joined(_kinds(spark, sf), _references(spark, sf)))
    return _long(b.select("fragment_id", "aln_no", "exon_id", "ref", "chrom", F.col("start").alias("block_start"), F.col("end").alias("block_end"), "strand"), "aln_no", "block_start", "block_end")


def _three(spark, sf):
    rows = settled.settled(_kinds(spark, sf), "kinds")
    return [rows.where(F.col("kind") == k).drop("kind", "mapq") for k in ("transcript", "junction", "genome")]


def _sets_sql(mode: str) -> str:
    """Combination of three sets, then the counts of what was chosen."""
    m = counting.MODES[mode]
    need = {"all": "max(last_block) + 1"}.get(m.required, str(m.required))
    side = "w{k} AS (SELECT fragment_id, greatest(sum(CASE WHEN read_index = 1 THEN 1 ELSE 0 END), sum(CASE WHEN read_index = 2 THEN 1 ELSE 0 END)) AS n, sum(nm) AS e, count(DISTINCT read_index) AS m, min(read_index) AS lo, max(read_index) AS hi FROM {t} GROUP BY 1)"
    rule = "CASE WHEN n{b} IS NULL THEN {a} WHEN n{a} IS NULL THEN {b} WHEN m{a} > m{b} THEN {a} WHEN m{b} > m{a} THEN {b} WHEN (1.0 * e{b} / n{b} <= 1.0 * e{a} / n{a} AND n{b} > 1.1 * n{a}) OR 1.0 * e{b} / n{b} < 1.0 * e{a} / n{a} - 0.25 THEN {b} ELSE {a} END"

    def best(a: int, b: int, name: str, one: str, two: str) -> str:
        pick = f"SELECT coalesce(w{a}.fragment_id, w{b}.fragment_id) AS fragment_id, " + ", ".join(f"w{k}.{c} AS {c}{k}" for k in (a, b) for c in ("n", "e", "m", "lo", "hi")) + f" FROM w{a} FULL OUTER JOIN w{b} ON w{a}.fragment_id = w{b}.fragment_id"
        plan = f"p{name} AS (SELECT *, {rule.format(a=a, b=b)} AS side FROM ({pick}) q)"
        also = lambda w: f"n{a} IS NOT NULL AND n{b} IS NOT NULL AND lo{w} = hi{w} AND t.read_index <> lo{w}"
        take = lambda t, own, other: f"SELECT t.* FROM {t} t JOIN p{name} p USING (fragment_id) WHERE side = {own} OR (side = {other} AND {also(other)})"
        return f"{plan}, {name} AS ({take(one, a, b)} UNION ALL {take(two, b, a)})"

    ok = f"(kind <> 'genome' OR ({_SPLICE})) AND ov >= least({m.overlap}, ee - es + 1)" if m.splice else f"ov >= least({m.overlap}, ee - es + 1)"
    ok = ok.replace("al = ov", "len = ov").replace("es <= bs", "es <= pos").replace("es = bs", "es = pos")
    sets = ", ".join(f"k{n} AS (SELECT * FROM kalns WHERE kind = '{k}')" for n, k in (("t", "transcript"), ("j", "junction"), ("g", "genome")))
    kinds = _KINDS.replace("FROM kalns a JOIN rex", "FROM kbest a JOIN rex")
    head, tail = kinds.split("khit AS", 1)
    choice = f"{sets}, {side.format(k=1, t='kt')}, {side.format(k=2, t='kj')}, {best(1, 2, 'kfirst', 'kt', 'kj')}, {side.format(k=3, t='kfirst')}, {side.format(k=4, t='kg')}, {best(3, 4, 'kbest', 'kfirst', 'kg')}, "
    both = "(SELECT * FROM kt UNION ALL SELECT * FROM kj)"
    table = f"{side.format(k=5, t=both)}, tab AS (SELECT *, {rule.format(a=5, b=6)} AS side FROM (SELECT coalesce(w5.fragment_id, w6.fragment_id) AS fragment_id, w5.n AS n5, w5.e AS e5, w5.m AS m5, w6.n AS n6, w6.e AS e6, w6.m AS m6 FROM w5 FULL OUTER JOIN w6 ON w5.fragment_id = w6.fragment_id) q)".replace("tab AS", side.format(k=6, t="kg") + ", tab AS")
    return sql("aln0", f""", {_KALN}, {head}{choice}khit AS{tail}, {_SNAP}, {table},
form AS (SELECT fragment_id, aln_no, read_index, CAST(list_sort(list(DISTINCT CAST(block_idx AS VARCHAR) || '@' || chrom || '/' || CAST(bs AS VARCHAR) || '/' || CAST(bend AS VARCHAR) || '/' || st)) AS VARCHAR) AS form FROM ksnap GROUP BY 1, 2, 3),
first AS (SELECT *, min(aln_no) OVER (PARTITION BY fragment_id, read_index, form) AS first FROM form),
h2 AS (SELECT h.*, f.first FROM ksnap h JOIN first f USING (fragment_id, aln_no, read_index)),
num AS (SELECT fragment_id, greatest(count(DISTINCT CASE WHEN read_index = 1 THEN form END), count(DISTINCT CASE WHEN read_index = 2 THEN form END)) AS n FROM form GROUP BY 1),
ok0 AS (SELECT * FROM h2 WHERE {ok}), ok AS (SELECT * FROM (SELECT *, max(CASE WHEN kind <> 'genome' THEN ov END) OVER (PARTITION BY fragment_id, first, read_index, block_idx) AS most FROM ok0) WHERE kind = 'genome' OR ov = most),
kmap AS (SELECT DISTINCT exon_id, gene_id AS object_id FROM rex),
obj AS (SELECT fragment_id, first, read_index, kmap.object_id FROM ok JOIN kmap USING (exon_id) GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT block_idx) >= {need}),
wgt AS (SELECT n.fragment_id, CAST(least(1.0 / CASE WHEN side = 5 THEN n5 ELSE n6 END, 1.0 / n.n) AS DOUBLE) AS w FROM num n JOIN tab t ON n.fragment_id = t.fragment_id),
per AS (SELECT o.fragment_id, object_id, least(1.0, greatest(coalesce(sum(CASE WHEN read_index = 1 THEN w END), 0), coalesce(sum(CASE WHEN read_index = 2 THEN w END), 0))) AS c FROM obj o JOIN wgt w ON o.fragment_id = w.fragment_id WHERE w >= 0.01 GROUP BY 1, 2)
SELECT object_id AS id, round(CAST(sum(c) AS DOUBLE), 6) AS count FROM per GROUP BY 1""")


def _sets_count(mode: str):
    def run(spark, sf):
        e = _references(spark, sf)
        return _rounded(references.counts(*_three(spark, sf), e, e.select("exon_id", F.col("gene_id").alias("object_id")), mode), "count")

    return run


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SETS_BY_SAMPLE = _sets_sql("gene").replace("SELECT object_id AS id, round(CAST(sum(c) AS DOUBLE), 6) AS count FROM per GROUP BY 1", """, c AS (SELECT object_id AS id, o_orderpriority AS sample, sum(c) AS count FROM per JOIN orders ON o_orderkey = fragment_id GROUP BY 1, 2), reads AS (SELECT sample, sum(count) AS reads FROM c GROUP BY 1), size AS (SELECT p_brand AS id, sum(p_size) AS length FROM part GROUP BY 1)
SELECT c.id, c.sample, round(CAST(count / (length / 1000.0) / (reads / 1e6) AS DOUBLE), 4) AS fpkm FROM c JOIN reads USING (sample) JOIN size ON size.id = c.id""")


@query(_SETS_BY_SAMPLE)
def three_set_sample_fpkm(spark, sf):
    """Three alignment sets of several samples and chunks to FPKM; a second call over the same folder makes nothing anew."""
    c = F.col
    of = adapters.table(spark, sf, "orders").select(c("o_orderkey").alias("fragment_id"), c("o_orderpriority").alias("sample"), (c("o_orderkey") % 3).cast("int").alias("chunk"))
    sets = [t.join(of, "fragment_id") for t in _three(spark, sf)]
    e, path = _references(spark, sf), settled.folder(spark, "counts")
    lengths = adapters.table(spark, sf, "part").groupBy(c("p_brand").alias("id")).agg(F.sum("p_size").cast("long").alias("length"))
    objects = e.select("exon_id", c("gene_id").alias("object_id"))
    return references.sample_tables(*sets, e, objects, lengths, _PRIORITIES, path)[1].withColumn("fpkm", F.round("fpkm", 4))


query(_sets_sql("gene"), "three_set_gene_counts")(_sets_count("gene"))
query(_sets_sql("junction"), "three_set_junction_counts")(_sets_count("junction"))


@query(sql("aln0", f""", {_KALN}, {_KINDS}, far AS (SELECT fragment_id, aln_no, read_index, g_chrom AS chrom, min(p_strand) AS strand, CAST(list_sort(list(DISTINCT lpad(CAST(p_start AS VARCHAR), 12, '0') || '-' || lpad(CAST(p_end AS VARCHAR), 12, '0'))) AS VARCHAR) AS places FROM kproj WHERE kind <> 'genome' GROUP BY 1, 2, 3, 4)
SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, chrom, strand, places FROM far"""))
def assembled_alignments(spark, sf):
    """Blocks of reads on transcripts and junctions put together on the genome, contradictions raise."""
    hits = references.joined(_kinds(spark, sf), _references(spark, sf)).where("kind <> 'genome'")
    b = hits.select("fragment_id", "aln_no", "read_index", F.col("g_chrom").alias("chrom"), F.col("p_start").alias("start"), F.col("p_end").alias("end"), F.col("p_strand").alias("strand"), "block_idx", "last_block")
    whole = projection.assemble(b)
    pad = lambda x: F.lpad(x.cast("string"), 12, "0")
    places = F.array_sort(F.array_distinct(F.transform("blocks", lambda x: F.concat(pad(x["start"]), F.lit("-"), pad(x["end"])))))
    return _long(whole.select("fragment_id", "aln_no", F.get("blocks", F.lit(0))["chrom"].alias("chrom"), "strand", F.concat(F.lit("["), F.array_join(places, ", "), F.lit("]")).alias("places")), "aln_no")


@query(sql("aln0 aln blk", "SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, CAST(fragment_id AS VARCHAR) || ':' || CASE WHEN min(read_index) = 2 THEN 'r-' ELSE 'l-' END || string_agg(chrom || '/' || CAST(bs AS VARCHAR) || '/' || CAST(be AS VARCHAR) || '/' || strand, ':' ORDER BY block_idx) AS canonical FROM blk GROUP BY 1, 2"))
def canonical_strings(spark, sf):
    b = alignments.blocks(adapters.alignments(spark, sf))
    whole = projection.assemble(b).withColumn("paired", F.lit(False))
    return _long(projection.canonical(whole).select("fragment_id", "aln_no", "canonical"), "aln_no")


@query(sql("aln0", f""", {_KALN}, {_KINDS}, {_SNAP}, place AS (SELECT DISTINCT fragment_id, aln_no, read_index, 'computed' AS source, chrom, st, bs, bend FROM ksnap WHERE kind <> 'genome' UNION SELECT fragment_id, aln_no, read_index, 'direct', chrom, strand, pos, pos + len - 1 FROM kalns WHERE kind = 'genome'),
gap AS (SELECT *, bs - lag(bend) OVER (PARTITION BY fragment_id, aln_no, read_index, source ORDER BY bs, bend) - 1 AS n FROM place),
whole AS (SELECT fragment_id, aln_no, read_index, source, min(chrom) AS chrom, min(st) AS st, min(bs) AS pos, max(bend) AS e, sum(bend - bs + 1) AS n, string_agg(CASE WHEN n > 0 THEN CAST(n AS VARCHAR) || 'N' ELSE '' END || CAST(bend - bs + 1 AS VARCHAR) || 'M', '' ORDER BY bs, bend) AS cigar FROM gap GROUP BY 1, 2, 3, 4),
one AS (SELECT *, bool_or(source = 'direct') OVER w AND bool_or(source = 'computed') OVER w AS twin FROM whole WINDOW w AS (PARTITION BY fragment_id, read_index, chrom, pos, cigar) QUALIFY row_number() OVER (PARTITION BY fragment_id, source, read_index, chrom, pos, cigar ORDER BY aln_no) = 1),
near AS (SELECT d.fragment_id, d.aln_no, d.read_index FROM one d JOIN one c ON d.source = 'direct' AND c.source = 'computed' AND NOT d.twin AND NOT c.twin AND d.fragment_id = c.fragment_id AND d.read_index = c.read_index AND d.chrom = c.chrom JOIN place p ON p.source = 'computed' AND p.fragment_id = c.fragment_id AND p.aln_no = c.aln_no AND p.read_index = c.read_index
 GROUP BY d.fragment_id, d.aln_no, d.read_index, c.aln_no HAVING sum(greatest(0, least(p.bend, d.e) - greatest(p.bs, d.pos) + 1)) >= 0.93 * any_value(c.n) OR (sum(greatest(0, least(p.bend, d.e) - greatest(p.bs, d.pos) + 1)) >= 0.3 * any_value(c.n) AND any_value(greatest(abs(d.pos - c.pos), abs(d.e - c.e))) <= 0.3 * any_value(c.n)))
SELECT fragment_id, CAST(read_index AS BIGINT) AS read_index, chrom AS ref, CAST(pos AS BIGINT) AS pos, cigar, st = '-' AS turned, CAST(count(*) OVER (PARTITION BY fragment_id) AS BIGINT) AS nh FROM one o WHERE NOT (source = 'computed' AND twin) AND NOT (source = 'direct' AND EXISTS (SELECT 1 FROM near n WHERE n.fragment_id = o.fragment_id AND n.aln_no = o.aln_no AND n.read_index = o.read_index))"""))
def genome_alignments(spark, sf):
    """Rows on the genome put together from transcripts and junctions, and direct hits that these do not nearly cover."""
    rows = settled.settled(_kinds(spark, sf), "kinds")
    reads = rows.select("fragment_id").distinct().withColumn("reads", F.lit(1))
    got = references.genome_rows(rows, _references(spark, sf), reads).where("ref <> '*'")
    return got.select(F.col("fragment_id").cast("long").alias("fragment_id"), F.col("read_index").cast("long").alias("read_index"), "ref", "pos", "cigar", flags.has(F.col("flag"), "reverse").alias("turned"), F.col("nh").cast("long").alias("nh"))


# --- weights, maps and lookups ------------------------------------------------------------------


@query(_count_sql("gene").replace("w >= 0.01", "w >= 0.3"))
def gene_counts_weight_threshold(spark, sf):
    a = adapters.alignments(spark, sf)
    w = weights.summarize(a).select("fragment_id", F.col("num_alignments").alias("n"))
    return _rounded(counting.quantify(alignments.blocks(a), adapters.exons(spark, sf), adapters.objects(spark, sf), "gene", w, threshold=0.3), "count")


@query(sql("aln0", ", l AS (SELECT 'chr' || CAST(n_nationkey AS VARCHAR) AS chrom FROM nation WHERE n_nationkey < 2) SELECT fragment_id, CAST(greatest(sum(CASE WHEN read_index = 1 THEN 1 ELSE 0 END), sum(CASE WHEN read_index = 2 THEN 1 ELSE 0 END)) AS BIGINT) AS num_alignments, CAST(sum(nm) AS BIGINT) AS sum_edit_distance FROM aln0 WHERE chrom IN (SELECT chrom FROM l) GROUP BY 1"))
def read_weights_listed_chromosomes(spark, sf):
    listed = adapters.table(spark, sf, "nation").where("n_nationkey < 2").select(F.concat(F.lit("chr"), F.col("n_nationkey").cast("string")).alias("chrom"))
    return _long(weights.summarize(adapters.alignments(spark, sf), chroms=listed).select("fragment_id", "num_alignments", "sum_edit_distance"), "num_alignments", "sum_edit_distance")


@query(sql("aln0 exon", "SELECT DISTINCT chrom, chrom IN (SELECT chrom FROM exon WHERE chrom <> 'chr3') AS known FROM aln0"))
def chromosome_check(spark, sf):
    return alignments.chromosome_check(adapters.alignments(spark, sf), adapters.exons(spark, sf).where("chrom <> 'chr3'"))


@query(f"WITH {_TG}, w AS (SELECT l_orderkey AS fragment_id, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) SELECT gene_id AS id, round(CAST(sum(1.0 / coalesce(n, 1)) AS DOUBLE), 6) AS count FROM tg LEFT JOIN w USING (fragment_id) GROUP BY 1")
def sam_gene_counts_weighted(spark, sf):
    """A fragment that the weight table lacks weighs 1."""
    rows, p = _transcripts(spark, sf)
    w = adapters.table(spark, sf, "lineitem").where("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("fragment_id")).agg(F.count("*").alias("n"))
    return _rounded(sam_counts.gene_counts(sam_counts.fragment_genes(rows, p), w), "count")


@query("WITH a AS (SELECT l_orderkey AS fragment_id, l_linenumber AS line, 'tr-' || CAST(l_partkey % 50 AS VARCHAR) AS chrom FROM lineitem), e AS (SELECT DISTINCT 'tr-' || CAST(p_partkey % 40 AS VARCHAR) AS base, 'tr-' || CAST(p_partkey % 40 AS VARCHAR) || '.' || CAST(p_size % 3 AS VARCHAR) AS versioned FROM part) SELECT fragment_id, CAST(line AS BIGINT) AS line, coalesce(versioned, chrom) AS chrom FROM a LEFT JOIN e ON base = chrom")
def transcript_versions(spark, sf):
    c = F.col
    rows = adapters.table(spark, sf, "lineitem").select(c("l_orderkey").alias("fragment_id"), c("l_linenumber").cast("long").alias("line"), F.concat(F.lit("tr-"), (c("l_partkey") % 50).cast("string")).alias("chrom"))
    e = adapters.table(spark, sf, "part").select(F.concat(F.lit("tr-"), (c("p_partkey") % 40).cast("string"), F.lit("."), (c("p_size") % 3).cast("string")).alias("chrom"))
    return alignments.expand_versions(rows, e).select("fragment_id", "line", "chrom")


@query(sql("aln0 aln blk", "SELECT b.fragment_id, CAST(b.aln_no AS BIGINT) AS aln_no, CAST(b.block_idx AS BIGINT) AS block_idx, CAST(a.pos % 7 AS BIGINT) AS kept FROM blk b JOIN aln a ON a.fragment_id = b.fragment_id AND a.aln_no = b.aln_no"))
def attached_rows(spark, sf):
    """Blocks with a column of the row they come from, found by reference, position and read."""
    a = adapters.alignments(spark, sf).withColumn("ref", F.col("chrom"))
    b = alignments.blocks(a).join(a.select("fragment_id", "aln_no", "ref", "pos"), ["fragment_id", "aln_no"])
    rows = a.withColumn("kept", F.col("pos") % 7)
    return _long(alignments.attach_rows(b, rows, ["kept"]).select("fragment_id", "aln_no", "block_idx", "kept"), "aln_no", "block_idx", "kept")


@query("SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) AS BIGINT) AS ordinal FROM part")
def ordinals(spark, sf):
    return _long(tables.ordinals(adapters.table(spark, sf, "part"), ["p_brand", "p_size"], ["p_partkey"]).select("p_partkey", "ordinal"), "ordinal")


@query("""WITH x AS (SELECT DISTINCT 'g' || CAST(p_partkey AS VARCHAR) || '-junction-' || CAST(a AS VARCHAR) || '-' || CAST(a + 1 AS VARCHAR) AS j FROM part, (SELECT unnest([2, 3]) AS a) WHERE p_size % 2 = 0 OR a = 3),
e AS (SELECT 'x' || CAST(p_partkey AS VARCHAR) AS ext FROM part WHERE 'g' || CAST(p_partkey AS VARCHAR) || '-junction-2-3' IN (SELECT j FROM x)),
m AS (SELECT 'x' || CAST(p_partkey + 1 AS VARCHAR) AS ext FROM part WHERE p_partkey % 5 = 0 AND 'x' || CAST(p_partkey AS VARCHAR) IN (SELECT ext FROM e)),
o AS (SELECT ext FROM e UNION SELECT ext FROM m)
SELECT 'e' || CAST(p_partkey AS VARCHAR) AS exon_id, 'x' || CAST(p_partkey AS VARCHAR) AS object_id FROM part WHERE 'x' || CAST(p_partkey AS VARCHAR) IN (SELECT ext FROM o) UNION SELECT 'e' || CAST(p_partkey AS VARCHAR), 't' || p_brand FROM part""")
def filter_junction_map(spark, sf):
    p, c = adapters.table(spark, sf, "part"), F.col
    k = c("p_partkey").cast("string")
    refs = p.select(F.concat(F.lit("g"), k, F.lit("-junction-3-4"), F.when(c("p_size") % 2 == 0, ":2:").otherwise("::")).alias("junction_id"))
    jmap = p.select(F.concat(F.lit("g"), k, F.lit("-junction-2-3")).alias("junction_id"), F.concat(F.lit("x"), k).alias("external_id"))
    same = p.where("p_partkey % 5 = 0").select(F.concat(F.lit("x"), k).alias("external_id"), F.concat(F.lit("x"), (c("p_partkey") + 1).cast("string")).alias("other_id"))
    exon = F.concat(F.lit("e"), k).alias("exon_id")
    return junctions.filter_junction_map(refs, jmap, same, p.select(exon, F.concat(F.lit("x"), k).alias("object_id")), p.select(exon, F.concat(F.lit("t"), c("p_brand")).alias("object_id")))


# --- single functions ---------------------------------------------------------------------------


@query("SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS line, q || 'M' || CAST(g + h AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN 'N' ELSE 'D' END || '9M' AS joined, '9M' || CAST(h AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN 'N' ELSE 'D' END AS turned FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q, 1 + l_suppkey % 9 AS g, 1 + l_partkey % 9 AS h FROM lineitem)")
def cigar_joined(spark, sf):
    """Appending merges a deletion into the gap or deletion beside it; turning reverses the operations."""
    c = F.col
    text = lambda x: x.cast("string")
    li = adapters.table(spark, sf, "lineitem")
    left = cigar.parse(F.concat(text(c("l_quantity").cast("long")), F.lit("M"), text(1 + c("l_suppkey") % 9), F.lit("D")))
    right = cigar.parse(F.concat(text(1 + c("l_partkey") % 9), F.when(c("l_linenumber") % 2 == 0, "N").otherwise("D"), F.lit("9M")))
    return li.select(c("l_orderkey").alias("k"), c("l_linenumber").cast("long").alias("line"), cigar.render(cigar.append(left, right)).alias("joined"), cigar.render(cigar.invert(right)).alias("turned"))


@query("SELECT o_orderkey AS k, CASE WHEN o_custkey % 2 = 0 THEN (CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '+' END) ELSE (CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END) END AS forward, CASE WHEN o_custkey % 2 = 1 THEN (CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '+' END) ELSE (CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END) END AS backward FROM orders")
def fragment_strands(spark, sf):
    o, c = adapters.table(spark, sf, "orders"), F.col
    s, i = F.when(c("o_orderkey") % 2 == 0, "+").otherwise("-"), F.when(c("o_custkey") % 2 == 0, 2).otherwise(1)
    return o.select(c("o_orderkey").alias("k"), flags.fragment_strand(s, i, "forward").alias("forward"), flags.fragment_strand(s, i, "backward").alias("backward"))


@query("SELECT p_partkey AS k, CASE WHEN p_size % 2 = 0 THEN 'g' || CAST(p_size AS VARCHAR) || '-junction-3-4' ELSE 'tx:' || CAST(p_size AS VARCHAR) END AS simple, 'g' || CAST(p_size AS VARCHAR) AS base, CASE WHEN p_size % 3 = 0 THEN 'rest' || CAST(p_partkey AS VARCHAR) ELSE 'whole' END AS fragment FROM part")
def object_names(spark, sf):
    p, c = adapters.table(spark, sf, "part"), F.col
    n = c("p_size").cast("string")
    name = F.when(c("p_size") % 2 == 0, F.concat(F.lit("g"), n, F.lit("-junction-3-4:1:5"))).otherwise(F.concat(F.lit("tx:"), n))
    fragment = F.when(c("p_size") % 3 == 0, F.concat(F.lit("ab#Prest"), c("p_partkey").cast("string"))).otherwise("whole")
    return p.select(c("p_partkey").alias("k"), names.simplify_junction(name).alias("simple"), names.base_object(F.concat(F.lit("g"), n, F.when(c("p_size") % 2 == 0, "-exon7").otherwise("-junction-1-2"))).alias("base"), names.modify_fragment(fragment, cut_off="#", prefix="#P").alias("fragment"))


@query("SELECT p_partkey AS k, CASE WHEN p_size % 2 = 0 THEN p_size END AS nm, CAST(p_size % 7 AS BIGINT) AS score, (CASE WHEN p_size % 2 = 0 THEN 'NM:i:' || CAST(p_size AS VARCHAR) || chr(9) ELSE '' END) || 'AS:i:' || CAST(p_size % 7 AS VARCHAR) || chr(9) || 'NH:i:4' AS tags FROM part")
def sam_tags(spark, sf):
    p, c = adapters.table(spark, sf, "part"), F.col
    old = F.concat(F.when(c("p_size") % 2 == 0, F.concat(F.lit("NM:i:"), c("p_size").cast("string"), F.lit("\t"))).otherwise(""), F.lit("AS:i:"), (c("p_size") % 7).cast("string"), F.when(c("p_size") % 3 == 0, "\tNH:i:9").otherwise(""))
    return p.select(c("p_partkey").alias("k"), names.tag(old, "NM").alias("nm"), names.tag(old, "AS").cast("long").alias("score"), names.set_tag(old, "NH", "i", F.lit(4)).alias("tags"))


@query("SELECT a.p_partkey AS k, CAST(CASE WHEN a.p_partkey % 5 = 4 THEN -1 ELSE greatest(abs(a.p_size - b.p_size), abs(a.p_size * 4 - b.p_size * 4)) END AS BIGINT) AS distance, CAST(greatest(0, least(a.p_size + 10, b.p_size + 20) - greatest(a.p_size, b.p_size) + 1) + greatest(0, least(a.p_size + 40, b.p_size + 20) - greatest(a.p_size + 30, b.p_size) + 1) AS BIGINT) AS shared FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1")
def distances(spark, sf):
    """Neighbouring parts as alignments: distance, and bases that a spliced one shares with the next."""
    p, c = adapters.table(spark, sf, "part"), F.col
    a, b = p.select(c("p_partkey").alias("k"), c("p_size").cast("long").alias("x")), p.select((c("p_partkey") - 1).alias("k"), c("p_size").cast("long").alias("y"))
    j = a.join(b, "k")
    block = lambda s, e: F.struct(s.alias("start"), e.alias("end"))
    blocks = F.array(block(c("x"), c("x") + 10), block(c("x") + 30, c("x") + 40))
    other = F.when(c("k") % 5 == 4, "d").otherwise("c")
    return j.select("k", distance(F.lit("c"), c("x"), c("x") * 4, other, c("y"), c("y") * 4).cast("long").alias("distance"), blocks_overlap(blocks, c("y"), c("y") + 20).alias("shared"))


@query("SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS whole, p_retailprice AS number FROM part")
def parsed_numbers(spark, sf):
    p, c = adapters.table(spark, sf, "part"), F.col
    return p.select(c("p_partkey").alias("k"), names.to_int(c("p_size").cast("string")).alias("whole"), names.to_double(c("p_retailprice").cast("string")).alias("number"))


# --- text formats: written and read again -------------------------------------------------------


def _written(spark: SparkSession, rows: DataFrame, suffix: str = "") -> str:
    """Lines (``value``) of a frame as text files."""
    path = settled.folder(spark, "text") + suffix
    with settled.cleared(spark):
        rows.select("value").write.text(path)
    return path


def _tabs(*columns) -> F.Column:
    return F.concat_ws("\t", *[x.cast("string") if not isinstance(x, str) else F.lit(x) for x in columns])


_SAM = "SELECT CAST(l_orderkey AS VARCHAR) AS fragment_name, CAST(1 + (l_linenumber - 1) % 2 AS BIGINT) AS read_index, 'chr' || CAST(l_partkey % 5 AS VARCHAR) AS ref, l_partkey * 20 AS pos, CAST(round(l_discount * 100) AS BIGINT) AS nm, CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey END AS BIGINT) AS hi FROM lineitem WHERE l_returnflag <> 'N'"


@query(_SAM)
def sam_rows(spark, sf):
    """SAM rows with a header, unmapped ones left out."""
    li, c = adapters.table(spark, sf, "lineitem"), F.col
    two, unmapped = c("l_linenumber") % 2 == 0, c("l_returnflag") == "N"
    flag = F.lit(1) + F.when(two, 128).otherwise(64) + F.when(unmapped, 4).otherwise(0)
    name = F.concat(c("l_orderkey").cast("string"), F.when(two, "/2").otherwise("/1"))
    ref = F.concat(F.lit("chr"), (c("l_partkey") % 5).cast("string"))
    row = _tabs(name, flag, ref, c("l_partkey") * 20, F.lit(20), F.lit("4M"), "=", c("l_partkey") * 20, F.lit(0), "ACGT", "IIII", F.concat(F.lit("NM:i:"), F.round(c("l_discount") * 100).cast("int").cast("string")), F.when(two, F.concat(F.lit("HI:i:"), c("l_suppkey").cast("string"))))
    lines = li.select(row.alias("value")).unionByName(spark.range(5).select(_tabs("@SQ", F.concat(F.lit("SN:chr"), c("id").cast("string")), F.lit("LN:999")).alias("value")))
    return readers.sam(spark, _written(spark, lines)).select("fragment_name", c("read_index").cast("long").alias("read_index"), "ref", "pos", c("NM").cast("long").alias("nm"), c("HI").cast("long").alias("hi"))


def _sample_sam(spark, sf) -> DataFrame:
    """Lines of orders as parsed SAM rows of samples (priorities) and chunks (line status of the customer's key)."""
    a, o, c = adapters.alignments(spark, sf), adapters.table(spark, sf, "orders"), F.col
    a = a.join(o.select(c("o_orderkey").alias("fragment_id"), c("o_orderpriority").alias("sample"), (c("o_custkey") % 3).cast("int").alias("chunk")), "fragment_id")
    flag = F.when(c("strand") == "-", 16).otherwise(0)
    return a.select("sample", "chunk", c("fragment_id").cast("string").alias("fragment_name"), F.concat(c("fragment_id").cast("string"), F.lit("/"), c("read_index").cast("string")).alias("query_name"), flag.alias("flag"), c("chrom").alias("ref"), "pos", "cigar", F.lit("*").alias("mate_ref"), F.lit(0).cast("long").alias("mate_pos"), "read_index", c("nm").alias("NM"), F.lit(None).cast("int").alias("HI"), F.lit(None).cast("int").alias("AS"), c("aln_no").alias("row_no"))


_BY_SAMPLE = _count_sql("gene", tail="SELECT o_orderpriority AS sample, object_id AS id, CAST(sum(c) AS DOUBLE) AS count FROM per JOIN orders ON o_orderkey = per.fragment_id GROUP BY 1, 2").replace("cnt AS (SELECT object_id AS id, CAST(sum(c) AS DOUBLE) AS count FROM per GROUP BY 1)", "cnt AS (SELECT 1)")
def _sample_tables(spark, sf):
    e, c = adapters.exons(spark, sf), F.col
    # The map's exon ids carry the places; strands of both are one, so that ids are told apart by place.
    objects = e.select("exon_id", c("gene_id").alias("object_id"))
    lengths = adapters.table(spark, sf, "part").groupBy(c("p_brand").alias("id")).agg(F.sum("p_size").cast("long").alias("length"))
    return genome_counts.sample_tables(settled.settled(_sample_sam(spark, sf), "sam"), objects, lengths, _PRIORITIES)  # read three times


@query(f"SELECT id, " + ", ".join(f"round(coalesce(sum(CASE WHEN sample = '{s}' THEN count END), 0.0), 6) AS s{i}" for i, s in enumerate(_PRIORITIES)) + f" FROM ({_BY_SAMPLE}) GROUP BY 1")
def sample_gene_matrix(spark, sf):
    """From SAM rows of several samples and chunks to the matrix of their counts."""
    m, _ = _sample_tables(spark, sf)
    return _rounded(m.select("id", *[F.col(f"`{s}`").alias(f"s{i}") for i, s in enumerate(_PRIORITIES)]), *[f"s{i}" for i in range(5)])


@query(f"WITH c AS ({_BY_SAMPLE}), n AS (SELECT sample, sum(count) AS reads FROM c GROUP BY 1), l AS (SELECT p_brand AS id, sum(p_size) AS length FROM part GROUP BY 1) SELECT c.id, c.sample, round(count / (length / 1000.0) / (reads / 1e6), 6) AS fpkm FROM c JOIN n USING (sample) JOIN l ON l.id = c.id")
def sample_gene_fpkm(spark, sf):
    return _rounded(_sample_tables(spark, sf)[1].select("id", "sample", "fpkm"), "fpkm")


@query("SELECT 't' || CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS BIGINT) AS length FROM part")
def reference_lengths(spark, sf):
    """Lengths from a header for even parts, from a table for odd ones."""
    p, c = adapters.table(spark, sf, "part"), F.col
    t, n = F.concat(F.lit("t"), c("p_partkey").cast("string")), c("p_size").cast("string")
    lines = p.select(F.when(c("p_partkey") % 2 == 0, _tabs("@SQ", F.concat(F.lit("SN:"), t), F.concat(F.lit("LN:"), n))).otherwise(_tabs(t, n)).alias("value"))
    return readers.lengths(spark, _written(spark, lines))


@query(sql("aln0 aln blk", "SELECT fragment_id, CAST(aln_no AS BIGINT) AS aln_no, CAST(block_idx AS BIGINT) AS block_idx, CAST(last_block AS BIGINT) AS last_block, chrom, bs AS block_start, be AS block_end, CAST(al AS BIGINT) AS aligned_len, CAST(read_index AS BIGINT) AS read_index FROM blk"))
def bed_blocks(spark, sf):
    """Blocks as BED rows with the block grammar of their names."""
    b, c = alignments.blocks(adapters.alignments(spark, sf)), F.col
    name = writers.block_name(c("fragment_id").cast("string"), c("aln_no"), c("aligned_len"), c("ins"), c("del"), c("block_idx"), c("last_block"), c("paired"), c("read_index"))
    got = readers.bed6(spark, _written(spark, b.select(writers.bed_line(c("chrom"), c("start"), c("end"), name, F.lit(0), c("strand")).alias("value"))))
    return got.select(c("block.fragment_id").cast("long").alias("fragment_id"), *[c(f"block.{x}").cast("long").alias(x) for x in ("aln_no", "block_idx", "last_block", "aligned_len", "read_index")], "chrom", c("start").alias("block_start"), c("end").alias("block_end"))


@query(sql("aln0 aln blk exon hit", "SELECT DISTINCT fragment_id, chrom, bs - 1 AS start0, exon_id, CAST(ov AS BIGINT) AS overlap FROM hit"))
def intersection_rows(spark, sf):
    got = readers.intersections(spark, _written(spark, projection.genomic_bed(intervals.interval_join(alignments.blocks(adapters.alignments(spark, sf)), adapters.exons(spark, sf))).withColumnRenamed("line", "value")))
    return got.select(F.col("name").cast("long").alias("fragment_id"), "chrom", "start0", "exon_id", F.col("overlap").cast("long").alias("overlap")).distinct()


@query(sql("aln0 aln", "SELECT CAST(fragment_id AS VARCHAR) || '/1' AS fragment, CAST(count(*) AS BIGINT) AS num_alignments, CAST(CASE WHEN count(*) > 1 THEN 3 ELSE 1 END AS BIGINT) AS multiplicity FROM aln GROUP BY 1"))
def weight_rows(spark, sf):
    """Weight rows whose read index is written twice are cleaned."""
    n, c = adapters.alignments(spark, sf).groupBy("fragment_id").count(), F.col
    lines = n.select(_tabs(F.concat(c("fragment_id").cast("string"), F.when(c("fragment_id") % 2 == 0, "/1/1").otherwise("/1")), c("count"), F.lit(0), F.when(c("count") > 1, "paired-end").otherwise("single-read")).alias("value"))
    return _long(readers.weights(spark, _written(spark, lines)).select("fragment", "num_alignments", "multiplicity"), "num_alignments", "multiplicity")


@query("SELECT 'e' || CAST(p_partkey AS VARCHAR) AS exon_id, p_brand AS object_id, CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_brand END AS internal_id FROM part")
def object_map_rows(spark, sf):
    p, c = adapters.table(spark, sf, "part"), F.col
    lines = p.select(_tabs(F.concat(F.lit("e"), c("p_partkey").cast("string")), c("p_brand"), F.when(c("p_size") % 2 == 0, c("p_type"))).alias("value")).unionByName(spark.range(1).select(_tabs("Exon Id", "Object").alias("value")))
    return readers.object_map(spark, _written(spark, lines))


@query("SELECT CASE WHEN p_size % 2 = 0 THEN 'g-junction-1-2' ELSE 't' || CAST(p_partkey AS VARCHAR) END AS transcript_id, p_brand AS gene_id, CAST(p_size AS BIGINT) AS position FROM part")
def transcript_map_rows(spark, sf):
    p, c = adapters.table(spark, sf, "part"), F.col
    lines = p.select(_tabs(F.when(c("p_size") % 2 == 0, "g-junction-1-2:5").otherwise(F.concat(F.lit("t"), c("p_partkey").cast("string"))), c("p_brand"), c("p_size")).alias("value"))
    return readers.transcript_map(spark, _written(spark, lines)).select("transcript_id", "gene_id", "position")


@query(sql("exon", "SELECT gene_id, 'T' || name AS transcript_id, CAST(CASE WHEN es % 40 = 1 THEN 3 END AS BIGINT) AS exon_number, CASE WHEN ee % 3 = 0 THEN 'own' || CAST(es AS VARCHAR) ELSE exon_id END AS exon_id FROM exon"))
def gtf_rows(spark, sf):
    e, c = adapters.exons(spark, sf), F.col
    attributes = F.concat(F.lit('gene_id "'), c("gene_id"), F.lit('"; transcript_id "T'), c("name"), F.lit('";'), F.when(c("start") % 40 == 1, ' exon_number "3";').otherwise(""), F.when(c("end") % 3 == 0, F.concat(F.lit(' exon_id "own'), c("start").cast("string"), F.lit('";'))).otherwise(""))
    lines = e.select(_tabs(c("chrom"), "s", "exon", c("start"), c("end"), ".", c("strand"), ".", attributes).alias("value")).unionByName(spark.range(1).select(F.lit("#!version 1").alias("value")))
    got = readers.gtf(spark, _written(spark, lines))
    return _long(got.select("gene_id", "transcript_id", "exon_number", "exon_id"), "exon_number")


@query("SELECT CAST(p_partkey AS VARCHAR) AS fragment_id, CAST(1 + p_partkey % 2 AS BIGINT) AS read_index, CAST(CASE WHEN p_size % 3 = 0 THEN p_size ELSE 1 END AS BIGINT) AS multiplicity, upper(repeat('acgt', 1 + p_size % 5)) AS seq, repeat('@', 4 + 4 * (p_size % 5)) AS qual FROM part")
def fastq_rows(spark, sf):
    """FASTQ entries, qualities that look like ids among them."""
    p, c = adapters.table(spark, sf, "part"), F.col
    n = (1 + c("p_size") % 5).cast("int")
    head = F.concat(F.lit("@"), c("p_partkey").cast("string"), F.when(c("p_partkey") % 2 == 0, "/1").otherwise("/2"), F.when(c("p_size") % 3 == 0, F.concat(F.lit(" "), c("p_size").cast("string"))).otherwise(""))
    entry = F.concat_ws("\n", head, F.repeat(F.lit("acgt"), n), F.lit("+"), F.repeat(F.lit("@"), 4 * n))
    got = readers.fastq(spark, _written(spark, p.select(entry.alias("value"))))
    return _long(got.select("fragment_id", "read_index", "multiplicity", "seq", "qual"), "read_index", "multiplicity")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS DOUBLE) AS count FROM part WHERE p_size <> 25")
def count_rows(spark, sf):
    p, c = adapters.table(spark, sf, "part"), F.col
    lines = p.select(_tabs(c("p_partkey"), F.when(c("p_size") == 25, 0).otherwise(c("p_size"))).alias("value")).unionByName(spark.range(1).select(_tabs("Id", "s").alias("value")))
    return readers.counts(spark, _written(spark, lines), nonzero=True).select("id", "count")


@query("SELECT o_orderpriority AS sample, CAST(sum(o_custkey) AS BIGINT) AS reads FROM orders GROUP BY 1")
def read_number_rows(spark, sf):
    o, c = adapters.table(spark, sf, "orders"), F.col
    return readers.read_numbers(spark, _written(spark, o.select(_tabs(c("o_orderpriority"), F.concat(F.lit("C"), c("o_orderkey").cast("string")), c("o_custkey")).alias("value"))))


@query("SELECT DISTINCT p_brand AS chrom FROM part")
def chromosome_rows(spark, sf):
    p, c = adapters.table(spark, sf, "part"), F.col
    return readers.chromosomes(spark, _written(spark, p.select(_tabs(c("p_brand"), c("p_partkey"), c("p_size")).alias("value"))))


@query("WITH r AS (SELECT 'S' || CAST(s_nationkey AS VARCHAR) AS sample, 'f' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS fastq_name FROM supplier) SELECT sample, fastq_name, CASE WHEN count(*) OVER (PARTITION BY sample) > 1 THEN sample || '_' || CAST(row_number() OVER (PARTITION BY sample ORDER BY fastq_name) AS VARCHAR) ELSE sample END AS link FROM r")
def sample_rows(spark, sf):
    c = F.col
    s = adapters.table(spark, sf, "supplier").select(F.concat(F.lit("S"), c("s_nationkey").cast("string")).alias("Sample Name"), F.lit("/d").alias("Fastq path"), F.concat(F.lit("f"), F.lpad(c("s_suppkey").cast("string"), 6, "0")).alias("Fastq name"))
    path = settled.folder(spark, "samples")
    writers.tsv(s, path, header=True)
    return readers.samples(spark, path).select("sample", "fastq_name", "link")


@query(sql("aln0", "SELECT CAST(fragment_id AS VARCHAR) AS fragment_name, CAST(read_index AS BIGINT) AS read_index, chrom AS ref, pos, CASE WHEN spliced THEN CAST(len AS VARCHAR) || 'M' || CAST(gap AS VARCHAR) || 'N' || CAST(len2 AS VARCHAR) || 'M' ELSE CAST(len AS VARCHAR) || 'M' END AS cigar, CAST(nm AS BIGINT) AS nm FROM aln0"))
def sam_file_rows(spark, sf):
    """A SAM file with header, written by place and read again."""
    c, a = F.col, adapters.alignments(spark, sf)
    name = c("fragment_id").cast("string")
    rows = a.select(F.concat(name, F.lit("/"), c("read_index").cast("string")).alias("query_name"), name.alias("fragment_name"), "read_index", F.when(c("strand") == "-", 16).otherwise(0).alias("flag"), c("chrom").alias("ref"), "pos", F.lit(20).alias("mapq"), "cigar", F.lit("*").alias("mate_ref"), F.lit(0).cast("long").alias("mate_pos"), F.lit("0").alias("insert_size"), F.lit("*").alias("seq"), F.lit("*").alias("qual"), F.concat(F.lit("NM:i:"), c("nm").cast("string")).alias("tags"))
    path = settled.folder(spark, "sam")
    writers.sam_file(rows, rows.select(c("ref").alias("id")).distinct().withColumn("length", F.lit(999)), path, by_place=True)
    return readers.sam(spark, path).select("fragment_name", c("read_index").cast("long").alias("read_index"), "ref", "pos", "cigar", c("NM").cast("long").alias("nm"))


@query(sql("aln0 aln", "SELECT strand, count(DISTINCT chrom) AS \"references\", count(DISTINCT fragment_id * 10 + read_index) AS reads FROM aln GROUP BY 1"))
def hit_references(spark, sf):
    from readloom.operators import stats

    return stats.references(adapters.alignments(spark, sf), ["strand"])


@query("WITH t AS (SELECT count(*) AS n, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS m, count(DISTINCT l_orderkey) AS f, count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END) AS g FROM lineitem) SELECT round(100.0 * m / n, 2) AS read_percent, round(100.0 * g / f, 2) AS fragment_percent FROM t")
def running_percentages(spark, sf):
    from readloom.operators import stats

    li = adapters.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("fragment_id"), (F.col("l_linestatus") == "F").alias("mapped"))
    return stats.running_totals(li).select("read_percent", "fragment_percent")


@query("""WITH a AS (SELECT p_partkey AS k, 1 + p_size % 30 AS l, 1 + p_size % 30 + p_partkey % 25 AS r, [{'n': 4, 'o': 'S'}, {'n': 5 + p_partkey % 9, 'o': 'M'}, {'n': 1 + p_partkey % 3, 'o': 'I'}, {'n': 6, 'o': 'M'}, {'n': 1 + p_size % 4, 'o': 'D'}, {'n': 20, 'o': 'M'}, {'n': 7, 'o': 'N'}, {'n': 9, 'o': 'M'}, {'n': 3, 'o': 'S'}] AS ops FROM part),
o AS (SELECT k, l, r, i, x.n AS n, x.o AS o, coalesce(sum(CASE WHEN x.o IN ('M', 'D', 'N') THEN x.n END) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS z, coalesce(sum(CASE WHEN x.o IN ('M', 'I', 'S') THEN x.n END) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS y FROM (SELECT k, l, r, unnest(range(1, 10)) AS i, unnest(ops) AS x FROM a)),
b AS (SELECT k, i, o, y, m FROM (SELECT *, unnest(range(1, n + 1)) AS m FROM o) WHERE CASE WHEN o IN ('M', 'D', 'N') THEN z + m ELSE z END BETWEEN l AND r),
g AS (SELECT k, i, o, count(*) AS n, min(CASE WHEN o IN ('M', 'I', 'S') THEN y + m END) AS f FROM b GROUP BY 1, 2, 3)
SELECT a.k, coalesce(string_agg(CAST(n AS VARCHAR) || o, '' ORDER BY i), '') AS part, CAST(coalesce(sum(CASE WHEN o IN ('M', 'I', 'S') THEN n END), 0) AS BIGINT) AS bases, CAST(CASE WHEN sum(CASE WHEN o IN ('M', 'I', 'S') THEN n END) > 0 THEN min(f) ELSE 0 END AS BIGINT) AS first FROM a LEFT JOIN g ON g.k = a.k GROUP BY a.k""")
def cigar_parts(spark, sf):
    """Operations of clipped, gapped alignments inside an interval of their reference, and the bases of the read that they take."""
    p, c = adapters.table(spark, sf, "part"), F.col
    own = {"m": 5 + c("p_partkey") % 9, "i": 1 + c("p_partkey") % 3, "d": 1 + c("p_size") % 4}
    text = F.concat(F.lit("4S"), own["m"].cast("string"), F.lit("M"), own["i"].cast("string"), F.lit("I6M"), own["d"].cast("string"), F.lit("D20M7N9M3S"))
    left = (1 + c("p_size") % 30).cast("int")
    got = p.select(c("p_partkey").alias("k"), cigar.cut(cigar.parse(text), left, (left + c("p_partkey") % 25).cast("int")).alias("x"))
    return got.select("k", cigar.render(c("x.ops")).alias("part"), c("x.bases").cast("long").alias("bases"), F.when(c("x.bases") > 0, c("x.begin") + 1).otherwise(0).cast("long").alias("first"))


@query(sql("aln0", f", {_KALN}, {_KINDS} SELECT DISTINCT fragment_id, CAST(read_index AS BIGINT) AS read_index, CAST(1 AS BIGINT) AS \"primary\" FROM (SELECT fragment_id, read_index FROM kproj WHERE kind <> 'genome' UNION SELECT fragment_id, read_index FROM kalns WHERE kind = 'genome') q"))
def primary_rows(spark, sf):
    """Of the rows of a read one is primary."""
    rows = settled.settled(_kinds(spark, sf), "kinds")
    got = references.genome_rows(rows, _references(spark, sf), rows.select("fragment_id").distinct().withColumn("reads", F.lit(1))).where("ref <> '*'")
    return got.groupBy(F.col("fragment_id").cast("long").alias("fragment_id"), F.col("read_index").cast("long").alias("read_index")).agg(F.sum((~flags.has(F.col("flag"), "secondary")).cast("long")).alias("primary"))
