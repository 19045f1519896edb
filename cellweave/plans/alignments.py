"""Queries over alignments. Line items stand in for alignment records and parts for features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators import features as X
from cellweave.operators import intervals as I
from cellweave.operators import metrics
from cellweave.plans.common import table


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    start = F.floor("l_extendedprice").cast("long")
    return t.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("read_id"),
        F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"),
        start.alias("start"),
        (start + F.col("l_quantity").cast("long") * 20).alias("end"),
        F.when(F.col("l_returnflag") == "A", "+").when(F.col("l_returnflag") == "R", "-").otherwise(".").alias("strand"),
        F.col("l_quantity").cast("int").alias("score"),
    )


def _genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    start = F.floor(F.col("p_retailprice") * 40).cast("long")
    return p.select(
        F.concat(F.lit("chr"), (F.col("p_partkey") % 5).cast("string")).alias("chrom"),
        start.alias("start"),
        (start + F.col("p_size") * 30).alias("end"),
        F.when(F.col("p_size") % 3 == 0, "+").when(F.col("p_size") % 3 == 1, "-").otherwise(".").alias("strand"),
        F.concat(F.lit("gene"), F.col("p_partkey").cast("string")).alias("label"),
        F.concat(F.lit("tx"), F.floor(F.col("p_partkey") / 2).cast("string")).alias("transcript_id"),
    )


def gene_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.min(F.struct("chrom", "start", "end", "strand", "score")).alias("a")  # one alignment for each read
    reads = _reads(spark, sf_dir).groupBy("read_id").agg(first).select("read_id", "a.*")
    return I.assign_genes(reads, _genes(spark, sf_dir).drop("transcript_id"), 20, width=1000)


def tx_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items of an order are the blocks of one read."""
    blocks = _reads(spark, sf_dir).withColumn("read_id", F.floor(F.col("read_id") / 10)).distinct()
    exons = _genes(spark, sf_dir).withColumn("label", F.concat(F.lit("g"), F.col("transcript_id")))
    return I.assign_transcripts(blocks, exons, 20, width=1000)


def region_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _reads(spark, sf_dir).distinct()
    return reads.groupBy(I.region_name(F.col("chrom"), F.col("start"), F.col("end") - 1).alias("region")).agg(F.count("*").alias("n"))


def _cigars(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n = F.col("l_quantity").cast("long").cast("string"), F.col("l_linenumber").cast("string")
    cigar = F.concat(n, F.lit("S"), q, F.lit("M"), F.lit("2D"), n, F.lit("M"), F.lit("10"), n, F.lit("N"), q, F.lit("M"), n, F.lit("I5M"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.floor("l_extendedprice").cast("long").alias("start"), cigar.alias("cigar"))


def cigar_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned blocks of each record."""
    rows = _cigars(spark, sf_dir)
    return rows.select("l_orderkey", "l_linenumber", F.explode(I.split_blocks(F.col("start"), F.col("cigar"))).alias("b")).select(
        "l_orderkey", "l_linenumber", F.col("b.start").alias("block_start"), F.col("b.end").alias("block_end")
    )


def cigar_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans on the reference and on the read."""
    c = F.col("cigar")
    return _cigars(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", (F.col("start") + I.reference_length(c)).alias("ref_end"),
        I.query_length(c, False).alias("aligned"), I.query_length(c, True).alias("read_length"),
    )


def feature_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a read and each of its line items a hit."""
    t = table(spark, sf_dir, "lineitem")
    hits = t.select(
        F.col("l_orderkey").alias("read_id"),
        F.concat(F.lit("g"), (F.col("l_partkey") % 50).cast("string")).alias("gene"),
        X.mask_class(F.substring("l_returnflag", 1, 1), F.concat(F.lit("t"), F.col("l_partkey").cast("string"))).alias("transcript"),
        (F.floor(F.col("l_quantity") / 10)).alias("score"),
        (F.round(F.col("l_discount") * 10, 2)).alias("query_cov"),
        (F.round(F.col("l_tax") * 12, 2)).alias("transcript_cov"),
        (F.col("l_suppkey") % 3).alias("mapq"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ord"),
    )
    reads = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("read_id"), (F.col("o_custkey") % 60).alias("genome_mapq"))
    return X.select_features(hits, reads)


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item is a tagged record of its order; chromosomes come from the customer of the order."""
    features = feature_select(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("read_id"), (F.col("o_custkey") % 60).alias("mapq"), (F.col("o_custkey") % 3).cast("string").alias("chrom"))
    known = orders.filter("chrom <> '2'").join(features, "read_id")
    return X.assignment_status(orders, known)


def assignment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statuses(spark, sf_dir)


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.status_counts(_statuses(spark, sf_dir))


def alignment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by their flags: unmapped 4, secondary 256, supplementary 2048; orders of even number stand for reads in final cells."""
    flag = F.when(F.col("l_returnflag") == "A", 4).when(F.col("l_linenumber") > 5, 2048).when(F.col("l_linenumber") == 5, 256).otherwise(0)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("read_id"), flag.alias("flag"))
    final = table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("read_id"))
    return metrics.alignment_summary(rows, final)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment records of line items with flags, places and CIGAR strings."""
    q = F.col("l_quantity").cast("long")
    flag = F.when(F.col("l_returnflag") == "A", 4).otherwise(0) + F.when(F.col("l_linenumber") % 2 == 0, 16).otherwise(0) + F.when(F.col("l_linenumber") == 1, 64).when(F.col("l_linenumber") == 2, 128).otherwise(0)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("read_id"), flag.alias("flag"), F.when(F.col("l_suppkey") % 7 != 0, F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string"))).alias("chrom"),
        F.floor("l_extendedprice").cast("long").alias("start"), F.concat(q.cast("string"), F.lit("M5I"), (q * 19).cast("string"), F.lit("M3S")).alias("cigar"), F.col("l_quantity").cast("int").alias("mapq"),
    )


def bed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.bed_records(_records(spark, sf_dir))


def tag_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags and genes of the records in one plan; orders carry the tags, those of priority 1 none."""
    tags = table(spark, sf_dir, "orders").filter("o_orderpriority NOT LIKE '1%'").select(
        F.col("o_orderkey").cast("string").alias("read_id"), F.concat(F.lit("cell"), (F.col("o_custkey") % 50).cast("string")).alias("barcode"), F.col("o_orderstatus").alias("umi")
    )
    return I.tag_and_assign(_records(spark, sf_dir), tags, _genes(spark, sf_dir).drop("transcript_id"), 20, width=1000)


def candidate_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverages of the hits to candidates: parts are assembled transcripts, a third of them of no reference."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    tmap = p.select(F.concat(F.lit("q"), key.cast("string")).alias("qry_id"), F.concat(F.lit("T"), F.floor(key / 2).cast("string")).alias("ref_id"), F.substring(F.lit("=cjiyps"), (key % 7 + 1).cast("int"), F.lit(1)).alias("class_code"))
    reference = p.filter("p_partkey % 3 <> 0").select(F.concat(F.lit("T"), key.cast("string")).alias("transcript_id"), F.concat(F.lit("G"), (key % 40).cast("string")).alias("gene"))
    lengths = p.select(F.concat(F.lit("q"), key.cast("string")).alias("query_id"), (F.col("p_size") * 40).alias("length"))
    q = F.col("l_quantity").cast("long")
    alignments = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("read_id"), F.concat(F.lit("q"), F.col("l_partkey").cast("string")).alias("query_id"), F.col("l_linenumber").alias("ord"),
        F.when(F.col("l_linenumber") % 3 != 0, q).alias("score"), F.concat(q.cast("string"), F.lit("M5I"), (q * 19).cast("string"), F.lit("M3S")).alias("cigar"), F.lit(1).alias("mapq"),
    )
    out = X.hit_features(alignments, X.candidates(tmap, reference), lengths)
    return out.select("read_id", "ord", "gene", "transcript", "score", F.round("query_cov", 9).alias("query_cov"), F.round("transcript_cov", 9).alias("transcript_cov"))


def gtf_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts and their genes from attribute texts made of the parts table."""
    p = table(spark, sf_dir, "part")
    gid = F.concat(F.lit("G"), (F.col("p_partkey") % 40).cast("string"))
    tid = F.concat(F.lit("T"), F.floor(F.col("p_partkey") / 3).cast("string"))
    name = F.when(F.col("p_size") % 4 == 0, F.lit(".")).otherwise(F.concat(F.lit("N"), F.col("p_size").cast("string")))
    feature = F.when(F.col("p_partkey") % 3 == 0, F.when(F.col("p_size") % 2 == 0, "mRNA").otherwise("Transcript")).when(F.col("p_partkey") % 3 == 1, "exon").otherwise("gene")
    text = F.concat(F.lit('gene_id "'), gid, F.lit('"; transcript_id "'), tid, F.when(F.col("p_size") % 5 == 0, '"; genename "').otherwise('"; gene_name "'), name, F.lit('";'))
    return X.transcript_reference(p.select(feature.alias("feature"), text.alias("attributes")))


QUERIES = {
    f.__name__: f
    for f in (gene_overlap, tx_support, region_bin, cigar_blocks, cigar_lengths, feature_select, assignment_status, status_counts, alignment_summary, bed_records, tag_genes, candidate_hits, gtf_reference)
}

_R = """WITH r AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS read_id, 'chr' || (l_suppkey % 5) AS chrom, CAST(floor(l_extendedprice) AS BIGINT) AS s,
    CAST(floor(l_extendedprice) AS BIGINT) + CAST(l_quantity AS BIGINT) * 20 AS e, CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' ELSE '.' END AS strand,
    CAST(l_quantity AS INTEGER) AS score FROM lineitem),
g AS (SELECT 'chr' || (p_partkey % 5) AS chrom, CAST(floor(p_retailprice * 40) AS BIGINT) AS s, CAST(floor(p_retailprice * 40) AS BIGINT) + p_size * 30 AS e,
    CASE p_size % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS strand, 'gene' || p_partkey AS label, 'tx' || (p_partkey // 2) AS tx FROM part),
"""
_OVERLAP = """FROM {r} AS r JOIN g ON r.chrom = g.chrom AND r.s < g.e AND g.s < r.e AND NOT (r.strand IN ('+', '-') AND g.strand IN ('+', '-') AND r.strand <> g.strand)"""
_STATUS = """CASE WHEN {sc} < 20 THEN 'Unassigned_mapq' WHEN n IS NULL THEN 'Unassigned_no_features' WHEN n > 1 THEN 'Unassigned_ambiguous' ELSE 'Assigned' END"""

_FEATURES = """WITH h AS (SELECT l_orderkey AS read_id, 'g' || (l_partkey % 50) AS gene, 't' || l_partkey AS transcript, floor(l_quantity / 10) AS score, round(l_discount * 10, 2) AS qc,
        round(l_tax * 12, 2) AS tc, l_suppkey % 3 AS mapq, l_linenumber AS o, l_partkey AS o2, l_suppkey AS o3 FROM lineitem),
    k AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS s2, lead(qc) OVER w AS q2, lead(tc) OVER w AS t2 FROM h WINDOW w AS (PARTITION BY read_id ORDER BY score DESC, qc DESC, tc DESC, o, o2, o3)),
    j AS (SELECT o_orderkey AS read_id, o_custkey % 60 AS gm, k.* EXCLUDE (read_id) FROM orders LEFT JOIN k ON o_orderkey = k.read_id AND rn = 1),
    f0 AS (SELECT read_id, rn, CASE WHEN rn IS NULL OR (s2 IS NULL AND mapq = 0) OR gm < 30 THEN '-' ELSE gene END AS gene,
        CASE WHEN rn IS NULL OR (s2 IS NULL AND mapq = 0) THEN '-' WHEN s2 IS NULL THEN transcript
            WHEN score <> s2 OR qc <> q2 THEN CASE WHEN qc >= 0.4 AND tc >= 0.4 THEN transcript ELSE '-' END
            WHEN tc <> t2 AND tc > 0.8 THEN transcript ELSE '-' END AS transcript FROM j),
    fs AS (SELECT read_id, gene, transcript, CASE WHEN rn IS NULL THEN 'no_reference_candidate' WHEN gene = '-' AND transcript = '-' THEN 'ambiguous_or_zero_transcript_mapq' ELSE 'candidate' END AS reason FROM f0)"""
_STATUSES = """, s0 AS (SELECT o_orderkey AS read_id, o_custkey % 60 AS mapq, coalesce(gene, '-') AS g, coalesce(transcript, '-') AS t, coalesce(reason, 'no_reference_candidate') AS reason
        FROM orders LEFT JOIN fs ON fs.read_id = o_orderkey AND o_custkey % 3 <> 2),
    st AS (SELECT read_id, mapq, CASE WHEN g <> '-' THEN 'Assigned' WHEN mapq < 30 THEN 'Unassigned_mapq' WHEN reason = 'ambiguous_or_zero_transcript_mapq' THEN 'Unassigned_ambiguous' ELSE 'Unassigned_no_features' END AS gene_status,
        CASE WHEN g = '-' THEN 'NA' ELSE g END AS gene, CASE WHEN t <> '-' THEN 'Assigned' WHEN reason <> 'no_reference_candidate' THEN 'Unassigned_ambiguous' ELSE 'Unassigned_no_features' END AS transcript_status,
        CASE WHEN t = '-' THEN 'NA' ELSE t END AS transcript, reason FROM s0)"""
_REC = """WITH rec AS (SELECT CAST(l_orderkey AS VARCHAR) AS read_id, l_linenumber AS n, 'chr' || (l_suppkey % 5) AS chrom, CAST(floor(l_extendedprice) AS BIGINT) AS start, CAST(l_quantity AS BIGINT) AS q, CAST(l_quantity AS INTEGER) AS mapq
    FROM lineitem WHERE l_returnflag <> 'A' AND l_suppkey % 7 <> 0)"""

ORACLES = {
    "gene_overlap": _R + "r1 AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY chrom, s, e, strand, score) = 1), "
    "o AS (SELECT r.read_id, label, least(r.e, g.e) - greatest(r.s, g.s) AS ov " + _OVERLAP.format(r="r1") + """),
        b AS (SELECT read_id, count(*) AS n, max(label) AS label FROM (SELECT *, max(ov) OVER (PARTITION BY read_id) AS m FROM o) WHERE ov = m GROUP BY read_id)
        SELECT r.read_id, st AS status, score, CASE WHEN st = 'Assigned' THEN label ELSE 'NA' END AS gene FROM (SELECT r.read_id, score, label, """ + _STATUS.format(sc="score") + """ AS st
        FROM r1 AS r LEFT JOIN b ON r.read_id = b.read_id) AS r""",
    "tx_support": _R + "rb AS (SELECT DISTINCT read_id // 10 AS read_id, chrom, s, e, strand, score FROM r), sc AS (SELECT read_id, max(score) AS score FROM rb GROUP BY read_id), "
    "o AS (SELECT r.read_id, tx, sum(least(r.e, g.e) - greatest(r.s, g.s)) AS ov " + _OVERLAP.format(r="rb") + """ GROUP BY ALL),
        b AS (SELECT read_id, count(*) AS n, max(tx) AS tx FROM (SELECT *, max(ov) OVER (PARTITION BY read_id) AS m FROM o) WHERE ov = m GROUP BY read_id)
        SELECT read_id, st AS status, score, CASE WHEN st = 'Assigned' THEN 'g' || tx ELSE 'NA' END AS gene, CASE WHEN st = 'Assigned' THEN tx ELSE 'NA' END AS transcript_id
        FROM (SELECT sc.read_id, score, tx, """ + _STATUS.format(sc="score") + " AS st FROM sc LEFT JOIN b ON sc.read_id = b.read_id)",
    "region_bin": _R + """x AS (SELECT chrom, (s + e - 1) // 2 AS mid FROM r)
        SELECT chrom || '_' || (mid // 1000) * 1000 || '_' || ((mid + 999) // 1000) * 1000 AS region, count(*) AS n FROM x GROUP BY ALL""",
    "cigar_blocks": """WITH c AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS s, CAST(l_quantity AS BIGINT) AS q, l_linenumber AS n FROM lineitem)
        SELECT l_orderkey, l_linenumber, s AS block_start, s + q + 2 + n AS block_end FROM c
        UNION ALL SELECT l_orderkey, l_linenumber, s + q + 2 + n + CAST('10' || n AS BIGINT), s + q + 2 + n + CAST('10' || n AS BIGINT) + q + 5 FROM c""",
    "cigar_lengths": """SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) + 2 * CAST(l_quantity AS BIGINT) + 7 + l_linenumber + CAST('10' || l_linenumber AS BIGINT) AS ref_end,
        2 * CAST(l_quantity AS BIGINT) + 2 * l_linenumber + 5 AS aligned, 2 * CAST(l_quantity AS BIGINT) + 3 * l_linenumber + 5 AS read_length FROM lineitem""",
    "feature_select": _FEATURES + " SELECT * FROM fs",
    "assignment_status": _FEATURES + _STATUSES + " SELECT * FROM st",
    "status_counts": _FEATURES + _STATUSES + """ SELECT counter, count(*) AS n FROM (SELECT unnest(['gene:' || gene_status, 'transcript:' || transcript_status, 'reason:' || reason]) AS counter FROM st) GROUP BY counter""",
    "bed_records": _REC + """ SELECT chrom, start, start + 20 * q AS end, read_id || CASE n WHEN 1 THEN '/1' WHEN 2 THEN '/2' ELSE '' END AS name, mapq AS score, CASE WHEN n % 2 = 0 THEN '-' ELSE '+' END AS strand FROM rec""",
    "tag_genes": _REC + """, g AS (SELECT 'chr' || (p_partkey % 5) AS chrom, CAST(floor(p_retailprice * 40) AS BIGINT) AS s, CAST(floor(p_retailprice * 40) AS BIGINT) + p_size * 30 AS e,
            CASE p_size % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS strand, 'gene' || p_partkey AS label FROM part),
        r AS (SELECT row_number() OVER () AS id, x.* FROM (SELECT DISTINCT read_id, n % 2 AS odd, n = 1 AS f1, n = 2 AS f2, chrom, start AS s, start + 20 * q AS e, CASE WHEN n % 2 = 0 THEN '-' ELSE '+' END AS strand, mapq,
            'cell' || (o_custkey % 50) AS barcode, o_orderstatus AS umi FROM rec JOIN orders ON o_orderkey = CAST(read_id AS BIGINT) WHERE o_orderpriority NOT LIKE '1%') AS x),
        o AS (SELECT id, label, least(r.e, g.e) - greatest(r.s, g.s) AS ov FROM r JOIN g ON r.chrom = g.chrom AND r.s < g.e AND g.s < r.e AND NOT (g.strand IN ('+', '-') AND r.strand <> g.strand)),
        b AS (SELECT id, count(*) AS n, max(label) AS label FROM (SELECT *, max(ov) OVER (PARTITION BY id) AS m FROM o) WHERE ov = m GROUP BY id)
        SELECT read_id, barcode, umi, st AS status, mapq AS score, CASE WHEN st = 'Assigned' THEN label ELSE 'NA' END AS gene FROM (SELECT r.*, label, """ + _STATUS.format(sc="mapq") + """ AS st FROM r LEFT JOIN b ON r.id = b.id)""",
    "candidate_hits": """WITH c AS (SELECT p_partkey, ref, substr('=cjiyps', p_partkey % 7 + 1, 1) AS code FROM (SELECT p_partkey, p_partkey // 2 AS ref FROM part) WHERE ref IN (SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0)),
        h AS (SELECT l_orderkey AS read_id, l_linenumber AS ord, l_partkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem)
        SELECT read_id, ord, 'G' || (ref % 40) AS gene, CASE WHEN code IN ('i', 'y', 'p', 's') THEN '-' ELSE 'T' || ref END AS transcript, CASE WHEN ord % 3 <> 0 THEN q ELSE 0 END AS score,
        round((20 * q + 5) / (20 * q + 8), 9) AS query_cov, round(20 * q / (p_size * 40), 9) AS transcript_cov FROM h JOIN c ON l_partkey = c.p_partkey JOIN part ON part.p_partkey = l_partkey""",
    "alignment_summary": """WITH f AS (SELECT l_orderkey AS r, l_returnflag = 'A' AS un, l_linenumber AS n FROM lineitem)
        SELECT count(*) AS records, count(*) FILTER (un) AS unmapped, count(*) FILTER (NOT un AND n < 5) AS primary_mapped, count(*) FILTER (NOT un AND n > 5) AS supplementary,
        count(DISTINCT CASE WHEN NOT un THEN r END) AS mapped_reads, count(DISTINCT CASE WHEN NOT un AND r % 2 = 0 AND r IN (SELECT o_orderkey FROM orders) THEN r END) AS mapped_in_cells FROM f""",
    "gtf_reference": """WITH p AS (SELECT p_partkey % 3 AS f, 'G' || (p_partkey % 40) AS gid, 'T' || (p_partkey // 3) AS tid, CASE WHEN p_size % 4 <> 0 THEN 'N' || p_size END AS nm FROM part),
        t AS (SELECT tid, min(nm) AS nm, min(gid) AS gid FROM p WHERE f = 0 GROUP BY tid), g AS (SELECT gid, min(nm) AS nm FROM p WHERE f = 2 GROUP BY gid),
        x AS (SELECT gid, min(nm) AS nm FROM p WHERE f = 1 GROUP BY gid)
        SELECT t.tid AS transcript_id, coalesce(t.nm, g.nm, x.nm, t.gid) AS gene FROM t LEFT JOIN g ON t.gid = g.gid LEFT JOIN x ON t.gid = x.gid""",
}
