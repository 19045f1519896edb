"""Queries over barcodes of reads, pairs of barcodes, and raw read quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions import seq as S
from cellweave.functions.text import clean_key, is_missing
from cellweave.operators import barcodes as B
from cellweave.operators import classify as K
from cellweave.operators import pairs as P
from cellweave.operators import readqc as R
from cellweave.operators.selection import select_quantiles
from cellweave.plans.common import sql_clean, table
from cellweave.session import materialize

_FLOOR = 2  # pairs of these tables have few reads


# Barcode lists


def _putative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes with the whole part of the read's mean quality in place of the barcode's."""
    quality = table(spark, sf_dir, "read_qc_reads").groupBy("read_id").agg(F.floor(F.max("mean_quality")).alias("quality"))
    rows = table(spark, sf_dir, "correction_map_3p").select("read_id", clean_key("putative_barcode").alias("barcode"))
    return rows.filter("barcode IS NOT NULL").join(quality, "read_id", "left")


def hq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.high_quality_counts(_putative(spark, sf_dir), "barcode", "quality", 10)


def observed_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = B.high_quality_counts(_putative(spark, sf_dir), "barcode", "quality", 10)
    return B.observed_whitelist(counts, table(spark, sf_dir, "whitelist_3p"), 50)


def strip_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by status, and what the fixed middle leaves of the stored corrected barcode."""
    rows = table(spark, sf_dir, "correction_map_3p").select(
        F.coalesce(clean_key("putative_barcode"), F.lit("")).alias("p"), F.coalesce(clean_key("corrected_barcode"), F.lit("")).alias("c")
    )
    outer = B.strip_middle(F.col("c"), B.BC_MIDDLE_3P)
    final = F.when(outer != "", S.revcomp_upper(outer)).otherwise("")
    return rows.groupBy(B.correction_status(F.col("p"), F.col("c")).alias("status"), final.alias("final_20bp")).agg(F.count("*").alias("n"))


def whitelist_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of 10-base codes, one code for each supplier: its number in base 4."""
    digits = F.lpad(F.conv(F.col("s_suppkey").cast("string"), 10, 4), 10, "0")
    tens = table(spark, sf_dir, "supplier").select(F.translate(digits, "0123", "ACGT").alias("ten"))
    return B.expand_whitelist(tens, "ten", B.BC_MIDDLE_5P, reverse=True)


def validity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "read_assigned_cell").select(clean_key("bc3n").alias("bc3"), clean_key("bc5n").alias("bc5"))
    out = B.validity_summary(rows, "bc3", "bc5")
    return out.select(*(F.round(c, 9).alias(c) if c.endswith("ratio") else F.col(c) for c in out.columns))


def unique_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct barcodes of each end and of both."""
    rows = table(spark, sf_dir, "readids_umi_bc_clean").select(clean_key("bc3n").alias("3p"), clean_key("bc5n").alias("5p"))
    sides = F.array(*(F.struct(F.lit(c).alias("side"), F.col(c).alias("b")) for c in ("3p", "5p")), *(F.struct(F.lit("any").alias("side"), F.col(c).alias("b")) for c in ("3p", "5p")))
    pairs = rows.select(F.explode(sides).alias("_s")).select("_s.*").filter("b IS NOT NULL").distinct()
    return pairs.groupBy("side").agg(F.count("*").alias("n"))


def fuzzy_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct putative barcode with the entry that fits best inside it."""
    values = table(spark, sf_dir, "correction_map_3p").select(clean_key("putative_barcode").alias("value"))
    return B.fuzzy_join(values, "value", table(spark, sf_dir, "whitelist_3p"), "barcode", 2)


# Read structures: reads put together from the barcodes and UMIs of the tables


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "readids_umi_bc_clean")
    clean = {c: F.coalesce(clean_key(c), F.lit("")) for c in ("bc5n", "bc3n", "putative_umi", "putative_umi_5p")}
    whole = lambda b, middle: F.when(b != "", F.concat(F.substring(b, 1, 10), F.lit(middle), F.substring(b, 11, 10))).otherwise("")
    body = F.translate(F.md5("read_id"), "0123456789abcdef", "ACGTACGTACGTACGT")
    seq = F.concat(
        whole(clean["bc5n"], B.BC_MIDDLE_5P), clean["putative_umi_5p"], body, F.lit("AAAAAAAAAAAA"), clean["putative_umi"], whole(clean["bc3n"], B.BC_MIDDLE_3P)
    )
    rows = t.select("read_id", clean["bc5n"].alias("bc5"), clean["bc3n"].alias("bc3"), seq.alias("seq")).distinct()
    return rows.withColumn("qual", F.translate(F.substring(F.repeat(F.md5("read_id"), 5), F.lit(1), F.length("seq")), "0123456789abcdef", "!#%')+-/13579;=?"))


def extract_3p(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.extract_3p(_sequences(spark, sf_dir), "seq", "qual").select("read_id", "end3.*")


def extract_5p(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.extract_5p(_sequences(spark, sf_dir), "seq", "qual", anchor="CAGCA").select("read_id", "end5.*")


def trim_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cDNA of the reads, between the structures of their valid ends."""
    rows = B.extract_5p(B.extract_3p(_sequences(spark, sf_dir), "seq", "qual"), "seq", "qual", anchor="CAGCA")
    bounds = B.trim_bounds(F.col("end3"), F.col("end5"), F.length("seq"), F.col("bc3") != "", F.col("bc5") != "")
    return rows.select("read_id", "seq", bounds.alias("b")).select(
        "read_id", F.col("b.start").alias("trim_start"), F.col("b.end").alias("trim_end"),
        S.py_slice(F.col("seq"), F.col("b.start"), F.col("b.end")).alias("cdna"),
    )


def read_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads by the outcome of the gate on length and quality."""
    scores = S.phred(F.col("qual"))
    rows = _sequences(spark, sf_dir).select(S.passes_gate(scores, 100, 7.0).alias("gate"))
    return rows.groupBy("gate").agg(F.count("*").alias("n"))


def mean_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sequences(spark, sf_dir)
    q = S.mean_quality(S.phred(F.col("qual"))).cast("double")
    return rows.select("read_id", F.round(q, 4).alias("mean_quality"), S.min_quality(F.col("qual")).alias("min_quality"))


#: The fixed middles of the barcodes serve as primers here, without edits, so that SQL can find them.
_PRIMERS = K.Primers(tso="CCTTCC", rtp="GGTAGC", tso_edits="0", rtp_edits="0", first=60, last=80, umi=25)


def classify_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.classify(_sequences(spark, sf_dir), _PRIMERS, min_length=100, min_quality=1.0).drop("qual")


def class_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.class_statistics(classify_reads(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


def _joined_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each read followed by itself, as it is or as its reverse complement."""
    rows, same = _sequences(spark, sf_dir), F.substring(F.md5("read_id"), 1, 1) < "8"
    return rows.withColumns({
        "seq": F.concat("seq", F.when(same, F.col("seq")).otherwise(S.revcomp(F.col("seq")))),
        "qual": F.concat("qual", F.when(same, F.col("qual")).otherwise(F.reverse("qual"))),
    })


def joined_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of two molecules, taken apart."""
    return K.classify(_joined_sequences(spark, sf_dir), _PRIMERS, min_length=100, min_quality=1.0).drop("qual")


def joined_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.run_summary(joined_reads(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


#: Two primers of full length, with the edits and windows that are the defaults.
_LONG_PRIMERS = K.Primers(tso="CTACACGACGCTCTTCCGATCT", rtp="AAGCAGTGGTATCAACGCAGAGTAC", umi=25)


def classify_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with primers of full length at both ends, in which the digits of a hash put edits, a third of them as their reverse
    complements. SQL has no distance to a part of a text, so that this one is tested by brute force on a small table."""
    h = F.md5("read_id")
    digit = lambda i: F.conv(F.substring(h, i, 2), 16, 10).cast("int")

    def edited(primer: str, i: int) -> Column:
        at, kind = digit(i) % len(primer), digit(i + 2) % 4
        cut = lambda skip, put: F.concat(F.substring(F.lit(primer), F.lit(1), at), F.lit(put), F.substring(F.lit(primer), at + 1 + skip, F.lit(len(primer))))
        return F.when(kind == 0, cut(1, "A")).when(kind == 1, cut(0, "G")).when(kind == 2, cut(2, "")).otherwise(F.lit(primer))

    rc = _LONG_PRIMERS.rtp.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    rows = _sequences(spark, sf_dir)
    whole = F.concat(edited(_LONG_PRIMERS.tso, 1), F.col("seq"), edited(rc, 9))
    turned = F.when(digit(17) % 3 == 0, S.revcomp(whole)).otherwise(whole)
    long = rows.select("read_id", turned.alias("seq"), F.rpad("qual", F.length(turned), "5").alias("qual"))
    return K.classify(long, _LONG_PRIMERS, min_length=100).drop("qual")


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads and bases of each output that classes go to, the merged one included."""
    rows = K.fan_out(joined_reads(spark, sf_dir))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.length("seq")).alias("bases"))


# Pairs of barcodes


def _pair_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "readids_umi_bc_clean")
    rows = t.select("read_id", *(clean_key(c).alias(c) for c in ("bc5n", "bc3n", "putative_umi", "putative_umi_5p"))).distinct()
    return P.drop_a_rich(P.valid_reads(rows, "bc5n", "bc3n", "putative_umi_5p", "putative_umi"), "putative_umi")


def _support(spark: SparkSession, sf_dir: str, reads: DataFrame | None = None) -> DataFrame:
    return P.pair_support(_pair_reads(spark, sf_dir) if reads is None else reads, "bc5n", "bc3n", "putative_umi_5p", "putative_umi")


def _kept(spark: SparkSession, sf_dir: str, reads: DataFrame | None = None) -> DataFrame:
    """Supported pairs, written once because several steps read them."""
    return materialize(P.keep_supported(_support(spark, sf_dir, reads), _FLOOR), "pairs").df


def pair_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _support(spark, sf_dir)


def pair_min_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pair_minimum(_support(spark, sf_dir), _FLOOR)


def supported_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.keep_supported(_support(spark, sf_dir), _FLOOR).orderBy(F.desc("n_reads"), "u", "v")


def top1_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.top_partner(_kept(spark, sf_dir)).withColumn("dominance", F.round("dominance", 9))


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.components(_kept(spark, sf_dir))


def component_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _kept(spark, sf_dir)
    return P.component_categories(kept, P.components(kept))


def edge_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _kept(spark, sf_dir)
    return P.prune_edges(kept, P.components(kept))


def clean_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that the table of clean reads takes over."""
    t = table(spark, sf_dir, "readids_umi_bc_clean")
    rows = t.select("read_id", *(clean_key(c).alias(c) for c in ("bc5n", "bc3n", "putative_umi", "putative_umi_5p"))).distinct()
    return P.clean_reads(rows, "bc5n", "bc3n", "putative_umi_5p", "putative_umi", _FLOOR)


def _cells(spark: SparkSession, sf_dir: str, reads: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cells of barcodes, the strongest partner of each barcode, and the pairs that pruning kept."""
    kept = _kept(spark, sf_dir, reads)
    pruned = P.prune_edges(kept, P.components(kept)).drop("kept_by")
    parts = P.components(pruned)
    return P.number_cells(P.component_categories(pruned, parts), parts), P.top_partner(pruned), pruned


def cell_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir)[0].withColumnRenamed("node", "barcode")


def read_to_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of cells that have at least 3, by the cell of their barcodes; a read with two needs a pair that was kept."""
    reads = materialize(_pair_reads(spark, sf_dir), "pair-reads").df  # three steps read them
    cells, partners, pairs = _cells(spark, sf_dir, reads)
    return P.assign_reads(reads.select("read_id", "bc5n", "bc3n"), "bc5n", "bc3n", pairs, cells, partners, 3)


# Raw read quality


def _reads_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "read_qc_reads").dropDuplicates(["read_id"])


def read_len_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = R.length_counts(_reads_once(spark, sf_dir), ["sample_name"], "read_length")
    return R.length_histogram(counts, ["sample_name"]).withColumn("mid_kb", F.round("mid_kb", 6))


def quality_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.quality_histogram(_reads_once(spark, sf_dir), ["sample_name"], "mean_quality").withColumn("mid", F.round("mid", 6))


def n50_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.n50(R.length_counts(_reads_once(spark, sf_dir), ["sample_name"], "read_length"), ["sample_name"])


def yield_above_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = R.length_counts(_reads_once(spark, sf_dir), ["sample_name"], "read_length")
    return R.yield_curve(counts, ["sample_name"]).withColumns({"x_kb": F.round("x_kb", 6), "y_gb": F.round("y_gb", 9)})


def qc_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.qc_payload(_reads_once(spark, sf_dir), ["sample_name"], "read_length", "mean_quality")


def qc_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the JSON of each sample says, parsed again."""
    p = qc_payload(spark, sf_dir).select("sample_name", F.from_json("payload", R.PAYLOAD).alias("p"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)
    return p.select(
        "sample_name", "p.n_reads",
        *(F.round(f"p.{k}.{c}", 6).alias(f"{k}_{c}") for k in ("quality", "length") for c in ("mean", "median")),
        F.col("p.length.min").alias("length_min"), F.col("p.length.max").alias("length_max"),
        F.col("p.yield_above_length.n50_bp").alias("n50_bp"), F.round("p.yield_above_length.total_gb", 9).alias("total_gb"),
        total(F.col("p.length.counts")).alias("in_length_bins"), total(F.col("p.quality.counts")).alias("in_quality_bins"),
        F.size("p.length.bins_kb").alias("length_bins"), F.size("p.quality.bins").alias("quality_bins"), F.size("p.yield_above_length.x_kb").alias("points"),
    )


def read_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads, mean and median length and quality, smallest and largest length of each sample."""
    ok = lambda c: F.when(F.col(c) >= 0, F.col(c))
    rows = materialize(_reads_once(spark, sf_dir).select("read_id", "sample_name", "read_length", "mean_quality"), "reads").df
    kinds = F.array(*(F.struct(F.lit(c).alias("k"), ok(c).cast("double").alias("v")) for c in ("read_length", "mean_quality")))
    values = rows.select("sample_name", F.explode(kinds).alias("_i")).select("sample_name", "_i.*").filter("v IS NOT NULL")
    counts = values.groupBy("sample_name", "k", "v").agg(F.count("*").alias("w"))
    middle = select_quantiles(counts, ["sample_name", "k"], "v", [0.5], weight="w", interpolate=True)
    of = lambda c: F.max(F.when(F.col("k") == c, F.col("value")))
    medians = middle.groupBy(F.col("sample_name").alias("_s")).agg(of("read_length").alias("median_length"), F.round(of("mean_quality"), 6).alias("median_quality"))
    one = rows.groupBy("sample_name").agg(
        F.count("*").alias("n_reads"),
        F.round(F.avg(ok("read_length")), 6).alias("mean_length"),
        F.min(ok("read_length")).alias("min_length"),
        F.max(ok("read_length")).alias("max_length"),
        F.round(F.avg(ok("mean_quality")), 6).alias("mean_quality"),
        F.count_if(is_missing("read_id")).alias("n_unnamed"),
    )
    return one.join(medians, F.col("sample_name").eqNullSafe(F.col("_s")), "left").drop("_s")


def trimmed_fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cDNA and its qualities of the clean reads, whole where the bounds conflict."""
    rows = B.extract_5p(B.extract_3p(_sequences(spark, sf_dir), "seq", "qual"), "seq", "qual", anchor="CAGCA")
    bounds = B.trim_bounds(F.col("end3"), F.col("end5"), F.length("seq"), F.col("bc3") != "", F.col("bc5") != "")
    clean = clean_reads(spark, sf_dir).select("read_id", F.coalesce("bc5n", F.lit("")).alias("_5"), F.coalesce("bc3n", F.lit("")).alias("_3")).distinct()
    named = lambda a, b: F.concat_ws(":", "read_id", a, b).alias("read_id")  # noqa: E731 - a read that comes with other barcodes is another one here
    reads = rows.select(named("bc5", "bc3"), "seq", "qual", bounds.alias("b"))
    return B.trimmed_reads(clean.select(named("_5", "_3")), reads, "seq", "qual", "b")


def known_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.known_barcodes(_putative(spark, sf_dir), "barcode", "quality", 10)


def bounded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 250 reads of each sample that has over 1,000."""
    rows = table(spark, sf_dir, "read_qc_reads").select("sample_name", "read_id", "read_length", "mean_quality").distinct()
    return R.sample_per_class(rows, "sample_name", "read_id", 1000, 250)


def report_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of each sample as the report shows them: thousands, two decimals, percent, compact bases."""
    rows = _reads_once(spark, sf_dir)
    ok = F.when(F.col("read_length") >= 0, F.col("read_length"))
    one = rows.groupBy("sample_name").agg(
        F.count("*").alias("n"), F.avg(ok).alias("mean"), (F.count_if(F.col("mean_quality") >= 10) / F.count("*")).alias("good"), F.sum(ok).alias("bases")
    )
    compact = F.when(F.col("bases") >= 1_000_000_000, F.concat(F.format_number(F.col("bases") / 1e9, 2), F.lit(" Gb"))).otherwise(
        F.concat(F.format_number(F.col("bases") / 1e6, 2), F.lit(" Mb"))
    )
    return one.select(
        "sample_name", F.format_number("n", 0).alias("reads"), F.format_number(F.round("mean", 2), 2).alias("mean_length"),
        F.concat(F.format_number(F.round(F.col("good") * 100, 2), 2), F.lit("%")).alias("good_reads"), compact.alias("yield"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        hq_counts, observed_whitelist, strip_fixed, whitelist_expand, validity_summary, unique_barcodes, fuzzy_correct, extract_3p, extract_5p, trim_bounds,
        read_gate, mean_quality, classify_reads, class_statistics, joined_reads, joined_summary, classify_edited, fan_out, pair_support, pair_min_auto, supported_pairs, top1_dominance, components, component_category, edge_prune, clean_reads, cell_ids, read_to_cell,
        read_len_hist, quality_hist, n50_yield, yield_above_length, qc_payload, qc_fields, read_summary, bounded_sample, report_metrics, trimmed_fastq, known_barcodes,
    )
}

_HQ = f"""WITH q AS (SELECT read_id, floor(max(mean_quality)) AS quality FROM read_qc_reads GROUP BY read_id),
h AS (SELECT barcode, count(*) AS n_reads FROM (SELECT read_id, {sql_clean('putative_barcode')} AS barcode FROM correction_map_3p) JOIN q USING (read_id)
    WHERE quality >= 10 AND barcode IS NOT NULL GROUP BY barcode)"""
_READS = f"""r AS (SELECT * FROM (SELECT DISTINCT read_id, {sql_clean('bc5n')} AS bc5n, {sql_clean('bc3n')} AS bc3n, {sql_clean('putative_umi')} AS u3,
    {sql_clean('putative_umi_5p')} AS u5 FROM readids_umi_bc_clean) WHERE (u3 IS NULL OR length(replace(u3, 'A', '')) >= 0.5 * length(u3)) AND coalesce(u3, u5) IS NOT NULL AND coalesce(bc5n, bc3n) IS NOT NULL),
s AS (SELECT least(bc5n, bc3n) AS u, greatest(bc5n, bc3n) AS v, count(*) AS n_reads, count(DISTINCT
    CASE WHEN bc5n = bc3n THEN concat(least(coalesce(u3, ''), coalesce(u5, '')), '|', greatest(coalesce(u3, ''), coalesce(u5, '')))
         WHEN bc5n < bc3n THEN concat(u5, '|', u3) ELSE concat(u3, '|', u5) END) AS n_umis
    FROM r WHERE bc5n IS NOT NULL AND bc3n IS NOT NULL GROUP BY ALL),
pm AS (SELECT greatest({_FLOOR}, coalesce(CAST(floor(quantile_cont(n_reads, 0.1)) AS BIGINT), 0)) AS pair_min FROM s),
kept AS (SELECT s.* FROM s, pm WHERE n_reads >= pair_min)"""
_ENDS = lambda t: f"(SELECT u AS node, v AS partner, n_reads, n_umis FROM {t} UNION ALL SELECT v, u, n_reads, n_umis FROM {t})"
_REACH = lambda t, name: f"""{name}_r(node, root) AS (SELECT u, u FROM {t} UNION SELECT v, v FROM {t}
    UNION SELECT e.partner, x.root FROM {name}_r AS x JOIN {_ENDS(t)} AS e ON x.node = e.node WHERE e.partner > x.root),
{name} AS (SELECT node, min(root) AS component FROM {name}_r GROUP BY node)"""  # noqa: E731
_CATEGORY = lambda t, parts, name: f"""{name} AS (SELECT component, n_nodes, n_edges, n_self, CASE WHEN n_nodes = 1 AND n_edges = 1 AND n_self = 1 THEN 'self_only'
    WHEN n_nodes = 2 AND n_edges - n_self = 1 THEN 'pair_only' WHEN n_nodes = 3 AND n_edges - n_self = 3 THEN 'triangle_only'
    WHEN n_nodes = 4 AND n_edges - n_self = 6 THEN 'clique4_only' WHEN n_nodes = 5 AND n_edges - n_self = 10 THEN 'clique5_only' ELSE 'other' END AS category
    FROM (SELECT component, count(*) AS n_nodes FROM {parts} GROUP BY component)
    JOIN (SELECT component, count(*) AS n_edges, count(*) FILTER (u = v) AS n_self FROM {t} JOIN {parts} ON u = node GROUP BY component) USING (component))"""  # noqa: E731
_PRUNED = f"""WITH RECURSIVE {_READS}, {_REACH('kept', 'part')}, {_CATEGORY('kept', 'part', 'cat')},
top AS (SELECT node, max(n_reads) AS tr, max(n_umis) AS tu FROM {_ENDS('kept')} GROUP BY node),
le AS (SELECT kept.*, component FROM kept JOIN part ON u = node),
inc AS (SELECT component, node, list(n_reads ORDER BY n_reads DESC) AS lr, list(n_umis ORDER BY n_umis DESC) AS lu FROM
    (SELECT component, u AS node, n_reads, n_umis FROM le WHERE u <> v UNION ALL SELECT component, v, n_reads, n_umis FROM le WHERE u <> v) GROUP BY ALL),
nt AS (SELECT inc.component, min(greatest(coalesce(list_sum(lr) / nullif(list_sum(lr) + coalesce(o.n_reads, 0), 0), 0), coalesce(list_sum(lu) / nullif(list_sum(lu) + coalesce(o.n_umis, 0), 0), 0))) AS t0,
    min(greatest(coalesce(lr[2] / greatest(coalesce(o.n_reads, 0), 1), 0), coalesce(lu[2] / greatest(coalesce(o.n_umis, 0), 1), 0))) AS t1,
    min(greatest(coalesce(lr[3] / greatest(coalesce(o.n_reads, 0), 1), 0), coalesce(lu[3] / greatest(coalesce(o.n_umis, 0), 1), 0))) AS t2
    FROM inc LEFT JOIN kept AS o ON o.u = inc.node AND o.v = inc.node GROUP BY inc.component),
wt AS (SELECT component, greatest(coalesce(sum(n_reads) FILTER (u <> v) / sum(n_reads), 0), coalesce(sum(n_umis) FILTER (u <> v) / sum(n_umis), 0)) AS share,
    greatest(coalesce(min(n_reads) FILTER (u <> v) / median(n_reads) FILTER (u <> v), 0), coalesce(min(n_umis) FILTER (u <> v) / median(n_umis) FILTER (u <> v), 0)) AS weak,
    max(n_umis) FILTER (u <> v) AS link FROM le GROUP BY component),
mo AS (SELECT cat.component, CASE category WHEN 'self_only' THEN true WHEN 'pair_only' THEN t0 >= 0.35 AND link >= 2 WHEN 'triangle_only' THEN share >= 0.55 AND weak >= 0.25 AND t0 >= 0.45
    WHEN 'clique4_only' THEN share >= 0.65 AND weak >= 0.18 AND t1 >= 0.25 WHEN 'clique5_only' THEN share >= 0.72 AND weak >= 0.15 AND t2 >= 0.18 ELSE false END AS ok
    FROM cat JOIN wt ON cat.component = wt.component LEFT JOIN nt ON cat.component = nt.component),
ep AS (SELECT le.*, (r1 >= 0.1 OR (m1 >= 0.3 AND r1 >= 0.05) OR (r1 >= 0.1 * 0.75 AND m1 >= 0.15)) OR (r2 >= 0.1 OR (m2 >= 0.3 AND r2 >= 0.05) OR (r2 >= 0.1 * 0.75 AND m2 >= 0.15)) AS ends_ok
    FROM (SELECT le.*, n_reads / a.tr AS r1, n_umis / a.tu AS m1, n_reads / b.tr AS r2, n_umis / b.tu AS m2 FROM le JOIN top AS a ON a.node = u JOIN top AS b ON b.node = v) AS le),
pr AS (SELECT u, v, n_reads, n_umis, CASE WHEN ok THEN 'motif' WHEN u = v OR ends_ok THEN 'ends' END AS kept_by FROM ep JOIN mo USING (component)),
pruned AS (SELECT * FROM pr WHERE kept_by IS NOT NULL)"""
_CELL_SQL = f"""{_PRUNED}, {_REACH('pruned', 'part2')}, {_CATEGORY('pruned', 'part2', 'cat2')},
no AS (SELECT component, printf('cell_%06d', row_number() OVER (ORDER BY component)) AS cell_id FROM cat2 WHERE category <> 'other'),
cells AS (SELECT node AS barcode, cell_id FROM part2 JOIN no USING (component))"""
_DOMINANCE = lambda t: f"""(SELECT node, partner, n_reads / total AS dominance FROM (SELECT *, sum(n_reads) OVER (PARTITION BY node) AS total,
    row_number() OVER (PARTITION BY node ORDER BY n_reads DESC, partner) AS rn FROM {_ENDS(t)}) WHERE rn = 1)"""  # noqa: E731
_ONCE = """WITH o AS (SELECT read_id, any_value(sample_name) AS sample_name, any_value(read_length) AS l, any_value(mean_quality) AS q FROM read_qc_reads GROUP BY read_id),
ol AS (SELECT sample_name, l FROM o WHERE l >= 0)"""
_SEQ = f"""WITH c AS (SELECT DISTINCT read_id, coalesce({sql_clean('bc5n')}, '') AS bc5, coalesce({sql_clean('bc3n')}, '') AS bc3, coalesce({sql_clean('putative_umi')}, '') AS u3,
    coalesce({sql_clean('putative_umi_5p')}, '') AS u5 FROM readids_umi_bc_clean),
d AS (SELECT DISTINCT read_id, bc5, bc3, concat(CASE WHEN bc5 <> '' THEN concat(substr(bc5, 1, 10), 'CCTTCC', substr(bc5, 11, 10)) ELSE '' END, u5,
    translate(md5(read_id), '0123456789abcdef', 'ACGTACGTACGTACGT'), 'AAAAAAAAAAAA', u3,
    CASE WHEN bc3 <> '' THEN concat(substr(bc3, 1, 10), 'GCTACC', substr(bc3, 11, 10)) ELSE '' END) AS seq FROM c),
e AS (SELECT *, translate(substr(repeat(md5(read_id), 5), 1, length(seq)), '0123456789abcdef', '!#%'')+-/13579;=?') AS qual FROM d),
f AS (SELECT *, list_transform(range(1, length(qual) + 1), lambda i: ascii(substr(qual, i, 1)) - 33) AS ph FROM e)"""

_X5 = """, a5 AS (SELECT *, instr(substr(seq, 1, 30), 'CCTTCC') - 1 AS loc FROM f),
b5 AS (SELECT *, CASE WHEN loc > 11 THEN loc - 10 ELSE 0 END AS bs, CASE WHEN loc IN (-1, 11) THEN 26 ELSE loc + 16 END AS be, CASE WHEN loc = 11 THEN 26 ELSE loc + 16 END AS us FROM a5),
c5 AS (SELECT *, CASE WHEN loc = -1 THEN nullif(instr(substr(seq, 1, 40), 'CAGCA'), 0) - 1 ELSE nullif(instr(substr(seq, us + 1, 10), 'CAGCA'), 0) - 1 + us END AS ul FROM b5),
x5 AS (SELECT read_id, bc3, bc5, seq, substr(seq, bs + 1, be - bs) AS bc, loc AS bc_loc, CASE WHEN loc <> -1 THEN list_min(ph[bs + 1:least(be, length(seq))]) END AS bc_min_q,
    CASE WHEN ul IS NOT NULL THEN substr(seq, ul + 1, 15) WHEN loc <> -1 THEN substr(seq, us + 1, 15) ELSE '' END AS umi, ul AS umi_loc FROM c5)"""
# In the last bases all places count from the end; slices are cut at the start of the read. A slice that ends at
# place 0 is empty, since 0 is the start of a read, but `be` 0 stands for its end.
_CUT = lambda a, e: f"substr(seq, greatest(n + ({a}), 0) + 1, greatest(n + ({e}), 0) - greatest(n + ({a}), 0))"
_BACK = lambda t, sub: f"CASE WHEN contains({t}, '{sub}') THEN -(instr(reverse({t}), '{sub[::-1]}') - 1) - {len(sub)} ELSE -1 END"
_X3 = f""", a3 AS (SELECT *, length(seq) AS n FROM f),
b3 AS (SELECT *, {_BACK('right(seq, 30)', 'GCTACC')} AS loc FROM a3),
c3 AS (SELECT *, {_BACK(_CUT('loc - 20', 'loc - 10'), 'AGATC')} AS near, {_BACK('left(seq, greatest(n - 40, 0))', 'AGATC')} AS far FROM b3),
d3 AS (SELECT *, CASE WHEN loc = -1 THEN nullif(far, -1) WHEN near <> -1 THEN near + loc - 10 END AS ul FROM c3),
e3 AS (SELECT *, CASE WHEN loc < -16 THEN loc - 10 WHEN loc NOT IN (-16, -1) AND ul IS NOT NULL THEN ul + 5 ELSE -26 END AS bs, CASE WHEN loc < -16 THEN loc + 16 ELSE 0 END AS be,
    coalesce(ul - 10, CASE WHEN loc <= -16 THEN loc - 10 END) AS we, coalesce(ul + 5, CASE WHEN loc <= -16 THEN loc - 10 END) AS ue FROM d3),
g3 AS (SELECT *, {_CUT('we - 100', 'we')} AS w FROM e3),
h3 AS (SELECT *, CASE WHEN contains(w, 'AAAA') THEN length(w) - instr(reverse(w), 'AAAA') - 3 END AS an FROM g3),
i3 AS (SELECT *, an - coalesce(nullif(list_position(list_transform(range(an - 1, -1, -1), lambda i: substr(w, i + 1, 1) = 'A' OR
    length(replace(substr(w, greatest(i - 9, 0) + 1, i - greatest(i - 9, 0) + 1), 'A', '')) <= i - greatest(i - 9, 0) + 1 - 7), false), 0) - 1, an) AS ts FROM h3),
x3 AS (SELECT read_id, bc3, bc5, seq, {_CUT('bs', 'be')} AS bc, loc AS bc_loc, CASE WHEN loc <= -16 OR (loc <> -1 AND ul IS NOT NULL) THEN list_min(ph[greatest(n + bs, 0) + 1:n + be]) END AS bc_min_q,
    CASE WHEN ue = 0 THEN '' ELSE coalesce({_CUT('ue - 15', 'ue')}, '') END AS umi, ul AS umi_loc, coalesce({_CUT('ue - 20', 'ue - 15')}, '') AS flank, CASE WHEN length(w) - ts >= 8 THEN ts - length(w) + we END AS poly_a,
    CASE WHEN loc = -1 AND ul IS NULL THEN 11 WHEN loc > -16 AND ul IS NULL THEN 14 ELSE CASE WHEN loc = -16 THEN 1 WHEN loc < -16 THEN 5 WHEN loc = -1 THEN 9 ELSE 12 END
        + CASE WHEN ul IS NULL THEN 2 ELSE 0 END + CASE WHEN length(w) - ts >= 8 THEN 0 ELSE 1 END END AS read_type FROM i3)"""
_BOUNDS = """, t AS (SELECT x3.read_id, x3.bc3, x3.bc5, x3.seq, length(x3.seq) AS n, CASE WHEN x5.bc5 <> '' THEN coalesce(least(x5.umi_loc + 15, length(x5.seq)), CASE WHEN x5.bc_loc >= 0 THEN least(x5.bc_loc + 31, length(x5.seq)) END, 0) ELSE 0 END AS s,
    CASE WHEN x3.bc3 <> '' THEN coalesce(CASE WHEN length(x3.seq) + poly_a >= 0 THEN length(x3.seq) + poly_a END, CASE WHEN length(x3.seq) + x3.umi_loc >= 0 THEN greatest(length(x3.seq) + x3.umi_loc - 10, 0) END,
        CASE WHEN x3.bc_loc <> -1 THEN greatest(length(x3.seq) + x3.bc_loc - 25, 0) END, length(x3.seq)) ELSE length(x3.seq) END AS e
    FROM x3 JOIN x5 ON x3.read_id = x5.read_id AND x3.seq = x5.seq AND x3.bc3 = x5.bc3 AND x3.bc5 = x5.bc5)"""
_TRIM = _BOUNDS + """ SELECT read_id, CASE WHEN s < e THEN s END AS trim_start, CASE WHEN s < e THEN e END AS trim_end, CASE WHEN s < e THEN substr(seq, s + 1, e - s) END AS cdna FROM t"""

_SEQ_JOINED = _SEQ.replace("FROM e)", """FROM (SELECT * REPLACE (concat(seq, CASE WHEN substr(md5(read_id), 1, 1) < '8' THEN seq ELSE reverse(translate(seq, 'ACGT', 'TGCA')) END) AS seq,
    concat(qual, CASE WHEN substr(md5(read_id), 1, 1) < '8' THEN qual ELSE reverse(qual) END) AS qual) FROM e))""")
_AT = lambda sub: f"list_filter(range(0, n - 5), lambda i: substr(seq, i + 1, 6) = '{sub}')"
_CLASS = """, p0 AS (SELECT row_number() OVER () AS rid, read_id, seq, length(seq) AS n, -10 * log10(list_avg(list_transform(ph, lambda x: pow(10, -x / 10.0)))) AS q, left(seq, 60) AS fr, reverse(right(seq, 80)) AS ba FROM f),
p1 AS (SELECT *, contains(fr, 'CCTTCC') AS t, contains(fr, 'GGTAGC') AS r, contains(ba, 'GGAAGG') AS tc, contains(ba, 'CCATCG') AS rc,
    length(fr) - instr(reverse(fr), 'CCTTCC') + 1 AS te, length(fr) - instr(reverse(fr), 'CGATGG') + 1 AS re, length(ba) - instr(reverse(ba), 'GGAAGG') + 1 AS tce, length(ba) - instr(reverse(ba), 'GCTACC') + 1 AS rce,
    nullif(instr(ba, repeat('A', 10)), 0) - 1 AS a, nullif(instr(fr, repeat('T', 10)), 0) - 1 AS tt FROM p0),
p2 AS (SELECT *, coalesce(a - rce BETWEEN 13 AND 38, false) AS plus, coalesce(tt - re BETWEEN 13 AND 38, false) AS minus, a IS NULL AND tt IS NULL AS bare FROM p1),
p3 AS (SELECT *, CASE WHEN n < 100 THEN 16 WHEN q < 1 THEN 17 WHEN t AND rc AND plus AND NOT (r AND tc AND minus) THEN 0 WHEN r AND tc AND minus AND NOT (t AND rc AND plus) THEN 1
    WHEN r AND rc AND plus AND minus THEN 4 WHEN t AND a IS NOT NULL AND NOT (rc AND plus) THEN 2 WHEN tc AND tt IS NOT NULL AND NOT (r AND minus) THEN 3
    WHEN NOT t AND rc AND plus THEN 5 WHEN r AND NOT tc AND minus THEN 6 WHEN t AND rc AND bare THEN 7 WHEN r AND tc AND bare THEN 8 WHEN t AND tc AND bare THEN 13 WHEN r AND rc AND bare THEN 14
    WHEN t AND NOT rc AND NOT tc AND NOT r THEN 9 WHEN r AND NOT tc AND NOT rc AND NOT t THEN 10 WHEN tc AND NOT r AND NOT t AND NOT rc THEN 11 WHEN rc AND NOT t AND NOT r AND NOT tc THEN 12 ELSE 15 END AS c FROM p2),
p4 AS (SELECT *, CASE WHEN c IN (0, 2, 7, 13, 9) THEN te WHEN c IN (1, 8, 14, 10) THEN re WHEN c IN (4, 3, 6) THEN tt ELSE 0 END AS s,
    CASE WHEN c IN (0, 7, 14, 12) THEN rce WHEN c IN (1, 3, 8, 13, 11) THEN tce WHEN c IN (4, 2, 5) THEN a ELSE 0 END AS e FROM p3),
c0 AS (SELECT rid, read_id, CAST(CASE WHEN n > s + e OR c > 15 THEN c ELSE 15 END AS INTEGER) AS class, CASE WHEN n > s + e THEN CASE WHEN c IN (1, 3) THEN reverse(translate(substr(seq, s + 1, n - s - e), 'ACGT', 'TGCA'))
    ELSE substr(seq, s + 1, n - s - e) END ELSE seq END AS seq, CAST(CASE WHEN n > s + e THEN s ELSE 0 END AS INTEGER) AS cut_start, CAST(CASE WHEN n > s + e THEN e ELSE 0 END AS INTEGER) AS cut_end FROM p4),
hits AS (SELECT rid, n, 0 AS id, unnest(""" + _AT("CCTTCC") + """) + 5 AS place FROM p3 WHERE c < 16 UNION ALL SELECT rid, n, 1, unnest(""" + _AT("GGTAGC") + """) + 5 FROM p3 WHERE c < 16
    UNION ALL SELECT rid, n, 2, unnest(""" + _AT("GCTACC") + """) FROM p3 WHERE c < 16 UNION ALL SELECT rid, n, 3, unnest(""" + _AT("GGAAGG") + """) FROM p3 WHERE c < 16),
parted AS (SELECT *, sum(fresh) OVER (PARTITION BY rid ORDER BY place, id ROWS UNBOUNDED PRECEDING) AS cno FROM
    (SELECT *, CASE WHEN place - lag(place) OVER (PARTITION BY rid ORDER BY place, id) <= 5 THEN 0 ELSE 1 END AS fresh FROM hits)),
clu AS (SELECT rid, n, cno, min(place) AS lo, max(place) AS hi, max(place) FILTER (id = 0) AS t, max(place) FILTER (id = 1) AS r, max(place) FILTER (id = 2) AS rc, max(place) FILTER (id = 3) AS tc FROM parted GROUP BY ALL),
jr AS (SELECT rid FROM clu GROUP BY rid, n HAVING count(*) > 2 OR (count(*) = 2 AND min(lo) >= 60 AND max(hi) + 80 < n)),
nb AS (SELECT x.*, p0.read_id, seq, nullif(instr(substr(seq, r + 2, 45), repeat('T', 10)), 0) - 1 AS tt,
    nullif(instr(reverse(substr(seq, greatest(rc2 - 45, 0) + 1, rc2 - greatest(rc2 - 45, 0))), repeat('A', 10)), 0) - 1 AS aa FROM
    (SELECT rid, n, cno, t, r, lead(rc) OVER w AS rc2, lead(tc) OVER w AS tc2 FROM clu WINDOW w AS (PARTITION BY rid ORDER BY cno)) AS x JOIN jr USING (rid) JOIN p0 USING (rid)),
pc AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY cno) AS no FROM (SELECT *, CASE WHEN k = 19 THEN t + 1 ELSE r + tt + 1 END AS ps, CASE WHEN k = 19 THEN rc2 - aa ELSE tc2 END AS pe FROM
    (SELECT *, CASE WHEN tt IS NOT NULL AND aa IS NOT NULL THEN NULL WHEN t IS NOT NULL AND rc2 IS NOT NULL THEN 19 WHEN r IS NOT NULL AND tc2 IS NOT NULL THEN 20 END AS k FROM nb)) WHERE k IS NOT NULL AND ps < pe AND pe <= n),
cl AS (SELECT read_id, class, seq, cut_start, cut_end FROM c0 WHERE rid NOT IN (SELECT rid FROM jr)
    UNION ALL SELECT read_id || '_rescued_No' || no || CASE k WHEN 19 THEN '_strand_plus' ELSE '_strand_minus' END, k, CASE k WHEN 19 THEN substr(seq, ps + 1, pe - ps)
        ELSE reverse(translate(substr(seq, ps + 1, pe - ps), 'ACGT', 'TGCA')) END, CAST(ps AS INTEGER), CAST(n - pe AS INTEGER) FROM pc
    UNION ALL SELECT read_id, 18, seq, 0, 0 FROM p0 JOIN jr USING (rid) WHERE rid NOT IN (SELECT rid FROM pc)),
nm(class, name) AS (VALUES """ + ", ".join(f"({k}, '{v.replace(chr(39), chr(39) * 2)}')" for k, v in K.CLASSES.items()) + ")"  # noqa: E501

ORACLES = {
    "classify_reads": _SEQ + _CLASS + " SELECT read_id, class, name, seq, cut_start, cut_end FROM cl JOIN nm USING (class)",
    "class_statistics": _SEQ + _CLASS + """ SELECT nm.class, name, count(read_id) AS n, CAST(coalesce(sum(length(seq)), 0) AS BIGINT) AS bases,
        round(CAST(100.0 * count(read_id) / (SELECT count(*) FROM cl) AS DOUBLE), 6) AS percent FROM nm LEFT JOIN cl ON nm.class = cl.class GROUP BY nm.class, name""",
    "joined_reads": _SEQ_JOINED + _CLASS + " SELECT read_id, class, name, seq, cut_start, cut_end FROM cl JOIN nm USING (class)",
    "joined_summary": _SEQ_JOINED + _CLASS + """, u AS (SELECT count(*) FILTER (class NOT IN (19, 20)) + count(DISTINCT CASE WHEN class IN (19, 20) THEN regexp_replace(read_id, '_rescued_No[0-9]+_strand_.*', '') END) AS total,
        count(*) FILTER (class = 16) AS sh, count(*) FILTER (class = 17) AS lo, count(*) FILTER (class <= 3) AS fu, count(*) FILTER (class = 19) AS pl, count(*) FILTER (class = 20) AS mi, count(*) FILTER (class = 18) AS ls,
        count(DISTINCT CASE WHEN class IN (19, 20) THEN regexp_replace(read_id, '_rescued_No[0-9]+_strand_.*', '') END) AS re FROM cl)
        SELECT unnest(['Total', 'Length-filtered', 'QC-filtered', 'Full-length+rescued', 'Chimeric', 'Non-chimeric', 'Full-length', 'Chimeric reads rescued', 'Rescued strand:+', 'Rescued strand:-', 'Irrescuable']) AS type,
        unnest([total, sh, lo, fu + pl + mi, ls + re, total - sh - lo - ls - re, fu, re, pl, mi, ls]) AS n,
        unnest(list_transform(list_zip([total, sh, lo, fu + pl + mi, ls + re, total - sh - lo - ls - re, fu, re, pl, mi, ls],
            [total, total, total, total, total, total, total, ls + re, pl + mi + ls, pl + mi + ls, pl + mi + ls]), lambda x: round(CAST(coalesce(100.0 * x[1] / nullif(x[2], 0), 0) AS DOUBLE), 6))) AS percent FROM u""",
    "fan_out": _SEQ_JOINED + _CLASS + """ SELECT b AS bucket, count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS bases FROM (SELECT seq, unnest(CASE WHEN class <= 3 THEN ['full-length', 'full-length-plus-rescued']
        WHEN class <= 12 THEN ['non-full-length'] WHEN class IN (13, 14, 15, 18) THEN ['discarded'] WHEN class < 18 THEN ['failed-filter'] ELSE ['rescued', 'full-length-plus-rescued'] END) AS b FROM cl) GROUP BY b""",
    "extract_5p": _SEQ + _X5 + " SELECT * EXCLUDE (bc3, bc5, seq) FROM x5",
    "extract_3p": _SEQ + _X3 + " SELECT * EXCLUDE (bc3, bc5, seq) FROM x3",
    "trim_bounds": _SEQ + _X5 + _X3 + _TRIM,
    "hq_counts": _HQ + " SELECT * FROM h",
    "observed_whitelist": _HQ + """, w AS (SELECT * FROM h WHERE barcode IN (SELECT barcode FROM whitelist_3p)),
        t AS (SELECT quantile_cont(n_reads, 0.95) / 20 AS cut FROM (SELECT * FROM w ORDER BY n_reads DESC, barcode LIMIT 50)) SELECT w.* FROM w, t WHERE n_reads > cut""",
    "strip_fixed": f"""WITH r AS (SELECT coalesce({sql_clean('putative_barcode')}, '') AS p, coalesce({sql_clean('corrected_barcode')}, '') AS c FROM correction_map_3p)
        SELECT CASE WHEN c = '' THEN 'failed' WHEN p = c THEN 'exact' ELSE 'corrected' END AS status,
        CASE WHEN length(c) = 26 AND substr(c, 11, 6) = 'GCTACC' THEN reverse(translate(regexp_replace(substr(c, 1, 10) || substr(c, 17, 10), '[^ACGTN]', 'N', 'g'), 'ACGT', 'TGCA')) ELSE '' END AS final_20bp,
        count(*) AS n FROM r GROUP BY ALL""",
    "whitelist_expand": """WITH t AS (SELECT reverse(translate(list_aggregate(list_transform(range(9, -1, -1), lambda i: CAST((s_suppkey // CAST(pow(4, i) AS BIGINT)) % 4 AS VARCHAR)), 'string_agg', ''), '0123', 'TGCA')) AS x FROM supplier)
        SELECT a.x || 'CCTTCC' || b.x AS barcode FROM t AS a, t AS b""",
    "validity_summary": f"""WITH r AS (SELECT {sql_clean('bc3n')} IS NOT NULL AS a, {sql_clean('bc5n')} IS NOT NULL AS b FROM read_assigned_cell),
        n AS (SELECT count(*) AS t, count(*) FILTER (a OR b) AS v, count(*) FILTER (a AND NOT b) AS o3, count(*) FILTER (b AND NOT a) AS o5, count(*) FILTER (a AND b) AS ab, count(*) FILTER (NOT a AND NOT b) AS ne FROM r)
        SELECT t AS total_rows, v AS valid_any_n, round(v / t, 9) AS valid_any_ratio, o3 AS only_3p_n, round(o3 / t, 9) AS only_3p_ratio, o5 AS only_5p_n, round(o5 / t, 9) AS only_5p_ratio,
        ab AS both_n, round(ab / t, 9) AS both_ratio, ne AS neither_n, round(ne / t, 9) AS neither_ratio FROM n""",
    "unique_barcodes": f"""WITH r AS (SELECT {sql_clean('bc3n')} AS a, {sql_clean('bc5n')} AS b FROM readids_umi_bc_clean)
        SELECT '3p' AS side, count(DISTINCT a) AS n FROM r UNION ALL SELECT '5p', count(DISTINCT b) FROM r
        UNION ALL SELECT 'any', count(*) FROM (SELECT a FROM r WHERE a IS NOT NULL UNION SELECT b FROM r WHERE b IS NOT NULL)""",
    # All entries have 26 letters. Within 2 edits one of three parts of an entry stays; parts of a value near that length are compared with it.
    "fuzzy_correct": f"""WITH w AS (SELECT DISTINCT barcode FROM whitelist_3p WHERE barcode <> ''), v AS (SELECT DISTINCT {sql_clean('putative_barcode')} AS v FROM correction_map_3p),
        a AS (SELECT v FROM v WHERE v IS NOT NULL AND v NOT IN (SELECT barcode FROM w)),
        q AS (SELECT barcode, unnest([substr(barcode, 1, 8), substr(barcode, 9, 11), substr(barcode, 20)]) AS s FROM w),
        p AS (SELECT DISTINCT v, substr(v, i, n) AS s FROM (SELECT v, n, unnest(range(1, length(v) - n + 2)) AS i FROM a, (VALUES (8), (11), (7)) AS k(n))),
        m AS (SELECT DISTINCT v, barcode FROM p JOIN q USING (s)),
        d AS (SELECT v, barcode, list_min(list_transform(range(0, 5 * length(v)), lambda i: levenshtein(substr(v, i // 5 + 1, 24 + i % 5), barcode))) AS d FROM m),
        b AS (SELECT v, count(*) AS n, min(barcode) AS barcode FROM d WHERE d <= 2 AND d = (SELECT min(d) FROM d AS x WHERE x.v = d.v) GROUP BY v)
        SELECT v.v AS value, CASE WHEN v.v IN (SELECT barcode FROM w) THEN v.v WHEN n = 1 THEN b.barcode ELSE '' END AS corrected FROM v LEFT JOIN b ON v.v = b.v WHERE v.v IS NOT NULL""",
    "read_gate": _SEQ + """ SELECT CASE WHEN length(seq) < 100 THEN 16 WHEN -10 * log10(list_avg(list_transform(ph, lambda x: pow(10, -x / 10.0)))) < 7 THEN 17 ELSE 0 END AS gate, count(*) AS n FROM f GROUP BY ALL""",
    "mean_quality": _SEQ + """, g AS (SELECT read_id, ph, CASE WHEN length(seq) >= 100 THEN ph[11:length(seq) - 10] ELSE ph END AS t FROM f)
        SELECT read_id, round(CAST(CAST(-10 * log10(list_avg(list_transform(t, lambda x: pow(10, -x / 10.0)))) AS FLOAT) AS DOUBLE), 4) AS mean_quality, list_min(ph) AS min_quality FROM g""",
    "pair_support": f"WITH {_READS} SELECT * FROM s",
    "pair_min_auto": f"WITH {_READS} SELECT pair_min, 'auto_quantile' AS mode FROM pm",
    "supported_pairs": f"WITH {_READS} SELECT * FROM kept",
    "top1_dominance": f"WITH {_READS} SELECT node, partner, round(dominance, 9) AS dominance FROM {_DOMINANCE('kept')}",
    "components": f"WITH RECURSIVE {_READS}, {_REACH('kept', 'part')} SELECT * FROM part",
    "component_category": f"WITH RECURSIVE {_READS}, {_REACH('kept', 'part')}, {_CATEGORY('kept', 'part', 'cat')} SELECT * FROM cat",
    "edge_prune": _PRUNED + " SELECT * FROM pruned",
    "clean_reads": f"""WITH a AS (SELECT DISTINCT read_id, {sql_clean('bc5n')} AS bc5n, {sql_clean('bc3n')} AS bc3n, {sql_clean('putative_umi')} AS putative_umi, {sql_clean('putative_umi_5p')} AS putative_umi_5p FROM readids_umi_bc_clean),
        c AS (SELECT *, count(*) OVER (PARTITION BY least(bc5n, bc3n), greatest(bc5n, bc3n)) AS n FROM a WHERE bc5n IS NOT NULL AND bc3n IS NOT NULL),
        m AS (SELECT greatest({_FLOOR}, CAST(floor(quantile_cont(n, 0.1)) AS BIGINT)) AS least_n FROM (SELECT DISTINCT least(bc5n, bc3n), greatest(bc5n, bc3n), n FROM c))
        SELECT * EXCLUDE (n, least_n) FROM c, m WHERE n >= least_n AND coalesce(putative_umi, putative_umi_5p) IS NOT NULL
        UNION ALL SELECT * FROM a WHERE (bc5n IS NULL OR bc3n IS NULL) AND coalesce(bc5n, bc3n) IS NOT NULL AND coalesce(putative_umi, putative_umi_5p) IS NOT NULL""",
    "cell_ids": _CELL_SQL + " SELECT * FROM cells",
    "read_to_cell": _CELL_SQL + f""", ab AS (SELECT d.node, cell_id FROM {_DOMINANCE('pruned')} AS d JOIN cells ON d.partner = cells.barcode WHERE dominance >= 0.8),
        x AS (SELECT r.read_id, r.bc5n, r.bc3n, coalesce(a.cell_id, b.cell_id, CASE WHEN bc5n IS NOT NULL AND bc3n IS NOT NULL THEN
            CASE WHEN c.cell_id IS NULL OR d.cell_id IS NULL OR c.cell_id = d.cell_id THEN coalesce(c.cell_id, d.cell_id) END ELSE coalesce(c.cell_id, d.cell_id) END) AS cell_id
            FROM (SELECT * FROM r WHERE bc5n IS NULL OR bc3n IS NULL OR EXISTS (SELECT 1 FROM pruned WHERE u = least(bc5n, bc3n) AND v = greatest(bc5n, bc3n))) AS r LEFT JOIN cells AS a ON r.bc5n = a.barcode LEFT JOIN cells AS b ON r.bc3n = b.barcode LEFT JOIN ab AS c ON r.bc5n = c.node LEFT JOIN ab AS d ON r.bc3n = d.node)
        SELECT * FROM x WHERE cell_id IN (SELECT cell_id FROM x WHERE cell_id IS NOT NULL GROUP BY cell_id HAVING count(*) >= 3)""",
    "read_len_hist": _ONCE + """, t AS (SELECT sample_name, greatest(quantile_cont(l / 1000, 0.995), 0.5) AS top FROM ol GROUP BY sample_name),
        b AS (SELECT sample_name, CAST(least(floor(least(l / 1000, top) / (top / 80)), 79) AS INTEGER) AS bin, count(*) AS n FROM ol JOIN t USING (sample_name) GROUP BY ALL),
        fr AS (SELECT sample_name, top, CAST(unnest(range(80)) AS INTEGER) AS bin FROM t)
        SELECT fr.sample_name, fr.bin, round((fr.bin + 0.5) * (top / 80), 6) AS mid_kb, coalesce(n, 0) AS n FROM fr LEFT JOIN b ON fr.sample_name = b.sample_name AND fr.bin = b.bin""",
    "quality_hist": _ONCE + """, v AS (SELECT sample_name, CAST(CAST(q AS FLOAT) AS DOUBLE) AS q FROM o WHERE q >= 0),
        t AS (SELECT sample_name, greatest(floor(min(q)), 0) - 1 AS lo, ceil(max(q)) + 1 AS hi FROM v GROUP BY sample_name),
        b AS (SELECT sample_name, CAST(least(floor((q - lo) / ((hi - lo) / 60)), 59) AS INTEGER) AS bin, count(*) AS n FROM v JOIN t USING (sample_name) GROUP BY ALL),
        fr AS (SELECT sample_name, lo, hi, CAST(unnest(range(60)) AS INTEGER) AS bin FROM t)
        SELECT fr.sample_name, fr.bin, round(lo + (fr.bin + 0.5) * ((hi - lo) / 60), 6) AS mid, coalesce(n, 0) AS n FROM fr LEFT JOIN b ON fr.sample_name = b.sample_name AND fr.bin = b.bin""",
    "n50_yield": _ONCE + """, w AS (SELECT sample_name, l, sum(l) OVER (PARTITION BY sample_name ORDER BY l DESC, rid ROWS UNBOUNDED PRECEDING) AS c, sum(l) OVER (PARTITION BY sample_name) AS t,
        count(*) OVER (PARTITION BY sample_name) AS n FROM (SELECT sample_name, l, row_number() OVER () AS rid FROM ol))
        SELECT sample_name, any_value(n) AS n_reads, CAST(any_value(t) AS BIGINT) AS total_bases, max(l) FILTER (c >= ceil(t / 2)) AS n50 FROM w GROUP BY sample_name""",
    "yield_above_length": _ONCE + """, w AS (SELECT sample_name, l, row_number() OVER (PARTITION BY sample_name ORDER BY l DESC) - 1 AS read_rank, count(*) OVER (PARTITION BY sample_name) AS n FROM ol),
        z AS (SELECT *, sum(l) OVER (PARTITION BY sample_name ORDER BY read_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
        p AS (SELECT DISTINCT sample_name, CASE WHEN least(n, 300) = 1 THEN 0 ELSE (i * (n - 1)) // (least(n, 300) - 1) END AS read_rank
            FROM (SELECT DISTINCT sample_name, n, unnest(range(least(n, 300))) AS i FROM w))
        SELECT z.sample_name, z.read_rank, round(l / 1000, 6) AS x_kb, round(rest / 1e9, 9) AS y_gb FROM z JOIN p ON z.sample_name = p.sample_name AND z.read_rank = p.read_rank""",
    "qc_fields": _ONCE + """, qv AS (SELECT sample_name, CAST(CAST(q AS FLOAT) AS DOUBLE) AS q FROM o WHERE q >= 0),
        qs AS (SELECT sample_name, round(avg(q), 6) AS quality_mean, round(median(q), 6) AS quality_median, count(*) AS in_quality_bins FROM qv GROUP BY sample_name),
        w AS (SELECT sample_name, l, sum(l) OVER (PARTITION BY sample_name ORDER BY l DESC, rid ROWS UNBOUNDED PRECEDING) AS c, sum(l) OVER (PARTITION BY sample_name) AS t FROM (SELECT sample_name, l, row_number() OVER () AS rid FROM ol)),
        ls AS (SELECT sample_name, count(*) AS n_reads, round(avg(l), 6) AS length_mean, round(CAST(median(l) AS DOUBLE), 6) AS length_median, min(l) AS length_min, max(l) AS length_max, max(l) FILTER (c >= ceil(t / 2)) AS n50_bp,
            round(sum(l) / 1e9, 9) AS total_gb, count(*) AS in_length_bins, least(count(*), 300) AS points FROM w GROUP BY sample_name)
        SELECT ls.*, quality_mean, quality_median, in_quality_bins, 80 AS length_bins, 60 AS quality_bins FROM ls JOIN qs ON ls.sample_name = qs.sample_name""",
    "known_barcodes": f"""WITH q AS (SELECT read_id, floor(max(mean_quality)) AS quality FROM read_qc_reads GROUP BY read_id)
        SELECT DISTINCT barcode FROM (SELECT read_id, {sql_clean('putative_barcode')} AS barcode FROM correction_map_3p) LEFT JOIN q USING (read_id) WHERE barcode IS NOT NULL AND NOT coalesce(quality < 10, false)""",
    "bounded_sample": """WITH d AS (SELECT DISTINCT sample_name, read_id, read_length, mean_quality FROM read_qc_reads),
        r AS (SELECT *, count(*) OVER (PARTITION BY sample_name) AS n, row_number() OVER (PARTITION BY sample_name ORDER BY sha256(read_id), read_id) AS rn FROM d)
        SELECT sample_name, read_id, read_length, mean_quality FROM r WHERE n <= 1000 OR rn <= 250""",
    "report_metrics": _ONCE + """, a AS (SELECT sample_name, count(*) AS n, avg(l) FILTER (l >= 0) AS m, count(*) FILTER (q >= 10) / count(*) AS g, sum(l) FILTER (l >= 0) AS b FROM o GROUP BY sample_name)
        SELECT sample_name, format('{:,}', n) AS reads, format('{:,.2f}', round(m, 2)) AS mean_length, format('{:,.2f}', round(g * 100, 2)) || '%' AS good_reads,
        CASE WHEN b >= 1000000000 THEN format('{:,.2f}', b / 1e9) || ' Gb' ELSE format('{:,.2f}', b / 1e6) || ' Mb' END AS yield FROM a""",
    "read_summary": _ONCE + """ SELECT sample_name, count(*) AS n_reads, round(avg(l) FILTER (l >= 0), 6) AS mean_length, median(l) FILTER (l >= 0) AS median_length, min(l) FILTER (l >= 0) AS min_length,
        max(l) FILTER (l >= 0) AS max_length, round(avg(q) FILTER (q >= 0), 6) AS mean_quality, round(median(q) FILTER (q >= 0), 6) AS median_quality,
        count(*) FILTER (upper(trim(coalesce(read_id, ''), ' ')) IN ('', 'NA', 'NAN', 'NONE')) AS n_unnamed FROM o GROUP BY sample_name""",
}
ORACLES["trimmed_fastq"] = _SEQ + _X5 + _X3 + _BOUNDS + f""", cr AS ({ORACLES['clean_reads']}) SELECT DISTINCT t.read_id || ':' || t.bc5 || ':' || t.bc3 AS read_id,
    CASE WHEN s < e THEN substr(t.seq, s + 1, e - s) ELSE t.seq END AS seq, CASE WHEN s < e THEN substr(f.qual, s + 1, e - s) ELSE f.qual END AS qual, NOT (s < e) AS fell_back
    FROM t JOIN f ON t.read_id = f.read_id AND t.seq = f.seq AND t.bc3 = f.bc3 AND t.bc5 = f.bc5 JOIN cr ON cr.read_id = t.read_id AND coalesce(bc5n, '') = t.bc5 AND coalesce(bc3n, '') = t.bc3"""
