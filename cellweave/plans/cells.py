"""Queries over the molecule table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.text import clean_key
from cellweave.operators import metrics as X
from cellweave.operators import molecules as M
from cellweave.operators.prefix import running_sum
from cellweave.operators.readqc import sample_per_class
from cellweave.operators.umi import collapse_umis, umi_counts
from cellweave.plans.common import SQL_MOLECULES, sql_clean, table
from cellweave.session import materialize

_FRACTIONS = (0.0, 0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.molecules(table(spark, sf_dir, "cell_umi_gene"))


def gene_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.gene_matrix(_rows(spark, sf_dir))


def isoform_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first assigned transcript of a read; transcripts are numbered by the first base of the UMI here."""
    rows = _rows(spark, sf_dir)
    calls = rows.select("read_id", F.concat_ws(".", "gene", F.substring("umi", 7, 1)).alias("transcript_id"))
    first = calls.groupBy("read_id").agg(F.min("transcript_id").alias("transcript_id"))
    return M.count_matrix(rows.join(first, "read_id"), "transcript_id")


def per_cell_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.per_cell_qc(_rows(spark, sf_dir)).withColumn("mito_percent", F.round("mito_percent", 6))


def matrix_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.matrix_cells(_rows(spark, sf_dir))


def _alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for each row of the correction map; a digit of a hash makes it unmapped, secondary or supplementary."""
    digit = F.substring(F.md5("read_id"), 1, 1)
    flag = F.when(digit == "0", 4).when(digit == "1", 2048).when(digit == "2", 256).otherwise(0)
    return table(spark, sf_dir, "correction_map_3p").select(F.trim("read_id").alias("read_id"), flag.alias("flag"))


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript calls of the molecule table; reads of a region have none."""
    rows = _rows(spark, sf_dir)
    known = M.is_known_gene(F.col("gene"))
    tx = F.concat_ws(".", "gene", F.substring("umi", 7, 1))
    return rows.select("read_id", F.when(known, "Assigned").otherwise("Unassigned_no_features").alias("status"), F.when(known, tx).otherwise("NA").alias("transcript_id"))


def _final_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "read_assigned_cell").filter(clean_key("cell_id").isNotNull())
    return rows.select(F.trim("read_id").alias("read_id")).distinct()


def bam_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.alignment_summary(_alignments(spark, sf_dir), _final_reads(spark, sf_dir))


def transcript_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.transcript_summary(_calls(spark, sf_dir), _final_reads(spark, sf_dir))


def experiment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metric, value: reads kept by each step and what cells hold."""

    def distinct(name: str, as_: str) -> DataFrame:
        # Distinct first, so that no task holds all ids.
        return table(spark, sf_dir, name).select("read_id").distinct().agg(F.count("read_id").cast("double").alias(as_))

    rows = materialize(_rows(spark, sf_dir), "molecules").df
    known = M.is_known_gene(F.col("gene"))
    kinds = F.array(
        F.struct(F.lit("r").alias("k"), F.col("read_id").alias("v")),
        F.struct(F.lit("kr").alias("k"), F.when(known, F.col("read_id")).alias("v")),
        F.struct(F.lit("g").alias("k"), F.when(known, F.col("gene")).alias("v")),
    )
    once = rows.select(F.explode(kinds).alias("_k")).select("_k.*").filter("v IS NOT NULL").distinct()
    held = once.agg(*(F.count_if(F.col("k") == k).cast("double").alias(n) for k, n in (("kr", "gene_reads"), ("r", "in_cells"), ("g", "genes"))))
    sources = (("read_qc_reads", "input"), ("correction_map_3p", "full"), ("readids_umi_bc_clean", "valid"), ("read_assigned_cell", "assigned"))
    totals = reduce(DataFrame.crossJoin, [*(distinct(t, n) for t, n in sources), held])  # every side is one row
    cells = materialize(M.per_cell_qc(rows), "cells").df
    out = X.experiment_metrics(totals, cells, bam_summary(spark, sf_dir), transcript_summary(spark, sf_dir))
    return out.withColumn("value", F.round("value", 6))


def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of a run with their shares of the raw reads; reads of less than 200 bases or quality 7 stand for the filtered ones."""
    reads = table(spark, sf_dir, "read_qc_reads").dropDuplicates(["read_id"])
    short = F.coalesce(F.col("read_length") < 200, F.lit(True))
    filtered = reads.agg(F.count_if(short).alias("too_short"), F.count_if(~short & F.coalesce(F.col("mean_quality") < 7, F.lit(True))).alias("too_bad"))
    return X.read_summary(experiment_metrics(spark, sf_dir), filtered).withColumn("share", F.round("share", 6))


def saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.saturation(_rows(spark, sf_dir), _FRACTIONS).withColumn("saturation", F.round("saturation", 9))


def saturation_full_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values at full depth, which don't depend on the order of the rows."""
    curve = M.saturation(_rows(spark, sf_dir), (0.0, 1.0)).filter("fraction = 1.0")
    return curve.withColumn("saturation", F.round("saturation", 9))


def matrix_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered and normalised matrix; limits on features are lower than usual because the cells here have few."""
    out = M.filter_matrix(M.gene_matrix(_rows(spark, sf_dir)), min_features=10, min_cells=3)
    return out.withColumn("value", F.round("value", 6))


def identical_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.identical_profiles(M.gene_matrix(_rows(spark, sf_dir)))


def barnyard_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = M.species_cells(_rows(spark, sf_dir))
    return cells.select(*(F.round(c, 6).alias(c) if c.endswith("fraction") else F.col(c) for c in cells.columns))


def barnyard_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that the ambient filter leaves, with the limit lowered to the depth of these cells."""
    return M.drop_ambient(M.species_cells(_rows(spark, sf_dir)), 20).select("cell_id", "umi_human", "umi_mouse", "assignment")


def barnyard_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.species_summary(M.species_cells(_rows(spark, sf_dir))).withColumn("value", F.round("value", 6))


def purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.purity(M.species_cells(_rows(spark, sf_dir))).withColumn("value", F.round("value", 6))


def _cells_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species counts of the cells with the number of their barcodes."""
    rows = table(spark, sf_dir, "read_assigned_cell").select(
        clean_key("cell_id").alias("cell_id"), F.explode(F.array(clean_key("bc5n"), clean_key("bc3n"))).alias("b")
    )
    pairs = rows.filter("cell_id IS NOT NULL AND b IS NOT NULL").distinct()
    metadata = pairs.groupBy("cell_id").agg(F.count("*").cast("string").alias("n_barcodes"), F.lit("core").alias("type"))
    return M.attach_metadata(M.species_cells(_rows(spark, sf_dir)), metadata)


def cells_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of two, three or four barcodes and at least 5 molecules, in the order of their assignment."""
    chosen = M.least_molecules(M.with_barcode_count(_cells_with_metadata(spark, sf_dir), "2, 4,3"), 5)
    return M.by_assignment(chosen).select("cell_id", "core_type", "n_barcodes", "umi_total", "assignment")


def ambient_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that the ambient filter removes."""
    return M.ambient_cells(M.species_cells(_rows(spark, sf_dir)), 20).select("cell_id", "umi_human", "umi_mouse", "assignment")


def count_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked totals of the genes over all cells."""
    return M.checked_totals(M.gene_matrix(_rows(spark, sf_dir)), "gene").select("gene", F.col("total").cast("long").alias("total"))


def fallback_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of the cells where they aren't clustered, those without counts apart."""
    return M.fallback_layout(M.matrix_cells(_rows(spark, sf_dir)).select("barcode", "n"))


def cell_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 2,000 cells, those with the smallest hashes, with what a report shows of them."""
    cells = per_cell_qc(spark, sf_dir).withColumn("_class", F.lit(0))
    return sample_per_class(cells, "_class", "barcode", 2000, 2000).drop("_class")


def first_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UMI counts of the first 20 reads of each cell and gene."""
    capped = M.first_per_key(_rows(spark, sf_dir), ["barcode", "gene"], ["read_id", "umi"], 20)
    return umi_counts(capped, ["barcode", "gene"], "umi")


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.first_per_key(_rows(spark, sf_dir), ["read_id"], ["gene", "barcode", "umi"])


def umi_directional(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = umi_counts(_rows(spark, sf_dir), ["barcode", "gene"], "umi")
    return collapse_umis(counts, ["barcode", "gene"])


def corrected_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gene matrix over corrected UMIs: a UMI that others are corrected to stays as it is, so that the UMIs that stay are counted."""
    counts = umi_counts(_rows(spark, sf_dir).filter(~M.is_placeholder(F.col("gene"))), ["barcode", "gene"], "umi")
    stay = collapse_umis(counts, ["barcode", "gene"]).filter(F.col("umi") == F.col("umi_corrected"))
    return stay.groupBy("gene", "barcode").agg(F.count("*").alias("n"))


def beads_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells by their number of distinct barcodes."""
    rows = table(spark, sf_dir, "read_assigned_cell").select(
        clean_key("cell_id").alias("cell_id"), F.explode(F.array(clean_key("bc5n"), clean_key("bc3n"))).alias("barcode")
    )
    pairs = rows.filter("cell_id IS NOT NULL AND barcode IS NOT NULL").distinct()
    return pairs.groupBy("cell_id").agg(F.count("*").alias("n_barcodes")).groupBy("n_barcodes").agg(F.count("*").alias("n_cells"))


def barcode_to_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_id, cell, place, barcode: the sorted barcodes of a cell, one a row, and a name from their number."""
    rows = table(spark, sf_dir, "read_assigned_cell").select(
        clean_key("cell_id").alias("cell_id"), F.explode(F.array(clean_key("bc5n"), clean_key("bc3n"))).alias("barcode")
    )
    pairs = rows.filter("cell_id IS NOT NULL AND barcode IS NOT NULL").distinct().withColumn("_one", F.lit(1).cast("long"))
    placed, written = running_sum(pairs, ["cell_id"], ["barcode"], {"place": "_one"}, name="beads")
    sizes = written.df.groupBy("cell_id").agg(F.count("*").alias("_n"))
    number = F.expr("try_cast(regexp_extract(cell_id, 'CELL_([0-9]+)', 1) AS BIGINT)")
    return placed.join(sizes, "cell_id").select("cell_id", F.format_string("CELL%d_N%d", number, F.col("_n")).alias("cell"), "place", "barcode")


def cell_read_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with at least 20 reads, largest first."""
    rows = table(spark, sf_dir, "read_assigned_cell").select(clean_key("cell_id").alias("cell_id"))
    counts = rows.filter("cell_id IS NOT NULL").groupBy("cell_id").agg(F.count("*").alias("n_reads")).filter("n_reads >= 20")
    return counts.orderBy(F.desc("n_reads"), "cell_id")


def read_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of each read from its first row: both barcodes, the pair, and the UMI of the 5' end or else of the 3' end."""
    t = table(spark, sf_dir, "read_assigned_cell")
    rows = t.select(F.trim("read_id").alias("read_id"), *(clean_key(c).alias(c) for c in ("cell_id", "bc5n", "bc3n", "putative_umi", "putative_umi_5p")))
    rows = rows.filter("cell_id IS NOT NULL")
    tagged = rows.select(
        "read_id", "cell_id", F.col("bc5n").alias("barcode_5p"), F.col("bc3n").alias("barcode_3p"),
        F.concat_ws("+", "bc5n", "bc3n").alias("barcode_dual"),
        F.coalesce("putative_umi_5p", "putative_umi").alias("umi"),
    ).filter("umi IS NOT NULL AND barcode_dual <> ''")
    return M.first_per_key(tagged, ["read_id"], ["cell_id", "barcode_dual", "umi"])


def semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw values of the reads that were assigned to a cell."""
    reads = table(spark, sf_dir, "read_qc_reads").select("read_id", "read_length").distinct()
    return reads.join(table(spark, sf_dir, "read_assigned_cell").filter(clean_key("cell_id").isNotNull()), "read_id", "left_semi")


def anti_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw values of the reads that were not."""
    reads = table(spark, sf_dir, "read_qc_reads").select("read_id", "read_length").distinct()
    return reads.join(table(spark, sf_dir, "read_assigned_cell").filter(clean_key("cell_id").isNotNull()), "read_id", "left_anti")


def assignment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """counter, n: rows by the kind of their gene, as one long table."""
    rows = _rows(spark, sf_dir)
    kind = F.when(~M.is_known_gene(F.col("gene")), "gene:region").when(M.is_mito(F.col("gene")), "gene:mito").otherwise("gene:known")
    by_gene = rows.groupBy(kind.alias("counter")).agg(F.count("*").alias("n"))
    by_species = rows.groupBy(F.concat(F.lit("species:"), M.species(F.col("gene"))).alias("counter")).agg(F.count("*").alias("n"))
    return by_gene.unionByName(by_species)


def rank_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of a knee plot of the cells by reads; `called` are the cells that reads were assigned to."""
    counts = _rows(spark, sf_dir).groupBy("barcode").agg(F.count("*").alias("n_reads"))
    return M.knee_points(counts, "barcode", "n_reads", table(spark, sf_dir, "read_assigned_cell").select(clean_key("cell_id")))


QUERIES = {
    f.__name__: f
    for f in (
        gene_matrix, isoform_matrix, per_cell_qc, experiment_metrics, saturation, saturation_full_depth, matrix_norm, identical_profiles,
        barnyard_cells, barnyard_filtered, barnyard_summary, purity, first_n_per_group, dedup_first, umi_directional, corrected_matrix,
        matrix_cells, bam_summary, transcript_summary, stage_summary, cells_with_metadata, ambient_removed, count_totals, fallback_layout, cell_sample,
        beads_hist, barcode_to_cell, cell_read_stats, read_tags, semi_filter, anti_filter, assignment_counts, rank_sample,
    )
}

_M = "WITH " + SQL_MOLECULES
_RECURSIVE = "WITH RECURSIVE " + SQL_MOLECULES
_MATRIX = r""", gm AS (SELECT gene, barcode, count(DISTINCT umi) AS n FROM m WHERE NOT regexp_matches(gene, '^.+_[0-9]+_[0-9]+$') GROUP BY ALL)"""
_CELLS = r""", pc AS (SELECT barcode, count(DISTINCT read_id) AS n_reads, count(DISTINCT CASE WHEN known THEN umi END) AS n_umis,
    count(DISTINCT CASE WHEN known THEN gene END) AS n_genes,
    100.0 * count(*) FILTER (regexp_matches(gene, '^([^_]*_)?MT-')) / count(DISTINCT read_id) AS mito_percent FROM k GROUP BY barcode)"""
_SPECIES = """, s AS (SELECT *, CASE WHEN gene LIKE 'HS\\_%' ESCAPE '\\' THEN 'human' WHEN gene LIKE 'MM\\_%' ESCAPE '\\' THEN 'mouse' ELSE 'other' END AS sp FROM m),
c0 AS (SELECT barcode AS cell_id, """ + ", ".join(
    f"count(DISTINCT {e}) FILTER (sp = '{s}') AS {k}_{s}"
    for k, e in (("read", "read_id"), ("umi", "gene || ' ' || umi"), ("gene", "gene"))
    for s in ("human", "mouse", "other")
) + """ FROM s GROUP BY barcode),
c1 AS (SELECT *, read_human + read_mouse + read_other AS read_total, umi_human + umi_mouse + umi_other AS umi_total,
    gene_human + gene_mouse + gene_other AS gene_total FROM c0),
c2 AS (SELECT *, coalesce(read_human / nullif(read_total, 0), 0.0) AS human_read_fraction, coalesce(read_mouse / nullif(read_total, 0), 0.0) AS mouse_read_fraction,
    coalesce(umi_human / nullif(umi_total, 0), 0.0) AS human_umi_fraction, coalesce(umi_mouse / nullif(umi_total, 0), 0.0) AS mouse_umi_fraction FROM c1),
cells AS (SELECT *, least(human_umi_fraction, mouse_umi_fraction) AS minority_umi_fraction, CASE WHEN mouse_umi_fraction >= 0.9 THEN 'mouse_singlet'
    WHEN human_umi_fraction >= 0.9 THEN 'human_singlet' WHEN human_umi_fraction > 0 AND mouse_umi_fraction > 0 THEN 'mixed' ELSE 'unclassified' END AS assignment FROM c2)"""
_FRACTION_COLUMNS = ("human_read_fraction", "mouse_read_fraction", "human_umi_fraction", "mouse_umi_fraction", "minority_umi_fraction")
_METRIC = lambda pairs: " UNION ALL ".join(f"SELECT '{n}' AS metric, round(CAST(({e}) AS DOUBLE), 6) AS value FROM cells" for n, e in pairs)
_COUNT = lambda a: f"count(*) FILTER (assignment = '{a}')"
_Q = lambda a, c, p: f"quantile_cont({c}, {p}) FILTER (assignment = '{a}')"
_NEAR = "assignment = 'mixed' AND human_umi_fraction BETWEEN 0.4 AND 0.6"
_FAR = "assignment = 'mixed' AND (human_umi_fraction BETWEEN 0.05 AND 0.10 OR human_umi_fraction BETWEEN 0.90 AND 0.95)"
_UMI = r""", n AS (SELECT barcode, gene, umi, count(*) AS n FROM m GROUP BY ALL),
e AS (SELECT a.barcode, a.gene, a.umi AS a, b.umi AS b FROM n AS a JOIN n AS b ON a.barcode = b.barcode AND a.gene = b.gene AND a.umi <> b.umi
    WHERE a.n >= 2 * b.n - 1 AND levenshtein(a.umi, b.umi) <= 3),
reach(barcode, gene, root, node) AS (SELECT barcode, gene, umi, umi FROM n UNION
    SELECT reach.barcode, reach.gene, reach.root, e.b FROM reach JOIN e ON reach.barcode = e.barcode AND reach.gene = e.gene AND reach.node = e.a),
best AS (SELECT r.barcode, r.gene, r.node AS umi, r.root, row_number() OVER (PARTITION BY r.barcode, r.gene, r.node ORDER BY n.n DESC, r.root) AS rn
    FROM reach AS r JOIN n ON r.barcode = n.barcode AND r.gene = n.gene AND r.root = n.umi),
umis AS (SELECT n.barcode, n.gene, n.umi, n.n, best.root AS umi_corrected FROM n JOIN best ON n.barcode = best.barcode AND n.gene = best.gene AND n.umi = best.umi AND best.rn = 1)"""
_ASSIGNED = f"""WITH r AS (SELECT trim(read_id, ' ') AS read_id, {sql_clean('cell_id')} AS cell_id, {sql_clean('bc5n')} AS a, {sql_clean('bc3n')} AS b,
    {sql_clean('putative_umi')} AS u3, {sql_clean('putative_umi_5p')} AS u5 FROM read_assigned_cell),
p AS (SELECT DISTINCT cell_id, x FROM (SELECT cell_id, a AS x FROM r UNION ALL SELECT cell_id, b FROM r) WHERE cell_id IS NOT NULL AND x IS NOT NULL)"""
_IN = f"read_id {{}}IN (SELECT read_id FROM read_assigned_cell WHERE {sql_clean('cell_id')} IS NOT NULL)"
_FINAL = f"(SELECT DISTINCT trim(read_id, ' ') AS read_id FROM read_assigned_cell WHERE {sql_clean('cell_id')} IS NOT NULL)"
_BAM = f""", al AS (SELECT trim(read_id, ' ') AS read_id, CASE substr(md5(read_id), 1, 1) WHEN '0' THEN 'u' WHEN '1' THEN 's' WHEN '2' THEN '2' ELSE 'p' END AS f FROM correction_map_3p),
bam AS (SELECT count(*) AS records, count(*) FILTER (f = 'u') AS unmapped, count(*) FILTER (f = 'p') AS primary_mapped, count(*) FILTER (f = 's') AS supplementary,
    count(DISTINCT read_id) FILTER (f <> 'u') AS mapped_reads, count(DISTINCT read_id) FILTER (f <> 'u' AND read_id IN {_FINAL}) AS mapped_in_cells FROM al)"""
_TX = f""", tx AS (SELECT count(DISTINCT read_id) AS known_reads, count(DISTINCT gene || '.' || substr(umi, 7, 1)) AS isoforms FROM k WHERE known AND read_id IN {_FINAL})"""
_DISTINCT = lambda t: f"(SELECT count(DISTINCT read_id) FROM {t})"
_FULL, _INPUT = _DISTINCT("correction_map_3p"), _DISTINCT("read_qc_reads")
_KNOWN, _IN_CELLS = "(SELECT count(DISTINCT read_id) FROM k WHERE known)", "(SELECT count(DISTINCT read_id) FROM k)"
_GENES, _N_CELLS = "(SELECT count(DISTINCT gene) FROM k WHERE known)", "(SELECT count(*) FROM pc)"
_FROM = lambda c, t: f"(SELECT {c} FROM {t})"
_TOTALS = {
    "Input reads": _INPUT, "Raw FASTQ reads": _INPUT, "Full length reads": _FULL, "Pass reads": _FULL, "Estimated number of cells": _N_CELLS,
    "Aligned BAM reads": _FROM("mapped_reads", "bam"), "Aligned BAM records": _FROM("records", "bam"), "Mapped": _FROM("primary_mapped", "bam"), "Unmapped": _FROM("unmapped", "bam"),
    "Supplementary": _FROM("supplementary", "bam"), "Barcode-valid reads": _DISTINCT("readids_umi_bc_clean"), "Reads assigned to final cells": _DISTINCT("read_assigned_cell"),
    "Gene assigned reads": _KNOWN, "Reads in final cells": _IN_CELLS, "Reads aligned to reference genome in final cells": _FROM("mapped_in_cells", "bam"),
    "Reads per cell (mean)": f"{_INPUT} / {_N_CELLS}", "Mean reads per cell": f"{_INPUT} / {_N_CELLS}", "Mean cell-associated reads per cell": _FROM("avg(n_reads)", "pc"),
    "Mean UMI counts per cell": _FROM("avg(n_umis)", "pc"), "Median UMI counts per cell": _FROM("median(n_umis)", "pc"), "Mean Genes per cell": _FROM("avg(n_genes)", "pc"),
    "Median Genes per cell": _FROM("median(n_genes)", "pc"), "Genes per cell (median)": _FROM("median(n_genes)", "pc"), "Unique genes": _GENES, "Total genes detected": _GENES,
    "Fraction reads in cells": f"{_IN_CELLS} / {_FULL}", "Percent full length reads": f"{_FULL} / {_INPUT}", "Percent barcode-valid reads of full length": f"{_DISTINCT('readids_umi_bc_clean')} / {_FULL}",
    "Percent reads assigned to final cells of full length": f"{_DISTINCT('read_assigned_cell')} / {_FULL}", "Percent gene assigned reads of full length": f"{_KNOWN} / {_FULL}",
    "Fraction reads aligned to reference genome in final cells": f"{_FROM('mapped_in_cells', 'bam')} / {_FULL}",
    "Transcript assigned reads": _FROM("known_reads", "tx"), "Percent transcript assigned reads of full length": f"{_FROM('known_reads', 'tx')} / {_FULL}",
    "High-confidence known-transcript reads": _FROM("known_reads", "tx"), "Fraction high-confidence known-transcript reads in final cells": f"{_FROM('known_reads', 'tx')} / {_FULL}",
    "Unique isoforms": _FROM("isoforms", "tx"),
}

ORACLES = {
    "gene_matrix": _M + _MATRIX + " SELECT * FROM gm",
    "isoform_matrix": _M + """, t AS (SELECT read_id, min(gene || '.' || substr(umi, 7, 1)) AS transcript_id FROM m GROUP BY read_id)
        SELECT transcript_id, barcode, count(DISTINCT umi) AS n FROM m JOIN t USING (read_id) GROUP BY ALL""",
    "per_cell_qc": _M + _CELLS + " SELECT barcode, n_reads, n_umis, n_genes, round(mito_percent, 6) AS mito_percent FROM pc",
    "matrix_cells": _M + _MATRIX + """ SELECT c.barcode, coalesce(f, 0) AS n_features, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (SELECT DISTINCT barcode FROM m) AS c
        LEFT JOIN (SELECT barcode, count(*) AS f, sum(n) AS n FROM gm GROUP BY barcode) AS g ON c.barcode = g.barcode""",
    "bam_summary": _M + _BAM + " SELECT * FROM bam",
    "transcript_summary": _M + _TX + " SELECT * FROM tx",
    "stage_summary": _M + f""", q AS (SELECT count(*) FILTER (coalesce(l < 200, true)) AS sh, count(*) FILTER (NOT coalesce(l < 200, true) AND coalesce(q < 7, true)) AS bad
            FROM (SELECT any_value(read_length) AS l, any_value(mean_quality) AS q FROM read_qc_reads GROUP BY read_id)){_TX},
        s AS (SELECT 0 AS no, 'Raw reads' AS metric, {_INPUT} AS n UNION ALL SELECT 1, 'Clean reads', {_INPUT} - sh - bad FROM q UNION ALL SELECT 2, 'Full length', {_FULL} UNION ALL SELECT 3, 'Barcode-valid', {_DISTINCT('readids_umi_bc_clean')}
            UNION ALL SELECT 4, 'Cell-assigned', {_DISTINCT('read_assigned_cell')} UNION ALL SELECT 5, 'Gene assigned', {_KNOWN} UNION ALL SELECT 6, 'Transcript assigned', known_reads FROM tx)
        SELECT no, metric, CAST(n AS DOUBLE) AS n, round(n / {_INPUT}, 6) AS share FROM s""",
    "cells_with_metadata": _M + _SPECIES + f""", b AS (SELECT cell_id, count(DISTINCT x) AS n_barcodes FROM (SELECT {sql_clean('cell_id')} AS cell_id, {sql_clean('bc5n')} AS x FROM read_assigned_cell
            UNION ALL SELECT {sql_clean('cell_id')}, {sql_clean('bc3n')} FROM read_assigned_cell) WHERE cell_id IS NOT NULL AND x IS NOT NULL GROUP BY cell_id)
        SELECT cells.cell_id, 'core' AS core_type, CAST(n_barcodes AS INTEGER) AS n_barcodes, umi_total, assignment FROM cells JOIN b ON cells.cell_id = b.cell_id WHERE n_barcodes IN (2, 3, 4) AND umi_total >= 5""",
    "ambient_removed": _M + _SPECIES + " SELECT cell_id, umi_human, umi_mouse, assignment FROM cells WHERE umi_human < 20 AND umi_mouse < 20",
    "count_totals": _M + _MATRIX + " SELECT gene, CAST(sum(n) AS BIGINT) AS total FROM gm GROUP BY gene",
    "fallback_layout": _M + _MATRIX + """, c AS (SELECT barcode, coalesce((SELECT CAST(sum(n) AS BIGINT) FROM gm WHERE gm.barcode = x.barcode), 0) AS n FROM (SELECT DISTINCT barcode FROM m) AS x),
        p AS (SELECT *, row_number() OVER (PARTITION BY n > 0 ORDER BY barcode) - 1 - (count(*) OVER (PARTITION BY n > 0) - 1) / 2.0 AS x FROM c)
        SELECT barcode, CAST(x AS DOUBLE) AS x, CAST(CASE WHEN n > 0 OR NOT (SELECT bool_or(n > 0) FROM c) THEN 0 ELSE -1 END AS DOUBLE) AS y, CASE WHEN n > 0 THEN '0' ELSE 'unassigned' END AS label,
            CASE WHEN n > 0 THEN 'fallback' ELSE 'unassigned' END AS status, n FROM p""",
    "cell_sample": _M + _CELLS + """ SELECT barcode, n_reads, n_umis, n_genes, round(mito_percent, 6) AS mito_percent FROM pc QUALIFY row_number() OVER (ORDER BY sha256(barcode), barcode) <= 2000""",
    "experiment_metrics": _M + _CELLS + _BAM + _TX + " ".join(["", " UNION ALL ".join(f"SELECT '{n}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value" for n, e in _TOTALS.items())]),
    "saturation": _M + f""", o AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', read_id, gene, barcode, umi)), read_id, gene, barcode, umi) AS rk FROM k),
        f AS (SELECT CAST(fraction AS DOUBLE) AS fraction, CAST(round_even(fraction * (SELECT count(*) FROM m), 0) AS BIGINT) AS reads FROM (SELECT unnest({list(_FRACTIONS)}) AS fraction)),
        c AS (SELECT fraction, barcode, count(DISTINCT read_id) AS r, count(DISTINCT umi) AS u, count(DISTINCT CASE WHEN known THEN gene END) AS g FROM f JOIN o ON rk <= reads GROUP BY ALL),
        d AS (SELECT fraction, median(r) AS r, median(u) AS u, median(g) AS g FROM c GROUP BY fraction),
        n AS (SELECT fraction, count(DISTINCT gene || '_' || barcode || '_' || umi) AS mols FROM f JOIN o ON rk <= reads GROUP BY fraction)
        SELECT f.fraction, reads, coalesce(r, 0.0) AS reads_per_cell, coalesce(g, 0.0) AS genes_per_cell, coalesce(u, 0.0) AS umis_per_cell,
            CASE WHEN reads > 0 THEN round(1 - mols / reads, 9) ELSE 0.0 END AS saturation FROM f LEFT JOIN d ON f.fraction = d.fraction LEFT JOIN n ON f.fraction = n.fraction""",
    "saturation_full_depth": _M + """, c AS (SELECT barcode, count(DISTINCT read_id) AS r, count(DISTINCT umi) AS u, count(DISTINCT CASE WHEN known THEN gene END) AS g FROM k GROUP BY barcode)
        SELECT CAST(1.0 AS DOUBLE) AS fraction, (SELECT count(*) FROM m) AS reads, median(r) AS reads_per_cell, median(g) AS genes_per_cell, median(u) AS umis_per_cell,
        round(1 - (SELECT count(DISTINCT gene || '_' || barcode || '_' || umi) FROM m) / (SELECT count(*) FROM m), 9) AS saturation FROM c""",
    "matrix_norm": _M + _MATRIX + """, f AS (SELECT gene FROM gm GROUP BY gene HAVING count(*) >= 3), c AS (SELECT barcode FROM gm GROUP BY barcode HAVING count(*) >= 10),
        l AS (SELECT * FROM gm WHERE gene IN (FROM f) AND barcode IN (FROM c)),
        t AS (SELECT barcode, sum(n) AS total, coalesce(sum(n) FILTER (contains(gene, 'MT-') OR contains(gene, 'mt-')), 0) AS mito FROM l GROUP BY barcode)
        SELECT gene, l.barcode, n, round(log10(1 + n * 10000.0 / total), 6) AS value FROM l JOIN t USING (barcode) WHERE mito <= 0.2 * total""",
    "identical_profiles": _M + _MATRIX + """ SELECT count(DISTINCT p) <= 1 AS identical FROM (SELECT string_agg(gene || ' ' || n, ',' ORDER BY gene) AS p FROM gm GROUP BY barcode)""",
    "barnyard_cells": _M + _SPECIES + f" SELECT * EXCLUDE ({', '.join(_FRACTION_COLUMNS)}), " + ", ".join(f"round({c}, 6) AS {c}" for c in _FRACTION_COLUMNS) + " FROM cells",
    "barnyard_filtered": _M + _SPECIES + " SELECT cell_id, umi_human, umi_mouse, assignment FROM cells WHERE NOT (umi_human < 20 AND umi_mouse < 20)",
    "barnyard_summary": _M + _SPECIES + " " + _METRIC([
        ("total_cells", "count(*)"),
        *((f"{a}_cells", _COUNT(a)) for a in ("human_singlet", "mouse_singlet", "mixed", "unclassified")),
        ("cross_species_doublet_rate_among_classified", f"{_COUNT('mixed')} / nullif(count(*) - {_COUNT('unclassified')}, 0)"),
        ("human_singlet_mouse_fraction_median", _Q("human_singlet", "mouse_umi_fraction", 0.5)),
        ("human_singlet_mouse_fraction_p95", _Q("human_singlet", "mouse_umi_fraction", 0.95)),
        ("mouse_singlet_human_fraction_median", _Q("mouse_singlet", "human_umi_fraction", 0.5)),
        ("mouse_singlet_human_fraction_p95", _Q("mouse_singlet", "human_umi_fraction", 0.95)),
        ("mixed_human_fraction_median", _Q("mixed", "human_umi_fraction", 0.5)),
        ("mixed_mouse_fraction_median", _Q("mixed", "mouse_umi_fraction", 0.5)),
        ("mixed_near_50_50_cells", f"count(*) FILTER ({_NEAR})"),
        ("mixed_near_50_50_fraction", f"count(*) FILTER ({_NEAR}) / nullif({_COUNT('mixed')}, 0)"),
        ("mixed_mostly_90_10_cells", f"count(*) FILTER ({_FAR})"),
        ("mixed_mostly_90_10_fraction", f"count(*) FILTER ({_FAR}) / nullif({_COUNT('mixed')}, 0)"),
        *((f"{a}_umi_total_median", _Q(a, "umi_total", 0.5)) for a in ("human_singlet", "mouse_singlet", "mixed")),
    ]),
    "purity": _M + _SPECIES + ", own AS (SELECT " + ", ".join(
        f"coalesce(sum({c}) FILTER (assignment = '{a}'), 0) AS {n}"
        for n, a, c in (("o0", "human_singlet", "umi_human"), ("t0", "human_singlet", "umi_total"), ("o1", "mouse_singlet", "umi_mouse"), ("t1", "mouse_singlet", "umi_total"))
    ) + f", {_COUNT('human_singlet')} AS n0, {_COUNT('mouse_singlet')} AS n1 FROM cells) " + " UNION ALL ".join(
        f"SELECT '{n}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value, CAST(NULL AS VARCHAR) AS text FROM own"
        for n, e in (
            ("genome0_singlet_cells", "n0"), ("genome1_singlet_cells", "n1"), ("effective_singlet_cells_for_overall_purity", "n0 + n1"),
            ("genome0_singlet_own_umis", "o0"), ("genome0_singlet_total_umis", "t0"), ("genome1_singlet_own_umis", "o1"), ("genome1_singlet_total_umis", "t1"),
            ("all_singlet_dominant_species_umis", "o0 + o1"), ("all_singlet_total_umis", "t0 + t1"),
            ("human_mean_purity", "o0 / nullif(t0, 0)"), ("mouse_mean_purity", "o1 / nullif(t1, 0)"),
            ("genome0_mean_purity", "o0 / nullif(t0, 0)"), ("genome1_mean_purity", "o1 / nullif(t1, 0)"), ("overall_purity", "(o0 + o1) / nullif(t0 + t1, 0)"),
        )
    ) + " UNION ALL SELECT 'genome0_name', NULL, 'human' UNION ALL SELECT 'genome1_name', NULL, 'mouse'",
    "first_n_per_group": _M + """, f AS (SELECT *, row_number() OVER (PARTITION BY barcode, gene ORDER BY read_id, umi) AS rn FROM m)
        SELECT barcode, gene, umi, count(*) AS n FROM f WHERE rn <= 20 GROUP BY ALL""",
    "dedup_first": _M + """ SELECT read_id, gene, barcode, umi FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY gene, barcode, umi) AS rn FROM m) WHERE rn = 1""",
    "umi_directional": _RECURSIVE + _UMI + " SELECT * FROM umis",
    "corrected_matrix": _RECURSIVE + _UMI + r" SELECT gene, barcode, count(DISTINCT umi_corrected) AS n FROM umis WHERE NOT regexp_matches(gene, '^.+_[0-9]+_[0-9]+$') GROUP BY ALL",
    "beads_hist": _ASSIGNED + " SELECT n_barcodes, count(*) AS n_cells FROM (SELECT cell_id, count(*) AS n_barcodes FROM p GROUP BY cell_id) GROUP BY n_barcodes",
    "barcode_to_cell": _ASSIGNED + """ SELECT cell_id, 'CELL' || CAST(regexp_extract(cell_id, 'CELL_([0-9]+)', 1) AS BIGINT) || '_N' || count(*) OVER (PARTITION BY cell_id) AS cell,
        row_number() OVER (PARTITION BY cell_id ORDER BY x) AS place, x AS barcode FROM p""",
    "cell_read_stats": _ASSIGNED + " SELECT cell_id, count(*) AS n_reads FROM r WHERE cell_id IS NOT NULL GROUP BY cell_id HAVING count(*) >= 20",
    "read_tags": _ASSIGNED + """, t AS (SELECT read_id, cell_id, a AS barcode_5p, b AS barcode_3p, concat_ws('+', a, b) AS barcode_dual, coalesce(u5, u3) AS umi FROM r
        WHERE cell_id IS NOT NULL AND coalesce(a, b) IS NOT NULL AND coalesce(u5, u3) IS NOT NULL)
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY cell_id, barcode_dual, umi) AS rn FROM t) WHERE rn = 1""",
    "semi_filter": f"SELECT DISTINCT read_id, read_length FROM read_qc_reads WHERE {_IN.format('')}",
    "anti_filter": f"SELECT DISTINCT read_id, read_length FROM read_qc_reads WHERE {_IN.format('NOT ')}",
    "assignment_counts": _M + """ SELECT CASE WHEN NOT known THEN 'gene:region' WHEN regexp_matches(gene, '^([^_]*_)?MT-') THEN 'gene:mito' ELSE 'gene:known' END AS counter, count(*) AS n FROM k GROUP BY 1
        UNION ALL SELECT 'species:' || CASE left(gene, 3) WHEN 'HS_' THEN 'human' WHEN 'MM_' THEN 'mouse' ELSE 'other' END, count(*) FROM k GROUP BY 1""",
    "rank_sample": _M + """, c AS (SELECT barcode, count(*) AS n_reads FROM m GROUP BY barcode), r AS (SELECT *, row_number() OVER (ORDER BY n_reads DESC, barcode) AS cell_rank FROM c)
        SELECT cell_rank, barcode, n_reads, barcode IN (SELECT {c} FROM read_assigned_cell WHERE {c} IS NOT NULL) AS called FROM r WHERE cell_rank <= 20000""".format(c=sql_clean("cell_id")),
}
