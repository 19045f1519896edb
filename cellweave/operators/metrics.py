"""Metrics of a whole experiment: alignments, transcripts, cells, and the list that a report shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.selection import select_quantiles


def wide_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row: for each name the exact quantile, between ranks, of a column over its rows that aren't NULL.

    All columns are put under each other as counts of their values and go through one selection, so that no task
    holds the values of a column. Without a row the value is NULL.
    """
    columns = sorted({c for c, _ in wanted.values()})
    items = F.array(*(F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in columns))
    counts = df.select(F.explode(items).alias("_i")).select("_i.*").filter("v IS NOT NULL").groupBy("k", "v").agg(F.count("*").alias("w"))
    found = select_quantiles(counts, ["k"], "v", sorted({p for _, p in wanted.values()}), weight="w", interpolate=True)
    pick = lambda c, p: F.max(F.when((F.col("k") == c) & (F.col("prob") == F.lit(float(p))), F.col("value")))
    return found.agg(*(pick(c, p).alias(name) for name, (c, p) in wanted.items()))


def alignment_summary(records: DataFrame, final_reads: DataFrame) -> DataFrame:
    """One row: records, unmapped, primary_mapped, supplementary, mapped_reads, mapped_in_cells.

    `records` has read_id and flag (bits 4 unmapped, 256 secondary, 2048 supplementary); the last two count distinct mapped
    reads, and those in the read_id column of `final_reads`. They go over distinct reads first, so that no task holds them all.
    """
    unset = lambda bit: F.col("flag").bitwiseAND(bit) == 0
    mapped = unset(4)
    per_read = records.groupBy("read_id").agg(
        F.count("*").alias("n"), F.count_if(~mapped).alias("un"), F.count_if(mapped & unset(256) & unset(2048)).alias("pr"), F.count_if(mapped & ~unset(2048)).alias("su"), F.max(mapped).alias("any")
    )
    final = final_reads.select("read_id").distinct().withColumn("_in", F.lit(True))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_read.join(final, "read_id", "left").agg(
        zero("n").alias("records"), zero("un").alias("unmapped"), zero("pr").alias("primary_mapped"), zero("su").alias("supplementary"),
        F.count_if("any").alias("mapped_reads"), F.count_if(F.col("any") & F.coalesce("_in", F.lit(False))).alias("mapped_in_cells"),
    )


def transcript_summary(calls: DataFrame, final_reads: DataFrame) -> DataFrame:
    """One row: known_reads, isoforms, the distinct reads and transcripts of assigned calls among `final_reads`.

    `calls` has read_id, status and transcript_id; calls that aren't Assigned or whose transcript is NA don't count.
    """
    known = calls.filter("status = 'Assigned' AND transcript_id <> 'NA'").join(final_reads.select("read_id").distinct(), "read_id", "left_semi")
    pairs = known.select(F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("read_id").cast("string").alias("v")), F.struct(F.lit(1).alias("k"), F.col("transcript_id").alias("v")))).alias("_p"))
    once = pairs.select("_p.*").distinct()
    return once.agg(F.count_if(F.col("k") == 0).alias("known_reads"), F.count_if(F.col("k") == 1).alias("isoforms"))


def experiment_metrics(totals: DataFrame, cells: DataFrame, alignments: DataFrame, transcripts: DataFrame | None = None) -> DataFrame:
    """metric, value DOUBLE: the totals, means, medians and ratios of an experiment; a ratio to nothing is 0.

    `totals` is one row with input, full, valid, assigned, gene_reads, in_cells and genes; `cells` has n_reads, n_umis and n_genes; the other
    two are the summaries above. Without `transcripts` the five metrics of transcripts are left out.
    """
    medians = wide_quantiles(cells, {"_mid_umis": ("n_umis", 0.5), "_mid_genes": ("n_genes", 0.5)})
    means = cells.agg(F.count("*").alias("_cells"), *(F.avg(c).alias(f"_mean_{c}") for c in ("n_reads", "n_umis", "n_genes")))
    one = totals.crossJoin(medians).crossJoin(means).crossJoin(alignments)  # every side is one row
    if transcripts is not None:
        one = one.crossJoin(transcripts)
    c = F.col
    ratio = lambda a, b: F.coalesce(F.try_divide(c(a), c(b)), F.lit(0.0))
    per_cell = ratio("input", "_cells")
    metrics = {
        "Input reads": c("input"), "Full length reads": c("full"), "Estimated number of cells": c("_cells"), "Raw FASTQ reads": c("input"), "Aligned BAM reads": c("mapped_reads"),
        "Aligned BAM records": c("records"), "Pass reads": c("full"), "Mapped": c("primary_mapped"), "Unmapped": c("unmapped"), "Supplementary": c("supplementary"),
        "Barcode-valid reads": c("valid"), "Reads assigned to final cells": c("assigned"), "Gene assigned reads": c("gene_reads"), "Reads in final cells": c("in_cells"),
        "Reads aligned to reference genome in final cells": c("mapped_in_cells"), "Reads per cell (mean)": per_cell, "Mean reads per cell": per_cell,
        "Mean cell-associated reads per cell": c("_mean_n_reads"), "Mean UMI counts per cell": c("_mean_n_umis"), "Median UMI counts per cell": c("_mid_umis"),
        "Mean Genes per cell": c("_mean_n_genes"), "Median Genes per cell": c("_mid_genes"), "Genes per cell (median)": c("_mid_genes"), "Unique genes": c("genes"), "Total genes detected": c("genes"),
        "Fraction reads in cells": ratio("in_cells", "full"), "Percent full length reads": ratio("full", "input"), "Percent barcode-valid reads of full length": ratio("valid", "full"),
        "Percent reads assigned to final cells of full length": ratio("assigned", "full"), "Percent gene assigned reads of full length": ratio("gene_reads", "full"),
        "Fraction reads aligned to reference genome in final cells": ratio("mapped_in_cells", "full"),
    }
    if transcripts is not None:
        known = ratio("known_reads", "full")
        metrics |= {
            "Transcript assigned reads": c("known_reads"), "Percent transcript assigned reads of full length": known, "High-confidence known-transcript reads": c("known_reads"),
            "Fraction high-confidence known-transcript reads in final cells": known, "Unique isoforms": c("isoforms"),
        }
    rows = F.array(*(F.struct(F.lit(k).alias("metric"), F.coalesce(v.cast("double"), F.lit(0.0)).alias("value")) for k, v in metrics.items()))
    return one.select(F.explode(rows).alias("_m")).select("_m.*")


def read_summary(metrics: DataFrame, filtered: DataFrame | None = None) -> DataFrame:
    """metric, n, share of the stages of a run to its raw reads, in their order (`no`); NULL where a stage has no metric.

    `filtered` is one row with the numbers of reads filtered by length and by quality; without it clean reads are those of full length.
    """
    stages = [("Full length", "Full length reads"), ("Barcode-valid", "Barcode-valid reads"), ("Cell-assigned", "Reads assigned to final cells"),
              ("Gene assigned", "Gene assigned reads"), ("Transcript assigned", "Transcript assigned reads")]
    value = lambda name: F.max(F.when(F.col("metric") == name, F.col("value")))
    one = metrics.agg(value("Input reads").alias("_raw"), *(value(name).alias(f"_s{i}") for i, (_, name) in enumerate(stages)))
    if filtered is not None:
        one = one.crossJoin(F.broadcast(filtered.select("too_short", "too_bad")))  # one row
        clean = F.greatest(F.col("_raw") - F.col("too_short") - F.col("too_bad"), F.lit(0.0))
    else:
        clean = F.col("_s0")
    shown = [("Raw reads", F.col("_raw")), ("Clean reads", clean), *((label, F.col(f"_s{i}")) for i, (label, _) in enumerate(stages))]
    rows = F.array(*(F.struct(F.lit(i).alias("no"), F.lit(k).alias("metric"), v.alias("n"), F.try_divide(v, F.col("_raw")).alias("share")) for i, (k, v) in enumerate(shown)))
    return one.select(F.explode(rows).alias("_m")).select("_m.*")
