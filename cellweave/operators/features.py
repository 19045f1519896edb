"""Choice of a read's gene and transcript from its hits, and tables of references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.intervals import query_length, reference_length

# Classes of assembled transcripts that keep their gene but not their transcript.
UNNAMED_CLASSES = ("i", "y", "p", "s")


def attribute(attributes: Column, key: str) -> Column:
    """Value of `key "value"` in a GTF attribute column; NULL if it isn't there."""
    value = F.regexp_extract(attributes, f'{key} "([^"]*)"', 1)
    return F.when(value != "", value)


def named(value: Column) -> Column:
    """NULL for the sentinels that stand for no name."""
    return F.when(~F.coalesce(value, F.lit("")).isin("", "-", ".", "NA"), value)


def transcript_reference(gtf: DataFrame) -> DataFrame:
    """transcript_id, gene: the label of the transcript, else of its gene's record, else of an exon of its gene, else the gene id.

    Labels are `gene_name`, else `genename`; kinds of records are read in any case. A transcript without any name is an error.
    Where several records of a gene carry labels the smallest counts; of several records of a transcript the one that has a
    label, then the smallest.
    """
    attributes = F.col("attributes")
    rows = gtf.select(
        F.lower("feature").alias("kind"),
        attribute(attributes, "transcript_id").alias("transcript_id"),
        named(attribute(attributes, "gene_id")).alias("gene_id"),
        F.coalesce(named(attribute(attributes, "gene_name")), named(attribute(attributes, "genename"))).alias("label"),
    )
    labels = rows.filter("gene_id IS NOT NULL").groupBy("gene_id").agg(
        F.min(F.when(F.col("kind") == "gene", F.col("label"))).alias("_gene"), F.min(F.when(F.col("kind") == "exon", F.col("label"))).alias("_exon")
    )
    own = rows.filter("kind IN ('transcript', 'mrna') AND transcript_id IS NOT NULL").groupBy("transcript_id").agg(
        F.min("label").alias("_own"), F.min("gene_id").alias("gene_id")
    )
    gene = F.coalesce("_own", "_gene", "_exon", "gene_id")
    missing = F.raise_error(F.concat(F.lit("a transcript without a gene name or id: "), F.col("transcript_id")))
    return own.join(labels, "gene_id", "left").select("transcript_id", F.coalesce(gene, missing).alias("gene"))


def candidates(tmap: DataFrame, reference: DataFrame) -> DataFrame:
    """query_id, gene, transcript: assembled transcripts (qry_id, ref_id, class_code) that a reference transcript is known for.

    The others are left out before any hit is ranked. Of several rows of a query the one with the largest reference id counts.
    """
    known = reference.select(F.col("transcript_id").alias("ref_id"), "gene")
    met = tmap.select("qry_id", "ref_id", "class_code").join(known, "ref_id")
    one = met.groupBy(F.col("qry_id").alias("query_id")).agg(F.max(F.struct("ref_id", "class_code", "gene")).alias("_c"))
    return one.select("query_id", F.col("_c.gene").alias("gene"), mask_class(F.col("_c.class_code"), F.col("_c.ref_id")).alias("transcript"))


def hit_features(alignments: DataFrame, known: DataFrame, lengths: DataFrame) -> DataFrame:
    """read_id, gene, transcript, score, query_cov, transcript_cov, mapq, ord of the alignments to candidates.

    `alignments` has read_id, query_id (the transcript aligned to), start, cigar, mapq, ord and score (NULL is 0); `lengths` has query_id and
    length. The first coverage is of the read with its clipped ends, the second of the transcript; reads of no length are left out.
    """
    c = F.col("cigar")
    spans = alignments.join(known, "query_id").join(lengths, "query_id").select(
        "read_id", "gene", "transcript", F.coalesce("score", F.lit(0)).alias("score"), query_length(c, False).alias("_aligned"), query_length(c, True).alias("_read"),
        reference_length(c).alias("_span"), "length", "mapq", "ord",
    )
    return spans.filter("_read > 0").select(
        "read_id", "gene", "transcript", "score", (F.col("_aligned") / F.col("_read")).alias("query_cov"), (F.col("_span") / F.col("length")).alias("transcript_cov"), "mapq", "ord"
    )


def mask_class(class_code: Column, transcript: Column) -> Column:
    return F.when(class_code.isin(*UNNAMED_CLASSES), "-").otherwise(transcript)


def select_features(hits: DataFrame, reads: DataFrame, min_mapq: int = 30, min_read: float = 0.4, min_transcript: float = 0.4) -> DataFrame:
    """read_id, gene, transcript, reason of each read; "-" where none is clear.

    `hits` has read_id, gene, transcript, score, query_cov, transcript_cov, mapq and ord (their order, which decides
    ties); `reads` has read_id and genome_mapq. The gene is that of the best hit if the read maps well to
    the genome. A single hit needs a transcript mapping quality above 0, for gene and transcript. If the best
    two differ in score or coverage of the read, the transcript needs both coverages; if not, it needs to be
    covered more than the second and more than 0.8. The reason is "no_reference_candidate" without a hit,
    "ambiguous_or_zero_transcript_mapq" with hits but neither gene nor transcript, and "candidate" otherwise.
    """
    w = Window.partitionBy("read_id").orderBy(F.desc("score"), F.desc("query_cov"), F.desc("transcript_cov"), "ord")
    ranked = hits.select("*", F.row_number().over(w).alias("_rn"), *(F.lead(c).over(w).alias(f"_{c}") for c in ("score", "query_cov", "transcript_cov")))
    best = ranked.filter("_rn = 1")
    gene = F.when(F.col("genome_mapq") >= min_mapq, F.col("gene")).otherwise("-")
    alone = F.col("_score").isNull()
    differ = (F.col("score") != F.col("_score")) | (F.col("query_cov") != F.col("_query_cov"))
    covered = (F.col("query_cov") >= min_read) & (F.col("transcript_cov") >= min_transcript)
    fuller = (F.col("transcript_cov") != F.col("_transcript_cov")) & (F.col("transcript_cov") > 0.8)
    missed = F.col("_rn").isNull() | (alone & (F.col("mapq") <= 0))
    keep = F.when(alone, True).when(differ, covered).otherwise(fuller)
    out = reads.join(best, "read_id", "left").select(
        "read_id",
        F.when(missed, "-").otherwise(gene).alias("gene"),
        F.when(missed, "-").when(keep, F.col("transcript")).otherwise("-").alias("transcript"),
        F.col("_rn").isNotNull().alias("_hit"),
    )
    reason = F.when(~F.col("_hit"), "no_reference_candidate").when((F.col("gene") == "-") & (F.col("transcript") == "-"), "ambiguous_or_zero_transcript_mapq").otherwise("candidate")
    return out.select("read_id", "gene", "transcript", reason.alias("reason"))


def assignment_status(records: DataFrame, features: DataFrame, min_mapq: int = 30) -> DataFrame:
    """read_id, mapq, gene_status, gene, transcript_status, transcript, reason of each tagged primary record.

    `records` has chrom, read_id and mapq; `features` has chrom, read_id, gene, transcript and reason. A record without features has
    no reference candidate. Names that are "-" come out as NA.
    """
    met = records.join(features.select("chrom", "read_id", "gene", "transcript", "reason"), ["chrom", "read_id"], "left").select(
        "read_id", "mapq", *(F.coalesce(c, F.lit("-")).alias(c) for c in ("gene", "transcript")), F.coalesce("reason", F.lit("no_reference_candidate")).alias("reason")
    )
    unclear, low = F.col("reason") == "ambiguous_or_zero_transcript_mapq", F.col("mapq") < min_mapq
    gene_status = F.when(F.col("gene") != "-", "Assigned").when(low, "Unassigned_mapq").when(unclear, "Unassigned_ambiguous").otherwise("Unassigned_no_features")
    tx_status = F.when(F.col("transcript") != "-", "Assigned").when(F.col("reason") != "no_reference_candidate", "Unassigned_ambiguous").otherwise("Unassigned_no_features")
    shown = lambda c: F.when(F.col(c) == "-", "NA").otherwise(F.col(c))
    return met.select("read_id", "mapq", gene_status.alias("gene_status"), shown("gene").alias("gene"), tx_status.alias("transcript_status"), shown("transcript").alias("transcript"), "reason")


def status_counts(statuses: DataFrame) -> DataFrame:
    """counter, n: gene:, transcript: and reason: counters of `assignment_status`."""
    names = F.array(*(F.concat(F.lit(f"{k}:"), F.col(c)) for k, c in (("gene", "gene_status"), ("transcript", "transcript_status"), ("reason", "reason"))))
    return statuses.select(F.explode(names).alias("counter")).groupBy("counter").agg(F.count("*").alias("n"))
