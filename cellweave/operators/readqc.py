"""Length and quality distributions of reads, from mergeable counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.prefix import running_sum
from cellweave.operators.selection import select_quantiles
from cellweave.session import materialize


def length_counts(reads: DataFrame, group: Sequence[str], length: str) -> DataFrame:
    """`group`, length, n: the summary that the others start from; summaries of parts add up."""
    return reads.filter(F.col(length) >= 0).groupBy(*group, F.col(length).alias("length")).agg(F.count("*").alias("n"))


def _weighted_rank(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    summed, _ = running_sum(counts, group, ["length"], {"_cum": "n"}, name="lengths")
    return summed


def length_histogram(counts: DataFrame, group: Sequence[str], bins: int = 80, upper: float = 0.995, least_kb: float = 0.5) -> DataFrame:
    """`group`, bin, mid_kb, n: bins up to the upper quantile, longer reads in the last; empty bins have n 0."""
    g = list(group)
    totals = counts.groupBy(*g).agg(F.sum("n").alias("_total"))
    at = (F.col("_total") - 1) * upper
    ranked = _weighted_rank(counts, g).join(totals, g)
    holds = lambda r: (F.col("_cum") > r) & (F.col("_cum") - F.col("n") <= r)
    low = F.max(F.when(holds(F.floor(at)), F.col("length")))
    high = F.max(F.when(holds(F.ceil(at)), F.col("length")))
    weight = F.max(at - F.floor(at))
    top = ranked.groupBy(*g).agg(F.greatest((low + (high - low) * weight) / 1000, F.lit(least_kb)).alias("_top"))
    width = F.col("_top") / bins
    filled = counts.join(top, g).withColumn(
        "bin", F.least(F.floor(F.least(F.col("length") / 1000, F.col("_top")) / width), F.lit(bins - 1)).cast("int")
    ).groupBy(*g, "bin").agg(F.sum("n").alias("_n"))
    frame = top.select(*g, "_top", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(filled, [*g, "bin"], "left").select(
        *g, "bin", ((F.col("bin") + 0.5) * width).alias("mid_kb"), F.coalesce("_n", F.lit(0)).alias("n")
    )


def quality_histogram(reads: DataFrame, group: Sequence[str], quality: str, bins: int = 60) -> DataFrame:
    """`group`, bin, mid, n over one unit below the smallest whole quality (at least 0) to one above the largest."""
    g = list(group)
    q = F.col(quality).cast("float").cast("double")
    counts = reads.filter(q >= 0).groupBy(*g, q.alias("_q")).agg(F.count("*").alias("_c"))
    edges = counts.groupBy(*g).agg(
        (F.greatest(F.floor(F.min("_q")), F.lit(0)) - 1).alias("_lo"), (F.ceil(F.max("_q")) + 1).alias("_hi")
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    filled = counts.join(edges, g).withColumn(
        "bin", F.least(F.floor((F.col("_q") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    ).groupBy(*g, "bin").agg(F.sum("_c").alias("_n"))
    frame = edges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(filled, [*g, "bin"], "left").select(
        *g, "bin", (F.col("_lo") + (F.col("bin") + 0.5) * width).alias("mid"), F.coalesce("_n", F.lit(0)).alias("n")
    )


def n50(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """`group`, n_reads, total_bases, n50: the length at which the longest reads hold half of the bases, rounded up."""
    g = list(group)
    rows = counts.withColumn("_bases", F.col("length") * F.col("n")).withColumn("_down", -F.col("length"))
    summed, _ = running_sum(rows, g, ["_down"], {"_cum": "_bases"}, name="yield")
    totals = rows.groupBy(*g).agg(F.sum("_bases").alias("total_bases"), F.sum("n").alias("n_reads"), F.min("length").alias("_least"))
    half = F.ceil(F.col("total_bases") / 2)
    hit = (F.col("_cum") >= half) & (F.col("_cum") - F.col("_bases") < half)
    return summed.join(totals, g).groupBy(*g, "n_reads", "total_bases", "_least").agg(
        F.max(F.when(hit, F.col("length"))).alias("_n50")
    ).select(*g, "n_reads", "total_bases", F.coalesce("_n50", "_least").alias("n50"))


def yield_curve(counts: DataFrame, group: Sequence[str], points: int = 300) -> DataFrame:
    """`group`, read_rank, x_kb, y_gb: bases in reads from a rank on (longest first), at evenly spaced ranks."""
    g = list(group)
    rows = counts.withColumn("_bases", F.col("length") * F.col("n")).withColumn("_down", -F.col("length"))
    summed, _ = running_sum(rows, g, ["_down"], {"_seen": "n", "_cum": "_bases"}, name="yield")
    totals = rows.groupBy(*g).agg(F.sum("_bases").alias("_all"), F.sum("n").alias("_reads"))
    m = F.least(F.col("_reads"), F.lit(points))
    placed = (
        summed.join(totals, g)
        .withColumn("_from", F.col("_seen") - F.col("n"))
        # Points whose rank falls into this length: rank = point * (reads - 1) div (points - 1).
        .withColumn("_p0", F.when(m == 1, 0).otherwise(F.ceil(F.col("_from") * (m - 1) / (F.col("_reads") - 1))))
        .withColumn("_p1", F.when(m == 1, 0).otherwise(F.least(F.ceil(F.col("_seen") * (m - 1) / (F.col("_reads") - 1)) - 1, m - 1)))
        .filter((F.col("_p0") <= F.col("_p1")) & ((m > 1) | (F.col("_from") == 0)))
        .withColumn("_p", F.explode(F.sequence(F.col("_p0").cast("long"), F.col("_p1").cast("long"))))
        .withColumn("read_rank", F.when(m == 1, 0).otherwise(F.floor(F.col("_p") * (F.col("_reads") - 1) / (m - 1))).cast("long"))
    )
    before = F.col("_cum") - F.col("_bases") + (F.col("read_rank") - F.col("_from")) * F.col("length")
    return placed.select(*g, "read_rank", (F.col("length") / 1000).alias("x_kb"), ((F.col("_all") - before) / 1e9).alias("y_gb")).distinct()


def qc_payload(reads: DataFrame, group: Sequence[str], length: str, quality: str, points: int = 300) -> DataFrame:
    """`group`, payload: the summary of raw read values as JSON, with sections on quality, length and the yield above a length.

    Values that are NULL or negative are left out of their section; a group without a length has no summary. Lists have 60, 80 and
    at most `points` places, whatever the number of reads.
    """
    g = list(group)
    rows = materialize(reads.select(*g, F.col(length).alias("_l"), F.col(quality).cast("float").cast("double").alias("_q")), "reads").df
    counts = materialize(length_counts(rows, g, "_l"), "lengths").df
    kinds = F.array(F.struct(F.lit("l").alias("k"), F.col("_l").cast("double").alias("v")), F.struct(F.lit("q").alias("k"), F.col("_q").alias("v")))
    values = rows.select(*g, F.explode(kinds).alias("_i")).select(*g, "_i.*").filter("v >= 0").groupBy(*g, "k", "v").agg(F.count("*").alias("w"))
    middle = select_quantiles(values, [*g, "k"], "v", [0.5], weight="w", interpolate=True).withColumn("mean", F.col("total") / F.col("n"))
    of = lambda k, c: F.max(F.when(F.col("k") == k, F.col(c)))
    stats = middle.groupBy(*g).agg(of("l", "value").alias("_lm"), of("l", "mean").alias("_la"), of("q", "value").alias("_qm"), of("q", "mean").alias("_qa"))
    ends = counts.groupBy(*g).agg(F.min("length").alias("_min"), F.max("length").alias("_max"))
    listed = lambda df, by, *c: df.groupBy(*g).agg(F.sort_array(F.collect_list(F.struct(by, *c))).alias("_h"))
    parts = [
        n50(counts, g),
        stats,
        ends,
        listed(length_histogram(counts, g), "bin", F.round("mid_kb", 6).alias("m"), "n").withColumnRenamed("_h", "_lh"),
        listed(quality_histogram(rows, g, "_q"), "bin", F.round("mid", 6).alias("m"), "n").withColumnRenamed("_h", "_qh"),
        listed(yield_curve(counts, g, points), "read_rank", "x_kb", "y_gb").withColumnRenamed("_h", "_yh"),
    ]
    one = parts[0]
    for i, part in enumerate(parts[1:]):
        names = [f"_r{i}_{j}" for j in range(len(g))]
        renamed = part.select(*(F.col(c).alias(r) for c, r in zip(g, names)), *(c for c in part.columns if c not in g))
        one = one.join(renamed, [F.col(c).eqNullSafe(F.col(r)) for c, r in zip(g, names)] or F.lit(True), "left").drop(*names)
    payload = F.struct(
        "n_reads",
        F.struct(F.col("_qa").alias("mean"), F.col("_qm").alias("median"), F.col("_qh.m").alias("bins"), F.col("_qh.n").alias("counts")).alias("quality"),
        F.struct(
            F.col("_la").alias("mean"), F.col("_lm").alias("median"), F.col("_min").alias("min"), F.col("_max").alias("max"), F.col("_lh.m").alias("bins_kb"), F.col("_lh.n").alias("counts")
        ).alias("length"),
        F.struct(F.col("_yh.x_kb").alias("x_kb"), F.col("_yh.y_gb").alias("y_gb"), (F.col("total_bases") / 1e9).alias("total_gb"), F.col("n50").alias("n50_bp")).alias("yield_above_length"),
    )
    return one.select(*g, F.to_json(payload).alias("payload"))


#: Schema of the JSON that `qc_payload` makes.
PAYLOAD = (
    "n_reads long, quality struct<mean: double, median: double, bins: array<double>, counts: array<long>>, "
    "length struct<mean: double, median: double, min: long, max: long, bins_kb: array<double>, counts: array<long>>, "
    "yield_above_length struct<x_kb: array<double>, y_gb: array<double>, total_gb: double, n50_bp: long>"
)


def sample_per_class(rows: DataFrame, group: str, key: str, whole: int = 100_000, most: int = 25_000) -> DataFrame:
    """All rows of a class of at most `whole`, and of a larger one the `most` whose keys have the smallest SHA-256.

    Ranks come from running counts over range-sorted hashes, so that no class passes through one task.
    """
    hashed = rows.withColumns({"_h": F.sha2(F.col(key).cast("string"), 256), "_one": F.lit(1).cast("long")})
    ranked, written = running_sum(hashed, [group], ["_h", key], {"_rank": "_one"}, name="sample")
    sizes = written.df.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("_all"))
    kept = ranked.join(sizes, F.col(group).eqNullSafe(F.col("_g"))).filter((F.col("_all") <= whole) | (F.col("_rank") <= most))
    return kept.select(*rows.columns)
