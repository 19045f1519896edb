"""Read quality of files that keep arriving: an extension over the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(reads: DataFrame, late: str = "7 days", width: str = "1 day") -> DataFrame:
    """sample_name, day_start, n_reads, total_bases of a stream of raw read values, by when the read ended.

    A read that is loaded again within the time allowed for lateness counts once; the sums of a window are
    given out when it can't change any more. Negative and NULL lengths add no bases.
    """
    once = reads.withWatermark("ended_at", late).dropDuplicatesWithinWatermark(["read_id"])
    return (
        once.groupBy(F.window("ended_at", width).alias("w"), "sample_name")
        .agg(
            F.count("*").alias("n_reads"),
            F.sum(F.when(F.col("read_length") >= 0, F.col("read_length")).otherwise(0)).alias("total_bases"),
        )
        .select("sample_name", F.col("w.start").alias("day_start"), "n_reads", "total_bases")
    )
