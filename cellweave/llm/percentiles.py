"""Percentiles per group from cumulative frequencies.

The rows are reduced to counts of group and value, which add up over partitions and days. The counts
are range-sorted; running sums within a partition plus the totals of the partitions before it give
the cumulative frequencies, and the first value that reaches a rank is the percentile. With a
`resolution` the values are rounded down to its multiples first: the error is then below it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.prefix import running_sum


def value_counts(df: DataFrame, group: Sequence[str], value: str, resolution: float | None = None) -> DataFrame:
    """`group`, value DOUBLE, n LONG: the mergeable summary. NULL and NaN values are left out."""
    v = F.col(value).cast("double")
    if resolution:
        v = F.floor(v / F.lit(float(resolution))) * F.lit(float(resolution))
    rows = df.select(*group, v.alias("value")).filter("value IS NOT NULL AND NOT isnan(value)")
    return rows.groupBy(*group, "value").agg(F.count("*").alias("n"))


def merge_counts(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Summaries of parts, days or runs, unioned, as one summary over the coarser `group`."""
    return counts.groupBy(*group, "value").agg(F.sum("n").alias("n"))


def percentiles(counts: DataFrame, group: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """`group`, prob, value: percentiles of merged counts, linear between the two nearest ranks.

    `counts` has one row per group and value. NULL is a group of its own; groups without a value
    don't appear; an empty table gives an empty result. The two ranks around (n - 1) * prob are
    looked up as the first values whose cumulative count reaches them.
    """
    group = list(group)
    rows = counts.select(*group, "value", "n").filter("n > 0")
    summed, written = running_sum(rows, group, ["value"], {"_cum": "n"}, name="frequencies")
    totals = written.df.groupBy(*group).agg(F.sum("n").alias("_total"))
    names = [f"_g{i}" for i in range(len(group))]
    totals = totals.select(*(F.col(c).alias(a) for c, a in zip(group, names)), "_total")
    on = F.lit(True)
    for c, a in zip(group, names):
        on = on & F.col(c).eqNullSafe(F.col(a))
    def around(prob: Column) -> tuple[Column, Column, Column]:
        at = prob * (F.col("_total") - 1)
        return F.floor(at) + 1, F.ceil(at) + 1, at - F.floor(at)

    reached = lambda rank: (F.col("_cum") >= rank) & (F.col("_cum") - F.col("n") < rank)
    # Only rows that reach a rank of some percentile are multiplied.
    some = reduce(or_, (reached(rank) for p in probs for rank in around(F.lit(float(p)))[:2]))
    low, high, part = around(F.col("prob"))
    asked = F.explode(F.array(*(F.lit(float(p)) for p in probs))).alias("prob")
    ranked = summed.join(totals, on).filter(some).select(*group, "value", "n", "_cum", "_total", asked)
    ranked = ranked.withColumns({"_low": low, "_high": high, "_part": part})
    picked = ranked.filter(reached(F.col("_low")) | reached(F.col("_high"))).groupBy(*group, "prob").agg(
        F.max(F.when(reached(F.col("_low")), F.col("value"))).alias("_a"),
        F.max(F.when(reached(F.col("_high")), F.col("value"))).alias("_b"),
        F.max("_part").alias("_part"),
    )
    return picked.select(*group, "prob", (F.col("_a") + F.col("_part") * (F.col("_b") - F.col("_a"))).alias("value"))
