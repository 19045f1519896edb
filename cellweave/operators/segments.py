"""Parts of short texts on which texts within a few edits of each other must meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Texts that the cuts are fitted on, and places along a text that are told apart.
SAMPLE, PLACES = 10_000, 200


def cut_places(texts: DataFrame, column: str, parts: int) -> list[float]:
    """Where to cut texts, as shares of their length, so that every part tells about as much.

    Positions at which all texts agree tell nothing; cutting at equal lengths would give parts that
    nearly every text has. Cuts are fitted on the `SAMPLE` texts with the smallest hashes and decide about speed alone: any cuts
    find the same. At most `PLACES` rows come to the driver.
    """
    sample = texts.select(F.col(column).alias("_t")).orderBy(F.xxhash64(column)).limit(SAMPLE)
    letters = sample.select(F.posexplode(F.split("_t", "")).alias("i", "c"), F.length("_t").alias("n")).filter("c <> ''")
    at = F.floor(F.col("i") * PLACES / F.col("n")) / PLACES
    counts = letters.groupBy(at.alias("at"), "c").agg(F.count("*").alias("m"))
    told = counts.groupBy("at").agg((F.log2(F.sum("m")) - F.sum(F.col("m") * F.log2("m")) / F.sum("m")).alias("bits"))
    rows = sorted(told.collect())
    total, upto, cuts = sum(r.bits for r in rows) or 1.0, 0.0, []
    for r in rows:
        if len(cuts) < parts - 1 and upto >= total * (len(cuts) + 1) / parts:
            cuts.append(r["at"])
        upto += r.bits
    if len(cuts) < parts - 1:  # too few places that tell anything: all parts are needed all the same
        cuts = [i / parts for i in range(1, parts)]
    return [0.0, *cuts, 1.0]


def bounds(length: Column, places: list[float], part: int) -> tuple[Column, Column]:
    """Start and end of a part of texts of a length."""
    return F.round(length * places[part]).cast("int"), F.round(length * places[part + 1]).cast("int")
