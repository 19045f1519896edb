"""Barcode and UMI structures at the ends of reads, their lists and their correction."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions import seq as S
from cellweave.functions.edits import blocks
from cellweave.operators.segments import bounds, cut_places

# Middles of the barcodes and anchors of the UMIs as they stand in a read.
BC_MIDDLE_3P = "GCTACC"
BC_MIDDLE_5P = "CCTTCC"
UMI_ANCHOR_3P = "AGATC"
UMI_ANCHOR_5P = "TGCTG"


def _staged(df: DataFrame, *steps: dict[str, Column]) -> DataFrame:
    """One projection for each step, so that what several expressions use is worked out once."""
    for step in steps:
        df = df.select("*", *(c.alias(k) for k, c in step.items()))
    return df


def extract_3p(df: DataFrame, seq: str, qual: str, out: str = "end3", middle: str = BC_MIDDLE_3P, anchor: str = UMI_ANCHOR_3P) -> DataFrame:
    """`df` with the STRUCT `out` of the barcode and UMI structure in the last 30 bases.

    Fields: bc, bc_loc (from the end; -1 without a middle), bc_min_q, umi, umi_loc, flank, poly_a and
    read_type 1 to 14. Where the middle is missing, the place of the UMI anchor counts from the end of
    the read without its last 40 bases, but is used as one from the end of the read.
    """
    s, n = F.col(seq), F.length(seq)
    loc, found = F.col("_loc"), F.col("_umi_loc").isNotNull()
    exact, left, none = loc == -16, loc < -16, loc == -1
    placed = exact | left
    near, far, umi_loc = F.col("_near"), F.col("_far"), F.col("_umi_loc")
    first = F.when(exact, 1).when(left, 5).when(none, 9).otherwise(12)
    step = F.when(found, 0).when(placed, 2)
    kind = F.when(step.isNotNull(), first + step + F.when(F.col("_poly").isNotNull(), 0).otherwise(1)).otherwise(
        F.when(none, 11).otherwise(14)
    )
    staged = _staged(
        df,
        {"_loc": S.rfind_from_end(S.py_slice(s, -30, n), middle)},
        {
            "_near": S.rfind_from_end(S.py_slice(s, loc - 20, loc - 10), anchor),
            "_far": S.rfind_from_end(S.py_slice(s, F.lit(0), F.lit(-40)), anchor),
        },
        {"_umi_loc": F.when(none, F.when(far != -1, far)).otherwise(F.when(near != -1, near + loc - 10))},
        {
            "_umi_end": F.when(found, umi_loc + 5).when(placed, loc - 10),
            "_bc_from": F.when(left, loc - 10).when(~placed & ~none & found, umi_loc + 5).otherwise(F.lit(-26)),
            "_bc_to": F.when(left, loc + 16).otherwise(n),
            "_window_end": F.when(found, umi_loc - 10).when(placed, loc - 10),
        },
        {"_window": F.upper(S.py_slice(s, F.col("_window_end") - 100, F.col("_window_end")))},
        {"_poly": S.poly_a_start(F.col("_window"), F.col("_window_end"))},
    )
    umi_end = F.col("_umi_end")
    result = F.struct(
        S.py_slice(s, F.col("_bc_from"), F.col("_bc_to")).alias("bc"),
        loc.alias("bc_loc"),
        F.when(placed | (~none & found), S.min_quality(S.py_slice(F.col(qual), F.col("_bc_from"), F.col("_bc_to")))).alias("bc_min_q"),
        F.coalesce(S.py_slice(s, umi_end - 15, umi_end), F.lit("")).alias("umi"),
        umi_loc.alias("umi_loc"),
        F.coalesce(S.py_slice(s, umi_end - 20, umi_end - 15), F.lit("")).alias("flank"),
        F.col("_poly").alias("poly_a"),
        kind.alias("read_type"),
    )
    return staged.select(*(F.col(c) for c in df.columns), result.alias(out))


def extract_5p(df: DataFrame, seq: str, qual: str, out: str = "end5", middle: str = BC_MIDDLE_5P, anchor: str = UMI_ANCHOR_5P) -> DataFrame:
    """`df` with the STRUCT `out` of bc, bc_loc, bc_min_q, umi and umi_loc in the first bases of a read."""
    s, loc = F.col(seq), F.col("_loc")
    none, right = loc == -1, loc > 11
    start, near, early, umi_loc = F.col("_start"), F.col("_near"), F.col("_early"), F.col("_umi_loc")
    staged = _staged(
        df,
        {"_loc": S.find(S.py_slice(s, 0, 30), middle)},
        {
            "_bc_from": F.when(right, loc - 10).otherwise(F.lit(0)),
            "_bc_to": F.when(none | (loc == 11), F.lit(26)).otherwise(loc + 16),
            "_start": F.when(loc == 11, F.lit(26)).otherwise(loc + 16),
        },
        {"_near": S.find(S.py_slice(s, start, start + 10), anchor), "_early": S.find(S.py_slice(s, 0, 40), anchor)},
        {"_umi_loc": F.when(none, F.when(early != -1, early)).otherwise(F.when(near != -1, near + start))},
    )
    umi = F.when(umi_loc.isNotNull(), S.py_slice(s, umi_loc, umi_loc + 15)).when(~none, S.py_slice(s, start, start + 15)).otherwise("")
    result = F.struct(
        S.py_slice(s, F.col("_bc_from"), F.col("_bc_to")).alias("bc"),
        loc.alias("bc_loc"),
        F.when(~none, S.min_quality(S.py_slice(F.col(qual), F.col("_bc_from"), F.col("_bc_to")))).alias("bc_min_q"),
        umi.alias("umi"),
        umi_loc.alias("umi_loc"),
    )
    return staged.select(*(F.col(c) for c in df.columns), result.alias(out))


def trim_bounds(end3: Column, end5: Column, length: Column, valid3: Column, valid5: Column) -> Column:
    """STRUCT<start, end> of the read between its structures, NULL if nothing is left.

    Only ends whose barcode was found valid are cut. `end3` and `end5` are the structs of the two extractions.
    """

    def inside(at: Column) -> Column:
        place = F.when(at < 0, length + at).otherwise(at)
        return F.when(place.between(0, length), place)

    umi5, bc5 = inside(end5["umi_loc"]), end5["bc_loc"]
    start = F.when(
        valid5,
        F.coalesce(F.least(umi5 + 15, length), F.when(bc5 >= 0, F.least(bc5 + 31, length)), F.lit(0)),
    ).otherwise(F.lit(0))
    poly, umi3, bc3 = inside(end3["poly_a"]), inside(end3["umi_loc"]), inside(F.when(end3["bc_loc"] != -1, end3["bc_loc"]))
    end = F.when(
        valid3,
        F.coalesce(poly, F.greatest(umi3 - 10, F.lit(0)), F.greatest(bc3 - 25, F.lit(0)), length),
    ).otherwise(length)
    return F.when((start < end) & (end <= length), F.struct(start.alias("start"), end.alias("end")))


def trimmed_reads(clean: DataFrame, reads: DataFrame, seq: str, qual: str, bounds: str) -> DataFrame:
    """read_id, seq, qual, fell_back: the cDNA of the clean reads; a read whose bounds are NULL keeps its whole sequence.

    `reads` has read_id, the sequence, its qualities and the STRUCT of `trim_bounds`. A clean read that isn't among them is an error.
    """
    found = F.col("_b.start").isNotNull()
    rows = clean.select("read_id").join(reads.select("read_id", F.col(seq).alias("_s"), F.col(qual).alias("_q"), F.col(bounds).alias("_b")), "read_id", "left")
    missing = F.raise_error(F.concat(F.lit("a clean read has no sequence: "), F.col("read_id")))
    cut = lambda c: F.when(found, F.substring(F.col(c), F.col("_b.start") + 1, F.col("_b.end") - F.col("_b.start"))).otherwise(F.col(c))
    return rows.select("read_id", F.coalesce(cut("_s"), missing).alias("seq"), cut("_q").alias("qual"), (~found).alias("fell_back"))


def known_barcodes(rows: DataFrame, barcode: str, quality: str, min_quality: int = 2) -> DataFrame:
    """barcode: the distinct ones, but for rows whose quality is known to be too low; blank barcodes left out."""
    low = F.coalesce(F.col(quality) < min_quality, F.lit(False))
    return rows.filter(~low & (F.trim(F.col(barcode)) != "")).select(F.col(barcode).alias("barcode")).distinct()


def strip_middle(barcode: Column, middle: str) -> Column:
    """The 20 outer bases of a barcode of 26 with the fixed middle, otherwise an empty string."""
    fits = (F.length(barcode) == 26) & (F.substring(barcode, 11, 6) == middle)
    return F.when(fits, F.concat(F.substring(barcode, 1, 10), F.substring(barcode, 17, 10))).otherwise("")


def correction_status(putative: Column, corrected: Column) -> Column:
    """failed, exact or corrected."""
    return F.when(F.coalesce(corrected, F.lit("")) == "", "failed").when(putative == corrected, "exact").otherwise("corrected")


def expand_whitelist(tens: DataFrame, column: str, middle: str, reverse: bool = False) -> DataFrame:
    """`barcode`: every pair of 10-base entries around the middle. The product is the result asked for.

    Entries that aren't 10 of ACGT, or that repeat, raise an error; so there are at most 4^10, and one side can be broadcast. The
    other is spread over a stated number of tasks, since adaptive execution sees only few rows and would put them into one.
    """
    bad = ~F.col(column).rlike("^[ACGT]{10}$")
    checked = tens.select(
        F.when(bad, F.raise_error(F.concat(F.lit("not a barcode of 10 bases: "), F.col(column)))).otherwise(F.col(column)).alias("ten")
    )
    once = checked.groupBy("ten").agg(F.count("*").alias("n")).select(
        F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("repeated barcode: "), F.col("ten")))).otherwise(F.col("ten")).alias("ten")
    )
    part = once.select((S.revcomp(F.col("ten")) if reverse else F.col("ten")).alias("ten"))
    spark = tens.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    left = part.select(F.concat("ten", F.lit(middle)).alias("a")).repartition(tasks, "a")
    return left.crossJoin(F.broadcast(part.withColumnRenamed("ten", "b"))).select(F.concat("a", "b").alias("barcode"))


def high_quality_counts(rows: DataFrame, barcode: str, quality: str, min_quality: int = 2) -> DataFrame:
    """barcode, n_reads of the rows whose quality is known and high enough, most reads first; blank barcodes left out."""
    keep = F.col(quality).isNotNull() & (F.col(quality) >= min_quality) & (F.trim(F.col(barcode)) != "")
    return rows.filter(keep).groupBy(F.col(barcode).alias("barcode")).agg(F.count("*").alias("n_reads")).orderBy(F.desc("n_reads"), "barcode")


def observed_whitelist(counts: DataFrame, full: DataFrame, expected_cells: int = 5000) -> DataFrame:
    """barcode, n_reads of the entries of the full list above a twentieth of the 95th percentile of the top ones."""
    known = counts.join(full.select("barcode").distinct(), "barcode", "left_semi")
    top = known.orderBy(F.desc("n_reads"), "barcode").limit(expected_cells)
    cut = top.agg((F.percentile("n_reads", F.lit(0.95)) / 20).alias("cut"))
    return known.crossJoin(F.broadcast(cut)).filter("n_reads > cut").drop("cut").orderBy("barcode")  # one row


def validity_summary(rows: DataFrame, bc3: str, bc5: str) -> DataFrame:
    """One row: reads with both, one or no barcode, and their ratios."""
    has3, has5 = (F.coalesce(F.col(c), F.lit("")) != "" for c in (bc3, bc5))
    counts = {
        "valid_any": has3 | has5,
        "only_3p": has3 & ~has5,
        "only_5p": ~has3 & has5,
        "both": has3 & has5,
        "neither": ~has3 & ~has5,
    }
    total = F.count("*")
    return rows.agg(
        total.alias("total_rows"),
        *(F.count_if(c).alias(f"{k}_n") for k, c in counts.items()),
        *(F.coalesce(F.try_divide(F.count_if(c), total), F.lit(0.0)).alias(f"{k}_ratio") for k, c in counts.items()),
    )


def substring_distances(patterns: pd.Series, texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Smallest edit distance of each pattern to any substring of its text, and the last end of such a substring.

    Pairs of texts alike in length go through the letters together, with one row of the usual table each.
    """
    best, end = np.zeros(len(patterns), np.int32), np.zeros(len(patterns), np.int32)
    left, right = patterns.tolist(), texts.tolist()
    for block in blocks([len(p) + len(t) for p, t in zip(left, right)]):
        best[block], end[block] = _substring_distances(pd.Series([left[x] for x in block]), pd.Series([right[x] for x in block]))
    return best, end


def _substring_distances(patterns: pd.Series, texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:

    def codes(strings: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        width = int(strings.str.len().max())
        flat = "".join(strings.str.ljust(width, "\0")).encode("utf-32-le")
        return np.frombuffer(flat, np.uint32).reshape(len(strings), width), strings.str.len().to_numpy()

    p, m = codes(patterns)
    t, n = codes(texts)
    steps, pairs = np.arange(p.shape[1] + 1, dtype=np.int32), np.arange(len(p))
    row = np.tile(steps, (len(p), 1))
    best, end = m.astype(np.int32), np.zeros(len(p), np.int32)
    for j in range(t.shape[1]):
        turned = row + 1
        turned[:, 0] = 0
        turned[:, 1:] = np.minimum(turned[:, 1:], row[:, :-1] + (p != t[:, j : j + 1]))
        row = np.minimum.accumulate(turned - steps, axis=1) + steps
        last = row[pairs, m]
        good = (j < n) & (last <= best)
        best, end = np.where(good, last, best), np.where(good, j + 1, end)
    return best, end


def fuzzy_join(values: DataFrame, column: str, entries: DataFrame, entry: str, k: int = 2) -> DataFrame:
    """value, corrected: the entry that fits into the value best, within k edits; "" if none or several do.

    An exact entry wins. Otherwise entries are compared with any substring of the value. An entry within k
    edits leaves one of its k + 1 parts unchanged, so values and entries meet on parts (an
    equi-join), and only the pairs that met are compared.
    """
    asked = values.select(F.col(column).alias("value")).filter("value <> ''").distinct()
    known = entries.select(F.col(entry).alias("entry")).filter("entry <> ''").distinct()
    places = cut_places(known, "entry", k + 1)
    size = F.length("entry")

    def part(p: int) -> Column:
        start, end = bounds(size, places, p)
        return F.struct(start.alias("at"), (end - start).alias("n"), F.substring(F.col("entry"), start + 1, end - start).alias("text"))

    pieces = known.select("entry", F.explode(F.array(*(part(p) for p in range(len(places) - 1)))).alias("_s")).select("entry", "_s.*")
    sizes = pieces.select("n").distinct()  # as many rows as part lengths differ
    # A value offers its substrings of those lengths; before and behind a part lie k edits at most.
    offered = (
        asked.join(known.withColumnRenamed("entry", "value"), "value", "left_anti")
        .crossJoin(F.broadcast(sizes))
        .filter(F.length("value") >= F.col("n"))
        .select("value", "n", F.explode_outer(F.transform(
            F.sequence(F.lit(0), F.length("value") - F.col("n")),
            lambda i: F.struct(i.alias("place"), F.substring(F.col("value"), i + 1, F.col("n")).alias("text")),
        )).alias("_s")).select("value", "n", "_s.*")
    )
    near_by = F.col("place").between(F.col("at") - k, F.col("at") + F.length("value") - F.length("entry") + k)
    pairs = offered.join(pieces, ["n", "text"]).filter(near_by).select("value", "entry").distinct()

    @F.pandas_udf("int")
    def distance(entry: pd.Series, value: pd.Series) -> pd.Series:
        return pd.Series(substring_distances(entry, value)[0])

    scored = pairs.withColumn("d", distance("entry", "value")).filter(F.col("d") <= k)
    best = scored.groupBy("value", "d").agg(F.count("*").alias("n_best"), F.min("entry").alias("entry"))
    nearest = best.groupBy("value").agg(F.min(F.struct("d", "n_best", "entry")).alias("b"))
    near = nearest.select("value", F.when(F.col("b.n_best") == 1, F.col("b.entry")).otherwise("").alias("corrected"))
    exact = asked.join(known.withColumnRenamed("entry", "value"), "value", "left_semi").select("value", F.col("value").alias("corrected"))
    return asked.join(exact.unionByName(near), "value", "left").select("value", F.coalesce("corrected", F.lit("")).alias("corrected"))
