"""Sequence and quality expressions; all but the tail scan are built-in column functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | int) -> Column:
    return F.lit(x) if isinstance(x, int) else x


def py_slice(seq: Column, start: Column | int, end: Column | int) -> Column:
    """`seq[start:end]` with negative and out-of-range bounds; an end of 0 is the start of the string."""
    n = F.length(seq)

    def bound(x: Column) -> Column:
        return F.least(F.greatest(F.when(x < 0, n + x).otherwise(x), F.lit(0)), n)

    a, e = bound(_col(start)), bound(_col(end))
    return F.when(a < e, F.substring(seq, a + 1, e - a)).otherwise(F.when(n.isNotNull(), F.lit("")))


def find(seq: Column, sub: str) -> Column:
    """Index of the first occurrence, -1 if there is none."""
    return F.locate(sub, seq) - 1


def rfind_from_end(seq: Column, sub: str) -> Column:
    """Index of the last occurrence counted from the end (negative), -1 if there is none."""
    at = F.locate(sub[::-1], F.reverse(seq))
    return F.when(at == 0, F.lit(-1)).otherwise(-(at - 1) - F.lit(len(sub)))


def revcomp(seq: Column) -> Column:
    """Reverse complement that keeps the case; letters other than ACGT stay."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def revcomp_upper(seq: Column) -> Column:
    """Reverse complement of the trimmed sequence in upper case; unknown letters become N."""
    return revcomp(F.regexp_replace(F.upper(F.trim(seq)), "[^ACGTN]", "N"))


def phred(qual: Column) -> Column:
    """Qualities of a Phred+33 string."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def min_quality(qual: Column) -> Column:
    """Smallest quality; NULL for an empty string."""
    return F.when(qual != "", F.ascii(F.array_min(F.split(qual, ""))) - 33)


def mean_quality(scores: Column) -> Column:
    """Quality of the mean error of an array of qualities, without 10 at each end from 100 on, as FLOAT."""
    n = F.size(scores)
    inner = F.when(n >= 100, F.slice(scores, F.lit(11), F.greatest(n - 20, F.lit(0)))).otherwise(scores)
    error = F.aggregate(inner, F.lit(0.0), lambda s, q: s + F.pow(F.lit(10.0), -q / 10.0)) / F.size(inner)
    return F.when(error > 0, -10 * F.log10(error)).otherwise(F.lit(0.0)).cast("float")


def passes_gate(scores: Column, min_length: int, min_mean_quality: float) -> Column:
    """0 for a read that passes, 16 for one too short, 17 for one of low quality."""
    error = F.aggregate(scores, F.lit(0.0), lambda s, q: s + F.pow(F.lit(10.0), -q / 10.0)) / F.size(scores)
    return F.when(F.size(scores) < min_length, 16).when(-10 * F.log10(error) < min_mean_quality, 17).otherwise(0)


def tail_lengths(windows: pd.Series) -> np.ndarray:
    """Lengths of the A tails at the ends of windows in upper case, NaN where there is none; all windows of a batch together."""
    known = windows.fillna("")
    n = known.str.len().to_numpy()
    width = max(int(n.max()) if len(n) else 0, 4)
    flat = np.frombuffer("".join(known.str.ljust(width, "\0")).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(known), width)
    is_a = flat == ord("A")
    count = np.zeros((len(known), width + 1), np.int32)
    count[:, 1:] = np.cumsum(is_a, axis=1)
    four = is_a[:, : width - 3] & is_a[:, 1 : width - 2] & is_a[:, 2 : width - 1] & is_a[:, 3:]
    last = np.where(four.any(1), width - 4 - four[:, ::-1].argmax(1), -1)
    # The tail goes on to the left of a place over an A, or over a base that ends 10 with at least 7 A.
    place = np.arange(width + 1)
    goes_on = np.zeros((len(known), width + 1), bool)
    goes_on[:, 1:] = is_a | (count[:, 1:] - count[:, np.maximum(place[1:] - 10, 0)] >= 7)
    stops = ~goes_on & (place <= last[:, None])
    start = width - stops[:, ::-1].argmax(1)
    return np.where((last >= 0) & (n - start >= 8), n - start, np.nan)


def poly_a_start(window: Column, end: Column) -> Column:
    """Start of the A tail in the upper-case `window` that ends at `end`, as an index from the end of the read, or NULL.

    From the last AAAA the tail goes left over each A and each base that ends 10 bases with 7 or more A.
    Tails of fewer than 8 bases don't count.
    """

    @F.pandas_udf("int")
    def tail(windows: pd.Series) -> pd.Series:
        return pd.Series(tail_lengths(windows)).astype("Int32")

    return end - tail(window)


def ratio_of(seq: Column, letter: str) -> Column:
    """Share of a letter; 0 for an empty sequence."""
    n = F.length(seq)
    return F.when(n > 0, (n - F.length(F.replace(seq, F.lit(letter), F.lit("")))) / n).otherwise(F.lit(0.0))
