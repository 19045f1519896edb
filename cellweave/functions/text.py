"""Column helpers for the oddly spelled text fields of the read tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that stand for a missing value, compared in upper case.
MISSING_WORDS = ("NA", "NAN", "NONE")


def clean_key(col: Column | str) -> Column:
    """Trimmed, upper-case value; NULL where the field is NULL, blank or a missing word."""
    value = F.upper(F.trim(F.col(col) if isinstance(col, str) else col))
    return F.when((value != "") & ~value.isin(*MISSING_WORDS), value)


def is_missing(col: Column | str) -> Column:
    """True where `clean_key` gives NULL."""
    return clean_key(col).isNull()


def parse_number(col: Column | str) -> Column:
    """DOUBLE of a text that may have thousands' commas and a percent sign at the end (which is dropped); NULL if it is no number."""
    text = F.regexp_replace(F.trim(F.col(col) if isinstance(col, str) else col), ",", "")
    return F.trim(F.regexp_replace(text, "%$", "")).try_cast("double")


def whole_number(col: Column | str, digits: int = 38) -> Column:
    """DECIMAL(38, 0) of a text that is exactly a whole number not below 0, also as 12.0 or 1.2e3; NULL otherwise or beyond `digits`.

    The value is put together from the digits of the text, never through a DOUBLE.
    """
    text = F.trim(F.col(col) if isinstance(col, str) else col)
    form = r"^\+?([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]{1,3}))?$"
    part = lambda i: F.regexp_extract(text, form, i)
    power = F.coalesce(F.nullif(part(3), F.lit("")).cast("int"), F.lit(0))
    every = F.concat(part(1), part(2))
    whole = F.length(part(1)) + power  # digits before the point
    padded = F.when(whole > 0, F.rpad(every, F.greatest(whole, F.length(every)), "0")).otherwise(every)
    left = F.when(whole > 0, F.substring(padded, F.lit(1), whole)).otherwise(F.lit("0"))
    right = F.when(whole > 0, F.substring(padded, whole + 1, F.length(padded))).otherwise(every)
    number = F.regexp_replace(left, "^0+(?=[0-9])", "")
    fits = text.rlike(form) & (every != "") & ~right.rlike("[1-9]") & (F.length(number) <= digits) & (whole <= 400)
    return F.when(fits, number.try_cast("decimal(38,0)"))
