"""Cleaning of raw scalar columns: missing marks, trimmed strings, tolerant numbers and tri-state flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that mean a missing value once lower-cased (fixed values).
MISSING_WORDS = ("nan", "none", "null")
#: Tokens that a CSV reader takes as missing before any cleaning (fixed values).
CSV_MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def strip(c: Column) -> Column:
    """Trims Unicode white space, not only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_str(c: Column) -> Column:
    """Trimmed text; missing values and words become the empty string."""
    t = strip(c.cast("string"))
    return F.when(t.isNull() | F.lower(t).isin(*MISSING_WORDS), F.lit("")).otherwise(t)


def text_or_null(c: Column) -> Column:
    return F.nullif(clean_str(c), F.lit(""))


def clean_int(c: Column, kind: str = "string") -> Column:
    """Floats are cut, integer text is read, anything else (also "5.0" and infinities) is null."""
    if kind in ("double", "float"):
        return F.when(~F.isnan(c) & (F.abs(c) < F.lit(9.2e18)), c).cast("bigint")
    return strip(c.cast("string")).try_cast("bigint") if kind == "string" else c.cast("bigint")


def clean_float(c: Column) -> Column:
    v = strip(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(v), v)


def clean_bool(c: Column) -> Column:
    """true/1/yes, false/0/no; anything else is unknown (null)."""
    t = F.lower(strip(c.cast("string")))
    return F.when(t.isin("true", "1", "yes"), True).when(t.isin("false", "0", "no"), False)


def is_missing(c: Column, kind: str = "string") -> Column:
    return (c.isNull() | F.isnan(c)) if kind in ("double", "float") else c.isNull()


def csv_missing(c: Column) -> Column:
    """A CSV cell with reader-level missing tokens as null."""
    return F.when(~c.isin(*CSV_MISSING), c)
