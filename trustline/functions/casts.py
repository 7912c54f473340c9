"""Casts that return NULL instead of failing, and NULL-marker handling.

All of them are plain Catalyst expressions, so they stay inside whole-stage
codegen and fold into the scan's projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mean NULL in landing files (besides the empty field).
NULL_MARKERS = ["NULL", "null"]

# Java's number parser takes a type suffix ("1.5d") and hex floats; a loader must not.
_JAVA_ONLY_NUMBER = r"(?i)^\s*[+-]?(0x.*|[0-9.][0-9.e+-]*[df])\s*$"


# Sign, digits before and after the point; at least one digit.
_DECIMAL = r"^\s*([+-]?)(?=\.?[0-9])([0-9]*)\.?([0-9]*)\s*$"


def safe_int(text: Column) -> Column:
    """Text to INT, rounding half away from zero; NULL when it is no number or overflows."""
    # Whole numbers, nearly all of them, take the cheap cast.  Others are rounded once, from
    # their digits; only texts with an exponent go through a double.
    whole = F.regexp_extract(text, _DECIMAL, 2)
    up = (F.substring(F.regexp_extract(text, _DECIMAL, 3), 1, 1) >= "5").cast("int")
    size = F.when(whole == "", F.lit(0)).otherwise(whole.try_cast("bigint")) + up
    digits = F.when(text.rlike(_DECIMAL), F.when(F.regexp_extract(text, _DECIMAL, 1) == "-", -size).otherwise(size))
    return F.coalesce(text.try_cast("int"), digits.try_cast("int"), F.when(text.rlike("[eE]"), F.round(safe_double(text))).try_cast("int"))


def safe_double(text: Column) -> Column:
    """Text to DOUBLE; NULL when it is not a decimal number or out of range."""
    # The pattern is only tried on texts that hold one of its letters.
    plain = F.translate(text, "dDfFxX", "") == text
    value = F.when(plain | ~text.rlike(_JAVA_ONLY_NUMBER), text.try_cast("double"))
    # NaN and the infinities, written out or by overflow, would take a group's sums with them.
    return F.when(F.abs(value) < float("inf"), value)


def safe_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to DATE; every other form is NULL."""
    # The cast alone would take "2024-1-5" and "2024-01-05T10", too.
    shaped = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(shaped, text.try_cast("date"))


def null_marker(text: Column) -> Column:
    """NULL for the marker texts and for the empty string."""
    return F.when(~text.isin(*NULL_MARKERS, ""), text)


def normalise_null_markers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Apply :func:`null_marker` to ``columns`` (default: every column)."""
    wanted = set(columns or df.columns)
    return df.select(*[null_marker(F.col(c)).alias(c) if c in wanted else F.col(c) for c in df.columns])


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower case."""
    return df.toDF(*[c.lower() for c in df.columns])
