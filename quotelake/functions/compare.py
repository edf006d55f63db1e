"""Predicates that decide whether two values differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotelake.config import DEFAULT
from quotelake.functions.quotes import is_true


def float_diff(ours: Column, official: Column, tolerance: float = DEFAULT.diff_tolerance) -> Column:
    return (ours.isNull() != official.isNull()) | is_true(F.abs(ours - official) > tolerance)


def normal_text(value: Column) -> Column:
    """Trimmed text without a trailing ``.0``; a lone dash counts as empty."""
    text = F.regexp_replace(F.trim(F.coalesce(value, F.lit(""))), r"\.0$", "")
    return F.when(text == "-", "").otherwise(text)


def string_diff(ours: Column, official: Column) -> Column:
    return normal_text(ours) != normal_text(official)


def text_or_number_diff(ours: Column, official: Column, tolerance: float = 1e-5) -> Column:
    """Numbers by tolerance where both texts are numbers, else by text."""
    a, b = ours.cast("string"), official.cast("string")
    x, y = a.try_cast("double"), b.try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.abs(x - y) > tolerance).otherwise(
        ~a.eqNullSafe(b)
    )
