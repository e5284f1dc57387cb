"""Ratio and conditional-count helpers (double arithmetic, ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den in double; null when den is 0 or null (no ANSI error)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """round(100 * num / den, digits) as double; null on a zero denominator."""
    return F.round(F.lit(100.0) * safe_ratio(num, den), digits)


def count_where(pred: Column) -> Column:
    """COUNT(*) FILTER (WHERE pred) -> bigint (null predicate counts as false)."""
    return F.count(F.when(pred, F.lit(1)))
