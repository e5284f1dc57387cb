"""Date helpers.

Month and year filters are written as half-open ranges on the date itself
(``d >= start AND d < next``) so that Parquet scans receive them as pushed
filters; ``year(d) = Y`` would only push ``IsNotNull``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from marquee.functions.text import WHITE_SPACE
from marquee.schema import ADDED_DATE_FORMAT


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_added_date(c: str | Column, fmt: str = ADDED_DATE_FORMAT) -> Column:
    """Strip, then parse ``September 25, 2021``; anything unparseable -> null."""
    return F.try_to_date(F.trim(_c(c), F.lit(WHITE_SPACE)), fmt)


def year_of(c: str | Column) -> Column:
    """Calendar year as bigint (SQL EXTRACT(YEAR ...) returns BIGINT)."""
    return F.year(_c(c)).cast("bigint")


def month_of(c: str | Column) -> Column:
    return F.month(_c(c)).cast("bigint")


def quarter_label(c: str | Column) -> Column:
    """'Q1'..'Q4'; null date -> null."""
    return F.concat(F.lit("Q"), F.quarter(_c(c)).cast("string"))


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    start = dt.date(year, month, 1)
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    return start, nxt


def in_month(c: str | Column, year: int, month: int) -> Column:
    start, nxt = month_bounds(year, month)
    c = _c(c)
    return (c >= F.lit(start)) & (c < F.lit(nxt))


def in_year_range(c: str | Column, first: int, last: int) -> Column:
    """first <= year(c) <= last, as a pushable date range."""
    c = _c(c)
    return (c >= F.lit(dt.date(first, 1, 1))) & (c < F.lit(dt.date(last + 1, 1, 1)))
