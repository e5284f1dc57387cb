"""Text helpers.

``strip_ws`` removes *all* leading/trailing whitespace (tabs, newlines too),
which is what the cleaning stage needs; Spark's ``trim`` only removes spaces
and is used where the reports ask for SQL TRIM semantics.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from marquee.schema import FIRST_NUMBER_PATTERN, LIST_SEPARATOR

_EDGE_WS = r"^\s+|\s+$"
#: The characters of ``\s``.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(_c(c), _EDGE_WS, "")


def blank_to_null(c: str | Column) -> Column:
    """Empty string -> null (what a CSV round trip does to blank fields)."""
    c = _c(c)
    return F.when(c != "", c)


def split_list(c: str | Column, sep: str = LIST_SEPARATOR) -> Column:
    """Split a delimited list, keeping empty tokens at both ends (limit -1)."""
    return F.split(_c(c), re.escape(sep), -1)


def first_token(c: str | Column, sep: str = LIST_SEPARATOR) -> Column:
    """First token of a delimited list, untrimmed (SQL ``split_part(c, sep, 1)``)."""
    return F.split_part(_c(c), F.lit(sep), F.lit(1))


def first_number(c: str | Column) -> Column:
    """First run of digits as a double; null when there is none."""
    digits = F.regexp_extract(_c(c), FIRST_NUMBER_PATTERN, 1)
    return F.when(digits != "", digits).cast("double")
