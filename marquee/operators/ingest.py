"""Extract stage: parse the added date, slice a month, find undated rows, tag
months for a one-pass backfill.

The raw date is text, so these filters parse it first and cannot reach the
scan of a raw CSV. Every month or range test is still written as a half-open
date range (``functions.in_month`` / ``in_year_range``): applied to a typed
DATE column - the cleaned titles, a staged Parquet table - the same helpers
are pushed into the Parquet scan (checked in ``tests/test_clean.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions import in_month, month_bounds, parse_added_date, strip_ws
from marquee.schema import KEY, MONTH_COL

PARSED = "_added"
#: Tasks that the rows of one key are dealt to at most, by these columns.
LANES = 63
LANE_COLUMNS = ("title", "date_added")


def with_added_date(raw: DataFrame, src: str = "date_added", out: str = PARSED) -> DataFrame:
    """Add the parsed date (strip, then ``MMMM d, yyyy``; bad -> null)."""
    return raw.withColumn(out, parse_added_date(src))


def month_slice(raw: DataFrame, year: int, month: int, date_col: str = "date_added") -> DataFrame:
    """Raw rows whose added date falls in (year, month); raw values kept.

    Undated or unparseable rows belong to no month.
    """
    return raw.where(in_month(parse_added_date(date_col), year, month))


def undated_rows(raw: DataFrame, date_col: str = "date_added") -> DataFrame:
    """Rows no monthly slice will ever pick up (null or unparseable date)."""
    return raw.where(parse_added_date(date_col).isNull())


def undated_reason(date_col: str = "date_added") -> Column:
    """Why a row without a parsed date has none: missing (null), blank (whitespace only) or unparseable text."""
    d = F.col(date_col)
    return (F.when(d.isNull(), F.lit("missing"))
             .when(strip_ws(d) == "", F.lit("blank"))
             .otherwise(F.lit("unparseable")))


def load_outcome(corrupt_col: str | None = None, date_col: str = "date_added") -> Column:
    """X3 with S1: where a raw record goes: its month (``1998-06``), ``undated-`` and the reason, or
    ``unparseable-record`` if the scan kept its text in ``corrupt_col``."""
    d = parse_added_date(date_col)
    dated = F.when(d.isNotNull(), F.date_format(d, "yyyy-MM")).otherwise(F.concat(F.lit("undated-"), undated_reason(date_col)))
    return dated if corrupt_col is None else F.when(F.col(corrupt_col).isNotNull(), F.lit("unparseable-record")).otherwise(dated)


def undated_summary(raw: DataFrame, date_col: str = "date_added") -> DataFrame:
    """X3 report: undated rows counted by reason - missing (null), blank
    (whitespace only) or unparseable text."""
    return (undated_rows(raw, date_col)
            .groupBy(undated_reason(date_col).alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


def tag_months(raw: DataFrame, first: tuple[int, int] | None = None,
               last: tuple[int, int] | None = None, date_col: str = "date_added") -> DataFrame:
    """X4 (part 1): keep rows dated within [first, last] months (either bound
    may be open; undated rows are always dropped) and add their month
    (``added_month``, the month's first day as a DATE), in one scan.

    A DATE rather than a 'yyyy-MM' label keeps the later max-per-key a plain
    hash aggregate (a string max would fall back to a sort aggregate). The date
    is parsed once a row: the condition on the partition's number, true
    everywhere, keeps the optimizer from repeating the parse in each filter.
    """
    d = F.col(PARSED)
    keep = d.isNotNull()
    if first is not None:
        keep = keep & (d >= F.lit(month_bounds(*first)[0]))
    if last is not None:
        keep = keep & (d < F.lit(month_bounds(*last)[1]))
    once = F.when(F.spark_partition_id() >= 0, F.col(PARSED)).alias(PARSED)
    return (with_added_date(raw, date_col)
            .select(*raw.columns, once)
            .where(keep)
            .withColumn(MONTH_COL, F.trunc(d, "month"))
            .drop(PARSED))


def latest_month_rows(tagged: DataFrame, key: str = KEY, month_col: str = MONTH_COL) -> DataFrame:
    """X4 (part 2): make a one-pass load equal to loading month after month.

    A monthly load replaces every row of a key, so after a loop only the
    key's *latest* month survives. Null keys never match a delete and are all
    kept. The latest month per key is a partial (map-side) aggregate, joined
    back to the rows: two references to the input. A key's rows, and those
    without a key, are dealt to up to ``LANES`` tasks by a hash of their own
    values (``LANE_COLUMNS``); the aggregate notes a key's lanes in the bits
    of a long and is repeated for these only, so that a hot key doesn't gather
    in one task. (AQE's skew join doesn't apply: one side is an aggregate.)
    """
    lane = F.pmod(F.xxhash64(*[c for c in LANE_COLUMNS if c in tagged.columns]), F.lit(LANES)).cast("int")
    latest = tagged.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max(month_col).alias("_latest"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), lane)).alias("_lanes"))
    lanes = F.filter(F.lit(list(range(LANES))), lambda i: F.call_function("getbit", F.col("_lanes"), i) == 1)
    # nearly every key has one lane: its number is the count of the bits below
    lanes = F.when(F.bit_count("_lanes") == 1, F.array(F.bit_count(F.col("_lanes") - 1))).otherwise(lanes)
    each = latest.select(key, "_latest", F.explode(lanes).alias("_lane"))
    both = tagged.withColumn("_lane", lane).join(each, [key, "_lane"], "left")
    return both.where(F.col("_latest").isNull() | (F.col(month_col) == F.col("_latest"))).select(*tagged.columns)
