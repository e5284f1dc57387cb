"""Raw catalog scan (fixed schema, no inference)."""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marquee.schema import RAW_SCHEMA
from marquee.sources.records import body_records, cut_records, first_line, parsed, text_lines

# Tokens pandas' CSV reader turns into nulls by default; opt-in parity only.
PANDAS_NULL_TOKENS = ("NA", "N/A", "n/a", "NULL", "null", "None", "nan", "NaN", "-NaN", "-nan",
                      "#N/A", "#NA", "<NA>", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN",
                      "#N/A N/A", "")


OPTIONS = {"quote": '"', "escape": '"'}


class MissingColumnError(ValueError):
    """The CSV header lacks a column of the catalog."""


def _file_schema(header: list[str], where: object) -> T.StructType:
    """Columns in the header's order: the catalog's with their types, others as text."""
    if missing := [f.name for f in RAW_SCHEMA.fields if f.name not in header]:
        raise MissingColumnError(f"no column {', '.join(missing)} in the header of {where}")
    types = {f.name: f.dataType for f in RAW_SCHEMA.fields}
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])


def read_raw_csv(spark: SparkSession, path: str | list[str], *, multi_line: bool = True, split: bool = False,
                 null_tokens: Iterable[str] | None = None,
                 corrupt_col: str | None = None) -> DataFrame:
    """Scan raw catalog CSV files; columns are bound by the header's names.

    The header may have any order and further columns; a missing column is an
    error, and so is a file whose header differs from the first file's.

    By default a quoted field may hold line breaks, which makes each file one
    task. With ``split`` many tasks read a file, and records are cut by the
    parity of quotes (see ``records``): the same rows, for files whose quotes
    are paired, at the price of reading the lines again. ``multi_line=False``
    splits files too, without that, for input known to have no such field; a
    record that breaks there fails the job instead of loading wrongly.
    Only the empty field is null unless ``null_tokens`` is given
    (``PANDAS_NULL_TOKENS`` reproduces a pandas reader). ``corrupt_col`` names
    an extra column that keeps the raw text of rows Spark could not parse
    (e.g. a non-numeric release year), so they can be counted and inspected
    instead of silently turning into nulls.
    """
    if split and multi_line:
        df = raw_from_lines(text_lines(spark.read, path), path, corrupt_col)
        if df is None:
            raise MissingColumnError(f"no header in {path}")
        return apply_null_tokens(df, null_tokens) if null_tokens else df
    options = {"header": True, "multiLine": multi_line, **OPTIONS}
    schema = _file_schema(spark.read.options(**options).csv(path).columns, path)
    reader = spark.read.options(**options, enforceSchema=False, mode="PERMISSIVE" if multi_line else "FAILFAST")
    if corrupt_col:
        schema = schema.add(corrupt_col, T.StringType())
        reader = reader.options(columnNameOfCorruptRecord=corrupt_col, mode="PERMISSIVE")
    df = reader.schema(schema).csv(path).select(*RAW_SCHEMA.names, *([corrupt_col] if corrupt_col else []))
    return apply_null_tokens(df, null_tokens) if null_tokens else df


def raw_from_lines(lines: DataFrame, where: object = "the input", corrupt_col: str | None = None) -> DataFrame | None:
    """Raw catalog rows from the lines of CSV files (``records.text_lines``); None if there is no line.

    The header's line, one row, is all that reaches the driver.
    """
    header = first_line(lines)
    if header is None:
        return None
    schema = _file_schema(next(csv.reader([header])), where)
    options = OPTIONS | {"mode": "PERMISSIVE"}
    if corrupt_col:
        schema = schema.add(corrupt_col, T.StringType())
        options["columnNameOfCorruptRecord"] = corrupt_col
    rows = parsed(body_records(cut_records(lines), header), schema, options)
    return rows.select(*RAW_SCHEMA.names, *([corrupt_col] if corrupt_col else []))


def apply_null_tokens(df: DataFrame, tokens: Iterable[str]) -> DataFrame:
    """Turn listed text tokens into nulls in every string column."""
    toks = list(tokens)
    return df.select(*[F.when(~F.col(f.name).isin(toks), F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])
