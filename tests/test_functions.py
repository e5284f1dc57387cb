"""Column helpers: each is a built-in Spark expression with the exact edge behaviour the
cleaning stage and the reports rely on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marquee.functions import (
    blank_to_null, first_number, first_token, pct, quarter_label, split_list, strip_ws, year_of,
)


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).collect()[0].r


def test_first_number(spark):
    assert one(spark, first_number("v"), "74 min") == 74.0
    assert one(spark, first_number("v"), "Season 12 of 3") == 12.0
    assert one(spark, first_number("v"), "no digits") is None
    assert one(spark, first_number("v"), None) is None


def test_split_and_first_token_keep_empty_tokens(spark):
    assert one(spark, split_list("v"), ", France,") == ["", " France", ""]
    assert one(spark, split_list("v", " "), "a b") == ["a", "b"]
    assert one(spark, first_token("v"), ", France") == ""
    assert one(spark, first_token("v"), "United States, France") == "United States"


def test_strip_and_blank(spark):
    assert one(spark, strip_ws("v"), " \t x y \n") == "x y"
    assert one(spark, blank_to_null(strip_ws("v")), " \t ") is None


def test_pct_is_double_and_null_on_zero(spark):
    r = spark.range(1).select(pct(F.lit(1), F.lit(3)).alias("a"), pct(F.lit(1), F.lit(0)).alias("b"),
                              pct(F.lit(1), F.lit(8), 2).alias("c")).collect()[0]
    assert (r.a, r.b, r.c) == (33.3, None, 12.5)
    assert dict(spark.range(1).select(pct(F.lit(1), F.lit(3)).alias("a")).dtypes)["a"] == "double"


def test_quarter_and_year(spark):
    assert one(spark, quarter_label("v"), dt.date(2021, 11, 3), "v date") == "Q4"
    assert one(spark, quarter_label("v"), None, "v date") is None
    got = spark.createDataFrame([(dt.date(2021, 1, 1),)], "v date").select(year_of("v").alias("y"))
    assert dict(got.dtypes)["y"] == "bigint" and got.collect()[0].y == 2021
