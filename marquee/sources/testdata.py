"""Binding of the catalog model to the generated testdata tables.

The testdata holds no text dates, comma lists or nulls, so a raw catalog is
derived row for row from ``orders`` by fixed rules (the same rules the DuckDB
oracle uses). Everything downstream sees only the RAW schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.schema import RAW_SCHEMA


_SCANS: dict[tuple[int, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one testdata table (read-only files), memoized per session and
    path: a DataFrame is an immutable plan, so queries can share it and skip
    re-listing and re-planning the same file."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    memo = (id(spark), path)
    df = _SCANS.get(memo)
    if df is None or df.sparkSession is not spark:
        df = _SCANS[memo] = spark.read.parquet(path)
    return df


def _s(c: Column) -> Column:
    return c.cast("string")


def catalog_from_orders(orders: DataFrame, hot_every: int | None = None, edge: bool = False) -> DataFrame:
    """Raw catalog rows derived from ``orders`` (one row per order).

    ``hot_every=n`` gives every n-th order the same id ``s0`` - a hot key
    holding 1/n of all rows (and of their genre rows), to exercise skew.
    ``edge`` adds what messy catalogs hold: null and repeated ids, impossible
    and blank dates, seasons in the rating, null and blank list entries.
    """
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    d = F.col("o_orderdate")
    text_date = F.date_format(d, "MMMM d, yyyy")
    kind = (F.when(k % 997 == 0, F.lit(None))
            .when(k % 10 < 7, F.lit("Movie"))
            .otherwise(F.lit("TV Show")))
    director = (F.when(k % 4 == 0, F.lit(None))
                .when(k % 9 == 0, F.concat(F.lit("D"), _s(cust % 40), F.lit(", D"), _s(cust % 37 + 40)))
                .otherwise(F.concat(F.lit("D"), _s(cust % 40))))
    cast_names = (F.when(k % 11 == 0, F.lit(None))
                  .otherwise(F.concat(F.lit("A"), _s(cust % 200), F.lit(", A"), _s(k % 150 + 200))))
    country = (F.when(k % 13 == 0, F.lit(None))
               .when(k % 3 == 0, F.concat(F.lit("C"), _s(cust % 25), F.lit(", C"), _s(k % 20 + 25)))
               .otherwise(F.concat(F.lit("C"), _s(cust % 25))))
    date_added = (F.when(k % 1000 == 7, F.lit(None))
                  .when(k % 50 == 3, F.concat(F.lit(" "), text_date))
                  .otherwise(text_date))
    release_year = (F.year(d) - cust % 12).cast("int")
    rating = (F.when(k % 500 == 1, F.lit("74 min"))
              .when(k % 333 == 5, F.lit(None))
              .when(k % 5 == 0, F.lit("TV-MA"))
              .when(k % 5 == 1, F.lit("PG-13"))
              .when(k % 5 == 2, F.lit("TV-Y7"))
              .when(k % 5 == 3, F.lit("R"))
              .otherwise(F.lit("TV-PG")))
    duration = (F.when(k % 500 == 1, F.lit(None))
                .when(k % 10 < 7, F.concat(_s(cust % 120 + 40), F.lit(" min")))
                .when(cust % 3 == 0, F.lit("1 Season"))
                .otherwise(F.concat(_s(cust % 9 + 2), F.lit(" Seasons"))))
    listed_in = F.concat(F.lit("G"), _s(k % 6), F.lit(", G"), _s(cust % 5 + 6))
    show_id = F.concat(F.lit("s"), _s(k))
    if hot_every:
        show_id = F.when(k % hot_every == 0, F.lit("s0")).otherwise(show_id)
    if edge:
        show_id = F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, F.concat(F.lit("s"), _s(k % 50))).otherwise(show_id)
        date_added = F.when(k % 23 == 0, F.lit("February 30, 1997")).when(k % 29 == 0, F.lit("  ")).otherwise(date_added)
        rating = F.when(k % 31 == 0, F.lit("1 Season")).when(k % 37 == 0, F.lit("2 Seasons")).otherwise(rating)
        listed_in = F.when(k % 13 == 1, F.lit(None)).when(k % 13 == 2, F.lit("G1, , G2")).otherwise(listed_in)
        country = F.when(k % 41 == 0, F.lit(", C3")).otherwise(country)
    exprs = {
        "show_id": show_id, "type": kind, "title": F.concat(F.lit("Title "), _s(k)),
        "director": director, "cast": cast_names, "country": country, "date_added": date_added,
        "release_year": release_year, "rating": rating, "duration": duration,
        "listed_in": listed_in, "description": F.lit(None),
    }
    return orders.select(*[exprs[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])
