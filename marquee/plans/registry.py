"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the testdata tables of ``sf_dir`` in full. Catalog queries
start from the raw catalog derived from ``orders`` (see
``sources.testdata``); natural-table queries run the same operators straight
on ``orders`` / ``lineitem`` / ``part``.

Binding parameters: the testdata's dates span 1995-2001, so the report
literals that name years (C2, D2) and the home country (E3) are rebound
below; the operators' defaults stay the report pack's own. The ``skew_*``
queries use the same adapter with every third order on one id, the ``edge_*``,
store, stage and file queries one with null and repeated ids and bad values.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from marquee.functions import parse_added_date, year_of
from marquee.operators import reports as R
from marquee.operators.clean import (
    clean_titles, explode_genres, fill_defaults, repair_shift, split_duration,
)
from marquee.operators.ingest import month_slice, undated_rows, undated_summary
from marquee.operators.upsert import upsert_catalog
from marquee.plans import analyses as A
from marquee.plans.jobs import (
    apply_month, backfill, backfill_tables, load_counts, read_month_stage, read_outcomes, run_month, write_month_stage, write_outcomes,
)
from marquee.plans.summary import CatalogSummary
from marquee.schema import GENRES_SCHEMA, MONTH_COL, RAW_SCHEMA, TITLES_SCHEMA, empty_frame
from marquee.session import ensure_checkpoint_dir
from marquee.sources.export import export_for_bi, read_csv_export, title_countries, write_csv
from marquee.sources.raw import read_raw_csv
from marquee.sources.store import CatalogStore
from marquee.sources.testdata import catalog_from_orders, read_table
from marquee.streaming import catalog_stream

# ---------------------------------------------------------------- binding
BIND = {
    "c2_min_release_year": 1995,
    "d2_base": (1996, 1998),
    "d2_recent": (1999, 2001),
    "d2_min_base": 20,
    "e3_home": "C1",
    "slice_month": (1998, 6),
    "backfill_first": (1995, 1),
    "backfill_last": (2001, 12),
    "upsert_target_before": dt.date(1999, 1, 1),
    "upsert_staged_from": dt.date(1998, 7, 1),
    "brand_base": (1995, 1997),
    "brand_recent": (1998, 2000),
    "store_months": [(1996, 3), (1996, 4)],
    "summary_loads": [((1995, 1), (1998, 12)), ((1998, 6), (2000, 6)), ((1996, 3), (1996, 3)), ((1999, 1), (2001, 12))],
    "hot_every": 3,            # skewed binding: every 3rd order shares one id
    "brand_value": "Brand#11",
}

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf: str, hot: bool = False, edge: bool = False) -> DataFrame:
    """Raw catalog rows. ``hot=True``: a third of all rows share one id;
    ``edge=True``: null and repeated ids, bad dates, blank list entries."""
    return catalog_from_orders(read_table(spark, sf, "orders"), BIND["hot_every"] if hot else None, edge)


def tables(spark: SparkSession, sf: str, hot: bool = False, edge: bool = False) -> tuple[DataFrame, DataFrame]:
    """Cleaned (titles, genres) of every dated raw row: the union of all monthly slices."""
    r = raw(spark, sf, hot, edge)
    return clean_titles(r.where(parse_added_date("date_added").isNotNull()))


def _titles(spark, sf):
    return tables(spark, sf)[0]


def _genres(spark, sf):
    return tables(spark, sf)[1]


def _empty(spark):
    return empty_frame(spark, TITLES_SCHEMA), empty_frame(spark, GENRES_SCHEMA)


# ---------------------------------------------------------------- pipeline
def q_parse_added_date(spark, sf):
    return raw(spark, sf).select("show_id", "date_added",
                                 parse_added_date("date_added").alias("added_date"))


def q_month_slice(spark, sf):
    return month_slice(raw(spark, sf), *BIND["slice_month"])


def q_undated_rows(spark, sf):
    return undated_rows(raw(spark, sf))


def q_undated_summary(spark, sf):
    return undated_summary(raw(spark, sf))


def q_repair_shift(spark, sf):
    return raw(spark, sf).transform(repair_shift).select("show_id", "rating", "duration")


def q_fill_defaults(spark, sf):
    return (raw(spark, sf).transform(repair_shift).transform(fill_defaults)
            .select("show_id", "director", "cast", "country", "rating"))


def q_split_duration(spark, sf):
    return (raw(spark, sf).transform(repair_shift).transform(split_duration)
            .select("show_id", "type", "duration_minutes", "duration_seasons"))


def q_explode_genres(spark, sf):
    return explode_genres(raw(spark, sf).transform(repair_shift))


def q_clean_titles(spark, sf):
    return _titles(spark, sf)


def q_clean_genres(spark, sf):
    return _genres(spark, sf)


def _backfill(spark, sf, hot=False, edge=False):
    t0, g0 = _empty(spark)
    return backfill_tables(t0, g0, raw(spark, sf, hot, edge), BIND["backfill_first"], BIND["backfill_last"])


def q_backfill_months(spark, sf):
    return _backfill(spark, sf)[0]


def q_backfill_genres(spark, sf):
    return _backfill(spark, sf)[1]


def _upsert(spark, sf, hot=False, edge=False):
    r = raw(spark, sf, hot, edge)
    d = parse_added_date("date_added")
    tgt_t, tgt_g = clean_titles(r.where(d < F.lit(BIND["upsert_target_before"])))
    stg_t, stg_g = clean_titles(r.where(d >= F.lit(BIND["upsert_staged_from"])))
    return upsert_catalog(tgt_t, tgt_g, stg_t, stg_g)


def q_upsert_titles(spark, sf):
    return _upsert(spark, sf)[0]


def q_upsert_genres(spark, sf):
    return _upsert(spark, sf)[1]


def q_run_month(spark, sf):
    r = raw(spark, sf)
    y, m = BIND["slice_month"]
    before = parse_added_date("date_added") < F.lit(dt.date(y, m, 1))
    t0, g0 = clean_titles(r.where(before))
    return apply_month(t0, g0, r, y, m)[0]


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/marquee-query-{uuid.uuid4().hex}"


def _streamed(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The raw catalog written as CSV files and ingested by the file stream,
    as one batch, into a fresh store under the session's checkpoint folder."""
    base = _folder(spark)
    write_csv(raw(spark, sf), f"{base}/in")
    store = CatalogStore(spark, f"{base}/store")
    catalog_stream(spark, f"{base}/in", store).awaitTermination()
    return store.read()


def q_stream_ingest(spark, sf):
    return _streamed(spark, sf)[0]


def q_stream_genres(spark, sf):
    return _streamed(spark, sf)[1]


def _month_loaded(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A store that holds all earlier months, then the job for one month;
    repeated ids occur in both."""
    r = raw(spark, sf, edge=True)
    y, m = BIND["slice_month"]
    store = CatalogStore(spark, f"{_folder(spark)}/store")
    backfill(spark, r, store, BIND["backfill_first"], (y, m - 1))
    run_month(spark, r, store, y, m)
    return store.read()


def _backfilled(spark, sf) -> tuple[DataFrame, DataFrame]:
    """X4 against a store: two monthly loads, compacted, then a backfill of
    all months over them (null ids of the two months are there twice)."""
    r = raw(spark, sf, edge=True)
    store = CatalogStore(spark, f"{_folder(spark)}/store")
    for y, m in BIND["store_months"]:
        run_month(spark, r, store, y, m)
    store.compact()
    backfill(spark, r, store, BIND["backfill_first"], BIND["backfill_last"])
    return store.read()


def q_raw_csv_roundtrip(spark, sf):
    """A CSV with its columns in another order, an extra column, and titles
    with commas, quotes and line breaks, read back by name."""
    r = raw(spark, sf, edge=True).withColumn("title", F.concat(F.col("title"), F.lit(', "quoted"\nnext line')))
    path = f"{_folder(spark)}/raw"
    write_csv(r.select(F.lit("x").alias("extra"), *reversed(r.columns)), path)
    return read_raw_csv(spark, path)


def q_raw_csv_split(spark, sf):
    """The same with two line breaks in a field, read by splits of the files."""
    r = raw(spark, sf, edge=True).withColumn("title", F.concat(F.col("title"), F.lit(', "quoted"\n\nnext line')))
    path = f"{_folder(spark)}/raw"
    write_csv(r.select(F.lit("x").alias("extra"), *reversed(r.columns)), path)
    return read_raw_csv(spark, path, split=True)


def q_load_rejects(spark, sf):
    """X3 with S1: records by outcome (month, undated reason, unparseable record), written and counted in one pass each."""
    r = raw(spark, sf, edge=True)
    n = F.substring("title", 7, 20).cast("bigint")
    base = _folder(spark)
    write_csv(r.withColumn("release_year", F.when(n % 43 == 0, F.lit("n/a")).otherwise(F.col("release_year").cast("string"))), f"{base}/raw")
    write_outcomes(read_raw_csv(spark, f"{base}/raw", split=True, corrupt_col="_corrupt"), f"{base}/out", "_corrupt")
    return read_outcomes(spark, f"{base}/out", "_corrupt").groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))


def _kept_summary(spark, sf) -> CatalogSummary:
    """J1 kept up to date over four loads that overlap, one of them a month loaded again."""
    r = raw(spark, sf, edge=True)
    store = CatalogStore(spark, f"{_folder(spark)}/store")
    summary = CatalogSummary(store)
    for first, last in BIND["summary_loads"]:
        backfill(spark, r, store, first, last)
        summary.refresh()
    return summary


def q_month_stage(spark, sf):
    """Two months staged, one read back (its folder only)."""
    r = raw(spark, sf, edge=True)
    root = f"{_folder(spark)}/stage"
    for y, m in BIND["store_months"]:
        write_month_stage(month_slice(r, y, m), root, y, m)
    y, m = BIND["store_months"][0]
    write_month_stage(month_slice(r, y, m), root, y, m, require_dir=True)     # again: replaced
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(MONTH_COL, T.StringType())])
    return read_month_stage(spark, root, y, m, schema)


def q_sql_views(spark, sf):
    """Both tables by name in SQL."""
    A.register_catalog(*tables(spark, sf, edge=True), "marquee_titles", "marquee_genres")
    return spark.sql("""SELECT t.type, g.genre, count(*) AS n FROM marquee_titles t
                        JOIN marquee_genres g ON t.show_id = g.show_id GROUP BY ALL""")


def _exported(spark, sf) -> str:
    """B-2 / S9 / S10: the four exports of the catalog; returns their folder."""
    t, g = tables(spark, sf, edge=True)
    out = f"{_folder(spark)}/bi"
    export_for_bi(spark, t, g, out, summary=A.j1_yearly_summary(t))
    return out


def _as_text(spark, path: str, names: list[str]) -> DataFrame:
    return read_csv_export(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in names]))


def q_export_titles(spark, sf):
    """S9 and the ISO date text: the exported titles, every field as text."""
    return _as_text(spark, f"{_exported(spark, sf)}/titles.csv", TITLES_SCHEMA.names).select(
        "show_id", "title", "country", "date_added", "release_year", "duration_minutes")


def q_export_countries(spark, sf):
    return _as_text(spark, f"{_exported(spark, sf)}/title_countries.csv", ["show_id", "country"])


def q_export_summary(spark, sf):
    """The summary, exported because it was given."""
    return _as_text(spark, f"{_exported(spark, sf)}/yearly_summary.csv",
                    ["year_added", "total_titles", "movies", "tv_shows", "avg_movie_minutes", "distinct_countries",
                     "avg_acquisition_lag_years"]).select("year_added", "total_titles", "movies", "tv_shows", "distinct_countries")


def q_load_counts(spark, sf):
    """L4 / A-10: rows of one month's batch for each table."""
    return load_counts(month_slice(raw(spark, sf, edge=True), *BIND["slice_month"]))


def q_report_order(spark, sf):
    """O-1 / O-2: the place of every row in the reports that are ordered without a limit."""
    out = None
    for name in A.ORDERED:
        rows = QUERIES[name](spark, sf)
        rows = rows.select(F.lit(name).alias("report"), F.col(rows.columns[0]).cast("string").alias("k"),
                           F.monotonically_increasing_id().alias("_id"))
        rows = rows.select("report", "k", F.row_number().over(Window.orderBy("_id")).cast("bigint").alias("place"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_title_countries(spark, sf):
    return title_countries(_titles(spark, sf))


# ---------------------------------------------------------------- reports
def _t(fn, *args, **kw) -> Query:
    return lambda spark, sf: fn(_titles(spark, sf), *args, **kw)


def _g(fn, *args, **kw) -> Query:
    return lambda spark, sf: fn(_genres(spark, sf), *args, **kw)


def q_d2(spark, sf, hot=False):
    t, g = tables(spark, sf, hot)
    return A.d2_rising_genres(g, t, BIND["d2_base"], BIND["d2_recent"], BIND["d2_min_base"])


def q_h3(spark, sf, hot=False):
    t, g = tables(spark, sf, hot)
    return A.h3_director_breadth(t, g)


# ---------------------------------------------------------------- skewed binding
SKEWED: dict[str, Query] = {
    "skew_backfill_months": lambda spark, sf: _backfill(spark, sf, hot=True)[0],
    "skew_upsert_titles": lambda spark, sf: _upsert(spark, sf, hot=True)[0],
    "skew_d2_rising_genres": lambda spark, sf: q_d2(spark, sf, hot=True),
    "skew_d3_genre_pairs": lambda spark, sf: A.d3_genre_pairs(tables(spark, sf, True)[1]),
    "skew_e3_non_us_share": lambda spark, sf: A.e3_non_us_share(tables(spark, sf, True)[0], BIND["e3_home"]),
    "skew_h3_director_breadth": lambda spark, sf: q_h3(spark, sf, hot=True),
    "skew_j1_yearly_summary": lambda spark, sf: A.j1_yearly_summary(tables(spark, sf, True)[0]),
}


# ---------------------------------------------------------------- edge binding
EDGE: dict[str, Query] = {
    "edge_parse_added_date": lambda spark, sf: raw(spark, sf, edge=True).select(
        "show_id", "date_added", parse_added_date("date_added").alias("added_date")),
    "edge_undated_summary": lambda spark, sf: undated_summary(raw(spark, sf, edge=True)),
    "edge_clean_titles": lambda spark, sf: tables(spark, sf, edge=True)[0],
    "edge_clean_genres": lambda spark, sf: tables(spark, sf, edge=True)[1],
    "edge_backfill_months": lambda spark, sf: _backfill(spark, sf, edge=True)[0],
    "edge_backfill_genres": lambda spark, sf: _backfill(spark, sf, edge=True)[1],
    "edge_upsert_titles": lambda spark, sf: _upsert(spark, sf, edge=True)[0],
    "edge_upsert_genres": lambda spark, sf: _upsert(spark, sf, edge=True)[1],
    "edge_c3_series_length": lambda spark, sf: A.c3_series_length(tables(spark, sf, edge=True)[0]),
    "edge_d3_genre_pairs": lambda spark, sf: A.d3_genre_pairs(tables(spark, sf, edge=True)[1]),
    "edge_e1_primary_country": lambda spark, sf: A.e1_primary_country(tables(spark, sf, edge=True)[0]),
    "edge_e3_non_us_share": lambda spark, sf: A.e3_non_us_share(tables(spark, sf, edge=True)[0], BIND["e3_home"]),
    "edge_h3_director_breadth": lambda spark, sf: A.h3_director_breadth(*tables(spark, sf, edge=True)),
    "edge_j1_yearly_summary": lambda spark, sf: A.j1_yearly_summary(tables(spark, sf, edge=True)[0]),
    "store_month_titles": lambda spark, sf: _month_loaded(spark, sf)[0],
    "store_month_genres": lambda spark, sf: _month_loaded(spark, sf)[1],
    "store_backfill_titles": lambda spark, sf: _backfilled(spark, sf)[0],
    "store_backfill_genres": lambda spark, sf: _backfilled(spark, sf)[1],
    "raw_csv_roundtrip": q_raw_csv_roundtrip,
    "raw_csv_split": q_raw_csv_split,
    "load_rejects": q_load_rejects,
    "summary_by_loads": lambda spark, sf: _kept_summary(spark, sf).read(),
    "summary_latest_by_loads": lambda spark, sf: _kept_summary(spark, sf).latest(),
    "share_by_loads": lambda spark, sf: _kept_summary(spark, sf).share(BIND["e3_home"]),
    "month_stage": q_month_stage,
    "sql_views": q_sql_views,
    "export_titles": q_export_titles,
    "export_countries": q_export_countries,
    "export_summary": q_export_summary,
    "load_counts": q_load_counts,
}


def _undated(fn, *args) -> Query:
    """A report over titles of which some have no date (its null group)."""
    return lambda spark, sf: fn(clean_titles(raw(spark, sf, edge=True))[0], *args)


UNDATED: dict[str, Query] = {f"undated_{fn.__name__}": _undated(fn, *args) for fn, *args in (
    (A.b1_yearly,), (A.b2_growth,), (A.b3_tv_share,), (A.e3_non_us_share, BIND["e3_home"]), (A.f2_audience,),
    (A.g2_freshness,), (A.i1_monthly,), (A.i2_quarters,))}


# ---------------------------------------------------------------- natural tables
def _brand_bridge(spark, sf) -> DataFrame:
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf, "part").select("p_partkey", "p_brand")
    return li.join(part, li["l_partkey"] == part["p_partkey"]).select(
        F.col("l_orderkey").alias("o_orderkey"), "p_brand")


def q_orders_yearly_growth(spark, sf):
    return R.growth_over_periods(read_table(spark, sf, "orders"), "o_orderdate", "year",
                                 period_out="order_year", count_out="orders",
                                 cumulative_out="cumulative_orders", growth_out="yoy_growth_pct")


def q_orders_status_share(spark, sf):
    o = read_table(spark, sf, "orders")
    s = F.col("o_orderstatus")
    return R.category_share_by_period(o, year_of("o_orderdate"), "order_year",
                                      {"finished": s == "F", "open": s == "O"},
                                      share_of="open", share_out="open_share_pct", total_out="total")


def q_orders_priority_share(spark, sf):
    o = read_table(spark, sf, "orders")
    return R.bucket_share(o, F.col("o_orderpriority"), "o_orderpriority",
                          count_out="orders", pct_out="pct")


def q_orders_price_profile(spark, sf):
    o = read_table(spark, sf, "orders")
    return R.numeric_profile(o, "o_totalprice", by="o_orderpriority", count_out="orders",
                             avg_out="avg_price", min_out="min_price", max_out="max_price",
                             digits=2)


def q_brand_top(spark, sf):
    return R.top_values(_brand_bridge(spark, sf), "p_brand", count_out="line_count")


def q_brand_pairs(spark, sf):
    return R.tag_cooccurrence(_brand_bridge(spark, sf), "o_orderkey", "p_brand",
                              a_out="brand_a", b_out="brand_b", count_out="orders_with_both")


def q_wide_pairs(spark, sf):
    """D3 over a wide vocabulary: brands and single parts, of which few come into a top pair."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    parts = li.select(F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("tag"))
    brands = _brand_bridge(spark, sf).select("o_orderkey", F.col("p_brand").alias("tag"))
    return R.tag_cooccurrence(parts.unionByName(brands), "o_orderkey", "tag", a_out="tag_a", b_out="tag_b",
                              count_out="orders_with_both", seed_tags=R.SEED_TAGS)


def q_brand_growth(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return R.period_growth_topk(_brand_bridge(spark, sf), o, "o_orderkey", "p_brand",
                                "o_orderdate", BIND["brand_base"], BIND["brand_recent"], 20)


def q_part_name_words(spark, sf):
    return R.multivalue_topk(read_table(spark, sf, "part"), "p_name", "word", sep=" ",
                             count_out="part_count")


def q_priority_brand_breadth(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return R.breadth_topk(o, "o_orderpriority", _brand_bridge(spark, sf), "o_orderkey", "p_brand",
                          min_titles=5, out="priority", titles_out="order_count",
                          breadth_out="distinct_brand_count")


def q_orders_overview(spark, sf):
    o = read_table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return R.overview(o, "o_orderstatus",
                      {"finished": "F", "open": "O"}, "o_orderdate", total_out="orders",
                      first_out="first_order", last_out="last_order")


def q_orders_quality(spark, sf):
    return R.sentinel_share(read_table(spark, sf, "orders"), {
        "pct_urgent": ("o_orderpriority", "1-URGENT"),
        "pct_partial": ("o_orderstatus", "P"),
    }, digits=2)


def q_part_first_word(spark, sf):
    return R.first_value_topk(read_table(spark, sf, "part"), "p_name", "first_word", sep=" ",
                              count_out="part_count")


def q_lineitem_monthly(spark, sf):
    return R.count_by_period(read_table(spark, sf, "lineitem"), "l_shipdate", "month",
                             period_out="ship_month", count_out="lines")


def q_brand_share_by_year(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    part = read_table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = li.join(part, li["l_partkey"] == part["p_partkey"]).select("l_orderkey", "l_shipdate", "p_brand")
    return R.distinct_share_by_period(lines, "p_brand", BIND["brand_value"], key="l_orderkey",
                                      date_col="l_shipdate", period_out="ship_year",
                                      match_out="orders_with_brand", other_out="orders_with_other",
                                      share_out="other_share_pct")


QUERIES: dict[str, Query] = {
    # extract / clean / load
    "parse_added_date": q_parse_added_date,
    "month_slice": q_month_slice,
    "undated_rows": q_undated_rows,
    "undated_summary": q_undated_summary,
    "repair_shift": q_repair_shift,
    "fill_defaults": q_fill_defaults,
    "split_duration": q_split_duration,
    "explode_genres": q_explode_genres,
    "clean_titles": q_clean_titles,
    "clean_genres": q_clean_genres,
    "backfill_months": q_backfill_months,
    "backfill_genres": q_backfill_genres,
    "upsert_titles": q_upsert_titles,
    "upsert_genres": q_upsert_genres,
    "run_month": q_run_month,
    "title_countries": q_title_countries,
    "stream_ingest": q_stream_ingest,
    "stream_genres": q_stream_genres,
    "report_order": q_report_order,
    # the 25 reports
    "a1_overview": _t(A.a1_overview),
    "a2_quality": _t(A.a2_quality),
    "b1_yearly": _t(A.b1_yearly),
    "b2_growth": _t(A.b2_growth),
    "b3_tv_share": _t(A.b3_tv_share),
    "c1_minutes": _t(A.c1_minutes),
    "c2_minutes_by_year": _t(A.c2_minutes_by_year, BIND["c2_min_release_year"]),
    "c3_series_length": _t(A.c3_series_length),
    "d1_genres": _g(A.d1_genres),
    "d2_rising_genres": q_d2,
    "d3_genre_pairs": _g(A.d3_genre_pairs),
    "e1_primary_country": _t(A.e1_primary_country),
    "e2_countries": _t(A.e2_countries),
    "e3_non_us_share": _t(A.e3_non_us_share, BIND["e3_home"]),
    "f1_ratings": _t(A.f1_ratings),
    "f2_audience": _t(A.f2_audience),
    "g1_acquisition_lag": _t(A.g1_acquisition_lag),
    "g2_freshness": _t(A.g2_freshness),
    "h1_directors": _t(A.h1_directors),
    "h2_actors": _t(A.h2_actors),
    "h3_director_breadth": q_h3,
    "i1_monthly": _t(A.i1_monthly),
    "i2_quarters": _t(A.i2_quarters),
    "j1_yearly_summary": _t(A.j1_yearly_summary),
    "j2_latest_years": _t(A.j2_latest_years),
    "j1_yearly_summary_dedup": _t(A.j1_yearly_summary, dedup=True),
    # the same operators on the natural tables
    "orders_yearly_growth": q_orders_yearly_growth,
    "orders_status_share": q_orders_status_share,
    "orders_priority_share": q_orders_priority_share,
    "orders_price_profile": q_orders_price_profile,
    "brand_top": q_brand_top,
    "brand_pairs": q_brand_pairs,
    "wide_pairs": q_wide_pairs,
    "brand_growth": q_brand_growth,
    "part_name_words": q_part_name_words,
    "priority_brand_breadth": q_priority_brand_breadth,
    "orders_overview": q_orders_overview,
    "orders_quality": q_orders_quality,
    "part_first_word": q_part_first_word,
    "lineitem_monthly": q_lineitem_monthly,
    "brand_share_by_year": q_brand_share_by_year,
    # a third of all rows on one key
    **SKEWED,
    # messy values; stores, stages and files
    **EDGE,
    **UNDATED,
}

