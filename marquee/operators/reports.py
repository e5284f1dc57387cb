"""Reusable report operators.

Each takes DataFrames plus column names / parameters and returns a small
DataFrame. Column names and literals are parameters; the defaults are the
catalog's. Scale notes:

* every aggregate is a hash aggregate with a map-side partial step, so a hot
  group (one year or genre with a third of all rows) is combined before the
  shuffle;
* windows (running totals, LAG) run only on already aggregated rows - one
  row per period - never on raw rows;
* shares of a total use a scalar subquery (``DataFrame.scalar``) over the
  grouped frame, which AQE serves from the same shuffle, not a window over
  the whole table;
* joins between a bridge and titles are made on pre-aggregated sides (one row
  per key, or per (key, value)), so a key repeated many times never fans out
  into a product of its rows, and no row holds a set gathered per key;
* tag pairs are generated once per distinct tag combination, weighted by how
  many keys share it, instead of once per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.functions import (
    count_where, first_token, in_year_range, month_of, pct, quarter_label,
    safe_ratio, split_list, year_of,
)
from marquee.schema import KEY, LIST_SEPARATOR, TOP_K


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _n() -> Column:
    return F.count(F.lit(1))


def period_expr(date_col: str | Column, unit: str) -> Column:
    if unit == "year":
        return year_of(date_col)
    if unit == "month":
        return month_of(date_col)
    if unit == "quarter":
        return quarter_label(date_col)
    raise ValueError(f"unknown period unit {unit!r}")


def topk(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """ORDER BY ... LIMIT k (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def sorted_by(df: DataFrame, *cols: str, descending: bool = False) -> DataFrame:
    """ORDER BY of a report's aggregated rows, nulls last either way."""
    return df.orderBy(*[F.desc_nulls_last(c) if descending else F.asc_nulls_last(c) for c in cols])


# ---------------------------------------------------------------- A: overview
def overview(df: DataFrame, type_col: str = "type",
             labels: Mapping[str, str] | None = None, date_col: str = "date_added",
             total_out: str = "total_titles", first_out: str = "earliest_date_added",
             last_out: str = "latest_date_added") -> DataFrame:
    """A1: one row - total rows, rows per label, first and last date."""
    labels = labels or {"total_movies": "Movie", "total_tv_shows": "TV Show"}
    aggs = [_n().alias(total_out)]
    aggs += [count_where(F.col(type_col) == F.lit(v)).alias(name) for name, v in labels.items()]
    aggs += [F.min(date_col).alias(first_out), F.max(date_col).alias(last_out)]
    return df.agg(*aggs)


def sentinel_share(df: DataFrame, checks: Mapping[str, tuple[str, str]], digits: int = 2) -> DataFrame:
    """A2: one row - percentage of rows where ``col == sentinel``, per check.

    ``checks`` maps output name -> (column, sentinel). Empty input -> nulls.
    """
    total = _n()
    return df.agg(*[pct(count_where(F.col(c) == F.lit(v)), total, digits).alias(name)
                    for name, (c, v) in checks.items()])


# ---------------------------------------------------------------- B: growth
def count_by_period(df: DataFrame, date_col: str = "date_added", unit: str = "year",
                    period_out: str = "year_added", count_out: str = "titles_added") -> DataFrame:
    """Rows per calendar year or month (null date = own group)."""
    return df.groupBy(period_expr(date_col, unit).alias(period_out)).agg(_n().alias(count_out))


def growth_over_periods(df: DataFrame, date_col: str = "date_added", unit: str = "year",
                        period_out: str = "year_added", count_out: str = "titles_added",
                        cumulative_out: str = "cumulative_titles",
                        growth_out: str = "yoy_growth_pct", digits: int = 1) -> DataFrame:
    """B2: per period - count, running total and growth vs the previous
    *present* period (gaps are not filled).

    The window is ordered over the aggregated periods only (at most a few
    hundred rows), so its single-partition exchange stays tiny.
    """
    per = count_by_period(df, date_col, unit, period_out, count_out)
    w = Window.orderBy(F.col(period_out).asc_nulls_last())
    prev = F.lag(count_out).over(w)
    return per.select(
        period_out, count_out,
        F.sum(count_out).over(w).cast("bigint").alias(cumulative_out),
        pct(F.col(count_out) - prev, F.nullif(prev, F.lit(0)), digits).alias(growth_out),
    )


def category_share_by_period(df: DataFrame, period: Column, period_out: str,
                             labels: Mapping[str, Column], share_of: str | None = None,
                             share_out: str | None = None, digits: int = 1,
                             total_out: str | None = None, where: Column | None = None) -> DataFrame:
    """Per period - conditional counts, optional share of
    one of them in the period's row count, optional total."""
    src = df if where is None else df.where(where)
    aggs = [count_where(pred).alias(name) for name, pred in labels.items()]
    if share_of is not None:
        aggs.append(pct(count_where(labels[share_of]), _n(), digits).alias(share_out or f"{share_of}_pct"))
    if total_out is not None:
        aggs.append(_n().alias(total_out))
    return src.groupBy(period.alias(period_out)).agg(*aggs)


# ---------------------------------------------------------------- C: durations
def numeric_profile(df: DataFrame, value: str, by: str | Column | None = None,
                    where: Column | None = None, avg_out: str | None = "avg",
                    min_out: str | None = None, max_out: str | None = None,
                    count_out: str | None = None, by_out: str | None = None,
                    digits: int = 1) -> DataFrame:
    """Count, rounded mean (nulls skipped), min, max of a numeric
    column, globally or per group."""
    src = df if where is None else df.where(where)
    aggs = []
    if count_out:
        aggs.append(_n().alias(count_out))
    if avg_out:
        aggs.append(F.round(F.avg(value), digits).alias(avg_out))
    if min_out:
        aggs.append(F.min(value).alias(min_out))
    if max_out:
        aggs.append(F.max(value).alias(max_out))
    if by is None:
        return src.agg(*aggs)
    key = _c(by) if by_out is None else _c(by).alias(by_out)
    return src.groupBy(key).agg(*aggs)


def bucket_share(df: DataFrame, bucket: Column, bucket_out: str, where: Column | None = None,
                 count_out: str = "n", pct_out: str = "pct", digits: int = 1) -> DataFrame:
    """Rows per bucket and each bucket's share of all (filtered) rows.

    The denominator is a scalar subquery summing the per-bucket counts of the
    same grouped frame; AQE reuses that frame's shuffle for it (a
    ``ReusedExchange``), so the input is scanned once and no window has to
    gather rows in one partition.
    """
    src = df if where is None else df.where(where)
    grouped = src.groupBy(bucket.alias(bucket_out)).agg(_n().alias(count_out))
    total = grouped.agg(F.sum(count_out)).scalar()
    return grouped.withColumn(pct_out, pct(F.col(count_out), total, digits))


# ---------------------------------------------------------------- D: tags
def top_values(df: DataFrame, col: str, k: int = TOP_K, exclude: str | None = None,
               count_out: str = "title_count", out: str | None = None) -> DataFrame:
    """The k most frequent values (ties broken by value)."""
    src = df if exclude is None else df.where(F.col(col) != F.lit(exclude))
    name = out or col
    agg = src.groupBy(F.col(col).alias(name)).agg(_n().alias(count_out))
    return topk(agg, k, F.col(count_out).desc(), F.col(name).asc_nulls_last())


def period_growth_topk(bridge: DataFrame, df: DataFrame, key: str = KEY, tag: str = "genre",
                       date_col: str = "date_added", base: tuple[int, int] = (2016, 2018),
                       recent: tuple[int, int] = (2019, 2021), min_base: int = 20,
                       k: int = TOP_K, base_out: str | None = None, recent_out: str | None = None,
                       growth_out: str = "growth_pct", digits: int = 1) -> DataFrame:
    """Bridge rows per tag in a base and a recent year range (joined to the
    keyed table for the date), growth in percent, top k by growth among tags
    with at least ``min_base`` base rows.

    Both sides are pre-aggregated (tag rows per key, dated rows per key and
    period) before the join, so the join sees one row per (key, tag) and
    (key, period) and multiplies the counts - the same bag semantics as
    joining raw rows, without the per-key product.
    """
    base_out = base_out or f"count_{base[0]}_{base[1]}"
    recent_out = recent_out or f"count_{recent[0]}_{recent[1]}"
    y = year_of(date_col)
    lo, hi = min(base[0], recent[0]), max(base[1], recent[1])
    per = (F.when(y.between(base[0], base[1]), F.lit("b"))
            .when(y.between(recent[0], recent[1]), F.lit("r")))
    dated = (df.where(in_year_range(date_col, lo, hi) & F.col(key).isNotNull())
               .groupBy(key, per.alias("_p")).agg(_n().alias("_nt")))
    tags = bridge.where(F.col(key).isNotNull()).groupBy(key, tag).agg(_n().alias("_ng"))
    joined = tags.join(dated, key)
    w = F.col("_ng") * F.col("_nt")
    piv = joined.groupBy(tag).agg(
        F.sum(F.when(F.col("_p") == "b", w).otherwise(F.lit(0))).cast("bigint").alias(base_out),
        F.sum(F.when(F.col("_p") == "r", w).otherwise(F.lit(0))).cast("bigint").alias(recent_out),
    )
    out = (piv.where(F.col(base_out) >= min_base)
              .withColumn(growth_out, pct(F.col(recent_out) - F.col(base_out),
                                          F.nullif(F.col(base_out), F.lit(0)), digits)))
    return topk(out, k, F.col(growth_out).desc_nulls_last(), F.col(tag).asc_nulls_last())


#: For a wide vocabulary: tags whose pairs are counted first, to learn what a pair must count to be among the top.
SEED_TAGS = 32


def tag_cooccurrence(bridge: DataFrame, key: str = KEY, tag: str = "genre", k: int = TOP_K,
                     a_out: str = "genre_a", b_out: str = "genre_b",
                     count_out: str = "titles_with_both", seed_tags: int = 0) -> DataFrame:
    """D3: how often two different tags occur on the same key (bag semantics:
    a tag listed twice on a key counts twice), top k pairs.

    Plan: (key, tag) multiplicities (partial aggregate) -> keys with the same
    combination of tags are found by order-free hashes of their rows and one
    of them stands for all -> only those representatives are joined with
    themselves, each pair weighted by ``keys * m_a * m_b``. No row ever holds a
    key's tags, so a key with very many tags is rows that AQE can split, and
    the pairs made follow the distinct combinations, not the keys.

    With a wide vocabulary, ``seed_tags`` keeps rare tags out of that join: a pair can't count more than its rarer tag,
    whose bound is ``keys * m * (largest m on the key)`` over its rows. The pairs
    of the ``seed_tags`` tags with the largest bounds are counted first; tags
    below the k-th of these counts are in no top pair. The answer is exact,
    whatever ``seed_tags`` is (0: nothing is pruned, which suits some dozens of tags).
    """
    b = bridge.where(F.col(key).isNotNull() & F.col(tag).isNotNull())
    mult = b.groupBy(key, tag).agg(_n().alias("m"))
    combos = (mult.groupBy(key)
                  .agg(F.bit_xor(F.xxhash64(F.col(tag), F.col("m"))).alias("h1"),
                       F.bit_xor(F.xxhash64(F.col("m"), F.col(tag))).alias("h2"), _n().alias("n"), F.max("m").alias("most"))
                  .where(F.col("n") >= 2)
                  .groupBy("h1", "h2", "n").agg(F.min(key).alias(key), _n().alias("keys"), F.max("most").alias("most")))
    rows = mult.join(combos.select(key, "keys", "most"), key)
    if seed_tags:
        bounds = rows.groupBy(tag).agg(F.sum(F.col("keys") * F.col("m") * F.col("most")).alias("_bound"))
        seed = topk(bounds, seed_tags, F.col("_bound").desc(), F.col(tag).asc()).select(tag)
        first = _pair_counts(rows.join(seed, tag, "left_semi"), key, tag, "_a", "_b", "_count")
        least = topk(first, k, F.col("_count").desc()).agg(F.when(_n() == k, F.min("_count")).otherwise(0).alias("x")).scalar()
        rows = rows.join(bounds.where(F.col("_bound") >= least).select(tag), tag, "left_semi")
    return topk(_pair_counts(rows, key, tag, a_out, b_out, count_out), k,
                F.col(count_out).desc(), F.col(a_out).asc(), F.col(b_out).asc())


def _pair_counts(rows: DataFrame, key: str, tag: str, a_out: str, b_out: str, count_out: str) -> DataFrame:
    """Counts of all pairs of tags over (key, tag, m, keys) rows."""
    left = rows.select(F.col(key).alias("_k"), F.col(tag).alias(a_out), F.col("m").alias("_ma"), "keys")
    right = rows.select(F.col(key).alias("_k"), F.col(tag).alias(b_out), F.col("m").alias("_mb"))
    pairs = left.join(right, "_k").where(F.col(a_out) < F.col(b_out))
    return pairs.groupBy(a_out, b_out).agg(F.sum(F.col("keys") * F.col("_ma") * F.col("_mb")).cast("bigint").alias(count_out))


# ---------------------------------------------------------------- E/H: lists
def explode_list(df: DataFrame, list_col: str, out: str, key: str | None = KEY,
                 sep: str = LIST_SEPARATOR, exclude: str | None = None,
                 keep: Sequence[str] = ()) -> DataFrame:
    """One row per list token, SQL-style: ``TRIM(UNNEST(STRING_SPLIT(c, sep)))``.

    Rows equal to ``exclude`` (and null lists) give no rows; blank tokens are
    kept as ''. Only spaces are trimmed (SQL TRIM).
    """
    src = df if exclude is None else df.where(F.col(list_col) != F.lit(exclude))
    carry = ([key] if key else []) + list(keep)
    tok = src.select(*carry, F.explode(split_list(list_col, sep)).alias("_tok"))
    return tok.select(*carry, F.trim("_tok").alias(out))


def first_value_topk(df: DataFrame, list_col: str, out: str, sep: str = LIST_SEPARATOR,
                     exclude: str | None = None, k: int = TOP_K,
                     count_out: str = "title_count") -> DataFrame:
    """Top k of the first list token (untrimmed)."""
    src = df if exclude is None else df.where(F.col(list_col) != F.lit(exclude))
    agg = src.groupBy(first_token(list_col, sep).alias(out)).agg(_n().alias(count_out))
    return topk(agg, k, F.col(count_out).desc(), F.col(out).asc_nulls_last())


def multivalue_topk(df: DataFrame, list_col: str, out: str, sep: str = LIST_SEPARATOR,
                    exclude: str | None = None, k: int = TOP_K,
                    count_out: str = "title_count") -> DataFrame:
    """Top k of trimmed list tokens, each occurrence counted."""
    tok = explode_list(df, list_col, out, key=None, sep=sep, exclude=exclude)
    agg = tok.groupBy(out).agg(_n().alias(count_out))
    return topk(agg, k, F.col(count_out).desc(), F.col(out).asc_nulls_last())


def distinct_share_by_period(df: DataFrame, list_col: str, value: str, key: str = KEY,
                             date_col: str = "date_added", sep: str = LIST_SEPARATOR,
                             exclude: str | None = None, period_out: str = "year_added",
                             match_out: str = "match_titles", other_out: str = "other_titles",
                             share_out: str = "other_share_pct", digits: int = 1) -> DataFrame:
    """Per year - distinct keys listing ``value``, distinct keys listing
    anything else, and the latter's share of all distinct keys. A key with
    both counts in both.

    Two-level aggregation instead of three COUNT(DISTINCT)s: first one row per
    (year, key) with "lists value" / "lists other" flags, then counts per
    year. Both levels combine map-side, and each token row is shuffled once
    (an Expand-based plan would shuffle it once per distinct expression).
    Null keys form a group but are not counted, as in COUNT(DISTINCT).
    """
    tok = explode_list(df, list_col, "_v", key=key, sep=sep, exclude=exclude, keep=[date_col])
    v = F.col("_v")
    per_key = tok.groupBy(year_of(date_col).alias(period_out), key).agg(
        F.max((v == F.lit(value)).cast("int")).alias("_match"),
        F.max((v != F.lit(value)).cast("int")).alias("_other"))
    has_key = F.col(key).isNotNull()
    other = count_where(has_key & (F.col("_other") == 1))
    return per_key.groupBy(period_out).agg(
        count_where(has_key & (F.col("_match") == 1)).alias(match_out),
        other.alias(other_out),
        pct(other, count_where(has_key), digits).alias(share_out),
    )


def breadth_topk(df: DataFrame, list_col: str, bridge: DataFrame, key: str = KEY,
                 tag: str = "genre", sep: str = LIST_SEPARATOR, exclude: str | None = None,
                 min_titles: int = 5, k: int = TOP_K, out: str = "single_director",
                 titles_out: str = "title_count", breadth_out: str = "distinct_genre_count") -> DataFrame:
    """H3: per list token (e.g. one director) - distinct keys that have at
    least one bridge row, and distinct tags over those keys; keep tokens with
    at least ``min_titles`` keys, top k by breadth then keys.

    Only distinct counts are asked for, so both sides are de-duplicated
    first, and each count is a hash aggregate: distinct (key, token) pairs that
    have a bridge row, counted per token; and their distinct (token, tag)
    pairs, counted per token. Nothing is gathered per key; a key with many
    tokens or tags is a skewed join partition AQE can split. A key whose tags
    are all null still counts as a title, as in the SQL join.
    """
    people = (explode_list(df, list_col, out, key=key, sep=sep, exclude=exclude)
              .where(F.col(key).isNotNull()).distinct())
    tags = bridge.where(F.col(key).isNotNull()).select(key, F.col(tag).alias("_tag")).distinct()
    titles = (people.join(tags.select(key).distinct(), key, "left_semi")
                    .groupBy(out).agg(_n().alias(titles_out))
                    .where(F.col(titles_out) >= min_titles))
    breadth = (people.join(tags, key).select(out, "_tag").distinct()
                     .groupBy(out).agg(F.count("_tag").alias(breadth_out)))
    agg = titles.join(breadth, out)
    return topk(agg, k, F.col(breadth_out).desc(), F.col(titles_out).desc(), F.col(out).asc_nulls_last())


# ---------------------------------------------------------------- G: lag
def lag_profile(df: DataFrame, date_col: str = "date_added", year_col: str = "release_year",
                out: str = "avg_acquisition_lag_years", digits: int = 1) -> DataFrame:
    """G1: mean of year(added) - release year (nulls skipped)."""
    return df.agg(F.round(F.avg(year_of(date_col) - F.col(year_col)), digits).alias(out))


# ---------------------------------------------------------------- J: summary
def summary_partials(titles: DataFrame, key: str = KEY, date_col: str = "date_added", type_col: str = "type",
                     minutes_col: str = "duration_minutes", year_col: str = "release_year", list_col: str = "country",
                     exclude: str | None = "Unknown", movie: str = "Movie", show: str = "TV Show") -> tuple[DataFrame, DataFrame]:
    """What J1 is summed from: per (year, key) kind flags, row count, unweighted sums and counts; and the distinct
    (key, token) rows of the list with their multiplicity."""
    y = year_of(date_col)
    kind = F.col(type_col)
    lag = y - F.col(year_col)
    per_year_key = titles.groupBy(y.alias("year_added"), F.col(key)).agg(
        F.max((kind == F.lit(movie)).cast("int")).alias("_mv"),
        F.max((kind == F.lit(show)).cast("int")).alias("_sh"),
        _n().alias("_r"),
        F.sum(minutes_col).alias("_sm"), F.count(minutes_col).alias("_cm"),
        F.sum(lag).alias("_sl"), F.count(lag).alias("_cl"),
    )
    listed = (explode_list(titles, list_col, "_country", key=key, exclude=exclude)
              .where(F.col(key).isNotNull()).groupBy(key, "_country").agg(_n().alias("_m")))
    return per_year_key, listed


def yearly_summary(titles: DataFrame, key: str = KEY, date_col: str = "date_added",
                   type_col: str = "type", minutes_col: str = "duration_minutes",
                   year_col: str = "release_year", list_col: str = "country",
                   exclude: str | None = "Unknown", movie: str = "Movie", show: str = "TV Show",
                   dedup: bool = False, digits: int = 1) -> DataFrame:
    """Per year - distinct titles / movies / shows, mean movie minutes,
    distinct countries, mean acquisition lag.

    Default (``dedup=False``) keeps the original view's semantics: titles are
    LEFT JOINed to their exploded countries before averaging, so a title row
    whose key has n country rows weighs n (at least 1) in both means.
    ``dedup=True`` weighs every title row once.

    Plan, without materialising that fan-out:

    1. per (year, key): kind flags and unweighted partial sums / counts;
    2. per key: the number of its country rows, joined to (1); the weight
       depends only on the key, so weighted sums are ``w_key * partial sum``;
    3. per year: distinct (key, country) pairs joined to the (year, key)
       pairs, reduced to distinct (year, country) and counted;
    4. (2) aggregated per year, joined with (3), ordered by year (nulls last).

    All aggregates combine map-side and nothing is gathered per key; null keys
    form their own (year, key) group, weigh 1 and contribute no countries and
    no distinct count, as in the SQL join.
    """
    per_year_key, listed = summary_partials(titles, key, date_col, type_col, minutes_col, year_col, list_col, exclude, movie, show)
    rows = per_year_key.join(listed.groupBy(key).agg(F.sum("_m").alias("_n")), key, "left")
    w = F.lit(1) if dedup else F.coalesce(F.col("_n"), F.lit(1))
    has_key = F.col(key).isNotNull()

    def wmean(total: str, count: str) -> Column:
        return F.round(safe_ratio(F.sum(w * F.col(total)), F.sum(w * F.col(count))), digits)

    years = rows.groupBy("year_added").agg(
        count_where(has_key).alias("total_titles"),
        count_where(has_key & (F.col("_mv") == 1)).alias("movies"),
        count_where(has_key & (F.col("_sh") == 1)).alias("tv_shows"),
        wmean("_sm", "_cm").alias("avg_movie_minutes"),
        wmean("_sl", "_cl").alias("avg_acquisition_lag_years"),
    )
    countries = (per_year_key.select(F.col("year_added").alias("_y"), key).join(listed.select(key, "_country"), key)
                 .select("_y", "_country").distinct().groupBy("_y").agg(_n().alias("_c")))
    both = years.join(countries, F.col("year_added").eqNullSafe(F.col("_y")), "left")
    return sorted_by(both.select(
        "year_added", "total_titles", "movies", "tv_shows", "avg_movie_minutes",
        F.coalesce("_c", F.lit(0)).cast("bigint").alias("distinct_countries"), "avg_acquisition_lag_years"), "year_added")


def latest(view: DataFrame, k: int = 5, order_col: str = "year_added") -> DataFrame:
    """The k latest rows of a summary."""
    return topk(view, k, F.col(order_col).desc_nulls_last())
