"""The most intricate rewrites against brute force on random small fixtures
(hypothesis): tag-pair counting (D3) and the fan-out-weighted yearly summary
(J1) against pure Python, and the one-pass backfill against the monthly loop."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal
from itertools import product

from hypothesis import HealthCheck, given, settings, strategies as st

from marquee.operators.reports import tag_cooccurrence, yearly_summary
from marquee.schema import GENRES_SCHEMA, TITLES_SCHEMA

keys = st.sampled_from(["a", "b", "c", "d", None])
tags = st.sampled_from(["G1", "G2", "G3", "G4", None])


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(keys, tags), min_size=1, max_size=40))
def test_tag_pairs_equal_self_join_count(spark, rows):
    expected = Counter()
    by_key = defaultdict(list)
    for k, t in rows:
        by_key[k].append(t)
    for k, ts in by_key.items():
        if k is None:
            continue
        for a, b in product(ts, ts):
            if a is not None and b is not None and a < b:
                expected[(a, b)] += 1
    top = sorted(expected.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    got = tag_cooccurrence(spark.createDataFrame(rows, GENRES_SCHEMA)).collect()
    assert [((r.genre_a, r.genre_b), r.titles_with_both) for r in got] == top


title = st.tuples(
    keys,
    st.sampled_from(["Movie", "TV Show", None]),
    st.sampled_from(["Unknown", "C1", "C1, C2", " C2 ,C3", ", C1", "C3"]),
    st.sampled_from([None, dt.date(2019, 5, 1), dt.date(2020, 2, 1), dt.date(2020, 9, 9)]),
    st.sampled_from([None, 2015, 2019]),
    st.sampled_from([None, 60.0, 95.0, 130.0]),
)


def round_half_up(x: float, digits: int = 1) -> float:
    """Spark's round(double): decimal value of the double, half up."""
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def brute_summary(rows):
    """LEFT JOIN titles to exploded countries, then aggregate per year."""
    countries = defaultdict(list)
    for k, _, c, *_ in rows:
        if k is not None and c != "Unknown":
            countries[k] += [x.strip(" ") for x in c.split(",")]
    joined = []
    for k, kind, c, d, ry, mins in rows:
        matches = countries.get(k, []) if k is not None else []
        for m in matches or [None]:
            joined.append((k, kind, d, ry, mins, m))
    out = {}
    for y in {None if d is None else d.year for _, _, d, _, _, _ in joined}:
        g = [r for r in joined if (None if r[2] is None else r[2].year) == y]
        ids = {r[0] for r in g if r[0] is not None}
        mins = [r[4] for r in g if r[4] is not None]
        lags = [r[2].year - r[3] for r in g if r[2] is not None and r[3] is not None]
        out[y] = (len(ids), len({r[0] for r in g if r[0] is not None and r[1] == "Movie"}),
                  len({r[0] for r in g if r[0] is not None and r[1] == "TV Show"}),
                  round_half_up(sum(mins) / len(mins)) if mins else None,
                  len({r[5] for r in g if r[5] is not None}),
                  round_half_up(sum(lags) / len(lags)) if lags else None)
    return out


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(title, min_size=1, max_size=25))
def test_yearly_summary_equals_left_join_fanout(spark, rows):
    data = [(k, kind, "t", "d", "c", c, d, ry, "R", mins, None) for k, kind, c, d, ry, mins in rows]
    got = {r.year_added: (r.total_titles, r.movies, r.tv_shows, r.avg_movie_minutes,
                          r.distinct_countries, r.avg_acquisition_lag_years)
           for r in yearly_summary(spark.createDataFrame(data, TITLES_SCHEMA)).collect()}
    assert got == brute_summary(rows)


raw_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]),
              st.sampled_from(["January 5, 2021", "February 7, 2021", " March 1, 2021",
                               "March 31, 2021", "April 2, 2021", None]),
              st.sampled_from(["X", "X, Y", None, "Y,,Z"])),
    min_size=1, max_size=15)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(raw_rows)
def test_one_pass_backfill_equals_monthly_loop(spark, rows):
    from marquee.plans.jobs import apply_month, backfill_tables
    from marquee.schema import RAW_SCHEMA, empty_frame
    from tests.conftest import raw_row
    raw = spark.createDataFrame([raw_row(k, date_added=d, listed_in=g, title=f"T{i}")
                                 for i, (k, d, g) in enumerate(rows)], RAW_SCHEMA)
    t, g = empty_frame(spark, TITLES_SCHEMA), empty_frame(spark, GENRES_SCHEMA)
    months = [(2021, m) for m in range(1, 5)]
    for y, m in months:
        t, g = apply_month(t, g, raw, y, m)
    t1, g1 = backfill_tables(empty_frame(spark, TITLES_SCHEMA), empty_frame(spark, GENRES_SCHEMA),
                             raw, months[0], months[-1])
    bag = lambda df: Counter(tuple(r) for r in df.collect())
    assert bag(t1) == bag(t) and bag(g1) == bag(g)
