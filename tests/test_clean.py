"""Cleaning stage: edge rows (null type, null / blank / padded lists, shifted
ratings, bad dates, durations without digits)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marquee.operators.clean import clean_titles, explode_genres, repair_shift
from marquee.operators.ingest import month_slice, tag_months, undated_rows
from marquee.schema import NOT_RATED, UNKNOWN
from tests.conftest import raw_row


def _by_id(df):
    return {r["show_id"]: r for r in df.collect()}


def test_null_type_goes_to_seasons(make_raw):
    t, _ = clean_titles(make_raw([raw_row("a", type=None, duration="3 Seasons")]))
    r = t.collect()[0]
    assert r.duration_seasons == 3.0 and r.duration_minutes is None


def test_movie_minutes_and_show_seasons(make_raw):
    t, _ = clean_titles(make_raw([raw_row("m", type="Movie", duration="95 min"),
                                  raw_row("s", type="TV Show", duration="2 Seasons")]))
    rows = _by_id(t)
    assert (rows["m"].duration_minutes, rows["m"].duration_seasons) == (95.0, None)
    assert (rows["s"].duration_minutes, rows["s"].duration_seasons) == (None, 2.0)


def test_duration_without_digits_is_null(make_raw):
    t, _ = clean_titles(make_raw([raw_row("a", duration="unknown length"),
                                  raw_row("b", duration=None)]))
    for r in t.collect():
        assert r.duration_minutes is None and r.duration_seasons is None


def test_shifted_ratings_move_to_duration(make_raw):
    rows = [raw_row("a", rating="1 Season", duration=None, type="TV Show"),
            raw_row("b", rating="2 Seasons", duration=None, type="TV Show"),
            raw_row("c", rating="74 min", duration=None),
            raw_row("d", rating="74 mins", duration="80 min"),
            raw_row("e", rating=None, duration="81 min")]
    t, _ = clean_titles(make_raw(rows))
    got = _by_id(t)
    assert got["a"].rating == NOT_RATED and got["a"].duration_seasons == 1.0
    assert got["b"].rating == NOT_RATED and got["b"].duration_seasons == 2.0
    assert got["c"].rating == NOT_RATED and got["c"].duration_minutes == 74.0
    assert got["d"].rating == "74 mins" and got["d"].duration_minutes == 80.0
    assert got["e"].rating == NOT_RATED and got["e"].duration_minutes == 81.0


def test_shift_overwrites_duration_unconditionally(make_raw):
    r = repair_shift(make_raw([raw_row("a", rating="74 min", duration="99 min")])).collect()[0]
    assert r.duration == "74 min" and r.rating is None


def test_defaults_fill_nulls_not_blanks(make_raw):
    t, _ = clean_titles(make_raw([raw_row("a", director=None, cast=None, country=None),
                                  raw_row("b", director="", cast="", country="")]))
    got = _by_id(t)
    assert (got["a"].director, got["a"].cast, got["a"].country) == (UNKNOWN,) * 3
    assert (got["b"].director, got["b"].cast, got["b"].country) == ("",) * 3


def test_genre_bridge_edges(make_raw):
    rows = [raw_row("n", listed_in=None),
            raw_row("b", listed_in="a, b,,c,"),
            raw_row("t", listed_in="\tHorror\t ,Comedies\n"),
            raw_row("d", listed_in="Dramas, Dramas")]
    g = explode_genres(make_raw(rows))
    got: dict[str, list] = {}
    for r in g.collect():
        got.setdefault(r.show_id, []).append(r.genre)
    assert got["n"] == [None]
    assert got["b"] == ["a", "b", None, "c", None]
    assert got["t"] == ["Horror", "Comedies"]
    assert got["d"] == ["Dramas", "Dramas"]


def test_dates_parse_strip_and_reject(make_raw):
    rows = [raw_row("ok", date_added="  September 25, 2021 "),
            raw_row("tab", date_added="\tSeptember 5, 2021"),
            raw_row("feb30", date_added="February 30, 2021"),
            raw_row("iso", date_added="2021-09-01"),
            raw_row("abbr", date_added="Sept 1, 2021"),
            raw_row("empty", date_added=""),
            raw_row("null", date_added=None)]
    raw = make_raw(rows)
    t, _ = clean_titles(raw)
    got = _by_id(t)
    assert got["ok"].date_added == dt.date(2021, 9, 25)
    assert got["tab"].date_added == dt.date(2021, 9, 5)
    for k in ("feb30", "iso", "abbr", "empty", "null"):
        assert got[k].date_added is None
    sept = {r.show_id for r in month_slice(raw, 2021, 9).collect()}
    assert sept == {"ok", "tab"}
    assert {r.show_id for r in undated_rows(raw).collect()} == {"feb30", "iso", "abbr", "empty", "null"}
    tagged = tag_months(raw, (2000, 1), (2030, 12))
    assert {r.show_id for r in tagged.collect()} == {"ok", "tab"}
    assert {r.added_month for r in tagged.collect()} == {dt.date(2021, 9, 1)}


def test_tagging_parses_a_date_once(make_raw):
    raw = make_raw([raw_row("a", date_added="\t\x0b March 1, 2020 \r\n")])
    tagged = tag_months(raw, (2000, 1), (2030, 12))
    assert tagged._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp") == 1
    assert [r.added_month for r in tagged.collect()] == [dt.date(2020, 3, 1)]


def test_month_slice_keeps_raw_values(make_raw):
    raw = make_raw([raw_row("a", date_added=" March 1, 2020", rating="74 min")])
    r = month_slice(raw, 2020, 3).collect()[0]
    assert r.date_added == " March 1, 2020" and r.rating == "74 min"


def test_month_filter_is_pushed_to_parquet(spark, tmp_path):
    """A month / year-range filter on a DATE column reaches the Parquet scan."""
    from marquee.functions import in_month
    p = str(tmp_path / "d")
    spark.range(10).select(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int") * 40)
                           .alias("date_added")).write.parquet(p)
    df = spark.read.parquet(p).where(in_month("date_added", 2020, 3))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(date_added" in plan and "LessThan(date_added" in plan


def test_undated_summary_reasons(make_raw):
    from marquee.operators.ingest import undated_summary
    raw = make_raw([raw_row("a", date_added=None), raw_row("b", date_added=" \t"),
                    raw_row("c", date_added="2021-09-01"), raw_row("d", date_added="Sept 1, 2021"),
                    raw_row("e", date_added="May 1, 2021")])
    got = {r.reason: r.rows for r in undated_summary(raw).collect()}
    assert got == {"missing": 1, "blank": 1, "unparseable": 2}


def test_december_and_month_edges(make_raw):
    from marquee.functions import month_bounds
    assert month_bounds(2020, 12) == (dt.date(2020, 12, 1), dt.date(2021, 1, 1))
    raw = make_raw([raw_row("a", date_added="December 31, 2020"),
                    raw_row("b", date_added="January 1, 2021"),
                    raw_row("c", date_added="December 1, 2020"),
                    raw_row("d", date_added="November 30, 2020")])
    assert sorted(r.show_id for r in month_slice(raw, 2020, 12).collect()) == ["a", "c"]
    assert sorted(r.show_id for r in month_slice(raw, 2021, 1).collect()) == ["b"]
