"""The 25 named catalog reports (A1 ... J2), each a composition of the
reusable operators over a ``titles`` table and its ``genres`` bridge.

Literals are parameters; defaults are the report pack's own values. Reports
that the pack orders without a limit are ordered here too, on their aggregated
rows. The output column names are fixed values: they must equal the pack's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.functions import quarter_label, year_of
from marquee.operators import reports as R
from marquee.schema import (
    FAMILY_RATINGS, FRESH_MAX_LAG, GROWTH_BASE_YEARS, GROWTH_MIN_BASE, GROWTH_RECENT_YEARS,
    HOME_COUNTRY, KEY, LATEST_YEARS, LIBRARY_MIN_LAG, MATURE_RATINGS, MIN_DIRECTOR_TITLES,
    MODERN_RELEASE_YEAR, MOVIE, NOT_RATED, SERIES_LENGTH_LABELS, TOP_K, TV_SHOW, UNKNOWN,
)

def _is_movie():
    return F.col("type") == F.lit(MOVIE)


def _is_show():
    return F.col("type") == F.lit(TV_SHOW)


# ---------------------------------------------------------------- A
def a1_overview(titles: DataFrame) -> DataFrame:
    return R.overview(titles)


def a2_quality(titles: DataFrame) -> DataFrame:
    return R.sentinel_share(titles, {
        "pct_unknown_director": ("director", UNKNOWN),
        "pct_unknown_cast": ("cast", UNKNOWN),
        "pct_unknown_country": ("country", UNKNOWN),
        "pct_not_rated": ("rating", NOT_RATED),
    }, digits=2)


# ---------------------------------------------------------------- B
def b1_yearly(titles: DataFrame) -> DataFrame:
    return R.sorted_by(R.count_by_period(titles, "date_added", "year"), "year_added")


def b2_growth(titles: DataFrame) -> DataFrame:
    return R.sorted_by(R.growth_over_periods(titles, "date_added", "year"), "year_added")


def b3_tv_share(titles: DataFrame) -> DataFrame:
    return R.sorted_by(R.category_share_by_period(
        titles, year_of("date_added"), "year_added",
        {"movies": _is_movie(), "tv_shows": _is_show()},
        share_of="tv_shows", share_out="tv_show_share_pct"), "year_added")


# ---------------------------------------------------------------- C
def c1_minutes(titles: DataFrame) -> DataFrame:
    return R.numeric_profile(titles, "duration_minutes", where=_is_movie(),
                             avg_out="avg_minutes", min_out="min_minutes", max_out="max_minutes")


def c2_minutes_by_year(titles: DataFrame, min_release_year: int = MODERN_RELEASE_YEAR) -> DataFrame:
    return R.sorted_by(R.numeric_profile(
        titles, "duration_minutes", by="release_year",
        where=_is_movie() & (F.col("release_year") >= min_release_year),
        count_out="movie_count", avg_out="avg_duration_minutes"), "release_year")


def series_length_bucket(seasons: str = "duration_seasons"):
    s = F.col(seasons)
    one, short, long_ = SERIES_LENGTH_LABELS
    return (F.when(s == 1, F.lit(one))
             .when(s.between(2, 4), F.lit(short))
             .when(s >= 5, F.lit(long_)))


def c3_series_length(titles: DataFrame) -> DataFrame:
    return R.sorted_by(R.bucket_share(
        titles, series_length_bucket(), "series_length_group", where=_is_show(),
        count_out="show_count", pct_out="pct_of_tv_shows"), "series_length_group")


# ---------------------------------------------------------------- D
def d1_genres(genres: DataFrame, k: int = TOP_K) -> DataFrame:
    return R.top_values(genres, "genre", k)


def d2_rising_genres(genres: DataFrame, titles: DataFrame,
                     base: tuple[int, int] = GROWTH_BASE_YEARS,
                     recent: tuple[int, int] = GROWTH_RECENT_YEARS,
                     min_base: int = GROWTH_MIN_BASE, k: int = TOP_K) -> DataFrame:
    return R.period_growth_topk(genres, titles, KEY, "genre", "date_added", base, recent,
                                min_base, k)


def d3_genre_pairs(genres: DataFrame, k: int = TOP_K) -> DataFrame:
    return R.tag_cooccurrence(genres, KEY, "genre", k)


# ---------------------------------------------------------------- E
def e1_primary_country(titles: DataFrame, k: int = TOP_K) -> DataFrame:
    return R.first_value_topk(titles, "country", "primary_country", exclude=UNKNOWN, k=k)


def e2_countries(titles: DataFrame, k: int = TOP_K) -> DataFrame:
    return R.multivalue_topk(titles, "country", "single_country", exclude=UNKNOWN, k=k)


def e3_non_us_share(titles: DataFrame, home: str = HOME_COUNTRY) -> DataFrame:
    return R.sorted_by(R.distinct_share_by_period(
        titles, "country", home, exclude=UNKNOWN, match_out="us_titles",
        other_out="non_us_titles", share_out="non_us_share_pct"), "year_added")


# ---------------------------------------------------------------- F
def f1_ratings(titles: DataFrame) -> DataFrame:
    shares = R.bucket_share(titles, F.col("rating"), "rating", count_out="title_count", pct_out="pct")
    return shares.orderBy(F.desc("title_count"), F.asc_nulls_last("rating"))


def f2_audience(titles: DataFrame) -> DataFrame:
    rating = F.col("rating")
    return R.sorted_by(R.category_share_by_period(
        titles, year_of("date_added"), "year_added",
        {"mature_count": rating.isin(*MATURE_RATINGS), "family_count": rating.isin(*FAMILY_RATINGS)},
        share_of="mature_count", share_out="mature_share_pct"), "year_added")


# ---------------------------------------------------------------- G
def g1_acquisition_lag(titles: DataFrame) -> DataFrame:
    return R.lag_profile(titles)


def g2_freshness(titles: DataFrame, fresh_max: int = FRESH_MAX_LAG,
                 library_min: int = LIBRARY_MIN_LAG) -> DataFrame:
    lag = year_of("date_added") - F.col("release_year")
    return R.sorted_by(R.category_share_by_period(
        titles, year_of("date_added"), "year_added",
        {"fresh_content": lag <= fresh_max, "library_content": lag >= library_min},
        share_of="fresh_content", share_out="fresh_content_pct",
        where=F.col("release_year").isNotNull()), "year_added")


# ---------------------------------------------------------------- H
def h1_directors(titles: DataFrame, k: int = TOP_K) -> DataFrame:
    return R.top_values(titles, "director", k, exclude=UNKNOWN)


def h2_actors(titles: DataFrame, k: int = TOP_K) -> DataFrame:
    return R.multivalue_topk(titles, "cast", "actor", exclude=UNKNOWN, k=k)


def h3_director_breadth(titles: DataFrame, genres: DataFrame,
                        min_titles: int = MIN_DIRECTOR_TITLES, k: int = TOP_K) -> DataFrame:
    return R.breadth_topk(titles, "director", genres, KEY, "genre", exclude=UNKNOWN,
                          min_titles=min_titles, k=k)


# ---------------------------------------------------------------- I
def i1_monthly(titles: DataFrame) -> DataFrame:
    return R.sorted_by(R.count_by_period(titles, "date_added", "month", period_out="month_number"), "month_number")


def i2_quarters(titles: DataFrame) -> DataFrame:
    return R.sorted_by(R.category_share_by_period(
        titles, quarter_label("date_added"), "quarter",
        {"movies": _is_movie(), "tv_shows": _is_show()}, total_out="total"), "quarter")


# ---------------------------------------------------------------- J
def j1_yearly_summary(titles: DataFrame, dedup: bool = False) -> DataFrame:
    return R.yearly_summary(titles, exclude=UNKNOWN, dedup=dedup)


def j2_latest_years(titles: DataFrame, k: int = LATEST_YEARS) -> DataFrame:
    return R.latest(j1_yearly_summary(titles), k)


def register_catalog(titles: DataFrame, genres: DataFrame, titles_name: str = "titles",
                     genres_name: str = "genres") -> None:
    """Expose both tables to ``spark.sql`` as session views."""
    titles.createOrReplaceTempView(titles_name)
    genres.createOrReplaceTempView(genres_name)


def register_yearly_summary(titles: DataFrame, name: str = "yearly_summary") -> DataFrame:
    """Expose J1 as a session view (the original keeps it as a database view)."""
    view = j1_yearly_summary(titles)
    view.createOrReplaceTempView(name)
    return view


#: Reports ordered without a limit, and what orders them (a minus sign: descending).
ORDERED = {
    "b1_yearly": "year_added", "b2_growth": "year_added", "b3_tv_share": "year_added",
    "c2_minutes_by_year": "release_year", "c3_series_length": "series_length_group",
    "e3_non_us_share": "year_added", "f1_ratings": "-title_count", "f2_audience": "year_added",
    "g2_freshness": "year_added", "i1_monthly": "month_number", "i2_quarters": "quarter",
    "j1_yearly_summary": "year_added",
}

# name -> fn(titles, genres) with the report pack's own parameters
REPORTS = {
    "a1_overview": lambda t, g: a1_overview(t),
    "a2_quality": lambda t, g: a2_quality(t),
    "b1_yearly": lambda t, g: b1_yearly(t),
    "b2_growth": lambda t, g: b2_growth(t),
    "b3_tv_share": lambda t, g: b3_tv_share(t),
    "c1_minutes": lambda t, g: c1_minutes(t),
    "c2_minutes_by_year": lambda t, g: c2_minutes_by_year(t),
    "c3_series_length": lambda t, g: c3_series_length(t),
    "d1_genres": lambda t, g: d1_genres(g),
    "d2_rising_genres": lambda t, g: d2_rising_genres(g, t),
    "d3_genre_pairs": lambda t, g: d3_genre_pairs(g),
    "e1_primary_country": lambda t, g: e1_primary_country(t),
    "e2_countries": lambda t, g: e2_countries(t),
    "e3_non_us_share": lambda t, g: e3_non_us_share(t),
    "f1_ratings": lambda t, g: f1_ratings(t),
    "f2_audience": lambda t, g: f2_audience(t),
    "g1_acquisition_lag": lambda t, g: g1_acquisition_lag(t),
    "g2_freshness": lambda t, g: g2_freshness(t),
    "h1_directors": lambda t, g: h1_directors(t),
    "h2_actors": lambda t, g: h2_actors(t),
    "h3_director_breadth": lambda t, g: h3_director_breadth(t, g),
    "i1_monthly": lambda t, g: i1_monthly(t),
    "i2_quarters": lambda t, g: i2_quarters(t),
    "j1_yearly_summary": lambda t, g: j1_yearly_summary(t),
    "j2_latest_years": lambda t, g: j2_latest_years(t),
}
