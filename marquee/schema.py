"""Fixed schemas and fixed values of the catalog model.

Everything in the "fixed values" block below must equal what the original
pipeline uses, otherwise cleaned tables and reports differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# --------------------------------------------------------------------------
# Fixed values (must match the source pipeline exactly)
# --------------------------------------------------------------------------
UNKNOWN = "Unknown"                 # fill for null director / cast / country
NOT_RATED = "Not Rated"             # fill for null or cleared rating
MOVIE = "Movie"
TV_SHOW = "TV Show"
ADDED_DATE_FORMAT = "MMMM d, yyyy"  # e.g. "September 25, 2021"
LIST_SEPARATOR = ","
# A duration that slipped into the rating column: digits, optional space,
# then "min", "Season" or "Seasons" (whole value).
SHIFTED_RATING_PATTERN = r"^[0-9]+\s*(min|Seasons?)$"
FIRST_NUMBER_PATTERN = r"([0-9]+)"
MATURE_RATINGS = ("TV-MA", "R", "NC-17")
FAMILY_RATINGS = ("G", "PG", "TV-G", "TV-Y", "TV-Y7", "TV-Y7-FV")
SERIES_LENGTH_LABELS = (
    "1) Limited series (1 season)",
    "2) Short-run (2-4 seasons)",
    "3) Long-running (5+ seasons)",
)
HOME_COUNTRY = "United States"
# Report parameters as the source report pack states them.
MODERN_RELEASE_YEAR = 2000
GROWTH_BASE_YEARS = (2016, 2018)
GROWTH_RECENT_YEARS = (2019, 2021)
GROWTH_MIN_BASE = 20
MIN_DIRECTOR_TITLES = 5
TOP_K = 10
LATEST_YEARS = 5
FRESH_MAX_LAG = 1
LIBRARY_MIN_LAG = 5
# --------------------------------------------------------------------------

KEY = "show_id"
MONTH_COL = "added_month"   # first day of a row's added month (DATE)

# Fixed values too: the columns and types of the three tables below.
# Raw catalog row. Everything is text except release_year; the date stays
# text until parsed so that bad values can be counted, not lost in the scan.
RAW_SCHEMA = T.StructType([
    T.StructField("show_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("director", T.StringType()),
    T.StructField("cast", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("date_added", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("rating", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("listed_in", T.StringType()),
    T.StructField("description", T.StringType()),
])

TITLES_SCHEMA = T.StructType([
    T.StructField("show_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("director", T.StringType()),
    T.StructField("cast", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("date_added", T.DateType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("rating", T.StringType()),
    T.StructField("duration_minutes", T.DoubleType()),
    T.StructField("duration_seasons", T.DoubleType()),
])

GENRES_SCHEMA = T.StructType([
    T.StructField("show_id", T.StringType()),
    T.StructField("genre", T.StringType()),
])

TITLE_COLUMNS = [f.name for f in TITLES_SCHEMA.fields]
GENRE_COLUMNS = [f.name for f in GENRES_SCHEMA.fields]


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A zero-row DataFrame with ``schema`` built on the JVM side (no Python
    RDD), so Catalyst can prune it as an empty relation."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
