"""Clean stage (T1-T7): pure DataFrame -> DataFrame functions chained with
``DataFrame.transform``. Order matters: repair -> fill -> date -> duration,
and the genre bridge is exploded from the same repaired rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.functions import blank_to_null, first_number, parse_added_date, split_list, strip_ws
from marquee.schema import (
    GENRE_COLUMNS, KEY, MOVIE, NOT_RATED, SHIFTED_RATING_PATTERN, TITLE_COLUMNS, UNKNOWN,
)


def repair_shift(df: DataFrame) -> DataFrame:
    """A duration found in ``rating`` moves to ``duration``; rating -> null.

    The match is evaluated once, on the original rating, and the duration is
    overwritten unconditionally for matched rows. Null rating = no match.
    """
    shifted = F.coalesce(F.col("rating").rlike(SHIFTED_RATING_PATTERN), F.lit(False))
    cols = []
    for c in df.columns:
        if c == "duration":
            cols.append(F.when(shifted, F.col("rating")).otherwise(F.col("duration")).alias("duration"))
        elif c == "rating":
            cols.append(F.when(~shifted, F.col("rating")).alias("rating"))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Null director/cast/country -> 'Unknown', null rating -> 'Not Rated'.
    Empty strings are not null and stay."""
    return df.na.fill({"director": UNKNOWN, "cast": UNKNOWN, "country": UNKNOWN, "rating": NOT_RATED})


def normalise_date(df: DataFrame, col: str = "date_added") -> DataFrame:
    """Text date -> DATE (bad values null). ISO text is produced only on export."""
    return df.withColumn(col, parse_added_date(col))


def split_duration(df: DataFrame) -> DataFrame:
    """T4: first number of ``duration`` goes to minutes for movies and to
    seasons for everything else, including a null type."""
    n = first_number("duration")
    is_movie = F.col("type").eqNullSafe(F.lit(MOVIE))
    return (df.withColumn("duration_minutes", F.when(is_movie, n))
              .withColumn("duration_seasons", F.when(~is_movie, n)))


def explode_genres(df: DataFrame, key: str = KEY, list_col: str = "listed_in",
                   out: str = "genre") -> DataFrame:
    """T5: one row per (key, genre token); a null list yields one null-genre row.

    Tokens are stripped of all whitespace and blank tokens become null; there
    is no de-duplication (a genre listed twice gives two rows).
    """
    tok = F.explode_outer(split_list(list_col)).alias("_tok")
    return (df.select(F.col(key), tok)
              .select(F.col(key), blank_to_null(strip_ws("_tok")).alias(out)))


def clean_titles(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw rows -> (titles, genres) with the target schemas (T6 = final select)."""
    repaired = raw.transform(repair_shift)
    titles = (repaired.transform(fill_defaults)
                      .transform(normalise_date)
                      .transform(split_duration)
                      .select(*TITLE_COLUMNS))
    genres = explode_genres(repaired).select(*GENRE_COLUMNS)
    return titles, genres
