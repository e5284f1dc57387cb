"""Keyed load (L1-L3): replace every target row whose key occurs in the batch,
then append the batch. Both tables are keyed by the *titles* batch.

The key set stays a DataFrame and the delete is a left-anti join: AQE
broadcasts the keys if their measured size is small, and otherwise splits
skewed partitions of the sort-merge join. Null keys never match, so they are
kept and a rerun appends them again, as in the original load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.schema import KEY


def batch_keys(staged_titles: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct non-null keys of a batch."""
    return staged_titles.select(key).where(F.col(key).isNotNull()).distinct()


def replace_by_key(target: DataFrame, staged: DataFrame, keys: DataFrame | None = None,
                   key: str = KEY) -> DataFrame:
    """L2 + L1: ``target`` minus rows whose key is in ``keys``, plus ``staged``.

    ``keys`` defaults to the distinct non-null keys of ``staged``. The append
    is by column name, cast to the target's types.
    """
    keys = batch_keys(staged, key) if keys is None else keys
    kept = target.join(keys, key, "left_anti")
    typed = staged.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])
    return kept.unionByName(typed)


def upsert_catalog(titles: DataFrame, genres: DataFrame, staged_titles: DataFrame,
                   staged_genres: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """L3: replace by key in both tables, keys taken from the staged titles."""
    keys = batch_keys(staged_titles, key)
    return (replace_by_key(titles, staged_titles, keys, key),
            replace_by_key(genres, staged_genres, keys, key))
