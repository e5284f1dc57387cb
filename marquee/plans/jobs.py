"""Jobs: one monthly run (extract -> clean -> keyed load) and a one-pass
backfill of a month range.

The pure functions (``apply_month``, ``backfill_tables``) build one lazy plan
from the raw source and the current tables; ``run_month`` / ``backfill``
read the latest store version, apply, and publish the next version.
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from marquee.functions import split_list
from marquee.operators.clean import clean_titles
from marquee.operators.ingest import latest_month_rows, load_outcome, month_slice, tag_months
from marquee.operators.upsert import upsert_catalog
from marquee.schema import MONTH_COL, RAW_SCHEMA
from marquee.session import ensure_checkpoint_dir
from marquee.sources.store import CatalogStore, MissingInputError


log = logging.getLogger("marquee.jobs")


def apply_month(titles: DataFrame, genres: DataFrame, raw: DataFrame, year: int,
                month: int) -> tuple[DataFrame, DataFrame]:
    """X2 -> T7 -> L3 for one month, as DataFrames."""
    staged_t, staged_g = clean_titles(month_slice(raw, year, month))
    return upsert_catalog(titles, genres, staged_t, staged_g)


def apply_months(titles: DataFrame, genres: DataFrame, raw: DataFrame,
                 months: list[tuple[int, int]], checkpoint_every: int = 6) -> tuple[DataFrame, DataFrame]:
    """The monthly loop as DataFrames (e.g. to replay history in one session).

    Each month adds a scan, a clean and an anti join to the plan, so the
    lineage is cut every ``checkpoint_every`` months with a reliable
    ``checkpoint()`` into the session's shared checkpoint folder: plans stay
    small and a lost executor recomputes from the checkpoint, not from the
    first month. ``backfill_tables`` gives the same result in one pass.
    """
    ensure_checkpoint_dir(raw.sparkSession)
    for i, (y, m) in enumerate(months, 1):
        titles, genres = apply_month(titles, genres, raw, y, m)
        if checkpoint_every and i % checkpoint_every == 0 and i < len(months):
            titles, genres = titles.checkpoint(), genres.checkpoint()
    return titles, genres


def backfill_tables(titles: DataFrame, genres: DataFrame, raw: DataFrame,
                    first: tuple[int, int], last: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """The result of loading every month in [first, last] in order, in one
    scan of the source and one keyed load.

    Equal to the monthly loop because each key keeps only its latest month's
    rows (a later month's load would have replaced the earlier ones); null
    keys are kept from every month.
    """
    return load_tagged(titles, genres, tag_months(raw, first, last))


def staged_from_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned batch from month-tagged raw rows (latest month per key wins)."""
    return clean_titles(latest_month_rows(tagged).drop(MONTH_COL))


def load_tagged(titles: DataFrame, genres: DataFrame, tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keyed load of month-tagged raw rows, as DataFrames."""
    staged_t, staged_g = staged_from_tagged(tagged)
    return upsert_catalog(titles, genres, staged_t, staged_g)


@dataclass(frozen=True)
class BatchStats:
    """L4 counts of a raw batch: title rows and genre-bridge rows it yields."""

    titles: int
    genres: int


def stage(spark: SparkSession, df: DataFrame, path: str) -> tuple[DataFrame, BatchStats]:
    """Write a batch of raw rows once as Parquet, count it on the way, and continue from the written copy.

    The raw source is scanned once per job instead of once per output table
    and key set, and the lineage is cut: a lost executor recomputes from the
    stage files on the shared store, not from the raw source. The counts are
    observed by the write itself, so they cost no job (a null list yields one
    genre row).
    """
    seen = Observation()
    genre_rows = F.greatest(F.size(split_list("listed_in")), F.lit(1))
    df.observe(seen, F.count(F.lit(1)).alias("titles"), F.sum(genre_rows).alias("genres")).write.mode("overwrite").parquet(path)
    stats = BatchStats(int(seen.get["titles"]), int(seen.get["genres"] or 0))
    return spark.read.schema(df.schema).parquet(path), stats


def load_counts(raw_batch: DataFrame) -> DataFrame:
    """L4 / A-10 as a table: rows that a batch brings to each table."""
    titles, genres = clean_titles(raw_batch)
    n = F.count(F.lit(1)).alias("rows")
    return titles.agg(n).select(F.lit("titles").alias("table"), "rows").unionByName(
        genres.agg(n).select(F.lit("genres").alias("table"), "rows"))


def run_month(spark: SparkSession, raw: DataFrame, store: CatalogStore, year: int,
              month: int, replace_null_ids: bool = False) -> int:
    """X2 (staged) -> T7 -> L3 against a versioned store; returns the new version.

    A rerun replaces the month's rows by key; with ``replace_null_ids`` the
    month is also the load's identity, so its rows without an id are replaced
    too (by default they are appended again, as in the original load)."""
    name = f"month={year:04d}-{month:02d}"
    sliced, stats = stage(spark, month_slice(raw, year, month), store.stage_path(name))
    v = store.publish_replace(*clean_titles(sliced), batch=name if replace_null_ids else None)
    store.drop_stage(name)
    log.info("[load] %04d-%02d: titles %d rows, genres %d rows -> version %d",
             year, month, stats.titles, stats.genres, v)
    return v


def backfill(spark: SparkSession, raw: DataFrame, store: CatalogStore,
             first: tuple[int, int], last: tuple[int, int], replace_null_ids: bool = False) -> int:
    """One-pass backfill of a month range against a versioned store; ``replace_null_ids`` as in ``run_month``, for the same range."""
    name = f"backfill={first[0]:04d}-{first[1]:02d}_{last[0]:04d}-{last[1]:02d}"
    tagged, stats = stage(spark, tag_months(raw, first, last), store.stage_path(name))
    v = store.publish_replace(*staged_from_tagged(tagged), batch=name if replace_null_ids else None)
    store.drop_stage(name)
    log.info("[backfill] %s: %d staged rows, %d genre rows -> version %d",
             name, stats.titles, stats.genres, v)
    return v


#: Column (and folder name) of ``write_outcomes``.
OUTCOME = "outcome"


def write_outcomes(raw: DataFrame, path: str, corrupt_col: str | None = None) -> None:
    """X2, X3 and S1's rejects in one pass: every raw record is written once, under its month, the reason why it has
    none, or ``unparseable-record`` (with its text). A month or a kind of reject is then one folder."""
    raw.withColumn(OUTCOME, load_outcome(corrupt_col)).write.partitionBy(OUTCOME).parquet(path)


def read_outcomes(spark: SparkSession, path: str, corrupt_col: str | None = None) -> DataFrame:
    """What ``write_outcomes`` has written; a filter on ``outcome`` reads only its folders."""
    text = [T.StructField(c, T.StringType()) for c in ([corrupt_col] if corrupt_col else []) + [OUTCOME]]
    return spark.read.schema(T.StructType([*RAW_SCHEMA.fields, *text])).parquet(path)


def read_stage(spark: SparkSession, path: str, schema) -> DataFrame:
    """S3: read a required stage input; a missing path is an error."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        raise MissingInputError(f"stage input not found: {path}")
    return spark.read.schema(schema).parquet(path)


#: Manifests of a month stage: one folder a month, the highest number counts.
_MANIFESTS, _DIGITS = "_months", re.compile(r"^(\d+)\.json$")


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path
    return p, p(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, root: str, label: str) -> list[int]:
    p, fs = _file_system(spark, root)
    folder = p(f"{root}/{_MANIFESTS}/{label}")
    names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(m[1]) for n in names if (m := _DIGITS.match(n)))


def read_month_stage(spark: SparkSession, root: str, year: int, month: int, schema) -> DataFrame:
    """S2 + S3: one month of a stage folder written by ``write_month_stage``.

    Reads the run that the month's last manifest names, and nothing else of the
    stage. A month that was never staged is an error, not an empty batch.
    """
    root = root.rstrip("/")
    label = f"{year:04d}-{month:02d}"
    runs = _manifests(spark, root, label)
    if not runs:
        raise MissingInputError(f"stage input not found: {root}/{MONTH_COL}={label}")
    rows = spark.read.schema(schema).option("basePath", root).parquet(f"{root}/{MONTH_COL}={label}/{_RUN}={runs[-1]}")
    return rows.where(F.col(MONTH_COL) == F.lit(label)).drop(MONTH_COL, _RUN)


_RUN = "run"


def write_month_stage(df: DataFrame, root: str, year: int, month: int,
                      require_dir: bool = False) -> str:
    """Write one month's stage data as a new run, then switch the month to it; returns the run's folder.

    The switch is one small manifest that is created last and without
    overwriting, so a write that is killed leaves the old month as it was, and
    of two writers of one run one fails. An empty batch replaces the month
    too. The run before the last stays for its readers, older ones go. S5: with
    ``require_dir`` the stage root must already exist (Spark would create it).
    """
    root = root.rstrip("/")
    spark = df.sparkSession
    p, fs = _file_system(spark, root)
    if require_dir and not fs.isDirectory(p(root)):
        raise FileNotFoundError(f"stage folder does not exist: {root}")
    label = f"{year:04d}-{month:02d}"
    runs = _manifests(spark, root, label)
    run = max(runs, default=0) + 1
    path = f"{root}/{MONTH_COL}={label}/{_RUN}={run}"
    df.write.mode("overwrite").parquet(path)            # what a killed write of this run has left is replaced
    fs.create(p(f"{root}/{_MANIFESTS}/{label}/{run}.json"), False).close()
    for old in runs[:-1]:
        fs.delete(p(f"{root}/{MONTH_COL}={label}/{_RUN}={old}"), True)
        fs.delete(p(f"{root}/{_MANIFESTS}/{label}/{old}.json"), True)
    return path
