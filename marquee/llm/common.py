"""Helpers shared by the operators: reading, lineage cuts, words, running sums."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marquee.session import ensure_checkpoint_dir

#: A word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark's setting to delete a query's shuffle files when the query has ended.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for ``materialize`` in the shared checkpoint folder, deleted at the end: what is read later is written elsewhere."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    yield path
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def materialize(df: DataFrame, tidy: bool = False, folder: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage at a place that survives a lost executor; the table is
    compressed and columnar, and the plan above it runs exactly once. With
    ``tidy`` Spark deletes the write's shuffle files once the table is there
    (they serve nothing else), so an operator of many steps holds one step's.
    ``folder``: a scratch folder to write to instead.
    """
    spark = df.sparkSession
    path = f"{folder or ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    was = spark.conf.get(_TIDY, None) if tidy else None
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path, compression="zstd" if folder else None)
    finally:
        if tidy:
            spark.conf.unset(_TIDY) if was is None else spark.conf.set(_TIDY, was)
    return spark.read.schema(df.schema).parquet(path)


def once(c: Column) -> Column:
    """``c``, computed once a row: filters, explodes and lambdas above don't repeat what depends on the partition's number."""
    return F.when(F.spark_partition_id() >= 0, c)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would change other letters too)."""
    return F.translate(c, UPPER, UPPER.lower())


def n_words(c: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n (null id: the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def running_sums(df: DataFrame, bucket: str, order: list[Column], sums: dict[str, Column],
                 within: list[str] = ()) -> DataFrame:
    """Inclusive running sums of ``sums`` in the order (bucket, *order) inside ``within``.

    The order is cut into buckets: totals per bucket are pre-aggregated, their
    prefix is taken over the few bucket rows, and each bucket is then summed on
    its own, so that no task holds all rows of a group.
    """
    keys = [*within, bucket]
    totals = df.groupBy(*keys).agg(*[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                            *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums])
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.join(offsets, on).drop(*[f"__k_{k}" for k in keys])
    return out.select(*df.columns, *[(F.col(f"__o_{n}") + F.sum(c).over(inside)).alias(n) for n, c in sums.items()])


#: Rows of a table that may be broadcast; its rows must be of bounded width.
BROADCAST_ROWS = 400_000


def broadcast_if_small(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written table of counted, bounded size for broadcast; a larger one is joined by shuffle."""
    return F.broadcast(table) if table.count() <= limit else table


#: Bytes of a table with arrays that may be broadcast.
BROADCAST_BYTES = 32 << 20


def broadcast_if_light(table: DataFrame, array: str, item_bytes: int, row_bytes: int = 48, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a written table with one array column for broadcast if its rows and items, counted, are small enough."""
    n = table.agg(F.count("*").alias("rows"), F.sum(F.size(array)).alias("items")).first()
    return F.broadcast(table) if n["rows"] * row_bytes + (n["items"] or 0) * item_bytes <= limit else table


#: log2 of the bits of ``mark_possible``: 2**18 rows of 64 bits travel to the tasks.
POSSIBLE_BITS = 24


def mark_possible(rows: DataFrame, key: str, keys: DataFrame, out: str, bits: int = POSSIBLE_BITS) -> DataFrame:
    """Add the boolean ``out``: false where the long ``key`` is surely none of ``keys.key``.

    A bitmap of fixed size, whatever the input, lets rows that a join can't match go past its shuffle; the join decides
    on the others.
    """
    cell = lambda c: F.shiftrightunsigned(c, 64 - bits)
    words = keys.select(F.shiftright(cell(F.col("key")), 6).alias("__at"), cell(F.col("key")).bitwiseAND(F.lit(63)).cast("int").alias("b"))
    words = materialize(words.distinct().groupBy("__at").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("__word")))
    both = rows.withColumn("__cell", cell(F.col(key))).withColumn("__at", F.shiftright("__cell", 6))
    both = both.join(F.broadcast(words), "__at", "left")
    bit = F.expr("shiftrightunsigned(__word, cast(__cell & 63 as int)) & 1")
    return both.select(*rows.columns, F.coalesce(bit == 1, F.lit(False)).alias(out))


def text_key(c: Column) -> Column:
    """Hash of a text that, with doc_id, stands for its row: fully repeated rows share it."""
    return F.xxhash64(F.coalesce(c, F.lit("")), c.isNull())
