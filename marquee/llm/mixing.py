"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every document gets a place in a fixed shuffle of its source. Its virtual
finish time is the number of its source's words up to and including it,
divided by the source's target; a second and third pass over a source continue
the count. Sorted by that time, all sources reach their targets together, and
the sorted queue is cut where the total budget is used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import materialize, n_words, running_sums

#: Parts of each source's shuffled order, and of a unit of virtual time.
SHUFFLE_DIGITS = 3          # hex digits: 4096 buckets a source
TIME_BUCKETS = 4096


def cyclic_weight(rank: Column) -> Column:
    """1, 2, 3, 1, ... by the rank (from 1) of the source."""
    return (rank - 1) % 3 + 1


def source_targets(sizes: DataFrame, weight=cyclic_weight, passes: int = 3) -> DataFrame:
    """(source, source_size) -> the same with rank, weight and target.

    The whole of all sizes is shared by weight; a target stops at ``passes``
    times its source's size, and the excess is shared again by weight among the
    others until none is above. In the order of cap / weight this is one pass:
    a source is capped if its cap is below its share of what the sources before
    it have left.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", weight(F.col("rank")).cast("double"))
    s = s.withColumn("cap", (F.col("source_size") * passes).cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    left = (F.sum("source_size").over(Window.partitionBy(F.lit(0))).cast("double")
            - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    weights = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", left / weights)
    capped = F.col("cap") <= F.col("weight") * F.col("level")
    # the first source that isn't capped fixes the level of all that follow
    level = F.min(F.when(~capped, F.struct("cap_rank", "level"))).over(Window.partitionBy(F.lit(0)))["level"]
    s = s.withColumn("cap_rank", F.row_number().over(by_ratio))
    return s.select("source", "source_size", "rank", "weight",
                    F.when(capped, F.col("cap")).otherwise(F.col("weight") * level).alias("target"))


def mix_sources(docs: DataFrame, weight=cyclic_weight, passes: int = 3, seed: str = "mix") -> DataFrame:
    """Mix ``docs`` (doc_id, source, text); one row per document:
    doc_id, source, size, source_size, target, taken, copies.

    size: words of the text (null or empty: 0). copies: how often the mix takes
    the document, 0 to ``passes``; taken = copies * size. Sources are ordered
    by code point, null last (null is a source of its own). The shuffle is the
    md5 of seed and doc_id, so reruns agree; repeated ids lie beside each
    other, smaller sizes first, and each row is judged by itself. An empty
    table gives an empty result. A document without words is never taken.
    Only the four columns above are read.
    """
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    base = materialize(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), key.alias("key"),
    ).withColumn("bucket", F.conv(F.substring("key", 1, SHUFFLE_DIGITS), 16, 10).cast("long")))

    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weight, passes))
    placed = running_sums(base, "bucket", [F.col("key"), F.col("doc_id"), F.col("size")], {"upto": F.col("size")}, ["source"])
    t = targets.withColumnRenamed("source", "__source").drop("weight")
    placed = materialize(placed.join(t, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source", "bucket"))

    finish = (F.col("pass") * F.col("source_size") + F.col("upto")) / F.col("target")
    queue = (placed.where("size > 0 and target > 0")
             .select("size", "rank", "upto", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass"))
             .select("size", finish.alias("finish"), "rank", "pass", "upto"))
    # equal slices of the time up to 2, then slices of its logarithm
    late = (2 * TIME_BUCKETS + F.floor(F.log2("finish") * 64)).cast("long")
    queue = queue.withColumn("slice", F.when(F.col("finish") < 2, F.floor(F.col("finish") * TIME_BUCKETS)).otherwise(late))
    order = ["finish", "rank", "pass", "upto"]
    served = running_sums(queue, "slice", [F.col(c) for c in order], {"used": F.col("size")})
    budget = targets.agg(F.sum("source_size").alias("x")).scalar()
    last = served.where(F.col("used") <= budget).agg(F.max(F.struct(*order)).alias("x")).scalar()

    copies = sum(
        F.when(F.col("size") == 0, 0).when(
            F.struct(((F.lit(p) * F.col("source_size") + F.col("upto")) / F.nullif(F.col("target"), F.lit(0.0))).alias("finish"),
                     F.col("rank"), F.lit(p).alias("pass"), F.col("upto")) <= last, 1).otherwise(0)
        for p in range(passes))
    out = placed.withColumn("copies", copies)
    return out.select("doc_id", "source", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
                      (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")


def mix_rows(docs: DataFrame, weight=cyclic_weight, passes: int = 3, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` that the mix takes, all columns, and size, target, taken and copies (replaced if there).

    Rows are judged as in ``mix_sources``. Rows that share doc_id, source and size can't be told apart there: they
    share what the mix takes of them evenly, the earlier text hash first.
    """
    new = ["size", "target", "taken", "copies"]
    passed = [c for c in docs.columns if c not in new]
    mixed = mix_sources(docs, weight, passes, seed).groupBy("doc_id", "source", "size").agg(
        F.first("target").alias("target"), F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    mixed = materialize(mixed).select(F.struct("*").alias("__m"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in passed]).alias("__row"))
    rows = rows.withColumn("__size", n_words(F.col("__row.text").cast("string")))
    rows = rows.join(mixed, F.col("__row.doc_id").eqNullSafe(F.col("__m.doc_id")) & (F.col("__size") == F.col("__m.size"))
                     & F.col("__row.source").cast("string").eqNullSafe(F.col("__m.source")))
    same = Window.partitionBy(F.col("__row.doc_id"), F.col("__row.source"), "__size").orderBy(F.xxhash64("__row"))
    left = F.col("__m.copies") - (F.row_number().over(same) - 1)            # copies still to give, one round each
    rows = rows.withColumn("copies", F.when(F.col("__m.rows") == 1, F.col("__m.copies")).otherwise(
        F.greatest(F.lit(0), F.ceil(left / F.col("__m.rows")))).cast("int"))
    return rows.where("copies > 0").select(
        *[F.col("__row").getField(c).alias(c) for c in passed], F.col("__size").alias("size"), F.col("__m.target").alias("target"),
        (F.col("copies") * F.col("__size")).cast("long").alias("taken"), "copies")
