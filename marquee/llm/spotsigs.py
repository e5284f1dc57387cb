"""Document fingerprints by spot signatures, in DataFrame functions only.

A spot signature is a common word (the anchor) and the chain of content words
that follow it, common words between them left out. Anchors are spread over
running prose and rare in menus and adverts. A document's fingerprint is the
set of its signatures; two documents are as alike as the Jaccard similarity of
their sets, which the set lengths bound from above.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import broadcast_if_small, materialize, once, text_key

#: Common words of English, German, French and Spanish that serve as anchors (public stop-word lists, fixed values).
ANCHORS = """a an the of and to in is it that was for on be with as by at are this from or
der die das und ist zu den von mit des auf ein eine im nicht
le la les de et un une des du que est pour dans en au
el los las y del que en un una es por con para se""".split()
CHAIN = 3               # content words of a signature
REACH = 4               # further anchors that a chain may run across
#: At most as many signatures, the common ones, travel to the tasks with their counts.
HOT = 1 << 17
_WORD = r"[\p{L}\p{N}]"
_MARK = "\u0001"


def _any_of(words: list[str]) -> str:
    """Pattern of the words, longest first, their common beginnings once: a position is not tried with every word."""
    rest: dict[str, list[str]] = {}
    for w in dict.fromkeys(words):
        if w:
            rest.setdefault(w[0], []).append(w[1:])
    some = "|".join(re.escape(c) + _any_of(more) for c, more in rest.items())
    return f"(?:{some})?" if rest and "" in words else f"(?:{some})" if len(rest) > 1 else some


def _chains(spots: Column, tails: Column, chain: int, reach: int) -> Column:
    """For each spot (an anchor and the content words up to the next one) the anchor and its chain; tails: the
    first content words of each spot. Only a spot of too few words looks at the ones behind it."""
    return F.transform(spots, lambda s, i: F.when(F.size(s) > chain, F.slice(s, 1, chain + 1)).otherwise(
        F.concat(F.slice(s, 1, 1), F.slice(F.flatten(F.slice(tails, i + 1, reach + 1)), 1, chain))))


def with_signatures(df: DataFrame, chain: int = CHAIN, reach: int = REACH, anchors: list[str] = ANCHORS, **texts: str) -> DataFrame:
    """``df`` with a sorted set of signature hashes for each ``name="text column"``; a null text counts as empty.

    Chains that the text (or ``reach`` further anchors) leaves incomplete are no
    signatures. A text without any has one: the hash of the whole text, so it is
    like its copies only.
    """
    words = _any_of(anchors)
    # Each step is a column of its own that the next one uses more than once, so nothing is computed once for every anchor.
    for name, column in texts.items():
        marked = F.regexp_replace(F.lower(F.coalesce(column, F.lit(""))), rf"(?<!{_WORD})(?:{words})(?!{_WORD})", _MARK + "$0")
        spots = F.slice(F.split(marked, _MARK), 2, 1 << 30)                 # without what stands before the first anchor
        df = df.withColumn(f"__{name}", F.transform(spots, lambda s: F.regexp_extract_all(s, F.lit(rf"{_WORD}+"), F.lit(0))))
    for name in texts:
        df = df.withColumn(f"__t_{name}", once(F.transform(f"__{name}", lambda s: F.slice(s, 2, chain))))
    for name in texts:
        spots, tails = F.col(f"__{name}"), F.col(f"__t_{name}")
        whole = F.transform(F.filter(_chains(spots, tails, chain, reach), lambda x: F.size(x) == chain + 1), lambda x: F.xxhash64(x))
        df = df.withColumn(f"__{name}", F.when(F.size(spots) > 0, F.sort_array(F.array_distinct(whole))))
    for name, column in texts.items():
        found = F.col(f"__{name}")
        alone = F.array(F.xxhash64(F.lit("text"), F.coalesce(column, F.lit(""))))
        df = df.withColumn(name, F.when(F.size(found) > 0, found).otherwise(alone))
    return df.drop(*[f"__{p}{name}" for name in texts for p in ("", "t_")])


def fingerprint(signatures: Column) -> Column:
    """Hex digest of a signature set."""
    return F.md5(F.array_join(F.transform(signatures, lambda x: F.hex(x)), ""))


def with_likeness(df: DataFrame, **pairs: tuple[str, str]) -> DataFrame:
    """``df`` with the Jaccard similarity of two signature sets for each ``name=(column, column)``."""
    for name, (a, b) in pairs.items():
        df = df.withColumn(name, F.size(F.array_intersect(a, b)))
    return df.withColumns({name: F.col(name) / (F.size(a) + F.size(b) - F.col(name)) for name, (a, b) in pairs.items()})


def similar_sets(sets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, similarity) for all pairs of different sets with Jaccard similarity of at least ``threshold``.

    sets: (fp, sigs), each fingerprint once. Sets are partitioned by length: bands
    grow by 1 / threshold, so alike sets lie in one band or in neighbours. Within
    bands only a prefix of each set, rarest signatures first, is joined, as long as
    needed for alike sets to meet; a pair is compared at its first shared signature only if
    the lengths and the place of that signature still allow the threshold.
    """
    n = F.size("sigs")
    each = sets.select("fp", n.alias("n"), F.explode("sigs").alias("sig"))
    counts = materialize(each.groupBy("sig").agg(F.count("*").alias("c")))
    total = counts.agg(F.sum("c")).first()[0] or 0
    common = F.col("c") > total // HOT          # true of fewer than ``HOT`` signatures, as the counts add up to total
    often = F.broadcast(materialize(counts.where(common)))
    counted = each.join(often, "sig").unionByName(each.join(often, "sig", "left_anti").join(counts.where(~common), "sig"))
    rarest = Window.partitionBy("fp").orderBy("c", "sig")
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(threshold) + 1e-9)
    posts = counted.select("fp", "n", band.alias("band"), (F.row_number().over(rarest) - 1).alias("at"), "sig")
    posts = materialize(posts.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9)))
    a = posts.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("at").alias("pa"), "band", "sig")
    b = posts.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("at").alias("pb"),
                     F.explode(F.array("band", F.col("band") - 1)).alias("band"), "sig")
    most = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))     # signatures that can still be shared
    need = threshold * (F.col("na") + F.col("nb")) / (1 + threshold) - 1e-9
    smaller = (F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))
    pairs = a.join(b, ["band", "sig"]).where(smaller & (F.col("na") >= threshold * F.col("nb") - 1e-9) & (most >= need)).select("a", "b").distinct()
    left, right = sets.select(F.col("fp").alias("a"), F.col("sigs").alias("x")), sets.select(F.col("fp").alias("b"), F.col("sigs").alias("y"))
    both = with_likeness(pairs.join(left, "a").join(right, "b"), similarity=("x", "y"))
    return both.where(F.col("similarity") >= threshold).select("a", "b", "similarity")


def next_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, next_th) of every different doc_id: the next larger id and the text hash that stands for it.

    The largest is followed by the smallest, null comes after all. Of an id with
    several texts, the one with the smallest hash stands for it. Ids are dealt into ranges,
    each is ordered by itself, and ranges are tied by their first rows.
    """
    ids = docs.groupBy("doc_id").agg(F.min(text_key(F.col("text"))).alias("th"))
    order = F.col("doc_id").asc_nulls_last()
    parts = materialize(ids.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    heads = parts.groupBy("part").agg(F.min_by(F.struct("doc_id", "th"), F.struct(F.col("doc_id").isNull(), F.col("doc_id"))).alias("head"))
    by_part = Window.orderBy("part")            # one row a range
    heads = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(
        by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = Window.partitionBy("part").orderBy(order)
    both = parts.withColumn("next", F.lead(F.struct("doc_id", "th")).over(inside)).join(heads, "part")
    return both.select("doc_id", F.coalesce("next", "after").alias("next")).select(
        "doc_id", F.col("next.doc_id").alias("next_id"), F.col("next.th").alias("next_th"))


def fingerprint_edits(docs: DataFrame, chain: int = CHAIN, reach: int = REACH, part: int = 4) -> DataFrame:
    """Fingerprint every document and its edited text, and compare.

    The edited text has its last floor(n_chars / ``part``) code points replaced by
    the first as many (or all) of the next document's text. Per row of ``docs``:
    doc_id, n_chars, n_signatures, fingerprint, edited_fingerprint, edited_sha256,
    near_edited, near_next (Jaccard similarity to the edited text's set and to the next
    document's), edited (text).

    Null texts count as empty; an empty text has one signature of its own, so empty
    texts are alike. For repeated ids see ``next_ids``; a single document is its own
    next one. Empty tables give an empty result; other columns aren't read.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = materialize(next_ids(rows))
    quarter = F.floor(F.length("text") / part).cast("int")
    need = rows.groupBy("doc_id").agg(F.max(quarter).alias("q"))
    asked = materialize(order.join(need.withColumnRenamed("doc_id", "__i"), F.col("doc_id").eqNullSafe(F.col("__i"))).select(
        F.col("doc_id").alias("asker"), "next_id", "next_th", "q"))
    # what a row needs of the next document: the beginning of its text and its signatures
    sent = rows.withColumn("th", text_key(F.col("text"))).join(
        broadcast_if_small(asked), F.col("doc_id").eqNullSafe(F.col("next_id")) & (F.col("th") == F.col("next_th")))
    # plain key columns (a null id has its own) let the join reuse the shuffle that drops repeats
    zero = F.lit(0).cast(rows.schema["doc_id"].dataType)
    sent = with_signatures(sent, chain, reach, next_sigs="text").select(
        F.coalesce("asker", zero).alias("k"), F.col("asker").isNull().alias("no_id"),
        F.substring("text", F.lit(1), F.col("q")).alias("head"), "next_sigs").dropDuplicates(["k", "no_id"])
    n = F.length("text")
    both = rows.withColumns({"k": F.coalesce("doc_id", zero), "no_id": F.col("doc_id").isNull()}).join(sent, ["k", "no_id"]).select("doc_id", "text", n.cast("long").alias("n_chars"), "next_sigs", F.concat(
        F.substring("text", F.lit(1), n - quarter), F.substring("head", F.lit(1), quarter)).alias("edited"))
    both = with_signatures(both, chain, reach, sigs="text", edited_sigs="edited")
    both = with_likeness(both, near_edited=("sigs", "edited_sigs"), near_next=("sigs", "next_sigs"))
    return both.select("doc_id", "n_chars", F.size("sigs").cast("long").alias("n_signatures"), fingerprint(F.col("sigs")).alias("fingerprint"),
                       fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"), F.sha2("edited", 256).alias("edited_sha256"),
                       "near_edited", "near_next", "edited")
