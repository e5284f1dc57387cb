"""Spelling variants: words one edit apart, by asymmetric chunks and grams.

Of two words one edit apart, take the shorter (or, at equal length, either) as x. x is cut
into two disjoint chunks; the edit lies in one of them at most, so y holds the other one
unchanged: at the same place if it stands before the edit, shifted by the difference in
length (none or one) if after. So x gives its two chunks and y, for each length x may
have, its positional grams of the chunks' sizes within that shift. Words that agree in
such a key meet and are verified.

A key that very many words share (a common ending) isn't paired out: what its chunk leaves
of the words is again one edit apart, so that rest is cut in two and keyed in the same
way, until the lists are short or only one letter is left, which bounds them by the
alphabet. Nothing is capped or left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import materialize

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT, RATIO, DROP = 7, 2, 10, 31
#: Pairs of a key's list that are verified one by one; larger lists are keyed again.
SPLIT = 512
HELD = 1 << 17              # different words that a task counts before it passes them on


def count_words(docs: DataFrame, drop: int = DROP, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(w, n): the words of all texts of at least ``min_length`` code points and ``min_count`` occurrences.

    Runs of letters, A-Z in lower case; where ``drop`` divides the crc32 of doc_id and run (null id: the empty text),
    the run loses the code point at crc32 modulo its length. 0: no run loses any.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["w", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not x.is_valid:
                    continue
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for w, n in Counter(RUN.findall(x.as_buffer().to_pybytes().lower().decode())).items():
                    if len(w) >= min_length:
                        if drop and (h := zlib.crc32(w.encode(), seed)) % drop == 0:
                            k = h % len(w)
                            w = w[:k] + w[k + 1:]
                            if len(w) < min_length:
                                continue
                        total[w] += n
                if len(total) >= HELD:
                    yield rows()
        yield rows()

    texts = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("bytes"))
    return texts.mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _cut(posts: DataFrame) -> DataFrame:
    """Key every post (key, w, n, d, a, r, lim) by either half of what its key leaves of the word.

    a, r: where that rest begins, and its length in x; in w it has d letters more (0 or 1). The first half stands where
    it stands in x, the second d letters later. lim: a pair found here differs in its first lim letters (0: no matter);
    without that, pairs that agree in both halves would be found twice.
    """
    half = F.floor(F.col("r") / 2).cast("int")
    cuts = posts.withColumn("h", half)
    piece = lambda start, size: F.substring(F.col("w"), start + 1, size)
    left = F.struct(F.xxhash64("key", F.lit(0), piece(F.col("a"), F.col("h"))).alias("key"), (F.col("a") + F.col("h")).alias("a"),
                    (F.col("r") - F.col("h")).alias("r"), F.col("lim"))
    right = F.struct(F.xxhash64("key", F.lit(1), piece(F.col("a") + F.col("h") + F.col("d"), F.col("r") - F.col("h"))).alias("key"),
                     F.col("a"), F.col("h").alias("r"), (F.col("a") + F.col("h")).alias("lim"))
    return cuts.select("w", "n", "d", F.explode(F.array(left, right)).alias("x")).select("x.key", "w", "n", "d", "x.a", "x.r", "x.lim")


def _paired(posts: DataFrame) -> DataFrame:
    """(x, nx, y, ny): the words of the same key that are one edit apart."""
    x = posts.where("d = 0").select("key", F.col("w").alias("x"), F.col("n").alias("nx"), "lim")
    y = posts.select("key", F.col("w").alias("y"), F.col("n").alias("ny"), "d")
    met = x.join(y, "key").where("(d = 1 or x < y) and (lim = 0 or left(x, lim) != left(y, lim))")
    return met.where("levenshtein(x, y, 1) = 1").select("x", "nx", "y", "ny")


def near_pairs(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """(x, nx, y, ny): every pair of ``words`` (w distinct, n) that differ by exactly one inserted, deleted or replaced
    code point, once. Words must have at least three code points."""
    length = F.char_length("w").cast("int")
    whole = words.select("w", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("d")).withColumn("r", length - F.col("d"))
    posts = _cut(whole.select(F.xxhash64("r").alias("key"), "w", "n", "d", F.lit(0).alias("a"), "r", F.lit(0).alias("lim")))
    pairs: DataFrame | None = None
    while True:
        posts = materialize(posts)
        sizes = posts.groupBy("key").agg(F.count("*").alias("ys"), F.sum(1 - F.col("d")).alias("xs"), F.max("r").alias("rest"))
        sizes = materialize(sizes.where("xs > 0 and ys > 1"))
        large = (F.col("xs") * F.col("ys") > split) & (F.col("rest") > 1)
        found = materialize(_paired(posts.join(sizes.where(~large).select("key"), "key", "left_semi")))
        pairs = found if pairs is None else pairs.unionByName(found)
        if sizes.where(large).isEmpty():
            return pairs
        posts = _cut(posts.join(sizes.where(large).select("key"), "key", "left_semi"))


def spelling_forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, n, n_near, form_n) of every word: form is the most frequent near word (ties: the smallest in
    code-point order) if it occurs at least ``ratio`` times as often, else null."""
    ends = pairs.select(F.col("x").alias("word"), F.col("y").alias("near"), F.col("ny").alias("m")).unionByName(
        pairs.select(F.col("y").alias("word"), F.col("x").alias("near"), F.col("nx").alias("m")))
    # the best of a word's near words: pre-aggregated, never gathered
    best = ends.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    out = words.select(F.col("w").alias("word"), "n").join(best, "word", "left")
    form_n = F.when(-F.col("best.m") >= F.col("n") * ratio, -F.col("best.m"))
    return out.select("word", F.when(form_n.isNotNull(), F.col("best.near")).alias("form"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form_n.alias("form_n"))


def form_roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the end of its chain of forms.

    Counts grow along a chain by the ratio, so chains are short; each round doubles the step.
    """
    steps = materialize(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        nxt = steps.select(F.col("word").alias("root"), F.col("root").alias("__far"))
        longer = steps.join(nxt, "root")
        if longer.isEmpty():
            return steps
        steps = materialize(steps.join(nxt, "root", "left").select("word", F.coalesce("__far", "root").alias("root")))


def spelling_variants(docs: DataFrame, drop: int = DROP, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, split: int = SPLIT) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word of ``docs`` (doc_id, text) with its near words.

    Null and empty texts have no words; whole texts count, words of any length too; repeated rows count each time, and a
    null id is the empty id; an empty table, or one without repeated long words, gives an empty result. Other columns
    aren't read.
    """
    if min_length < 3:
        raise ValueError("words must have at least three code points")
    words = materialize(count_words(docs, drop, min_length, min_count))
    forms = materialize(spelling_forms(words, near_pairs(words, split), ratio))
    roots = form_roots(forms).select(F.col("word").alias("__word"), "root")
    out = forms.join(roots, forms["word"] == F.col("__word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
