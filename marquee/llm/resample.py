"""Importance resampling towards a target distribution, with features hashed in length-bucketed CRC matrices.

A document's features are its runs of one to three words; each falls into one of a
fixed number of buckets by the crc32 of its bytes. A bucket's gain compares how often
the target and the raw corpus fall into it; the sum of a document's gains and a noise
fixed by its id order the draw.

In a task, the distinct features of some documents are gathered by equal length into
two-dimensional uint8 arrays, one feature a row. All checksums of an array are updated
together, column by column, and the buckets are scattered back to the features' places.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import materialize

BUCKETS, LONGEST_RUN = 10000, 3
MIN_WORDS, PERCENT, SEED = 20, 5, 42
PIECE = 1 << 20             # bytes of text that are hashed at once
MATRIX = 1 << 22            # bytes of one array
LONG = 512                  # features of more bytes fill no array with others and get their checksum one by one


def _crc_table() -> np.ndarray:
    """The checksums of the 256 single-byte steps."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> np.uint32(1)) ^ np.uint32(0xEDB88320), steps >> np.uint32(1))
    return steps


def _letters() -> np.ndarray:
    """What each byte counts as: digits, lower-case letters and all beyond ASCII as themselves, A-Z in lower case, others 0."""
    out = np.zeros(256, np.uint8)
    for a, b, shift in ((0x30, 0x3A, 0), (0x61, 0x7B, 0), (0x41, 0x5B, 32), (0x80, 0x100, 0)):
        out[a:b] = np.arange(a, b) + shift
    return out


_TABLE, _LETTERS = _crc_table(), _letters()


def crc_matrix(rows: np.ndarray) -> np.ndarray:
    """crc32 of every row of a two-dimensional uint8 array."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _TABLE[crc.astype(np.uint8) ^ column] ^ (crc >> np.uint32(8))
    return ~crc


def crc_of_slices(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of the slices of ``data``, grouped by equal size into arrays."""
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(sizes, kind="stable")
    edges = np.r_[0, np.flatnonzero(np.diff(sizes[order])) + 1, len(order)]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if a == b:
            continue
        size = int(sizes[order[a]])
        if size > LONG:
            for i in order[a:b].tolist():
                out[i] = zlib.crc32(data[starts[i]:starts[i] + size])
            continue
        every = np.lib.stride_tricks.sliding_window_view(data, size)
        step = max(1, MATRIX // size)
        for k in range(a, b, step):
            part = order[k:min(k + step, b)]
            out[part] = crc_matrix(every[starts[part]])
    return out


class Features:
    """Buckets of all features of some texts.

    n_words: words of each text; parts: for runs of 1, 2 and 3 words the text of each feature and its bucket.
    """

    def __init__(self, texts: list[bytes], buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> None:
        raw = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)      # every text ends with a separator
        letters = _LETTERS[raw]
        ends = np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)
        # one separator after each word is kept, so a run of words is a slice
        word_end = np.r_[False, (letters[:-1] > 0) & (letters[1:] == 0)] if len(letters) else np.empty(0, bool)
        self.n_words = np.diff(np.r_[0, np.cumsum(word_end)[ends - 1]]) if len(texts) else np.empty(0, np.int64)
        keep = (letters > 0) | word_end
        data = np.where(letters[keep] > 0, letters[keep], np.uint8(0x20))
        stops = np.flatnonzero(word_end[keep])
        starts = np.r_[0, stops[:-1] + 1] if len(stops) else stops
        owner = np.repeat(np.arange(len(texts)), self.n_words)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        if not len(stops):
            return
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), [
            None, pa.py_buffer(np.r_[starts, stops[-1] + 1].astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        ids = words.indices.to_numpy().astype(np.int64)
        vocabulary, code = len(words.dictionary), ids
        for n in range(1, longest + 1):
            if n > 1:
                code = code[:-1] * vocabulary + ids[n - 1:]
            distinct, first, code = np.unique(code, return_index=True, return_inverse=True)
            crc = crc_of_slices(data, starts[first], stops[first + n - 1] - starts[first])
            inside = owner[:len(owner) - n + 1] == owner[n - 1:]      # a run doesn't pass from one text to the next
            self.parts.append((owner[:len(owner) - n + 1][inside], (crc % np.uint32(buckets))[code][inside]))
            if n == len(ids):
                break

    def histogram(self, buckets: int) -> np.ndarray:
        return sum((np.bincount(bucket, minlength=buckets) for _, bucket in self.parts), np.zeros(buckets, np.int64))

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, summed gains) of each text."""
        n, total = np.zeros(len(self.n_words), np.int64), np.zeros(len(self.n_words), np.int64)
        for owner, bucket in self.parts:
            n += np.bincount(owner, minlength=len(n))
            upto = np.r_[0, np.cumsum(gains[bucket])]
            edges = np.searchsorted(owner, np.arange(len(n) + 1))
            total += upto[edges[1:]] - upto[edges[:-1]]
        return n, total


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) of some rows at a time, so that what a task holds is bounded by the longest text."""
    first, size, texts = 0, 0, []
    for i, x in enumerate(batch.column(column)):
        texts.append(x.as_buffer().to_pybytes() if x.is_valid else b"")
        size += len(texts[-1])
        if size >= PIECE:
            yield first, texts
            first, size, texts = i + 1, 0, []
    if texts:
        yield first, texts


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``buckets`` sums reach the driver, whatever the input."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _pieces(batch, 0):
                total += Features(texts, buckets).histogram(buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])

    rows = docs.select(F.col(f"`{text}`").cast("string").cast("binary").alias("bytes"))
    out = np.zeros(buckets, np.int64)
    for r in rows.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of each bucket's smoothed shares in the target and in the raw corpus."""
    k = len(raw)
    s, t = float(raw.sum() + k), float(target.sum() + k)
    return np.array([math.floor(1000 * math.log((y + 1) * s / ((x + 1) * t))) for x, y in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: object, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, fixed by seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))


def score_documents(docs: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs``; two scans of its texts, no shuffle of them."""
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, text, buckets))
    rows = docs.select("doc_id", F.col(f"`{text}`").cast("string").cast("binary").alias("bytes"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["n_words", "n_features", "weight", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _pieces(batch, 1):
                ids = batch.column(0).slice(first, len(texts))
                found = Features(texts, buckets)
                n, weight = found.sums(gains)
                total = weight + np.array([noise(x, seed) for x in ids.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c.astype(np.int64)) for c in (found.n_words, n, weight, total))], ["doc_id", *names])

    return rows.mapInArrow(score, f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in names))


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``rank``: 1, 2, 3 ... for the floor(percent * N / 100) highest scores among the N rows of at least
    ``min_words`` words, ties to the smaller doc_id, null for all others.

    The rows are sorted by range over all tasks; a row's rank is its place in its slice and the sizes of the slices
    before it, so nothing but one number a slice is gathered.
    """
    fit = scored.where(F.col("n_words") >= min_words)
    in_order = fit.orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "n_features")
    in_order = materialize(in_order.withColumn("__at", F.monotonically_increasing_id()))
    in_order = in_order.withColumn("__slice", F.shiftright("__at", 33))
    slices = in_order.groupBy("__slice").agg(F.count("*").alias("n")).orderBy("__slice").collect()    # one row a partition
    before, total = [], 0
    for r in slices:
        before.append((r["__slice"], total))
        total += r["n"]
    take = percent * total // 100
    spark = scored.sparkSession
    offsets = F.broadcast(spark.createDataFrame(before, "__slice long, __before long"))
    rank = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = in_order.join(offsets, "__slice").withColumn("__rank", rank)
    return ranked.select(*scored.columns, F.when(F.col("__rank") <= take, F.col("__rank")).alias("rank")).unionByName(
        scored.where(F.coalesce(F.col("n_words") < min_words, F.lit(True))).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``, drawn towards the texts of ``target``.

    Words are runs of ASCII letters and digits and all characters beyond ASCII, A-Z in lower case. Null and empty texts
    have no features and weight 0; they and texts of under ``min_words`` words are never drawn. Whole texts count,
    whatever their length. Every row is judged by itself: repeated rows and rows that share an id have ranks of their
    own; a null id has the noise of the empty id. An empty target gives gains from smoothing alone; empty ``docs``
    give an empty result. Other columns aren't read.
    """
    return draw(materialize(score_documents(docs, target, text, buckets, seed)), percent, min_words)


def sample_documents(docs: DataFrame, drawn: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that ``drawn`` (of ``resample``) has a rank for, by doc_id; with unique ids that is the sample."""
    ids = drawn.where("rank is not null").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__drawn")), "left_semi")
