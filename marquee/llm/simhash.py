"""SimHash near-duplicates through an inverted index of positional bytes.

Two 64-bit fingerprints at most 3 bits apart differ in at most 3 of their 8
bytes, so they share at least 5 positional bytes. A list per single (position,
byte) would hold 1/256 of all rows, so the index is keyed by triples of
positional bytes: the 8 triples inside {0..3} or {4..7}. Of any 5 shared
positions, 3 lie in one half, so every such pair meets in some list. There the
shared positional bytes are tallied, pairs with fewer than 5 are dropped, and
the rest is verified bit by bit.

Equal fingerprints are merged beforehand. A list emits a spanning star for each
of its linked groups rather than all its pairs. Lists over ``SPLIT`` members
(large groups of near copies) are keyed again by five positional bytes and a
quarter of the other 24 bits (three differing bits leave one quarter equal):
such a list has 18 free bits, so at most 2**18 members at any input size.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from marquee.llm.common import UPPER, materialize, text_key
from marquee.llm.components import connected_components

BITS, BYTES = 64, 8
SHINGLE, DISTANCE, SEED = 3, 3, 42
SPLIT = 4096
_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def fingerprint_batch(texts: list[bytes], words: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each UTF-8 text, over its word shingles with repeats."""
    ends, hashes = [0], array("Q")
    digest = xxhash.xxh64_intdigest
    for text in texts:
        # bytes.split() cuts at exactly space and \t \n \v \f \r
        parts = text.translate(_LOWER).split()
        if parts:
            line, n = b" ".join(parts), len(parts)
            stop = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1)
            start = (stop - np.diff(stop, prepend=0)).tolist()
            last = (stop - 1)[words - 1:].tolist() or [len(line)]
            hashes.extend(digest(line[s:e], SEED) for s, e in zip(start, last, strict=False))
        ends.append(len(hashes))
    out = np.zeros(len(texts), np.uint64)
    h, ends = np.frombuffer(hashes, np.uint64) if hashes else np.empty(0, np.uint64), np.array(ends)
    full = np.flatnonzero(np.diff(ends))
    step = 1 << 16
    for i in full.tolist() if len(h) > step else ():
        ones = np.zeros(BITS, np.int64)
        for at in range(ends[i], ends[i + 1], step):
            ones += _bits(h[at:min(at + step, ends[i + 1])]).sum(0, dtype=np.int32)
        out[i] = _pack(ones[None] * 2 > ends[i + 1] - ends[i])[0]
    if len(h) <= step and len(full):
        ones = np.add.reduceat(_bits(h), ends[full], axis=0, dtype=np.int32)
        out[full] = _pack(ones * 2 > np.diff(ends)[full, None])
    return out


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, BYTES), axis=1)


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = SHINGLE, name: str = "fp",
                     keep: list[str] = ()) -> DataFrame:
    """``keep`` columns and the SimHash (as a signed long) of each row's whole text.

    Null and empty texts have fingerprint 0; texts of fewer words than a
    shingle are one shingle. Repeated rows each get their row.
    """
    keep = list(keep)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary())
            fps = np.zeros(len(texts), np.uint64)
            at, size = 0, 0
            sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in texts]
            for i, n in enumerate(sizes, 1):
                size += n
                if size > 1 << 18 or i == len(sizes):
                    fps[at:i] = fingerprint_batch([x or b"" for x in texts.slice(at, i - at).to_pylist()], words)
                    at, size = i, 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(fps.view(np.int64))], [*keep, name])

    kept = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    return kept.mapInArrow(scan, T.StructType([*kept.schema.fields[:-1], T.StructField(name, T.LongType())]))


def _gather(fp: Column, positions: tuple[int, ...]) -> Column:
    """The bytes of ``fp`` at ``positions``, side by side."""
    out = F.lit(0).cast("long")
    for p in positions:
        out = F.shiftleft(out, 8).bitwiseOR(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)))
    return out


def _triples() -> list[tuple[int, ...]]:
    return [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def _same_list(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars over the linked groups of one list: (member, representative)."""
    values = np.sort(values)
    n = len(values)
    label = np.arange(n)
    rows = max(1, (1 << 20) // n)
    free = [np.uint64(1) << np.uint64(i) for i in range(BITS) if int(np.bitwise_or.reduce(values ^ values[0])) >> i & 1]
    few = sum(math.comb(len(free), d) for d in range(1, distance + 1)) < n // 4
    changed = True
    while changed:
        best = label.copy()
        if few:                     # fewer neighbours than members: look each of them up
            for mask in (np.bitwise_or.reduce(c) for d in range(1, distance + 1) for c in combinations(free, d)):
                at = np.minimum(np.searchsorted(values, values ^ mask), n - 1)
                best = np.where(values[at] == values ^ mask, np.minimum(best, label[at]), best)
        else:
            for at in range(0, n, rows):
                near = _linked(values[at:at + rows, None], values[None, :], distance)
                best[at:at + rows] = np.where(near, label[None, :], n).min(1)
        best = np.minimum(best, label)
        np.minimum.at(best, label, best.copy())     # a group's label falls with any member's
        while (best[best] != best).any():
            best = best[best]
        changed = bool((best != label).any())
        label = best
    member = np.flatnonzero(label != np.arange(n))
    return values[member], values[label[member]]


def _linked(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Count filter, then the bit distance."""
    x = np.ascontiguousarray(a ^ b)
    shared = (x.view(np.uint8).reshape(*x.shape, BYTES) == 0).sum(-1)
    return (shared >= BYTES - distance) & (np.bitwise_count(x) <= distance)


def _links(lists: DataFrame, distance: int) -> DataFrame:
    """Links inside lists; rows (key, fp) come clustered and sorted by key."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.int64)
        batches = iter(batches)
        while True:
            batch = next(batches, None)
            if batch is not None:
                key = np.concatenate([key, batch.column(0).to_numpy()])
                fp = np.concatenate([fp, batch.column(1).to_numpy()])
            if not len(key):
                if batch is None:
                    return
                continue
            whole = len(key) if batch is None else int(np.searchsorted(key == key[-1], True))
            k, v = key[:whole], fp[:whole].view(np.uint64)
            key, fp = key[whole:], fp[whole:]
            starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if whole else np.empty(0, np.int64)
            sizes = np.diff(np.r_[starts, whole])
            pairs = starts[sizes == 2]
            near = _linked(v[pairs], v[pairs + 1], distance) if len(pairs) else np.empty(0, bool)
            a, b = [v[pairs][near]], [v[pairs + 1][near]]
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                x, y = _same_list(v[s:s + n], distance)
                a.append(x)
                b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z).view(np.int64)) for z in (a, b)], ["a", "b"])
            if batch is None:
                return

    return lists.repartition("key").sortWithinPartitions("key").mapInArrow(scan, "a long, b long")


def fingerprint_links(fps: DataFrame, distance: int = DISTANCE, split: int = SPLIT) -> DataFrame:
    """Links (a, b) that connect the same groups of ``fps.fp`` as all pairs within ``distance`` (at most 3) bits.

    ``fps`` must hold each fingerprint once. The links are spanning stars of what
    is connected inside a list, so a link's ends may be further apart than
    ``distance``; use its components, not its ends.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError("the index of byte triples serves distances up to 3")
    posts = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), _gather(F.col("fp"), t).bitwiseOR(F.lit(i << 24)).alias("key"))
        for i, t in enumerate(_triples())])).alias("p")).select("p.t", "p.key", "fp")
    large = posts.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > split).select("key", F.lit(True).alias("large"))
    posts = posts.join(large, "key", "left")
    usual = posts.where("large is null").select("key", "fp")

    def rekey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            triple, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for n, five in enumerate(combinations(range(BYTES), 5)):
                v = fp[triple == next(i for i, t in enumerate(_triples()) if set(t) <= set(five))]
                shared, rest = np.zeros_like(v), np.zeros_like(v)
                for p in range(BYTES):
                    byte = v >> np.uint64(8 * p) & np.uint64(255)
                    if p in five:
                        shared = shared << np.uint64(8) | byte
                    else:
                        rest = rest << np.uint64(8) | byte
                for q in range(4):          # 6 bits for the set, 2 for the quarter, 6 of it, 40 of the set's bytes
                    key = np.uint64(n << 48 | q << 46) | (rest >> np.uint64(6 * q) & np.uint64(63)) << np.uint64(40) | shared
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(v.view(np.int64))], ["key", "fp"])

    again = posts.where("large").select("t", "fp").mapInArrow(rekey, "key long, fp long")
    return _links(usual, distance).unionByName(_links(again, distance)).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = SHINGLE,
                       distance: int = DISTANCE) -> DataFrame:
    """id, fp (signed long) and component_id: the smallest id reachable over links of at most ``distance`` bits.

    One row per input row. Rows of equal fingerprint are linked, empty and null
    texts (fingerprint 0) among them. Null ids are never the smallest; a
    component of null ids only has a null component_id. An empty table gives
    an empty result. Other columns are not read.
    """
    rows = materialize(with_fingerprint(docs, text, words, keep=[id_col]))
    fps = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("rep")))
    groups = connected_components(fingerprint_links(fps.select("fp"), distance))
    label = F.coalesce(F.col("component"), F.col("fp"))
    fps = fps.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", label.alias("label"))
    smallest = fps.groupBy("label").agg(F.min("rep").alias("component_id"))
    return rows.join(fps.join(smallest, "label").select("fp", "component_id"), "fp").select(id_col, "fp", "component_id")


def keep_one_per_component(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` (all columns) with one row of each near-duplicate component: the smallest doc_id (null after all
    others), of those the smallest text hash; of fully repeated rows one stays."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text").cast("string").alias("__text"))
    rows = rows.withColumn("__th", text_key(F.col("__text")))
    found = materialize(with_fingerprint(rows.select(F.col("__row.doc_id").alias("doc_id"), "__th", "__text"), "__text", words,
                                         keep=["doc_id", "__th"]))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("__th").alias("th"))
    fps = materialize(found.groupBy("fp").agg(F.min(order).alias("first")))
    groups = connected_components(fingerprint_links(fps.select("fp"), distance)).withColumnRenamed("node", "fp")
    label = F.coalesce("component", "fp")
    kept = materialize(fps.join(groups, "fp", "left").groupBy(label).agg(F.min("first").alias("k")).select(
        F.col("k.d").alias("__doc"), F.col("k.th").alias("__kept")))
    rows = rows.join(kept, F.col("__row.doc_id").eqNullSafe(F.col("__doc")) & (F.col("__th") == F.col("__kept")), "left_semi")
    one = Window.partitionBy(F.col("__row.doc_id"), "__th").orderBy(F.xxhash64("__row"))     # repeated rows of one id and text
    return rows.withColumn("__n", F.row_number().over(one)).where("__n = 1").select("__row.*")
