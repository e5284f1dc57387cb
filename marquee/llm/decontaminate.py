"""Benchmark decontamination by spaced seeds.

A fixed mask over a window of tokens hashes only the positions it selects, so
a substituted word at another position leaves the hash as it is. Documents
and benchmark items are hashed under the same few masks and joined; each hit
fixes an alignment, along which the tokens are compared one by one.

A bitmap of the benchmark's hashes (fixed size, whatever the benchmark) lets the
tasks drop nearly all document hashes before anything is shuffled; it only
saves work, the join decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import broadcast_if_light, broadcast_if_small, materialize, text_key

#: 1: the position counts, 0: it is ignored. Whichever two of twelve tokens are substituted, one mask ignores both.
MASKS = ("111001000011", "000110101101", "011010110010", "100101011100", "100011110001", "011100001110")
WINDOW, SIMILARITY, SHORTEST = 13, 0.8, 5
BITMAP = 24                 # log2 of the bitmap's bits: 2 MB
TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased runs of letters, digits and underscores."""
    found = TOKEN.findall(text.lower()) if text else ()
    return np.fromiter((xxhash.xxh64_intdigest(x) for x in found), np.uint64, len(found))


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window of ``h`` under ``mask``."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, len(mask), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            out = (out ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, window: int) -> tuple[int, int]:
    """(matches in the best window, its first document token) with item token i beside document token i + shift."""
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    if b - a < window:
        return 0, 0
    same = np.r_[0, np.cumsum(doc[a + shift:b + shift] == item[a:b])]
    counts = same[window:] - same[:-window]
    best = int(counts.argmax())
    return int(counts[best]), a + best + shift


def short_masks(n: int, similarity: float) -> list[str]:
    """Masks for items of just ``n`` tokens: some mask ignores all substitutions that ``similarity`` allows."""
    holes, size = int(n * (1 - similarity) + 1e-9), max(1, n // 4)
    groups = range(-(-n // size))
    return ["".join("0" if i // size in ignored else "1" for i in range(n)) for ignored in combinations(groups, min(holes, len(groups) - 1))]


def find_contamination(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, window: int = WINDOW,
                       similarity: float = SIMILARITY, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, item_id) for every document that holds part of a benchmark item, with the best overlap:
    matched (equal tokens), window (tokens compared), similarity, start (its first token in the document).

    An overlap counts if, along an alignment that a seed hit fixes, at least
    ``similarity`` of some ``window`` consecutive tokens are equal (of all
    tokens for a shorter item). Up to two substitutions never hide an overlap,
    nor do as many as ``similarity`` allows in an item shorter than a mask, which
    has masks of its own length; items of fewer than ``shortest`` tokens, null and empty texts never
    match. Texts of any length are searched whole. Rows with equal doc_id (or item_id)
    are reported as one, with their best overlap; null ids are ids like others. Empty
    tables give an empty result. Only the ids and texts are read, so other columns may
    have any names.
    """
    best = F.max(F.struct("similarity", "matched", "window", (-F.col("start")).alias("s"))).alias("b")
    return contaminated_texts(docs, benchmark, masks, window, similarity, shortest).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.matched", "b.window", "b.similarity", (-F.col("b.s")).alias("start"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, window: int = WINDOW,
                       similarity: float = SIMILARITY, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, th, item_id, matched, window, similarity, start): as ``find_contamination``, for every different text
    of an id (th: its ``text_key``) and every different text of an item."""
    spark = docs.sparkSession
    # one row per different text: repeated items share it
    items = materialize(benchmark.select("item_id", F.col("text").cast("string").alias("item")).where("item is not null").distinct())

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array({len(tokens(x.as_py())) for x in batch.column(0)}, pa.int64())})

    short = items.select("item").mapInArrow(lengths, "n long").where(F.col("n") < max(map(len, masks))).distinct()
    span = min(map(len, masks))
    lengths_found = sorted(r["n"] for r in short.collect())     # at most as many rows as a mask has positions
    own = {n: short_masks(n, similarity) for n in lengths_found if shortest <= n < span}
    used = [*masks, *(m for x in own.values() for m in x)]

    def hash_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0), batch.column(1), strict=True):
                h = tokens(text.as_py())
                for m in own.get(len(h), masks if len(h) >= span else ()):
                    s = seeds(h, m)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s.view(np.int64)), pa.array([item_id.as_py()] * len(s), batch.schema.field(0).type),
                         pa.array([text.as_py()] * len(s)), pa.array(np.arange(len(s), dtype=np.int32))],
                        ["seed", "item_id", "item", "at"])

    id_type = items.schema["item_id"].dataType.simpleString()
    grid = materialize(items.mapInArrow(hash_items, f"seed long, item_id {id_type}, item string, at int")
                       .withColumn("item_key", F.xxhash64("item_id", "item")))
    bits = np.zeros(1 << BITMAP >> 3, np.uint8)
    cells = grid.select(F.shiftrightunsigned("seed", 64 - BITMAP).cast("int").alias("c")).distinct().toArrow().column(0).to_numpy()
    np.bitwise_or.at(bits, cells >> 3, (1 << (cells & 7)).astype(np.uint8))     # at most 2**BITMAP cells
    shipped = spark.sparkContext.broadcast(bits.tobytes())

    def hash_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shipped.value, np.uint8)
        for batch in batches:
            rows, found, places = [], [], []
            for i, text in enumerate(batch.column(2)):
                h = tokens(text.as_py())
                for m in used:
                    s = seeds(h, m)
                    c = (s >> np.uint64(64 - BITMAP)).astype(np.int64)
                    at = np.flatnonzero(bitmap[c >> 3] >> (c & 7).astype(np.uint8) & 1)
                    if len(at):
                        rows.append(np.full(len(at), i))
                        found.append(s[at])
                        places.append(at)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(np.concatenate(rows))) for c in (0, 1)), pa.array(np.concatenate(found).view(np.int64)),
                     pa.array(np.concatenate(places).astype(np.int32))], ["doc_id", "th", "seed", "place"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", text_key(F.col("text")).alias("th"), "text")
    doc_type = texts.schema["doc_id"].dataType.simpleString()
    hits = texts.mapInArrow(hash_docs, f"doc_id {doc_type}, th long, seed long, place int")
    aligned = materialize(
        hits.join(grid.select("seed", "item_key", "at"), "seed")
        .groupBy("doc_id", "th", "item_key").agg(F.collect_set(F.col("place") - F.col("at")).alias("shifts")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, last, d = [], None, None
            for doc_id, th, item_id, text, item, shifts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if text != last:                # a text's items mostly follow one another
                    last, d = text, tokens(text)
                t = tokens(item)
                n = min(window, len(t)) if len(t) >= span else len(t)
                matched, start = max(((*overlap(d, t, s, n),) for s in shifts), key=lambda x: (x[0], -x[1]))
                if matched >= similarity * n:
                    out.append((doc_id, th, item_id, matched, n, matched / n, start))
            cols = [list(c) for c in zip(*out, strict=True)] or [[] for _ in range(7)]
            types = (batch.schema.field(0).type, pa.int64(), batch.schema.field(2).type, pa.int64(), pa.int64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types, strict=True)],
                                             ["doc_id", "th", "item_id", "matched", "window", "similarity", "start"])

    # a row holds as many shifts as the text has seed hits along different alignments: counted before it may travel
    pairs = broadcast_if_light(aligned.withColumnRenamed("doc_id", "__doc").withColumnRenamed("th", "__th"), "shifts", 4)
    both = texts.join(pairs, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("th") == F.col("__th"))).join(
        items.withColumn("item_key", F.xxhash64("item_id", "item")), "item_key")
    checked = both.select("doc_id", "th", "item_id", "text", "item", "shifts").mapInArrow(
        verify, f"doc_id {doc_type}, th long, item_id {id_type}, matched long, window long, similarity double, start long")
    # fully repeated rows give the same row each
    return checked.distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` (all columns) without the rows whose text ``find_contamination`` reports.

    Rows are judged by id and text: other texts of a contaminated document's id stay, and so do other rows without an id.
    """
    found = contaminated_texts(docs, benchmark, **options)
    found = materialize(found.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    rows = rows.withColumn("__key", text_key(F.col("__row.text").cast("string")))
    return rows.join(broadcast_if_small(found), F.col("__row.doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__th")),
                     "left_anti").select("__row.*")
