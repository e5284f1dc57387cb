"""Quality classifier: a support vector machine on Naive Bayes features.

The n-grams of a text (present or not) are scaled by the log ratio of their
counts in the two classes; a linear hinge-loss model over them is fitted by
dual coordinate descent. Counts cover all training rows; the descent runs over
a bounded sample of them (``SAMPLE`` rows), its margins are turned into
probabilities on folds that neither it nor the counts have seen.

N-grams are words and word pairs, and the same over word shapes (runs of
letters, digits and each other sign reduced to one, a repeated word to "="):
shapes recognise words that never occurred.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marquee.llm.common import broadcast_if_small, crc_mod, materialize

BITS = 18               # n-grams are hashed to 2**BITS features
SAMPLE = 6000           # training rows that the descent sees (bound on its memory)
THRESHOLD = 0.3
_CACHE = 1 << 18
_RUNS = re.compile(r"([a-z])[a-z]*|([A-Z])[A-Z]*|([0-9])[0-9]*|(.)\4*", re.S)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _shape(word: str) -> str:
    return "".join("a" if a else "A" if b else "0" if c else "a" if d.isalpha() else d for a, b, c, d in _RUNS.findall(word))


class _Words(dict):
    """Word -> place in ``hashes``; dropped as a whole when it grows over its bound."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes: list[tuple[int, int]] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self.hashes)
        shape = re.sub(r"a+", "a", _shape(word))
        self.hashes.append((xxhash.xxh64_intdigest(word.lower()), xxhash.xxh64_intdigest(shape, 1)))
        return at


def features(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The features present in each text; none for null and empty texts."""
    words, table = _Words(), np.empty((0, 2), np.uint64)
    seen = np.zeros(1 << BITS, bool)
    repeat = np.uint64(xxhash.xxh64_intdigest("=", 1))
    for text in texts:
        parts = text.split() if text else ()
        if not parts:
            yield np.empty(0, np.int32)
            continue
        if len(words.hashes) > _CACHE:
            words, table = _Words(), np.empty((0, 2), np.uint64)
        at = np.fromiter(map(words.__getitem__, parts), np.int64, len(parts))
        if len(table) < len(words.hashes):
            table = np.concatenate([table, np.array(words.hashes[len(table):], np.uint64)])
        w, s = table[at, 0], table[at, 1].copy()
        s[1:][at[1:] == at[:-1]] = repeat
        grams = (w, s * _M2, w[:-1] * _M1 + w[1:] * _M3, s[:-1] * _M3 + s[1:] * _M1,
                 (s[:-2] * _M3 + s[1:-1]) * _M3 + s[2:] * _M2)
        for g in grams:
            seen[((g ^ g >> np.uint64(31)) * _M1 >> np.uint64(64 - BITS)).astype(np.int64)] = True
        out = np.flatnonzero(seen)
        seen[out] = False
        yield out.astype(np.int32)


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Weights (with the bias last) of the linear hinge-loss model, by dual coordinate descent.

    rows: features of each row; a row's vector is ``ratio`` at them, scaled to
    length 1, and 1 for the bias. labels: +1 or -1. cost: bound of each row's
    dual variable.
    """
    w = np.zeros(len(ratio) + 1)
    vectors = [ratio[r] / max(np.linalg.norm(ratio[r]), 1e-12) if len(r) else ratio[r] for r in rows]
    squares = np.array([v @ v + 1 for v in vectors])
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            r, v, y = rows[i], vectors[i], labels[i]
            gradient = y * (w[r] @ v + w[-1]) - 1
            new = min(max(alpha[i] - gradient / squares[i], 0.0), cost[i])
            if (step := (new - alpha[i]) * y):
                w[r] += step * v
                w[-1] += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def margins(rows: list[np.ndarray], ratio: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.array([(w[r] @ ratio[r]) / max(np.linalg.norm(ratio[r]), 1e-12) + w[-1] if len(r) else w[-1] for r in rows])


def logistic(m: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) such that 1 / (1 + exp(-(a m + b))) fits the labels, with smoothed targets."""
    up, down = (labels > 0).sum(), (labels < 0).sum()
    target = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x, theta = np.c_[m, np.ones(len(m))], np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-6 * theta)
        theta += np.clip(step, -2, 2)
    return float(max(theta[0], 1e-3)), float(theta[1])


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Log of each feature's share in class 1 over its share in class 0, from counts (class, feature), one added."""
    smooth = counts + 1.0
    return np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())


def fit(rows: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    """Train on ``rows`` (doc_id, text, quality 0/1): (ratio, weights, a, b); None without rows of both classes."""
    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2, 1 << BITS), np.int64)
        for batch in batches:
            labels, folds = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for label, fold, f in zip(labels, folds, features(batch.column(0).to_pylist()), strict=True):
                counts[fold, label, f] += 1
        fold, f = np.nonzero(counts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(fold, pa.int32()), pa.array(f), pa.array(counts[fold, 0, f]), pa.array(counts[fold, 1, f])],
                                         ["fold", "f", "n0", "n1"])

    rows = materialize(rows.select("doc_id", F.col("text").cast("string").alias("text"), F.col("quality").cast("int").alias("quality"))
                       .where("quality in (0, 1)").withColumn("fold", F.pmod(F.xxhash64("text", "doc_id"), F.lit(2)).cast("int")))
    n = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    if len(n) < 2:
        return None
    table = (rows.select("text", "quality", "fold").mapInArrow(presence, "fold int, f long, n0 long, n1 long")
             .groupBy("fold", "f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow())     # at most 2 * 2**BITS rows
    counts = np.zeros((2, 2, 1 << BITS))
    fold, at = table.column("fold").to_numpy(), table.column("f").to_numpy()
    counts[fold, 0, at] = table.column("n0").to_numpy()
    counts[fold, 1, at] = table.column("n1").to_numpy()
    ratio = log_ratio(counts.sum(0))

    # a fixed share of the ids, as the bound allows: the smaller class first, up to half of it
    rare = min(n, key=n.get)
    room = {rare: min(n[rare], sample // 2)}
    room[1 - rare] = sample - room[rare]
    chosen = None
    for label, most in room.items():
        share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(min(1.0, most / n[label]) * (1 << 30))
        part = F.when(F.col("quality") == label, share)
        chosen = part if chosen is None else F.coalesce(chosen, part)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(features(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.int32()))], ["quality", "fold", "f"])

    got = (rows.where(chosen).select("text", "quality", "fold")
           .mapInArrow(vectors, "quality int, fold int, f array<int>").toArrow())
    y = np.where(got.column("quality").to_numpy() == 1, 1.0, -1.0)
    fold = got.column("fold").to_numpy()
    x = [np.asarray(f.values.to_numpy(), np.int64) for f in got.column("f")]
    if not (y > 0).any() or not (y < 0).any():
        return None
    cost = np.ones(len(y))
    unseen = np.zeros(len(y))
    for k in (0, 1):
        here, there = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        other = log_ratio(counts[1 - k])                # counts, too, without the rows whose margins these are
        unseen[here] = margins([x[i] for i in here], other, dual_descent([x[i] for i in there], y[there], other, cost[there]))
    a, b = logistic(unseen, y)
    # the sample holds the classes in other shares than the rows: shift to the rows' odds
    b += float(np.log(n[1] / n[0]) - np.log((y > 0).sum() / (y < 0).sum()))
    return ratio, dual_descent(x, y, ratio, cost), a, b


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float, float] | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of every row's whole text; without a model 0.5 everywhere."""
    keep = list(keep)
    shipped = docs.sparkSession.sparkContext.broadcast(
        None if model is None else (model[0].astype(np.float32), model[1].astype(np.float32), model[2], model[3]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shipped.value is None:
                p = np.full(batch.num_rows, 0.5)
            else:
                ratio, w, a, b = shipped.value
                product, square, bias = w[:-1] * ratio, ratio * ratio, float(w[-1])
                m = np.array([product[f].sum(dtype=float) / max(square[f].sum(dtype=float), 1e-24) ** 0.5 + bias if len(f) else bias
                              for f in features(batch.column(len(keep)).to_pylist())])
                p = 1 / (1 + np.exp(-np.clip(a * m + b, -40, 40)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(p, pa.float64())], [*keep, "score"])

    kept = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    return kept.mapInArrow(scan, T.StructType([*kept.schema.fields[:-1], T.StructField("score", T.DoubleType())]))


def training_rows(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """Labelled rows outside the held-out ids; contradictory labels of one id count once each, repeated ones once."""
    marks = materialize(labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)").distinct())
    return docs.select("doc_id", "text").where(~held_out).join(broadcast_if_small(marks), "doc_id")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold) of every row of ``docs``.

    Trained on the labelled rows whose crc32(doc_id) mod 5 isn't 0; only texts
    are scored. Null and empty texts get the score of the bias alone; repeated
    rows each get theirs; unlabelled, null-labelled and null-id rows aren't
    learned from (a null id counts as empty text in the fold). Without rows of both
    classes every score is 0.5. Empty tables give an empty result; other
    columns aren't read.
    """
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = fit(training_rows(docs, labels, held_out), sample)
    scored = score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """``docs`` (all columns, unchanged) without the rows that the classifier scores below the threshold."""
    model = fit(training_rows(docs, labels, crc_mod(F.col("doc_id"), 5) == 0), sample)
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text"))
    scored = score(wide, model, ["__row"])
    return scored.where(F.col("score") >= threshold).select("__row.*")
