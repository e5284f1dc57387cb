"""Class-based n-gram language model: words in classes found by exchange.

Words are assigned to classes so that class bigrams predict the corpus best;
a token's probability is that of its class after the class before it, times
that of the word in its class.

Counts are taken over all training texts, and every training word gets its
class by exchange. The ``FREQUENT`` most frequent words are exchanged one after
another on the matrix of their bigrams, which has a bounded size. All other
words move in parallel sweeps, each word to the class that raises the
likelihood of its own neighbours most while the class matrix stands still; the
matrix is counted anew after each sweep. The first sweep sees the neighbours
that are frequent, later ones all: the classes of the ``HOT`` most frequent
words travel to the tasks, those of the others are joined. None of the words
that move is among the frequent ones, so none holds more than 1 / ``FREQUENT``
of all tokens. Unseen words share one place in the class with most words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import crc_mod, materialize, text_key

FREQUENT, CLASSES = 2000, 48
HOT = 1 << 18
#: Rounds of the exchange of frequent words at most (it ends when nothing moves), and sweeps over the others.
ROUNDS, SWEEPS = 40, 2
END = 0                 # hash, unit and class of the end token; a text begins after one
_GOLDEN, _MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)      # fixed values of splitmix64
#: Base of the words' polynomial hash: odd, so that it has an inverse modulo 2**64, and 3 modulo 8, so that places differ.
BASE = 0x9E3779B97F4A7C1B
#: Bytes of text hashed together, and tokens counted together, in a task.
_BYTES, _TOKENS = 1 << 20, 1 << 19


def mix(z: np.ndarray) -> np.ndarray:
    """splitmix64's last step."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(_MIX[0])
    z = (z ^ (z >> np.uint64(27))) * np.uint64(_MIX[1])
    return z ^ (z >> np.uint64(31))


def byte_values() -> np.ndarray:
    """A 64-bit number for each byte, the same for a letter of A-Z and its lower case."""
    out = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLDEN))
    out[65:91] = out[97:123]
    return out


class _Words:
    """Hashes of the words of whole texts, all words of many texts at once.

    A word's hash is the sum of its bytes' numbers times powers of ``BASE`` (modulo 2**64, mixed, never that of the end):
    differences of running sums over all the bytes, taken back to the word's start.
    """

    def __init__(self) -> None:
        self.value = byte_values()
        self.gap = np.zeros(256, bool)
        self.gap[[9, 10, 11, 12, 13, 32]] = True
        self.up, self.down = self._powers(_BYTES)

    @staticmethod
    def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
        both = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            x = np.full(n, base, np.uint64)
            x[:1] = 1
            both.append(np.cumprod(x, dtype=np.uint64))
        return both[0], both[1]

    def _hash(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), np.uint64)
        i = 0
        while i < len(start):               # one step but for texts longer than _BYTES
            j = max(i + 1, int(np.searchsorted(stop, start[i] + _BYTES, "right")))
            first, size = start[i], int(stop[j - 1] - start[i])
            up, down = (self.up, self.down) if size <= _BYTES else self._powers(size)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(self.value[data[first:first + size]] * up[:size], out=sums[1:])
            out[i:j] = (sums[stop[i:j] - first] - sums[start[i:j] - first]) * down[start[i:j] - first]
            i = j
        h = mix(out).view(np.int64)
        h[h == END] = 1
        return h

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For one group of (binary) texts after another: the hashes, an end after each text, and where each text's stop."""
        texts = texts.fill_null(b"").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _BYTES, "right")) - 1)
            part, cuts = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            inside = np.r_[False, ~self.gap[part], False]
            new = np.zeros(len(part) + 1, bool)
            new[cuts] = True                # a word neither begins before a text nor goes on after it
            start = np.flatnonzero(inside[1:] & (~inside[:-1] | new))
            stop = np.flatnonzero(inside[:-1] & (~inside[1:] | new))
            of = np.searchsorted(cuts[1:], start, "right")
            out = np.full(len(start) + j - i, END, np.int64)
            out[np.arange(len(start)) + of] = self._hash(part, start, stop)
            yield out, np.cumsum(np.bincount(of, minlength=j - i) + 1)
            i = j


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Hashes of many whole texts at a time, an end before, between and after them."""
    words, texts, n = _Words(), [np.array([END], np.int64)], 0
    for batch in batches:
        for h, _ in words(batch.column(0)):
            texts.append(h)
            n += len(h)
            if n > _TOKENS:
                yield np.concatenate(texts)
                texts, n = texts[:1], 0
    if n:
        yield np.concatenate(texts)


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c): how often each word occurs in ``texts`` (column text); the end token has hash 0."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h in _tokens(batches):
            words, n = np.unique(h[1:], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(n, pa.int64())], ["h", "c"])

    return texts.select(F.col("text").cast("binary")).mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _find(h: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each hash in a sorted table, and whether it's there."""
    if not len(table):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return at, table[at] == h


def unit_bigrams(texts: DataFrame, frequent: np.ndarray) -> np.ndarray:
    """Matrix of the counts of neighbouring units: the end, the (sorted) frequent words, all other words together."""
    size = 2 + len(frequent)
    shipped = texts.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size * size, np.int64)
        for h in _tokens(batches):
            at, found = _find(h, shipped.value)
            u = np.where(h == END, 0, np.where(found, at + 1, size - 1))
            pair, n = np.unique(u[:-1] * size + u[1:], return_counts=True)
            seen[pair] += n
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], ["pair", "n"])

    table = texts.select(F.col("text").cast("binary")).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[table.column("pair").to_numpy()] = table.column("n").to_numpy()      # at most size**2 rows, whatever the corpus
    return out.reshape(size, size)


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every unit, by exchange: each unit in turn moves to the class that raises the likelihood of the
    class bigram model most, until nothing moves. Unit 0 (the end) has class 0 to itself."""
    n = len(bigrams)
    weight = bigrams.sum(1)
    cls = np.zeros(n, np.int64)
    by_weight = 1 + np.argsort(-weight[1:], kind="stable")
    cls[by_weight] = 1 + np.arange(n - 1) % max(classes - 1, 1)
    onehot = np.zeros((n, classes))
    onehot[np.arange(n), cls] = 1
    after, before = bigrams @ onehot, bigrams.T @ onehot        # of each unit, by the class of its neighbour
    m = onehot.T @ after
    for _ in range(rounds):
        moved = 0
        for u in by_weight.tolist():
            a = cls[u]
            out, into, own = after[u].copy(), before[u].copy(), bigrams[u, u]
            out[a] -= own
            into[a] -= own
            m[a] -= out
            m[:, a] -= into
            m[a, a] -= own
            sums = m.sum(1), m.sum(0)
            r, c = out.sum() + own, into.sum() + own
            diagonal = m.diagonal()
            gain = ((_phi(m + out) - _phi(m)).sum(1) + (_phi(m + into[:, None]) - _phi(m)).sum(0)
                    - (_phi(diagonal + out) + _phi(diagonal + into) - 2 * _phi(diagonal))
                    + _phi(diagonal + out + into + own) - _phi(diagonal)
                    - (_phi(sums[0] + r) - _phi(sums[0])) - (_phi(sums[1] + c) - _phi(sums[1])))
            gain[0] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            m[b] += out
            m[:, b] += into
            m[b, b] += own
            if b != a:
                moved += 1
                cls[u] = b
                for table, counts in ((after, bigrams[:, u]), (before, bigrams[u])):
                    table[:, a] -= counts
                    table[:, b] += counts
        if not moved:
            break
    return cls


def _steps(pairs: np.ndarray, used: np.ndarray) -> np.ndarray:
    """log10 of the probability of each class after each: a class's continuations, with as much weight on the plain
    shares of the ``used`` classes as it has different ones."""
    pairs = pairs * used * used[:, None]
    alone = (pairs.sum(0) + 1) * used
    kinds = (pairs > 0).sum(1, keepdims=True) + 1
    with np.errstate(divide="ignore"):
        return np.log10((pairs + kinds * alone / alone.sum()) / (pairs.sum(1, keepdims=True) + kinds))


def neighbours(texts: DataFrame, known: np.ndarray, cls: np.ndarray, fixed: np.ndarray, classes: int,
               assigned: DataFrame | None) -> DataFrame:
    """(h, items): the neighbours' classes of every word that isn't fixed, counted.

    ``known``: sorted hashes of words (and the end) whose classes ``cls`` travel, ``fixed`` the ones that don't move;
    the classes of other neighbours are joined from ``assigned`` (h, cls), without it they don't count. An item is
    n * 3 * classes + k; k is the class of a fixed word before, that of another word before + classes, or that of
    the word after + 2 * classes.
    """
    shipped = texts.sparkSession.sparkContext.broadcast((known, cls, fixed))
    codes, join = 3 * classes, assigned is not None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cls, fixed = shipped.value
        for h in _tokens(batches):
            at, found = _find(h, known)
            k, still = np.where(found, cls[at], -1), found & fixed[at]
            i = np.flatnonzero(~still)                  # never the first or last token, which are ends
            before, after = k[i - 1], k[i + 1]
            word = np.concatenate([h[i][before >= 0], h[i][after >= 0]])
            code = np.concatenate([(before + np.where(still[i - 1], 0, classes))[before >= 0], after[after >= 0] + 2 * classes])
            words, which = np.unique(word, return_inverse=True)
            pair, n = np.unique(which * codes + code, return_counts=True)
            ends = np.searchsorted(pair, np.arange(len(words) + 1) * codes)
            items = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(n * codes + pair % codes, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.nulls(len(words), pa.int64()), items], ["h", "other", "items"])
            if join:
                a, b = i[before < 0], i[after < 0]
                base = np.concatenate([np.full(len(a), codes + classes), np.full(len(b), codes + 2 * classes)])
                items = pa.ListArray.from_arrays(pa.array(np.arange(len(base) + 1), pa.int32()), pa.array(base, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h[a], h[b]]), pa.int64()),
                                                  pa.array(np.concatenate([h[a - 1], h[b + 1]]), pa.int64()), items], ["h", "other", "items"])

    seen = texts.select(F.col("text").cast("binary")).mapInArrow(count, "h long, other long, items array<long>")
    if not join:
        return seen.select("h", "items")
    seen = materialize(seen)
    joined = seen.where("other is not null").join(assigned.select(F.col("h").alias("other"), "cls"), "other")
    return seen.where("other is null").select("h", "items").unionByName(
        joined.select("h", F.transform("items", lambda x: x + F.col("cls")).alias("items")))


def sweep(around: DataFrame, pairs: np.ndarray, types: np.ndarray) -> DataFrame:
    """One parallel round over ``neighbours``: (h, cls, null, null) of every word, the class that its neighbours and the
    number of words of each class (``types``) make likeliest, and (null, cls, k, n) rows that count the neighbours of
    the classes thus made. A neighbour is counted for the class that the word has without it: otherwise the many words
    of few occurrences, each in the class that fits them best, would make all steps look surer than they are."""
    classes = len(pairs)
    step = _steps(pairs, np.full(classes, True)) - np.log10((pairs.sum(0) + 1) / (pairs.sum() + classes))
    prior = np.log10(types + 1)
    prior[END] = -np.inf                        # the end's class is no choice
    shipped = around.sparkSession.sparkContext.broadcast((np.vstack([step, step, step.T]), prior))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, prior = shipped.value
        made = np.zeros((classes, 3 * classes), np.int64)
        kept_h, kept = np.zeros(0, np.int64), np.zeros((0, 3 * classes), np.int64)

        def settle(h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            score = n @ gain + prior
            cls = score.argmax(1)
            word, k = np.nonzero(n)
            for at in range(0, len(word), 1 << 16):
                w, j = word[at:at + (1 << 16)], k[at:at + (1 << 16)]
                np.add.at(made, ((score[w] - gain[j]).argmax(1), j), n[w, j])
            return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(cls, pa.int32()), pa.nulls(len(h), pa.int32()),
                                               pa.nulls(len(h), pa.int64())], ["h", "cls", "k", "n"])

        for batch in batches:                   # sorted by h: a word's rows follow each other
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            words, row = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            items = lists.flatten().to_numpy()
            place = np.repeat(row, lists.value_lengths().to_numpy()) * (3 * classes) + items % (3 * classes)
            n = np.bincount(place, items // (3 * classes), len(words) * 3 * classes).astype(np.int64).reshape(-1, 3 * classes)
            if len(kept_h) and kept_h[0] == words[0]:
                n[0] += kept[0]
            elif len(kept_h):
                yield settle(kept_h, kept)
            yield settle(words[:-1], n[:-1])
            kept_h, kept = words[-1:], n[-1:]
        yield settle(kept_h, kept)
        c, k = np.nonzero(made)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(c), pa.int64()), pa.array(c, pa.int32()), pa.array(k, pa.int32()),
                                          pa.array(made[c, k], pa.int64())], ["h", "cls", "k", "n"])

    return materialize(around.repartition("h").sortWithinPartitions("h").mapInArrow(choose, "h long, cls int, k int, n long"))


class ClassModel:
    """Smoothed probabilities (log10) of classes after classes, and of each class's words.

    ``pairs``: counts of neighbouring classes; ``size``: the sum of (c + 1) over each class's words; ``opened``: the
    class of unseen words, with one place for them.
    """

    def __init__(self, pairs: np.ndarray, size: np.ndarray, opened: int, n: int, v: int) -> None:
        """n, v: training tokens, and different ones."""
        size = size.astype(float)
        size[opened] += 1
        size[END] = max(size[END], 1)
        self.step = _steps(pairs, size > 0)
        self.size = np.log10(np.maximum(size, 1))
        self.opened, self.n, self.v = opened, n, v


def _most(table: DataFrame, n: int) -> pa.Table:
    """The end's row and those of the ``n`` most frequent words, sorted by hash."""
    both = [table.where(F.col("h") == END).toArrow(), table.where(F.col("h") != END).orderBy(F.col("c").desc(), "h").limit(n).toArrow()]
    return pa.concat_tables(both).sort_by("h")


def train(texts: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES, rounds: int = ROUNDS, sweeps: int = SWEEPS,
          hot: int = HOT) -> tuple[ClassModel, DataFrame]:
    """The model of ``texts`` (column text), and the written table (h, c, cls) of all its words, the end's class 0."""
    counts = materialize(word_counts(texts))
    spark = texts.sparkSession
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = _most(counts, frequent).column("h").to_numpy()
    top = top[top != END]
    bigrams = unit_bigrams(texts, top)
    cls = exchange(bigrams, classes, rounds)[:-1]
    # from here on without the unit of all other words: their classes come from the sweeps
    onehot = np.zeros((len(cls), classes))
    onehot[np.arange(len(cls)), cls] = 1
    among = onehot.T @ bigrams[:-1, :-1] @ onehot
    pairs, opened, types = among, 1, onehot.sum(0)
    seed = spark.createDataFrame(pa.table({"h": pa.array(np.r_[END, top], pa.int64()), "cls": pa.array(cls, pa.int32())}))
    words = counts.join(F.broadcast(seed), "h", "left").select("h", "c", F.coalesce("cls", F.lit(opened)).alias("cls"))
    for i in range(sweeps):
        known = pa.table({"h": np.r_[END, top], "cls": cls}).sort_by("h") if not i else _most(words, max(hot, frequent))
        h = known.column("h").to_numpy()
        around = neighbours(texts, h, known.column("cls").to_numpy(), _find(h, np.unique(np.r_[END, top]))[1], classes, words if i else None)
        found = sweep(around, pairs, types)
        moved = found.where("h is not null").select("h", F.col("cls").alias("__cls"))
        types = onehot.sum(0)
        for r in moved.groupBy("__cls").count().collect():
            types[r["__cls"]] += r["count"]
        opened = 1 + int(types[1:].argmax())
        words = materialize(counts.join(moved, "h", "left").join(F.broadcast(seed), "h", "left").select(
            "h", "c", F.coalesce("cls", "__cls", F.lit(opened)).alias("cls")))
        pairs = among.copy()
        for r in found.where("h is null").groupBy("cls", "k").agg(F.sum("n").alias("n")).collect():     # at most 3 * classes**2 rows
            if r["k"] < classes:
                pairs[r["k"], r["cls"]] += r["n"]
            elif r["k"] >= 2 * classes:         # a pair of two words that move is counted where it is the word after
                pairs[r["cls"], r["k"] - 2 * classes] += r["n"]
    size = np.zeros(classes, np.int64)
    for r in words.groupBy("cls").agg(F.sum(F.col("c") + 1).alias("n")).collect():
        size[r["cls"]] = r["n"]
    return ClassModel(pairs, size, opened, total["n"] or 0, total["v"] or 0), words


def score(docs: DataFrame, model: ClassModel, words: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, th and, over each whole text: n_tokens, n_known, train_tokens, base_score, score.

    Counts and classes of ``hot`` words travel to the tasks; the others' are joined.
    """
    known = _most(words, hot)
    shipped = docs.sparkSession.sparkContext.broadcast((model, *(known.column(c).to_numpy() for c in ("h", "c", "cls"))))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", text_key(F.col("text")).alias("th"), F.col("text").cast("binary").alias("bytes"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    token = pa.struct([("at", pa.int64()), ("h", pa.int64()), ("before", pa.int32()), ("after", pa.int32())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hot_h, hot_c, hot_cls = shipped.value
        words = _Words()
        unknown = np.log10(model.n + model.v + 1)
        own, cls = np.log10(hot_c + 1), hot_cls
        if not len(hot_h):
            own, cls = np.zeros(1), np.zeros(1, np.int32)
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for h, stops in words(batch.column(2)):
                starts = np.r_[0, stops[:-1]]
                at, found = _find(h, hot_h)
                k = np.where(h == END, END, np.where(found, cls[at], -1))
                before, after = np.r_[END, k[:-1]], np.r_[k[1:], END]        # an end comes before every text
                there = k >= 0
                log = np.where(found, own[at], 0)
                both = there & (before >= 0)
                steps = np.where(both, model.step[np.where(both, before, END), np.where(both, k, END)], 0) - np.where(there, model.size[k], 0)
                rest = np.flatnonzero(~there)
                of = np.searchsorted(stops, rest, "right")
                n = stops - starts
                for col, x in zip(cols, (n, np.add.reduceat(found.astype(np.int64), starts), np.add.reduceat(log, starts) - n * unknown,
                                         np.add.reduceat(log + steps, starts), np.bincount(of, minlength=len(n)),
                                         np.array([rest - starts[of], h[rest]]), before[rest], after[rest]), strict=True):
                    col.append(x)
            if not batch.num_rows:
                continue
            n, known, base, score, many, token_at, before, after = (np.concatenate(c, axis=-1) for c in cols)
            each = pa.StructArray.from_arrays([pa.array(token_at[0], pa.int64()), pa.array(token_at[1], pa.int64()),
                                               pa.array(before, pa.int32()), pa.array(after, pa.int32())], fields=list(token))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(score, pa.float64()), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)], pa.int32()), each)],
                ["doc_id", "th", "n_tokens", "known", "base", "model", "rest"])

    parts = materialize(texts.mapInArrow(scan, f"doc_id {id_type}, th long, n_tokens long, known long, base double, model double, "
                                               "rest array<struct<at: long, h: long, before: int, after: int>>"))
    # the other words, each with its count and class; fully repeated rows have equal parts and are joined once
    each = parts.select("doc_id", "th", F.inline("rest")).join(words, "h", "left")
    each = each.withColumn("cls", F.coalesce("cls", F.lit(model.opened)))
    classes = len(model.step)
    # no word is in a class without words, whose steps are infinite
    steps = F.lit(np.where(np.isfinite(model.step), model.step, 0).ravel().tolist())
    step = lambda a, b: F.get(steps, a * classes + b)
    own = F.log10(F.coalesce("c", F.lit(0)) + 1)
    beside = (F.when(F.col("before") >= 0, step(F.col("before"), F.col("cls"))).otherwise(0)
              + F.when(F.col("after") >= 0, step(F.col("cls"), F.col("after"))).otherwise(0))
    sums = each.groupBy("doc_id", "th").agg(
        F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("more"), F.sum(own).alias("own"),
        F.sum(beside - F.get(F.lit(model.size.tolist()), F.col("cls"))).alias("beside"),
        # at most the tokens of a text: those beside another one of them
        F.array_sort(F.collect_set(F.when((F.col("before") < 0) | (F.col("after") < 0), F.struct("at", "cls")))).alias("runs"))
    later = F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0)))
    between = F.zip_with("runs", later, lambda a, b: F.when(b["at"] == a["at"] + 1, step(a["cls"], b["cls"])).otherwise(0.0))
    copies = parts.groupBy(F.col("doc_id").alias("__doc"), F.col("th").alias("__th")).agg(F.count("*").alias("rows"))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("th") == F.col("__th"))
    sums = sums.join(copies, same).select(
        "__doc", "__th", (F.col("more") / F.col("rows")).cast("long").alias("more"), (F.col("own") / F.col("rows")).alias("own"),
        (F.col("beside") / F.col("rows") + F.aggregate(between, F.lit(0.0), lambda s, x: s + x)).alias("beside"))
    both = parts.drop("rest").join(sums, same, "left")
    own = F.coalesce("own", F.lit(0.0))
    return both.select("doc_id", "th", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                       F.lit(model.n).cast("long").alias("train_tokens"), (F.col("base") + own).alias("base_score"),
                       (F.col("model") + own + F.coalesce("beside", F.lit(0.0))).alias("score"))


def score_corpus(docs: DataFrame, held_out: Column | None = None, **options) -> DataFrame:
    """Train on the rows that aren't held out, score all: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity (of the class model, per token).

    Scores are log10 probabilities of the whole text and its end; base_score is that of the add-one unigram model.
    By default rows with crc32(doc_id) mod 7 = 2 are held out (a null id counts as an empty text there). Null and empty
    texts are an end alone; fully repeated rows count, and are scored, each time. Without training rows every token is
    unseen. An empty table gives an empty result; other columns aren't read.
    """
    held_out = crc_mod(F.col("doc_id"), 7) == 2 if held_out is None else held_out
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    model, words = train(rows.where(~held_out), **options)
    scored = score(rows, model, words)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                         F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
