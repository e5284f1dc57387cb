"""Removal of long repeated byte strings by sorting suffixes.

A string of ``length`` bytes counts as repeated if it starts at two places of
the corpus. Sorting every suffix would shuffle many times the corpus, so the
suffixes are sampled first, by content: of all ``gram``-byte strings inside a
window of ``length`` bytes, those with the smallest hash are its anchors. Equal
windows have equal anchors, so every repeated window holds an anchor whose gram
occurs twice. Grams that occur once are dropped; of the others, the suffixes
that start at the anchors (and what stands before them, read backwards) are
sorted in each group of equal grams: multikey quicksort down to a shallow
depth, then blind tries for groups that still share a longer prefix. Common
prefix lengths between neighbours in both orders tell which windows around
each anchor occur twice, byte by byte.

Equal surroundings (copies) are merged before the sort. Groups with more
different surroundings than ``SPLIT`` are not sorted in one task; their windows
are counted one by one by a shuffle on the windows' hashes.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import broadcast_if_small, mark_possible, materialize, text_key

LENGTH = 400
SHALLOW = 8                 # bytes that the quicksort looks at beyond the shared gram
SPLIT = 1 << 15             # surroundings sorted in one task: 20 MB
PIECE = 1 << 18             # bytes that are hashed at once
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)


# ------------------------------------------------------------------ anchors
class _Grams:
    """Rolling hash of all grams of a buffer (polynomial, modulo 2**64, then mixed)."""

    def __init__(self, gram: int, room: int) -> None:
        self.gram = gram
        self.table = np.random.default_rng(42).integers(0, 2**64, 256, dtype=np.uint64)
        self.power = np.cumprod(np.full(room, _BASE))
        self.inverse = np.cumprod(np.full(room, np.uint64(pow(int(_BASE), -1, 2**64))))

    def hashes(self, buffer: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.table[buffer] * self.power[:len(buffer)])])
        h = (sums[self.gram:] - sums[:-self.gram]) * self.inverse[:len(buffer) - self.gram + 1]
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
        return h


def _sliding(values: np.ndarray, width: int, reduce: np.ufunc) -> np.ndarray:
    """reduce over every ``width`` neighbouring values, by doubling."""
    out, done = values, 1
    while done * 2 <= width:
        out = reduce(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return reduce(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(pieces: list[np.ndarray], length: int, grams: _Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, position in it, gram hash) of every anchor of every window inside a piece."""
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    if not len(ends) or ends[-1] < length:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
    h = grams.hashes(np.concatenate(pieces))
    width = length - grams.gram + 1             # grams in a window
    low = _sliding(h, width, np.minimum)
    for a, b in zip((ends - length + 1).tolist(), ends.tolist(), strict=True):
        low[max(a, 0):b] = 0                    # windows that run over a piece's end
    reach = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero((_sliding(reach, width, np.maximum)[:len(h)] == h) & (h > 0))
    piece = np.searchsorted(ends, at, side="right")
    return piece, at - (ends - sizes)[piece], h[at]


# ------------------------------------------------------------------ sorting
def deep_shallow_order(strings: list[bytes], depth: int, shallow: int) -> list[int]:
    """Order of ``strings``, which share their first ``depth`` bytes; ends sort before bytes."""
    out: list[int] = []
    todo = [(list(range(len(strings))), depth)]
    while todo:
        group, d = todo.pop()
        if len(group) < 2:
            out += group
        elif d >= depth + shallow:
            out += _blind_trie_order(strings, group)
        else:                                   # three-way split on the byte at d
            key = [strings[i][d] if d < len(strings[i]) else -1 for i in group]
            pivot = sorted(key)[len(key) // 2]
            parts: tuple[list[int], ...] = ([], [], [])
            for i, k in zip(group, key, strict=True):
                parts[(k > pivot) - (k < pivot) + 1].append(i)
            todo += [(parts[2], d), (parts[1], d + 1) if pivot >= 0 else ([], d), (parts[0], d)]
            if pivot < 0:                       # strings that end here are equal
                out += parts[1]
    return out


def _blind_trie_order(strings: list[bytes], group: list[int]) -> list[int]:
    """Order of a group by a trie that keeps branching depths only: descend blindly, compare once, split there."""
    root: list = [0, {}, group[0]]              # depth, children by byte, any leaf below; a leaf is [None, equal strings, itself]
    leaf = [None, [group[0]], group[0]]
    root[1][_byte(strings[group[0]], 0)] = leaf
    for i in group[1:]:
        s = strings[i]
        node = root
        while node[0] is not None:              # blind descent: only branching bytes are looked at
            node = node[1].get(_byte(s, node[0])) or next(iter(node[1].values()))
        common = common_prefix(s, strings[node[2]])
        if common == len(s) == len(strings[node[2]]):
            node[1].append(i)
            continue
        above, node = None, root
        while node[0] is not None and node[0] < common:
            above, node = node, node[1][_byte(s, node[0])]
        new = [None, [i], i]
        if node[0] == common:
            node[1][_byte(s, common)] = new
        else:
            split = [common, {_byte(strings[node[2]], common): node, _byte(s, common): new}, i]
            if above is None:
                root = split
            else:
                above[1][_byte(s, above[0])] = split
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node[0] is None:
            out += node[1]
        else:
            todo += [node[1][k] for k in sorted(node[1], reverse=True)]
    return out


def _byte(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by comparing halves."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def repeated_windows(before: list[bytes], after: list[bytes], often: list[bool], length: int, gram: int,
                     shallow: int = SHALLOW) -> list[tuple[int, int] | None]:
    """For one gram, the repeated windows around each of its different surroundings.

    before: the bytes before the anchor, nearest first; after: those from it on.
    often: the surrounding itself occurs more than once. A window starts o
    bytes before the anchor; returned are the first and the last o, None if
    there is none. Windows around one anchor overlap, so the two fix the bytes
    that the repeated windows cover.
    """
    n, most = len(after), length - gram
    first = [max(0, length - len(x)) for x in after]
    last = [min(most, len(x)) for x in before]
    right = deep_shallow_order(after, gram, shallow)
    left = deep_shallow_order(before, 0, shallow)
    rank = np.empty((2, n), np.int64)
    shared = np.zeros((2, n), np.int64)         # with the neighbour before, in each order
    for k, (order, strings) in enumerate(((left, before), (right, after))):
        rank[k, order] = np.arange(n)
        shared[k, 1:] = [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]
    fit = np.array([first, last])
    # the classes of equal windows change only at these offsets
    cuts = {0, *(shared[0] + 1).tolist(), *(length - shared[1]).tolist(), *first, *(x + 1 for x in last)}
    cuts = sorted(c for c in cuts if 0 <= c <= most)
    out = [(f, t) if many and f <= t else None for f, t, many in zip(first, last, often, strict=True)]
    for o, nxt in zip(cuts, [*cuts[1:], most + 1], strict=True):
        ok = (fit[0] <= o) & (o <= fit[1])
        if ok.sum() < 2:
            continue
        lefts = np.cumsum(shared[0] < o)[rank[0]]
        rights = np.cumsum(shared[1] < length - o)[rank[1]]
        code = (lefts * (n + 1) + rights)[ok]
        _, where, counts = np.unique(code, return_inverse=True, return_counts=True)
        for i in np.flatnonzero(ok)[counts[where] > 1].tolist():
            was = out[i] or (o, o)
            out[i] = min(was[0], o), max(was[1], nxt - 1)
    return out


# ------------------------------------------------------------------ operator
def repeated_spans(docs: DataFrame, length: int = LENGTH, split: int = SPLIT) -> DataFrame:
    """(doc_id, th, spans): the maximal runs [from, to) of bytes that lie in a string of ``length`` bytes occurring
    at two places; one row per row identity (doc_id, ``text_key``) with any.

    Fully repeated rows share one identity, and each is the other's second place.
    """
    gram = length // 2
    most = length - gram
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.octet_length("text") >= length) \
        .select("doc_id", text_key(F.col("text")).alias("th"), F.col("text").cast("binary").alias("bytes"))
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(gram, 2 * PIECE + length)
        for batch in batches:
            first, size = 0, 0
            for i, blob in enumerate(batch.column(2), 1):       # some documents at a time bound what a task holds
                size += len(blob.as_buffer())
                if size >= PIECE or i == batch.num_rows:
                    yield anchor_rows(grams, batch.slice(first, i - first))
                    first, size = i, 0

    def anchor_rows(grams: _Grams, batch: pa.RecordBatch) -> pa.RecordBatch:
        blobs = [x.as_buffer() for x in batch.column(2)]
        pieces, source, size = [], [], 0
        places: list[dict[int, int]] = [{} for _ in blobs]      # of each document: position -> gram

        def place() -> None:
            piece, at, h = anchors(pieces, length, grams)
            for p, x, g in zip(piece.tolist(), at.tolist(), h.view(np.int64).tolist(), strict=True):
                i, start = source[p]
                places[i][start + x] = g                        # pieces share anchors at their edges
            pieces.clear()
            source.clear()

        for i, blob in enumerate(blobs):
            whole = np.frombuffer(blob, np.uint8)
            for start in range(0, len(whole) - length + 1, PIECE):
                pieces.append(whole[start:start + PIECE + length - 1])      # the windows that start in the piece
                source.append((i, start))
                size += len(pieces[-1])
                if size >= PIECE:
                    place()
                    size = 0
        place()
        cols: list[list] = [[] for _ in range(7)]
        for i, found in enumerate(places):
            view = memoryview(blobs[i])
            n = len(view)
            same: dict[tuple[int, int], list[int]] = defaultdict(list)
            for x, g in found.items():
                a, b = max(0, x - most), min(n, x + length)
                same[g, xxhash.xxh64_intdigest(view[a:b], x - a) - (1 << 63)].append(x)
            for (g, around), at in same.items():
                at.sort()
                for k, x in enumerate(at):      # a repeat inside the text needs no partner elsewhere
                    row = (i, None if k else g, None if k else around, x, min(x, most), min(n - x, length), 0 if k else len(at))
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
        take = pa.array(cols[0], pa.int64())
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take),
                                           *(pa.array(c, t) for c, t in zip(cols[1:], types, strict=True))],
                                          ["doc_id", "th", "gram", "around", "at", "left", "right", "n"])

    found = materialize(texts.mapInArrow(
        find, f"doc_id {id_type}, th long, gram long, around long, at int, left int, right int, n int"))
    totals = found.where("gram is not null").groupBy("gram").agg(
        F.sum("n").alias("all"), F.min("around").alias("lo"), F.max("around").alias("hi")).where("all > 1")
    twice = materialize(found.join(totals, "gram").withColumn("mixed", F.col("lo") != F.col("hi")).drop("lo", "hi", "all"))

    # one of each different surrounding, with its bytes
    several = twice.where("mixed").groupBy("gram", "around").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "th", "at", "left", "right")).alias("r")).select("gram", "around", "n", "r.*")
    several = materialize(several)
    wanted = several.withColumnRenamed("doc_id", "__doc").withColumnRenamed("th", "__th")
    bytes_of = F.substring(F.col("bytes"), F.col("at") - F.col("left") + 1, F.col("left") + F.col("right"))
    holders = mark_possible(texts, "th", several.select(F.col("th").alias("key")), "__may")
    around = holders.where("__may").join(wanted, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("th") == F.col("__th"))).select(
        "gram", "around", "n", "left", bytes_of.alias("bytes"))
    large = several.groupBy("gram").agg(F.count("*").alias("size")).where(F.col("size") > split).select("gram", F.lit(True).alias("large"))
    around = around.join(broadcast_if_small(materialize(large)), "gram", "left")

    def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(g: int, group: dict[int, tuple[bool, int, bytes]]) -> list[tuple]:
            keys = list(group)
            ranges = repeated_windows([group[k][2][:group[k][1]][::-1] for k in keys], [group[k][2][group[k][1]:] for k in keys],
                                      [group[k][0] for k in keys], length, gram)
            return [(g, k, -found[1], length - found[0]) for k, found in zip(keys, ranges, strict=True) if found]

        group: dict[int, tuple[bool, int, bytes]] = {}
        current = None
        out: list[tuple] = []
        for batch in batches:
            for g, k, n, left, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != current:
                    out += flush(current, group) if group else []
                    group, current = {}, g
                group[k] = (n > 1, left, b)
            yield _covers(out)
            out = []
        yield _covers(flush(current, group) if group else [])

    def _covers(rows: list[tuple]) -> pa.RecordBatch:
        cols = [list(c) for c in zip(*rows, strict=True)] or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)],
                                          ["gram", "around", "from", "to"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g, k, n, left, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for o in range(max(0, length - (len(b) - left)), min(most, left) + 1):
                    w = b[left - o:left - o + length]
                    out.append((g, k, n, o, xxhash.xxh64_intdigest(w) - (1 << 63), xxhash.xxh64_intdigest(w, 1) - (1 << 63)))
            cols = [list(c) for c in zip(*out, strict=True)] or [[] for _ in range(6)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["gram", "around", "n", "o", "w", "x"])

    columns = ["gram", "around", "n", "left", "bytes"]
    usual = (around.where("large is null").select(*columns).repartition("gram").sortWithinPartitions("gram")
             .mapInArrow(sort_groups, "gram long, around long, `from` int, `to` int"))
    each = materialize(around.where("large").select(*columns).dropDuplicates(["gram", "around"])
                       .mapInArrow(windows, "gram long, around long, n long, o long, w long, x long"))
    again = each.groupBy("o", "w", "x").agg(F.sum("n").alias("total")).where("total > 1")
    hot = each.join(again, ["o", "w", "x"]).groupBy("gram", "around").agg(
        (-F.max("o")).cast("int").alias("from"), (F.lit(length) - F.min("o")).cast("int").alias("to"))
    covers = usual.unionByName(hot)

    span = lambda a, b: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")).alias("s")
    full = span(F.col("at") - F.col("left"), F.col("at") + F.col("right"))
    inside = found.where("gram is null or n > 1").select("doc_id", "th", full)
    copies = twice.where("not mixed").select("doc_id", "th", full)
    mixed = twice.where("mixed").join(covers, ["gram", "around"]).select(
        "doc_id", "th", span(F.col("at") + F.col("from"), F.col("at") + F.col("to")))
    return inside.unionByName(copies).unionByName(mixed).groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("s")).alias("spans"))


def merge_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs covered by sorted spans."""
    out: list[tuple[int, int]] = []
    for s in spans or ():
        if out and s["a"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["b"]))
        else:
            out.append((s["a"], s["b"]))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, split: int = SPLIT, with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the remaining bytes) of every row of ``docs``.

    Each byte of a string of ``length`` bytes that also starts at another place
    of any text goes; places are judged on the input. Null and empty texts
    have no bytes; shorter texts keep all; very long ones are hashed piece by
    piece, windows over the pieces' edges included; fully repeated rows lose all they
    have if long enough, each its row; rows with one doc_id and different
    texts are different documents; null ids are ids like others. Empty tables
    give an empty result; other columns aren't read.
    """
    spans = materialize(repeated_spans(docs, length, split))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", text_key(F.col("text")).alias("th"), F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))
    marks = spans.select(F.col("doc_id").alias("__doc"), F.col("th").alias("__th"), "spans")
    # a text without spans goes straight to its hash, only the others are shuffled
    rows = mark_possible(rows, "th", spans.select(F.col("th").alias("key")), "__may")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("th") == F.col("__th"))
    both = rows.where("__may").join(marks, same, "left").select("doc_id", "bytes", "spans").unionByName(
        rows.where("not __may").select("doc_id", "bytes", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for blob, spans in zip(batch.column(1), batch.column(2), strict=True):
                view, runs = memoryview(blob.as_buffer()), merge_spans(spans.as_py())
                edges = [0, *(x for r in runs for x in r), len(view)]
                kept = b"".join(view[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for c, v in zip(out, (len(view), len(view) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(),
                                      kept if with_bytes else None), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(out, (pa.int64(),) * 3 + (pa.string(), pa.binary()), strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    result = both.select("doc_id", "bytes", "spans").mapInArrow(
        cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return result if with_bytes else result.drop("kept")
