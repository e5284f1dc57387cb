from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from marquee.llm.queries import op12_importance_resampling
from marquee.llm.resample import LONG, crc_matrix, crc_of_slices, resample, sample_documents
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def reference(docs, target, percent=5, min_words=20):
    """(doc_id, n_features, weight, score, rank), feature by feature."""
    s, t = (Counter(b for x in texts for b in buckets_of(x)[1]) for texts in ([x for _, x in docs], target))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out, fit = [], []
    for i, (d, text) in enumerate(docs):
        n, found = buckets_of(text)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n >= min_words:
            fit.append(i)
    fit.sort(key=lambda i: (-out[i][3], -1 if out[i][0] is None else out[i][0], out[i][1]))
    for k, i in enumerate(fit[:percent * len(fit) // 100]):
        out[i][4] = k + 1
    return sorted(map(tuple, out), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


def test_crc_of_equal_lengths_and_of_slices():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 40):
        rows = rng.integers(0, 256, (50, size), dtype=np.uint8)
        assert crc_matrix(rows).tolist() == [zlib.crc32(r.tobytes()) for r in rows]
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    sizes = rng.integers(1, 30, 400)
    sizes[:3] = LONG, LONG + 1, 3000
    starts = rng.integers(0, 2000, 400)
    assert crc_of_slices(data, starts, sizes).tolist() == [zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(starts, sizes, strict=True)]


def test_equals_the_plain_count(spark, make_docs):
    rng = random.Random(5)
    words = ["a", "B", "ab9", "é", "ÄÖ", "漢字", "x" * 600, "zz", "q"]
    seps = [" ", "  ", "\n", "-", "\t.", "_", "\0"]
    text = lambda n: "".join(rng.choice(words) + rng.choice(seps) for _ in range(n))
    docs = [(i, rng.choice(["", " ", "-"]) + text(rng.choice([0, 1, 2, 3, 19, 20, 21, 60]))) for i in range(120)]
    docs += [(7, None), (None, text(30)), (None, None), docs[5], (900, ""), (901, text(4000))]
    target = [text(25), None, "", "zz q zz"]
    bench = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id int, text string")
    got = resample(make_docs(docs), bench, percent=30)
    assert result(got) == reference(docs, target, 30)
    assert sum(r["rank"] is not None for r in got.collect()) > 10


def test_ties_go_to_the_smaller_id(spark, make_docs):
    # equal ids and texts give equal scores; noise alone orders others
    docs = [(5, "w " * 25)] * 4 + [(i, "w " * 25) for i in range(6, 46)]
    bench = spark.createDataFrame([(1, "w")], "item_id int, text string")
    assert result(resample(make_docs(docs), bench, percent=50)) == reference(docs, ["w"], 50)


def test_cases(spark, make_docs, awkward):
    none = spark.createDataFrame([], "item_id int, text string")
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert result(resample(awkward, none, percent=50)) == reference(rows, [], 50)
    assert resample(awkward.limit(0), none).count() == 0
    drawn = resample(awkward, none, percent=50)
    kept = sample_documents(awkward, drawn)
    assert kept.columns == awkward.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in drawn.where("rank > 0").collect()}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert result(op12_importance_resampling(spark, SF_SMALL)) == reference(docs, target)
