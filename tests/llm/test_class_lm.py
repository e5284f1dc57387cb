from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm.class_lm import _Words, BASE, END, byte_values, exchange, mix, neighbours, score, score_corpus, sweep, train
from marquee.llm.queries import op5_class_lm
from tests.conftest import SF_MID, SF_SMALL


def likelihood(b, cls):
    one = np.eye(cls.max() + 1)[cls]
    m = one.T @ b @ one
    phi = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
    return phi(m) - phi(m.sum(1)) - phi(m.sum(0))


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(3)
    b = rng.integers(0, 9, (31, 31)).astype(float)
    b[1:16, 16:] *= 12
    b[16:, 1:16] *= 12
    cls = exchange(b, 4, rounds=50)
    best = likelihood(b, cls)
    for u in range(1, 31):
        for c in range(1, 4):
            other = cls.copy()
            other[u] = c
            assert likelihood(b, other) <= best + 1e-6
    assert cls[0] == 0 and (cls[1:] > 0).all()


def words(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()


def reference(docs):
    held = {d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2 for d, _ in docs}
    c, ends = Counter(), 0
    for d, t in docs:
        if not held[d]:
            c.update(words(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + bool(ends)
    out = []
    for d, t in docs:
        w = words(t)
        counts = [c[x] for x in w] + [ends]
        out.append((str(d), held[d], len(counts), sum(x > 0 for x in counts), n,
                    sum(math.log10((x + 1) / (n + v + 1)) for x in counts)))
    return sorted(out)


def close(got, expected):
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert all(math.isclose(g[5], e[5], rel_tol=1e-9) for g, e in zip(got, expected, strict=True))


def test_query_base_and_gain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    got = op5_class_lm(spark, SF_MID).collect()
    close(got, reference(docs))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.96 * sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


VALUES = [int(x) for x in byte_values()]


def word_hash(word):
    h = sum(VALUES[b] * pow(BASE, i, 1 << 64) for i, b in enumerate(word)) % (1 << 64)
    return int(mix(np.array([h], np.uint64)).view(np.int64)[0]) or 1


def test_words_of_texts_at_once():
    """Words that touch a text's edge, empty and null texts, other white space, and texts and words longer than a step."""
    texts = ["a B", "", None, "b", "  x\ty\r\nZ é\u00a0é ", "q", "ab" * (1 << 20) + " tail", "one " * (1 << 19) + "Two", "end\x0b\x0c"]
    got_h, got_n = [], []
    for h, stops in _Words()(pa.array([None if t is None else t.encode() for t in ["cut off", *texts]]).slice(1)):
        got_h += h.tolist()
        got_n += np.diff(np.r_[0, stops]).tolist()
    long = _Words()._hash(np.frombuffer(b"ab" * (1 << 20), np.uint8), np.array([0]), np.array([1 << 21]))[0]
    expected = [[long, word_hash(b"tail"), END] if t and len(t) == (1 << 21) + 5 else
                [word_hash(b"one")] * (1 << 19) + [word_hash(b"two"), END] if t and len(t) > 99 else tokens(t)[1:] for t in texts]
    assert got_n == [len(e) for e in expected] and got_h == [h for e in expected for h in e]


def tokens(text):
    """Hashes of a text between two ends."""
    return [END, *map(word_hash, words(text)), END]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")


@pytest.mark.parametrize("hot", [0, 40, 1 << 18])
def test_neighbours_equal_brute_force(spark, small, hot):
    docs = small.where("doc_id < 40")
    count = Counter(h for r in docs.collect() for h in tokens(r.text)[1:])
    top = sorted((h for h in count if h != END), key=lambda h: (-count[h], h))
    cls = {h: 1 + h % 5 for h in count} | {END: 0}
    fixed = {END, *top[:30]}
    travel = sorted({END, *top[:max(hot, 30)]})
    assigned = spark.createDataFrame([(h, c) for h, c in cls.items()], "h long, cls int")
    got = neighbours(docs, np.array(travel), np.array([cls[h] for h in travel]), np.array([h in fixed for h in travel]), 6, assigned)
    seen = Counter()
    for r in got.collect():
        for x in r["items"]:
            seen[r.h, x % 18] += x // 18
    expected = Counter()
    for r in docs.collect():
        t = tokens(r.text)
        for x, y, z in zip(t, t[1:], t[2:]):
            if y not in fixed:
                expected[y, cls[x] + (0 if x in fixed else 6)] += 1
                expected[y, cls[z] + 12] += 1
    assert seen == expected


def test_sweep_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 50, (4, 4)).astype(float)
    rows = [(h, [int(n) * 12 + int(k) for n, k in zip(rng.integers(1, 9, 3), rng.integers(0, 12, 3))]) for h in range(1, 40) for _ in range(h % 4 + 1)]
    around = spark.createDataFrame(rows, "h long, items array<long>")
    types = np.array([9, 2, 30, 4])
    found = sweep(around, pairs, types).collect()
    kinds = (pairs > 0).sum(1) + 1
    share = (pairs.sum(0) + 1) / (pairs.sum() + 4)
    step = (pairs + kinds[:, None] * share) / (pairs.sum(1) + kinds)[:, None]
    best, made = {}, Counter()
    for h in range(1, 40):
        items = [(x // 12, x % 12) for g, xs in rows if g == h for x in xs]
        each = Counter()
        for n, k in items:
            each[k] += n

        def choice(seen):
            gain = [math.log10(types[b] + 1) + sum(n * math.log10(step[k % 4, b] / share[b] if k < 8 else step[b, k % 4] / share[k % 4])
                                                   for k, n in seen.items()) for b in range(1, 4)]
            return 1 + int(np.argmax(gain))

        best[h] = choice(each)
        for k, n in each.items():
            made[choice(each - Counter([k])), k] += n
    assert {r.h: r.cls for r in found if r.h is not None} == best
    counted = Counter()
    for r in found:
        if r.h is None:
            counted[r.cls, r.k] += r.n
    assert counted == made


@pytest.mark.parametrize("hot", [0, 60, 1 << 18])
def test_score_equals_brute_force(small, hot):
    model, table = train(small.where("doc_id % 3 > 0"), frequent=50, classes=8, hot=hot)
    known = {r.h: (r.c, r.cls) for r in table.collect()}
    assert set(known) == {h for r in small.where("doc_id % 3 > 0").collect() for h in tokens(r.text)}    # every word has a class
    assert known[END][1] == 0 and all(0 < cls < 8 for h, (_, cls) in known.items() if h != END)
    got = {r.doc_id: r for r in score(small, model, table, hot).collect()}
    for r in small.collect():
        t = tokens(r.text)
        k = [known.get(h, (0, model.opened))[1] for h in t]
        c = [known.get(h, (0, 0))[0] for h in t[1:]]
        expected = sum(model.step[a, b] for a, b in zip(k, k[1:])) + sum(math.log10(x + 1) - model.size[b] for x, b in zip(c, k[1:]))
        assert math.isclose(got[r.doc_id].score, expected, rel_tol=1e-9)
        assert got[r.doc_id].n_known == sum(x > 0 for x in c) and got[r.doc_id].n_tokens == len(c)


def test_joined_classes_equal_travelling_ones(small):
    options = {"frequent": 50, "classes": 8}
    some, all_ = (({(r.h, r.c, r.cls) for r in train(small, hot=hot, **options)[1].collect()}) for hot in (60, 1 << 18))
    assert some == all_


def test_rare_words_join_the_class_of_their_kind(make_docs):
    """Names and deeds take turns; those that occur twice get the class of the frequent ones of their kind."""
    docs = make_docs([(i, f"n{i % 3} d{i % 4} n{i % 2} d{i % 3} rn{i // 2} d{i % 4} n{i % 3} rd{i // 2}") for i in range(60)])
    cls = {h: c for h, _, c in train(docs.select("text"), frequent=7, classes=3)[1].select("h", "c", "cls").collect()}
    of = lambda w: cls[tokens(w)[1]]
    assert {of(f"rn{i}") for i in range(30)} == {of("n0")} and {of(f"rd{i}") for i in range(30)} == {of("d0")} != {of("n0")}


def test_probabilities_sum_to_one(make_docs):
    """After any token, over the end, all training words, and one unseen word."""
    docs = make_docs([(i, f"a b c d{i % 3} a e{i % 5} b") for i in range(30)])
    model, table = train(docs.select("text"), frequent=3, classes=4)
    of_class = np.zeros(len(model.step))
    for r in table.collect():
        of_class[r.cls] += (r.c + 1) / 10 ** model.size[r.cls]
    of_class[model.opened] += 1 / 10 ** model.size[model.opened]
    used = of_class > 0
    assert np.allclose((10 ** model.step[used]).sum(1), 1) and np.allclose(of_class[used], 1)
    assert np.allclose(10 ** model.step[used][:, ~used], 0)


def test_cases(spark, awkward):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    got = score_corpus(awkward).collect()
    assert len(got) == len(docs)
    close(got, reference(docs))
    assert score_corpus(awkward.limit(0)).count() == 0
    alone = score_corpus(awkward, held_out=F.lit(True)).collect()
    assert {r.train_tokens for r in alone} == {0} and {r.n_known for r in alone} == {0}
