from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from marquee.llm.queries import op11_spelling_variants
from marquee.llm.spelling import near_pairs, spelling_variants
from tests.conftest import SF_SMALL


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def all_near(words):
    """Near words of each word, by all words with one place left out."""
    by = defaultdict(set)
    for w in words:
        by[w].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1:]].add(w)
            by[w[:i] + "\0" + w[i + 1:]].add(w)
    near = {w: set() for w in words}
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def reference(docs, drop=31, min_length=7):
    count = Counter()
    for d, text in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                count[run] += 1
    n = {w: c for w, c in count.items() if c > 1}
    near = all_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("split", [1, 8, 1 << 20])
@pytest.mark.parametrize("seed", range(2))
def test_pairs_equal_all_pairs(spark, split, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choices("abé" if seed else "ab", k=rng.randint(3, 9))) for _ in range(500)}
    words |= {"tion" * 3 + c for c in "abcdefgh"} | {c + "tion" * 3 for c in "abcdefgh"} | {"tiontion", "tiontio", "iontion"}
    got = near_pairs(spark.createDataFrame([(w, 1) for w in words], "w string, n long"), split).collect()
    pairs = [tuple(sorted((r.x, r.y))) for r in got]
    near = all_near(words)
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {tuple(sorted((a, b))) for a in near for b in near[a]}


@pytest.mark.parametrize("drop", [31, 3, 0])
def test_equals_the_plain_count(spark, make_docs, drop):
    rng = random.Random(drop)
    base = ["ciónción", "reading", "threading", "ÉCOLEÇAÀ", "Readings", "treading", "a×÷bÿÀzzz"]
    docs = [(i, " ".join(rng.choices(base, weights=[100, 40, 30, 20, 3, 1, 1], k=rng.randint(0, 80)))) for i in range(60)]
    docs += [(None, "Reading reading"), (3, None), (4, ""), docs[0]]
    got = result(spelling_variants(make_docs(docs), drop=drop, split=4))
    assert got == reference(docs, drop)
    assert drop == 0 or any(r[1] for r in got)


def test_chains_end_at_the_last_form(spark, make_docs):
    words = {"abcdefgh": 3000, "abcdefgX": 200, "abcdefYX": 20, "abcdeZYX": 2}
    docs = [(1, " ".join(w for w, n in words.items() for _ in range(n)))]
    got = result(spelling_variants(make_docs(docs), drop=0))
    assert got == reference(docs, 0)
    assert {r[2] for r in got} == {"abcdefgh"}


def test_cases(spark, make_docs, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert result(spelling_variants(awkward)) == reference(rows)
    assert spelling_variants(awkward.limit(0)).count() == 0
    long = "ab" * 20_000
    docs = [(1, f"{long} {long} {long}c {long}c"), (2, None)]
    got = result(spelling_variants(make_docs(docs), drop=0))
    assert [(len(r[0]), r[4]) for r in got] == [(40_000, 1), (40_001, 1)]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert result(op11_spelling_variants(spark, SF_SMALL)) == reference(docs)
