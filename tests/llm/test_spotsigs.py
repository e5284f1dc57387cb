from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from marquee.llm import spotsigs
from marquee.llm.queries import op9_spotsigs
from marquee.llm.spotsigs import ANCHORS, CHAIN, REACH, fingerprint_edits, next_ids, similar_sets, with_signatures
from tests.conftest import SF_SMALL


def signatures(text):
    """Word by word: each anchor and the next content words."""
    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    out = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            chain, passed = [], 0
            for x in words[i + 1:]:
                if x in ANCHORS:
                    passed += 1
                    if passed > REACH:
                        break
                elif len(chain) < CHAIN:
                    chain.append(x)
                if len(chain) == CHAIN:
                    break
            if len(chain) == CHAIN:
                out.add((w, *chain))
    return out or {text or ""}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def reference(docs):
    """docs: (id, text) with different ids."""
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        out.append((str(d), len(t), hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(signatures(t), signatures(edited)), 9),
                    round(jaccard(signatures(t), signatures(nxt)), 9)))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect())


def test_query_equals_reading_word_by_word(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = op9_spotsigs(spark, SF_SMALL)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
    rows = df.collect()
    assert result(df) == reference(docs)
    text = dict(docs)
    for a, b in itertools.combinations(rows, 2):
        if text[a.doc_id] == text[b.doc_id]:
            assert a.fingerprint == b.fingerprint
        elif a.fingerprint == b.fingerprint:
            assert signatures(text[a.doc_id]) == signatures(text[b.doc_id])
    for r in rows:
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1)


@pytest.mark.parametrize("text", ["", "no anchors", "the quick brown fox", "the of and a quick brown fox jumps", "The THE the x y z w",
                                  "der Hund und die große Katze schlafen", "the a of in is it x y z", "theory ofthe x y z", "the x y"])
def test_signatures(spark, text):
    got = with_signatures(spark.range(1).select(F.lit(text).alias("t")), sigs="t").first().sigs
    assert len(got) == len(signatures(text)) and got == sorted(got)


def test_cases(spark, make_docs):
    docs = [(5, None), (2, ""), (9, "the one two three four é漢"), (-3, "of " * 30 + "a b c"), (None, "and then some more words come"),
            (7, " ".join(f"the w{i} x{i % 7} y{i % 11}" for i in range(8000)))]
    assert result(fingerprint_edits(make_docs(docs))) == reference(docs)
    one = fingerprint_edits(make_docs([(1, "abcdefgh")])).first()
    assert one.edited == "abcdefab" and one.near_next == 1
    assert fingerprint_edits(make_docs([])).count() == 0
    twice = fingerprint_edits(make_docs([(1, "same text here"), (1, "same text here"), (2, "xyz")])).collect()
    assert len(twice) == 3 and twice[0].near_next == twice[0].near_next
    several = {(r.doc_id, r.next_id) for r in next_ids(make_docs([(1, "a"), (1, "b"), (3, "c"), (None, "d")])).collect()}
    assert several == {(1, 3), (3, None), (None, 1)}


def test_anchors_are_found_as_by_trying_every_word(spark):
    """Common beginnings of anchors are tried once, sorting compares without a lambda, and a spot of enough words looks no further."""
    words = [*ANCHORS, "c", "c'est", "c'es"]
    rng = random.Random(3)
    text = " ".join("".join(rng.choice(words) + rng.choice(["", "", " ", "'", "x"]) for _ in range(4)) for _ in range(500))
    one, each = (re.compile(rf"(?<!\w)(?:{p})(?!\w)") for p in (spotsigs._any_of(words), "|".join(map(re.escape, words))))
    # where several words fit the longest one is taken
    assert [m.start() for m in one.finditer(text.replace("c'es", ""))] == [m.start() for m in each.finditer(text.replace("c'es", ""))]
    assert one.findall("c'est c'esx cx") == ["c'est", "c"]
    plan = with_signatures(spark.createDataFrame([("x",)], "t string"), sigs="t")._jdf.queryExecution().optimizedPlan().toString()
    assert "an|the" not in plan and "array_sort" not in plan and "CASE WHEN (size(lambda" in plan


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_similar_sets_equals_all_pairs(spark, threshold):
    rng = random.Random(1)
    sets = []
    for i in range(150):
        s = set(rng.choice(sets)[1]) if sets and rng.random() < .6 else {rng.randrange(10**6) for _ in range(rng.randint(1, 40))}
        for _ in range(rng.randint(0, 4)):
            s ^= {rng.choice(sorted(s)) if s and rng.random() < .5 else rng.randrange(10**6)}
        sets.append((f"f{i}", sorted(s or {1})))
    exact = {(a[0], b[0]) for a, b in itertools.permutations(sets, 2)
             if (len(a[1]), a[0]) < (len(b[1]), b[0]) and jaccard(set(a[1]), set(b[1])) >= threshold}
    got = {(r.a, r.b) for r in similar_sets(spark.createDataFrame(sets, "fp string, sigs array<long>"), threshold).collect()}
    assert got == exact and len(exact) > 20


def test_common_signatures_join_no_sets(spark, monkeypatch):
    """A signature of every set, smallest by value, leads no pair to a comparison; like sets are found all the same."""
    compared = []
    with_likeness = spotsigs.with_likeness
    monkeypatch.setattr(spotsigs, "with_likeness", lambda df, **pairs: compared.append(df.count()) or with_likeness(df, **pairs))
    sets = [(f"f{i}", [0, *range(100 * i + 1, 100 * i + 20)]) for i in range(40)] + [("like", [0, *range(101, 119), 10**6])]
    got = similar_sets(spark.createDataFrame(sets, "fp string, sigs array<long>")).collect()
    assert [(r.a, r.b) for r in got] == [("f1", "like")] and compared == [1]
