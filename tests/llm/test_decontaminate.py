from __future__ import annotations

import random
from itertools import combinations

import pytest

from marquee.llm.decontaminate import MASKS, drop_contaminated, find_contamination, overlap, seeds, short_masks, tokens
from marquee.llm.queries import op3_decontamination
from tests.conftest import SF_SMALL


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def brute(docs, items, window=13, similarity=0.8, shortest=5):
    """Every alignment of every pair, compared token by token."""
    out = {}
    for d, text in docs:
        a = tokens(text)
        for i, item in items:
            b = tokens(item)
            n = min(window, len(b))
            if n < shortest:
                continue
            best = max((overlap(a, b, s, n)[0] for s in range(-len(b) + 1, len(a))), default=0)
            if best >= (similarity if len(b) >= 12 else 1) * n:
                out[d, i] = max(best, out.get((d, i), 0))
    return out


@pytest.fixture
def corpus(spark, make_docs):
    rng = random.Random(5)
    items = [(i, " ".join(words(rng, rng.choice([6, 11, 12, 16, 30, 60])))) for i in range(25)] + [(90, None), (91, ""), (92, "too short")]
    docs = []
    for d in range(60):
        text = words(rng, rng.randint(0, 120))
        if d % 2:
            part = rng.choice(items[:25])[1].split()
            if len(part) > 20 and rng.random() < .5:
                part = part[5:5 + rng.randint(13, 20)]
            for k in range(0, len(part), rng.choice([6, 9, 50])):
                if len(part) > 11 and k:
                    part[k] = "changed"
            at = rng.randint(0, len(text))
            text[at:at] = [x.upper() if rng.random() < .2 else x + "," for x in part]
        docs.append((d, " ".join(text)))
    docs += [(3, docs[3][1]), (None, docs[5][1]), (70, None), (71, "")]
    return docs, items, make_docs(docs), spark.createDataFrame(items, "item_id long, text string")


def test_finds_what_comparing_everything_finds(corpus):
    docs, items, d, b = corpus
    exact = brute(docs, items)
    got = {(r.doc_id, r.item_id): r for r in find_contamination(d, b).collect()}
    assert set(got) <= set(exact) and len(exact) > 15
    # seeds can miss an overlap with unlucky substitutions; not one that has a run of 12 equal tokens
    assert len(got) >= 0.95 * len(exact)
    for k, r in got.items():
        assert r.matched <= exact[k] and r.similarity == r.matched / r.window >= 0.8


def test_masks_tolerate_any_substitution_of_one_token():
    """A window of 13 equal tokens but one is hit by some mask at some place."""
    for hole in range(13):
        a, b = tokens(" ".join(f"t{i}" for i in range(13))), tokens(" ".join("x" if i == hole else f"t{i}" for i in range(13)))
        assert any((seeds(a, m) == seeds(b, m)).any() for m in MASKS)


def test_masks_tolerate_every_pattern_the_overlap_tolerates():
    for n in range(5, 15):
        a = tokens(" ".join(f"t{i}" for i in range(n)))
        masks = MASKS if n >= 12 else short_masks(n, 0.8)
        for holes in range(3):
            if n - holes >= 0.8 * min(n, 13):
                for ignored in combinations(range(n), holes):
                    b = tokens(" ".join("x" if i in ignored else f"t{i}" for i in range(n)))
                    assert any((seeds(a, m) == seeds(b, m)).any() for m in masks), (n, ignored)


def test_substitutions_hide_no_item(spark, make_docs):
    """Items of 5 to 13 tokens, each with all patterns of as many substitutions as their overlap tolerates."""
    items = [(n, " ".join(f"i{n}t{k}" for k in range(n))) for n in range(5, 14)]
    docs, expected = [], set()
    for n, item in items:
        for ignored in combinations(range(n), 1 if n < 10 else 2):
            words = ["x" if k in ignored else w for k, w in enumerate(item.split())]
            expected.add((len(docs), n))
            docs.append((len(docs), " ".join(["before", *words, "after"])))
    got = find_contamination(make_docs(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected


def test_clean_documents_stay(corpus):
    docs, items, d, b = corpus
    left = drop_contaminated(d, b)
    flagged = {r.doc_id for r in find_contamination(d, b).select("doc_id").collect()}
    assert left.columns == d.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((i for i, _ in docs if i not in flagged), key=str)


def test_empty_tables(corpus, spark):
    _, _, d, b = corpus
    assert find_contamination(d.limit(0), b).count() == 0
    assert find_contamination(d, b.limit(0)).count() == 0
    assert drop_contaminated(d, b.limit(0)).count() == d.count()


def test_query_finds_the_benchmark_in_the_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in op3_decontamination(spark, SF_SMALL).collect()}
    assert {(d, i) for d, t in docs.items() for i, x in items.items() if x in t} <= got
    assert all(brute([(d, docs[d])], [(i, items[i])]) for d, i in got)


def test_long_text(awkward, spark):
    item = awkward.where("doc_id = 6").first().text.split(" ")[9000:9040]
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert sorted(r.doc_id for r in find_contamination(awkward, b).collect()) == [6, 7]


def test_rows_are_judged_by_id_and_text(spark, make_docs):
    item = " ".join(f"t{i}" for i in range(20))
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = make_docs([(None, item), (None, "clean one"), (5, "clean two"), (5, "x " + item), (5, "x " + item), (6, None), (7, "")])
    left = drop_contaminated(docs, b)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(None, "clean one"), (5, "clean two"), (6, None), (7, "")], key=str)
    assert sorted(((r.doc_id, r.item_id) for r in find_contamination(docs, b).collect()), key=str) == [(5, 1), (None, 1)]
