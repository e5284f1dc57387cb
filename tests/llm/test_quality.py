from __future__ import annotations

import zlib

import numpy as np
import pytest

from marquee.llm.quality import classify, dual_descent, features, keep_good
from marquee.llm.queries import op4_quality
from tests.conftest import SF_MID


def test_descent_ends_at_the_minimum():
    """No nearby weights have a smaller hinge-loss objective."""
    rng = np.random.default_rng(1)
    rows = [np.flatnonzero(rng.random(40) < .3) for _ in range(80)]
    ratio = rng.normal(size=40)
    truth = rng.normal(size=40)
    y = np.array([1.0 if truth[r].sum() > 0 else -1.0 for r in rows])
    cost = np.ones(80)
    w = dual_descent(rows, y, ratio, cost, rounds=3000)
    x = np.array([[ratio[j] * (j in set(r)) for j in range(40)] for r in rows])
    x = np.c_[x / np.linalg.norm(x, axis=1, keepdims=True), np.ones(80)]
    primal = w @ w / 2 + np.maximum(0, 1 - y * (x @ w)).sum()
    better = [(v @ v / 2 + np.maximum(0, 1 - y * (x @ v)).sum()) for v in (w + rng.normal(size=41) * .05 for _ in range(200))]
    assert primal <= min(better) + 1e-6


def test_features_are_a_set_and_shapes_repeat():
    a, b, c = features(["Alpha beta&&& 12", "Alpha beta&&& 12 " * 3, None])
    assert len(set(a)) == len(a) and set(a) <= set(b) and len(c) == 0
    x, y = features(["ungh###", "zzor###"])
    assert set(x) & set(y) and set(x) != set(y)


def test_query_scores_held_out_rows_well(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    got = op4_quality(spark, SF_MID).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.3) for r in got)
    unseen = [(r.score, labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [s for s, q, _ in unseen if q], [s for s, q, _ in unseen if not q]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.97 and np.mean([p == q for _, q, p in unseen]) > 0.95


def test_scores_are_probabilities_of_unseen_rows(spark):
    """On held-out rows the mean score is near the share of label 1, overall and among the rows of low and of high scores."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    got = [(r.score, labels[r.doc_id]) for r in op4_quality(spark, SF_MID).collect() if r.held_out and labels.get(r.doc_id) is not None]
    for part in (got, [x for x in got if x[0] < .5], [x for x in got if x[0] >= .5]):
        assert len(part) > 10 and abs(np.mean([s for s, _ in part]) - np.mean([q for _, q in part])) < 0.1


@pytest.fixture
def small(make_docs, spark):
    rows = [(i, f"good words here number {i} and some more" if i % 3 else f"bad!!! junk$$$ {i} !!!! more###") for i in range(60)]
    labels = [(i, int(i % 3 > 0), 0, "x") for i in range(40)] + [(41, None, 0, "x"), (None, 1, 0, "x"), (5, 1, 0, "x"), (999, 0, 1, "x")]
    return make_docs([*rows, (7, rows[7][1]), (None, None), (70, ""), (71, rows[3][1] + " x" * 50_000)]), \
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score string")


def test_cases(small):
    docs, labels = small
    got = classify(docs, labels).collect()
    assert len(got) == 64 and [r.score for r in got if r.doc_id == 7][0] == [r.score for r in got if r.doc_id == 7][1]
    assert len({r.score for r in got if r.doc_id in (None, 70)}) == 1
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 60)
    left = keep_good(docs, labels)
    assert left.columns == docs.columns
    kept = sorted((r.doc_id for r in left.collect()), key=str)
    assert kept == sorted((r.doc_id for r in got if r.predicted), key=str)


def test_without_labels_or_rows(small):
    docs, labels = small
    assert {r.score for r in classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in classify(docs, labels.where("quality = 1")).collect()} == {0.5}
    assert classify(docs.limit(0), labels).count() == 0 and keep_good(docs.limit(0), labels).count() == 0
    assert keep_good(docs, labels.limit(0)).count() == docs.count()


def test_labels_outside_the_fold_are_not_read(small, spark):
    """Turning every held-out label round changes no score."""
    docs, labels = small
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end quality", "toxic")
    score = lambda t: sorted((str(r.doc_id), r.score) for r in classify(docs, t).collect())
    assert score(labels) == score(flipped)
