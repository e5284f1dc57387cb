from __future__ import annotations

import base64

import pytest
import tiktoken

from marquee.llm.queries import op10_token_counts
from marquee.llm.token_counts import PATTERN, TOKENIZER, length_histogram, length_quantile, length_report, truncated_total
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def encode():
    with open(TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def check(rows, lengths):
    assert {r.n_tokens: r.docs for r in rows} == {n: lengths.count(n) for n in lengths}
    for r in rows:
        limit = r.n_tokens
        assert r.docs_fit == sum(n <= limit for n in lengths) and r.docs_over == sum(n > limit for n in lengths)
        assert r.tokens_fit == sum(n for n in lengths if n <= limit) and r.tokens_over == sum(n for n in lengths if n > limit)
        assert r.truncated_tokens == sum(min(n, limit) for n in lengths) and r.quantile == r.docs_fit / len(lengths)


def test_query_equals_counting(spark, encode):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(op10_token_counts(spark, SF_SMALL).collect(), [len(encode(t)) for t in texts])


def test_cases(spark, awkward, encode):
    lengths = [len(encode(r.text or "")) for r in awkward.collect()]
    h = length_histogram(awkward)
    check(length_report(h).collect(), lengths)
    one = spark.range(1)
    for limit in (0, 1, 3, 5000, 10**9):
        assert one.select(truncated_total(h, limit).alias("x")).first().x == sum(min(n, limit) for n in lengths)
    for q in (0.1, 0.5, 1.0):
        want = min(n for n in lengths if sum(m <= n for m in lengths) >= q * len(lengths))
        assert one.select(length_quantile(h, q).alias("x")).first().x == want
    empty = length_histogram(awkward.limit(0))
    assert empty.count() == 0 and length_report(empty).count() == 0
    assert one.select(truncated_total(empty, 5).alias("x")).first().x == 0
    assert one.select(length_quantile(empty, .5).alias("x")).first().x is None
