"""Token counts: an exact histogram of encoded document lengths.

Documents are encoded in the tasks and reduced to (length, documents) rows at
once; everything else is answered from that histogram by running sums, so no
text or document row is ever shuffled.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import running_sums

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published split pattern of the byte-level vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Upper bound of a vocabulary file that is sent to the executors.
MAX_VOCABULARY_BYTES = 64 << 20
BUCKET = 1024


def _encoding(vocabulary: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def length_histogram(docs: DataFrame, tokenizer: str = TOKENIZER, pattern: str = PATTERN,
                     text: str = "text") -> DataFrame:
    """(n_tokens, docs): how many documents encode to each number of tokens.

    Null and empty texts have length 0; repeated rows count each time; an
    empty table has an empty histogram. Whole texts are encoded. Other columns
    are not read, so clashing names don't matter.
    """
    vocabulary = Path(tokenizer).read_bytes()
    if len(vocabulary) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{tokenizer} is larger than {MAX_VOCABULARY_BYTES} bytes")
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(shipped.value, pattern).encode_ordinary
        seen: Counter[int] = Counter()
        for batch in batches:
            seen.update(len(encode(x.as_py())) if x.is_valid else 0 for x in batch.column(0))
        yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(seen.keys(), pa.int64()),
                                          "docs": pa.array(seen.values(), pa.int64())})

    parts = docs.select(F.col(text).cast("string")).mapInArrow(lengths, "n_tokens long, docs long")
    return parts.groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def length_report(histogram: DataFrame) -> DataFrame:
    """One row per occurring length, answering for the context limit of that length.

    n_tokens, docs; docs_fit / tokens_fit: documents of at most this length and
    their tokens; docs_over / tokens_over: the longer ones (suffix sums);
    truncated_tokens: tokens left when every document is cut to this limit;
    quantile: share of documents that fit. Between two lengths a limit's
    answers follow from the next lower row: see ``truncated_total``.
    """
    sums = {"docs_fit": F.col("docs"), "tokens_fit": F.col("docs") * F.col("n_tokens")}
    h = running_sums(histogram.select("n_tokens", "docs", F.expr(f"n_tokens div {BUCKET}").alias("bucket")),
                     "bucket", [F.col("n_tokens")], sums)
    total = histogram.agg(F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("n_tokens")).alias("t"))
    all_docs, all_tokens = total.select("d").scalar(), total.select("t").scalar()
    return h.select(
        "n_tokens", "docs", "docs_fit", "tokens_fit",
        (all_docs - F.col("docs_fit")).alias("docs_over"),
        (all_tokens - F.col("tokens_fit")).alias("tokens_over"),
        (F.col("tokens_fit") + F.col("n_tokens") * (all_docs - F.col("docs_fit"))).alias("truncated_tokens"),
        (F.col("docs_fit") / all_docs).alias("quantile"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> Column:
    """Scalar: tokens left when every document is cut to ``limit`` tokens (0 without documents)."""
    kept = F.least(F.col("n_tokens"), F.lit(limit)) * F.col("docs")
    return histogram.agg(F.coalesce(F.sum(kept), F.lit(0)).alias("x")).scalar()


def length_quantile(histogram: DataFrame, q: float) -> Column:
    """Scalar: the smallest length that at least a share q of the documents fit (null without documents)."""
    report = length_report(histogram)
    return report.where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("x")).scalar()
