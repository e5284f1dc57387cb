"""Registered queries of the operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm.class_lm import score_corpus
from marquee.llm.common import materialize, read
from marquee.llm.decontaminate import find_contamination
from marquee.llm.html_extract import extract_pages
from marquee.llm.line_dedup import dedup_lines
from marquee.llm.mixing import mix_sources
from marquee.llm.pii import find_personal_data
from marquee.llm.quality import classify
from marquee.llm.resample import resample
from marquee.llm.simhash import simhash_components
from marquee.llm.spelling import spelling_variants
from marquee.llm.spotsigs import fingerprint_edits
from marquee.llm.suffix_dedup import remove_repeats
from marquee.llm.token_counts import length_histogram, length_report


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(read(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), with_bytes=False)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents")).drop("edited")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_report(materialize(length_histogram(read(spark, sf_dir, "documents"))))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extraction, op2_simhash, op3_decontamination, op4_quality, op5_class_lm, op6_suffix_dedup,
                                op7_line_dedup, op8_mixing, op9_spotsigs, op10_token_counts,
                                op11_spelling_variants, op12_importance_resampling, op13_personal_data)
}

#: The mix in SQL: the same shuffle, virtual finish times and cut, by plain windows.
_MIX = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM d GROUP BY source),
w AS (SELECT *, ((rk - 1) % 3 + 1)::DOUBLE AS weight, (3 * source_size)::DOUBLE AS cap FROM s),
r AS (
  SELECT *, row_number() OVER o AS cr,
         (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, rk)),
f AS (SELECT arg_min(level, cr) AS level FROM r WHERE cap > weight * level),
t AS (SELECT r.source, source_size, rk, CASE WHEN cap <= weight * r.level THEN cap ELSE weight * f.level END AS target
      FROM r, f),
p AS (
  SELECT d.*, t.source_size, t.rk, t.target, row_number() OVER () AS id,
         sum(size) OVER (PARTITION BY t.rk ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT id, size, rk, pass, upto, (pass * source_size + upto)::DOUBLE / target AS finish
  FROM p, (SELECT unnest([0, 1, 2]) AS pass) WHERE size > 0 AND target > 0),
u AS (SELECT id, size, sum(size) OVER (ORDER BY finish, rk, pass, upto ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM q),
c AS (SELECT id, sum(size)::BIGINT AS taken FROM u WHERE used <= (SELECT sum(size) FROM d) GROUP BY id)
SELECT p.doc_id, p.source, p.size, p.source_size, p.target, coalesce(c.taken, 0)::BIGINT AS taken
FROM p LEFT JOIN c USING (id)
"""

ORACLE: dict[str, str] = {"op8_mixing": _MIX}
