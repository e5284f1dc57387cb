from __future__ import annotations

import pytest

import corpus_pipeline as P
from marquee.llm.common import read
from marquee.llm.decontaminate import find_contamination
from marquee.llm.line_dedup import dedup_lines
from marquee.llm.mixing import mix_sources
from marquee.llm.quality import classify
from marquee.llm.simhash import simhash_components
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into and comes out of every stage, written and read again."""
    base = tmp_path_factory.mktemp("stages")
    docs, out = read(spark, SF_SMALL, "documents"), []
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(f"file://{base}/{k}")
        after = spark.read.parquet(f"file://{base}/{k}")
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_stages_do_what_their_operators_say(spark, stages):
    columns = read(spark, SF_SMALL, "documents").columns
    assert [n for n, _, _ in stages] == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "source mixing"]
    assert all(after.columns == columns for _, _, after in stages[:-1])
    (_, b, a), *_ = stages
    assert ids(a) == sorted(r.doc_id for r in classify(b, read(spark, SF_SMALL, "labels")).collect() if r.predicted)
    _, b, a = stages[1]
    text = {r.doc_id: r.text for r in dedup_lines(b).collect()}
    assert {r.doc_id: r.text for r in a.collect()} == text and all(r.n_chars == len(r.text) for r in a.collect())
    _, b, a = stages[2]
    assert ids(a) == sorted({r.component_id for r in simhash_components(b).collect()})
    _, b, a = stages[3]
    bad = {r.doc_id for r in find_contamination(b, read(spark, SF_SMALL, "benchmark")).collect()}
    assert ids(a) == [d for d in ids(b) if d not in bad]
    _, b, a = stages[4]
    assert {(r.doc_id, r.taken) for r in a.collect()} == {(r.doc_id, r.taken) for r in mix_sources(b).collect() if r.taken}


def test_run_gives_the_last_stage(spark, stages):
    got = P.run(spark, SF_SMALL)
    last = stages[-1][2]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, last.select(*got.columns).collect()))


@pytest.mark.parametrize("k", range(5))
def test_awkward_rows_pass_every_stage(spark, awkward, k):
    out = P.STAGES[k][1](spark, awkward, SF_SMALL)
    assert out.columns[:len(awkward.columns)] == awkward.columns or k == 4
    out.collect()
    assert P.STAGES[k][1](spark, awkward.limit(0), SF_SMALL).count() == 0
