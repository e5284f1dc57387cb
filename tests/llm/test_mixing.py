from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from marquee.llm.mixing import mix_rows, mix_sources
from marquee.llm.queries import ORACLE, op8_mixing
from tests.conftest import SF_SMALL


def targets(sizes):
    """Share by weight, cap at three times the size, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    got, open_ = dict.fromkeys(names, 0.0), set(names)
    left = float(sum(sizes.values()))
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        full = {s for s in open_ if got[s] + share[s] >= 3 * sizes[s]}
        if not full:
            for s in open_:
                got[s] += share[s]
            break
        for s in full:
            left -= 3 * sizes[s] - got[s]
            got[s] = 3.0 * sizes[s]
        open_ -= full
    return got


def reference(rows):
    """The queue, one event after another."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        sizes[s] = sizes.get(s, 0) + n
    want = targets(sizes)
    rank = {s: i for i, s in enumerate(sorted((x for x in sizes if x is not None), key=lambda s: s.encode()) + [None])}
    key = [hashlib.md5(("mix:" + ("" if d is None else str(d))).encode()).hexdigest() for d, _, _ in rows]
    queue = []
    for s in sizes:
        upto = 0
        for i in sorted((i for i, r in enumerate(rows) if r[2] == s), key=lambda i: (key[i], rows[i][0] if rows[i][0] is not None else -1, size[i])):
            upto += size[i]
            if size[i]:
                queue += [((p * sizes[s] + upto) / want[s], rank[s], p, upto, i) for p in range(3)]
    used, taken = 0, [0] * len(rows)
    for *_, i in sorted(queue):
        used += size[i]
        if used > sum(size):
            break
        taken[i] += size[i]
    return sorted(((str(d), str(s), size[i], sizes[s], round(want[s], 6), taken[i]) for i, (d, _, s) in enumerate(rows)))


def result(df):
    return sorted((str(r.doc_id), str(r.source), r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_queue_played_through(spark, make_docs, seed):
    rng = random.Random(seed)
    names = ["a", "B", "é", "漢", "z", None]
    rows = [(d, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 5, 40, 200]))), rng.choice(names[:rng.randint(1, 6)] if seed else names))
            for d in range(80)]
    rows += [(100 + d, "x y", "a") for d in range(60)] + [(7, None, "a"), (None, "p q r", "B"), rows[3]]
    assert result(mix_sources(make_docs(rows))) == reference(rows)


def test_cases(spark, make_docs, awkward):
    assert mix_sources(awkward.limit(0)).count() == 0
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    assert result(mix_sources(awkward)) == reference(rows)
    nothing = mix_sources(make_docs([(1, ""), (2, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2
    mixed = mix_rows(awkward)
    assert set(mixed.columns) == {*awkward.columns, "size", "target", "taken", "copies"}
    taken = sorted((str(r.doc_id), r.taken) for r in mixed.collect())
    assert sum(t for _, t in taken) == sum(r.taken for r in mix_sources(awkward).collect())
    assert mix_rows(awkward.limit(0)).count() == 0


def test_query_equals_sql_agrees_on_reruns_and_uses_no_python(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    res = con.execute(ORACLE["op8_mixing"])
    names = [d[0] for d in res.description]
    df = op8_mixing(spark, SF_SMALL)
    got = sorted(tuple(r[n] for n in names) for r in df.collect())
    assert got == sorted(res.fetchall()) == sorted(tuple(r[n] for n in names) for r in op8_mixing(spark, SF_SMALL).collect())
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    by = {}
    for r in df.collect():
        by.setdefault(r.source, []).append(r)
        assert r.taken <= 3 * r.size
    for rows in by.values():                        # a source misses its target by less than a document
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows)
