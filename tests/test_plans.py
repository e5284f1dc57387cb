"""Plan properties the scale design relies on (checked on final adaptive plans)."""

from __future__ import annotations

import re

import pytest

from marquee.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.plans import final_plan


@pytest.fixture(scope="module")
def plan_of(spark):
    cache: dict[str, str] = {}

    def get(name: str) -> str:
        if name not in cache:
            old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # see the real join shapes
            try:
                cache[name] = final_plan(QUERIES[name](spark, SF_SMALL))
            finally:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        return cache[name]
    return get


def joins(plan: str) -> int:
    return len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|CartesianProduct|BroadcastNestedLoopJoin)", plan))


@pytest.mark.parametrize("name", ["d3_genre_pairs", "skew_d3_genre_pairs", "brand_pairs", "h3_director_breadth",
                                  "j1_yearly_summary", "skew_j1_yearly_summary"])
def test_nothing_is_gathered_per_key(plan_of, name):
    assert not re.search(r"collect_(set|list)", plan_of(name))


@pytest.mark.parametrize("name", ["clean_titles", "clean_genres", "parse_added_date", "repair_shift"])
def test_row_wise_queries_have_no_exchange(plan_of, name):
    assert "Exchange" not in plan_of(name)


def test_many_tags_on_one_key(spark):
    """2,000 tags on one key: two million pairs, as rows."""
    from marquee.operators.reports import tag_cooccurrence
    bridge = spark.range(2000).selectExpr("'k' show_id", "concat('t', lpad(id, 5, '0')) genre").union(
        spark.sql("select 'm', explode(array('t00001', 't00002'))"))
    top = tag_cooccurrence(bridge, k=2).collect()
    assert [tuple(r) for r in top] == [("t00001", "t00002", 2), ("t00000", "t00001", 1)]


def test_reports_are_sorted(spark):
    from marquee.plans import analyses as A
    from marquee.plans.registry import tables
    t, g = tables(spark, SF_SMALL)
    for name, by in A.ORDERED.items():
        col = by.lstrip("-")
        got = [r[col] for r in A.REPORTS[name](t, g).collect()]
        key = lambda x: (x is None, (-x if by[0] == "-" else x) if x is not None else 0)
        assert got == sorted(got, key=key), name


def test_windows_only_over_aggregates(plan_of):
    for name in ("c3_series_length", "f1_ratings", "j1_yearly_summary", "e3_non_us_share"):
        assert "Window" not in plan_of(name)
    plan = plan_of("b2_growth")
    window_input = plan[plan.index("Window"):]
    assert "HashAggregate" in window_input   # the window sits on the per-year aggregate


@pytest.mark.parametrize("name", ["c3_series_length", "f1_ratings"])
def test_share_denominator_reuses_the_shuffle(plan_of, name):
    assert "ReusedExchange" in plan_of(name)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stream_", "store_"))))
def test_no_cartesian_or_python(plan_of, name):
    plan = plan_of(name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas", plan)
