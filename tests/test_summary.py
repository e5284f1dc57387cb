"""The kept yearly summary equals the full recomputation after every load."""

from __future__ import annotations

import random

import pytest

from marquee.operators.clean import clean_titles
from marquee.operators import reports as R
from marquee.plans import analyses as A
from marquee.plans.jobs import run_month
from marquee.plans.summary import CatalogSummary, OutdatedSummaryError
from marquee.sources.store import CatalogStore
from tests.conftest import raw_row
from tests.test_upsert import Interleaved


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def some_rows(rng, months):
    pick = rng.choice
    names = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
    return [raw_row(pick([None, "h", *(f"k{i}" for i in range(25))]), type=pick(["Movie", "TV Show", None]),
                    country=pick([None, "A", "A, B", "B,C, A", ", C", "D"]), duration=pick([None, "90 min", "2 Seasons", "71 min"]),
                    release_year=pick([None, 1990, 2003]), date_added=f"{names[pick(months) % 12]} 3, {pick([2019, 2020, 2021])}")
            for _ in range(40)]


def test_equal_after_each_of_twelve_loads(spark, make_raw, tmp_path):
    rng = random.Random(4)
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    summary = CatalogSummary(store)
    for i in range(12):
        batch = f"b{i % 5}" if i % 2 else None          # some loads replace their rows without an id
        store.publish_replace(*clean_titles(make_raw(some_rows(rng, [i, i + 1]))), batch=batch)
        assert summary.refresh() == [i + 1]
        titles = store.read()[0]
        assert rows_of(summary.read()) == rows_of(A.j1_yearly_summary(titles)), i
        for home in ("A", "D") if i % 3 == 2 else "A":
            assert rows_of(summary.share(home)) == rows_of(A.e3_non_us_share(titles, home)), i
        if i == 6:
            assert rows_of(summary.latest(2)) == rows_of(A.j2_latest_years(titles, 2))
    assert summary.refresh() == []
    keys = summary._scan("keys", [1]).select("show_id").where("show_id is not null")
    old, _, _ = summary._before(keys.where("show_id in ('h', 'k0')"), list(range(2, 13)))
    assert "GreaterThanOrEqual(show_id,h), LessThanOrEqual(show_id," in old._jdf.queryExecution().toString()


def test_what_touched_keys_had_is_found_once_a_load(spark, make_raw, tmp_path):
    rng = random.Random(11)
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    summary = CatalogSummary(store)
    for _ in range(2):
        store.publish_replace(*clean_titles(make_raw(some_rows(rng, [1, 2]))))
    summary.refresh()
    keys = summary._scan("keys", [2]).select("show_id")
    for df in summary._before(keys, [1]):           # the search for a key's last load isn't repeated in each change
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "LeftSemi" not in plan
    assert rows_of(summary.read()) == rows_of(A.j1_yearly_summary(store.read()[0]))


def test_late_loads_compaction_and_rebuild(spark, make_raw, tmp_path):
    rng = random.Random(9)
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    summary = CatalogSummary(store)
    load = lambda: clean_titles(make_raw(some_rows(rng, [1, 2])))
    store.publish_replace(*load())
    late = Interleaved(store, *load())
    store.publish_replace(*load())
    assert summary.refresh() == [1, 3]
    late.finish()
    assert summary.refresh() == [2]
    assert rows_of(summary.read()) == rows_of(A.j1_yearly_summary(store.read()[0]))
    assert rows_of(summary.share("A")) == rows_of(A.e3_non_us_share(store.read()[0], "A"))
    store.compact()
    assert summary.refresh() == []                      # a compaction changes nothing
    store.publish_replace(*load())
    assert summary.refresh() == [5]
    assert rows_of(summary.read()) == rows_of(A.j1_yearly_summary(store.read()[0]))
    store.publish_replace(*load())
    store.compact()                                     # before the summary has seen the load
    with pytest.raises(OutdatedSummaryError):
        summary.refresh()
    summary.rebuild()
    store.publish_replace(*load())
    assert summary.refresh() == [8]
    assert rows_of(summary.read()) == rows_of(A.j1_yearly_summary(store.read()[0]))
    assert rows_of(summary.share("A")) == rows_of(A.e3_non_us_share(store.read()[0], "A"))


def test_the_command(spark, make_raw, tmp_path, capsys):
    from marquee.__main__ import main
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    run_month(spark, make_raw([raw_row("a"), raw_row("b", country=None)]), store, 2021, 1)
    assert main(["summary", "--store", f"file://{tmp_path}/s"]) == 0
    assert capsys.readouterr().out.splitlines()[-1].startswith("2021\t2\t2\t0\t90.0\t1")
    assert main(["summary", "--store", f"file://{tmp_path}/s", "--share", "Nowhere"]) == 0
    assert capsys.readouterr().out.splitlines()[-1] == "2021\t0\t1\t100.0"


def test_a_summary_without_shares_is_rebuilt(spark, make_raw, tmp_path):
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    run_month(spark, make_raw([raw_row("a", country="A, B"), raw_row("b", country="A")]), store, 2021, 1)
    summary = CatalogSummary(store)
    summary.refresh()
    marker = f"{summary.root}/v=000001/_COMPLETE"
    store._fs.delete(store._Path(marker), False)
    store._write_text(marker, "{}")
    for use in (summary.refresh, summary.share):
        with pytest.raises(OutdatedSummaryError):
            use()
    summary.rebuild()
    assert rows_of(summary.share("A")) == [(2021, 2, 1, 50.0)]


@pytest.mark.parametrize("seed", range(3))
def test_pruned_pairs_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    tags = [f"t{i:03d}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    rows = [(f"k{rng.randint(0, 150)}", rng.choices(tags, weights)[0]) for _ in range(900)]
    rows += [("rare", "t198"), ("rare", "t199")] * 9 + [(None, "t1"), ("k1", None)]
    g = spark.createDataFrame(rows, "show_id string, genre string")
    for k in (5, 4000):
        assert rows_of(R.tag_cooccurrence(g, k=k, seed_tags=R.SEED_TAGS)) == rows_of(R.tag_cooccurrence(g, k=k))


def test_rare_tags_do_not_enter_the_pair_join(spark):
    """A wide vocabulary: each key has three common tags and thirty of its own."""
    rows = spark.range(400).selectExpr("concat('k', id) as show_id", "explode(concat(array('a', 'b', 'c'), "
                                       "transform(sequence(1, 30), i -> concat('own', id, '-', i)))) as genre")

    def made(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        out, todo = [], [plan]
        while todo:
            p = todo.pop()
            name = p.nodeName()
            if name == "AdaptiveSparkPlan":
                todo.append(p.executedPlan())
            elif "QueryStage" in name:
                todo.append(p.plan())
            else:
                if "Join" in name and "LeftSemi" not in p.simpleString(25) and p.metrics().contains("numOutputRows"):
                    out.append(p.metrics().apply("numOutputRows").value())
                todo += [p.children().apply(i) for i in range(p.children().size())]
        return max(out)

    pruned, whole = (R.tag_cooccurrence(rows, k=3, seed_tags=n) for n in (8, 0))
    assert rows_of(pruned) == rows_of(whole)
    assert made(pruned) * 10 < made(whole)
