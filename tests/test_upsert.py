"""Keyed load, versioned store, monthly run and one-pass backfill."""

from __future__ import annotations

import os
from collections import Counter

import pytest

from marquee.operators.clean import clean_titles
from marquee.operators.upsert import replace_by_key, upsert_catalog
from marquee.plans.jobs import apply_month, backfill, backfill_tables, read_stage, run_month, write_month_stage
from marquee.schema import GENRES_SCHEMA, TITLES_SCHEMA
from marquee.sources.store import CatalogStore, ConcurrentLoadError, MissingInputError
from tests.conftest import raw_row


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def empty(spark):
    return spark.createDataFrame([], TITLES_SCHEMA), spark.createDataFrame([], GENRES_SCHEMA)


@pytest.fixture
def moving_raw(make_raw):
    # "a" moves from January to March with new values; "n" has a null id in
    # two months; "b" stays in January; "c" appears twice within February.
    return make_raw([
        raw_row("a", date_added="January 3, 2021", rating="PG", listed_in="X, Y"),
        raw_row("b", date_added="January 9, 2021", listed_in="Z"),
        raw_row(None, date_added="January 10, 2021", listed_in="N1"),
        raw_row("c", date_added="February 2, 2021", listed_in="C1"),
        raw_row("c", date_added="February 3, 2021", title="c again", listed_in="C2"),
        raw_row("a", date_added="March 4, 2021", rating="R", listed_in="W"),
        raw_row(None, date_added="March 10, 2021", listed_in="N2"),
        raw_row("u", date_added=None, listed_in="U"),
    ])


def loop(spark, raw, months):
    t, g = empty(spark)
    for y, m in months:
        t, g = apply_month(t, g, raw, y, m)
    return t, g


MONTHS = [(2021, 1), (2021, 2), (2021, 3), (2021, 4)]


def test_later_month_replaces_key(spark, moving_raw):
    t, g = loop(spark, moving_raw, MONTHS)
    rows = [r for r in t.collect() if r.show_id == "a"]
    assert len(rows) == 1 and rows[0].rating == "R"
    assert sorted(r.genre for r in g.collect() if r.show_id == "a") == ["W"]


def test_null_ids_and_in_batch_duplicates_are_kept(spark, moving_raw):
    t, g = loop(spark, moving_raw, MONTHS)
    assert sum(r.show_id is None for r in t.collect()) == 2
    assert sum(r.show_id == "c" for r in t.collect()) == 2
    assert sorted(r.genre for r in g.collect() if r.show_id is None) == ["N1", "N2"]


def test_undated_rows_never_load(spark, moving_raw):
    t, _ = loop(spark, moving_raw, MONTHS)
    assert "u" not in {r.show_id for r in t.collect()}


def test_rerun_is_idempotent_for_non_null_keys(spark, moving_raw):
    t1, g1 = apply_month(*empty(spark), moving_raw, 2021, 2)
    t2, g2 = apply_month(t1, g1, moving_raw, 2021, 2)
    assert bag(t1) == bag(t2) and bag(g1) == bag(g2)


def test_null_key_rows_duplicate_on_rerun(spark, moving_raw):
    t1, _ = apply_month(*empty(spark), moving_raw, 2021, 1)
    t2, _ = apply_month(t1, _, moving_raw, 2021, 1)
    assert sum(r.show_id is None for r in t2.collect()) == 2


def test_empty_month_changes_nothing(spark, moving_raw):
    t1, g1 = apply_month(*empty(spark), moving_raw, 2021, 1)
    t2, g2 = apply_month(t1, g1, moving_raw, 2021, 4)
    assert bag(t1) == bag(t2) and bag(g1) == bag(g2)


def test_backfill_equals_monthly_loop(spark, moving_raw):
    t_loop, g_loop = loop(spark, moving_raw, MONTHS)
    t_one, g_one = backfill_tables(*empty(spark), moving_raw, MONTHS[0], MONTHS[-1])
    assert bag(t_loop) == bag(t_one)
    assert bag(g_loop) == bag(g_one)


def test_backfill_onto_existing_target(spark, moving_raw, make_raw):
    seed_t, seed_g = clean_titles(make_raw([raw_row("a", date_added="May 1, 2020", listed_in="OLD"),
                                            raw_row("z", date_added="May 2, 2020", listed_in="Z0")]))
    t_loop, g_loop = seed_t, seed_g
    for y, m in MONTHS:
        t_loop, g_loop = apply_month(t_loop, g_loop, moving_raw, y, m)
    t_one, g_one = backfill_tables(seed_t, seed_g, moving_raw, MONTHS[0], MONTHS[-1])
    assert bag(t_loop) == bag(t_one) and bag(g_loop) == bag(g_one)
    assert "OLD" not in {r.genre for r in g_one.collect()}


def test_replace_by_key_keys_from_titles(spark, make_raw):
    old_t, old_g = clean_titles(make_raw([raw_row("a", listed_in="G1, G2"), raw_row("b", listed_in="G3")]))
    new_t, new_g = clean_titles(make_raw([raw_row("a", listed_in="G9")]))
    t, g = upsert_catalog(old_t, old_g, new_t, new_g)
    assert sorted((r.show_id, r.genre) for r in g.collect()) == [("a", "G9"), ("b", "G3")]
    assert sorted(r.show_id for r in t.collect()) == ["a", "b"]
    # plain replace: schema of the target is kept
    assert replace_by_key(old_t, new_t).schema == old_t.schema


def test_store_versions_and_markers(spark, moving_raw, tmp_path):
    store = CatalogStore(spark, f"file://{tmp_path}/store")
    assert store.latest() is None
    t0, g0 = store.read()
    assert t0.count() == 0 and t0.schema == TITLES_SCHEMA
    for y, m in MONTHS:
        run_month(spark, moving_raw, store, y, m)
    assert store.versions() == [1, 2, 3, 4]
    t_loop, g_loop = loop(spark, moving_raw, MONTHS)
    t_st, g_st = store.read()
    assert bag(t_st) == bag(t_loop) and bag(g_st) == bag(g_loop)
    # a crashed load (data but no marker) is invisible and is skipped over
    (tmp_path / "store" / "v=000005" / "titles").mkdir(parents=True)
    assert store.latest() == 4
    v = backfill(spark, moving_raw, CatalogStore(spark, f"file://{tmp_path}/one"), MONTHS[0], MONTHS[-1])
    assert v == 1
    assert bag(CatalogStore(spark, f"file://{tmp_path}/one").read()[0]) == bag(t_loop)
    # staged copies are gone after the loads
    assert os.listdir(tmp_path / "store" / "_stage") == [] and os.listdir(tmp_path / "one" / "_stage") == []
    # nothing can be pruned before a compaction: later versions build on the first ones
    assert store.prune(keep=1) == []
    assert store.compact() == 6
    assert bag(store.read()[0]) == bag(t_loop) and bag(store.read()[1]) == bag(g_loop)
    assert store.prune(keep=1) == [1, 2, 3, 4, 5]
    assert bag(store.read()[0]) == bag(t_loop)


def test_a_load_writes_only_its_batch(spark, make_raw, tmp_path):
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    many = make_raw([raw_row(f"k{i}", date_added="January 5, 2021") for i in range(500)]
                    + [raw_row("k3", date_added="February 5, 2021", title="new")])
    run_month(spark, many, store, 2021, 1)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "s" / "v=000001").rglob("*")}
    v = run_month(spark, many, store, 2021, 2)
    assert spark.read.parquet(f"file://{tmp_path}/s/v={v:06d}/titles").count() == 1
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "s" / "v=000001").rglob("*")} == before
    titles, _ = store.read()
    assert titles.count() == 500 and [r.title for r in titles.collect() if r.show_id == "k3"] == ["new"]


def test_second_writer_of_a_version_fails(spark, moving_raw, tmp_path, monkeypatch):
    one, two = (CatalogStore(spark, f"file://{tmp_path}/s") for _ in range(2))
    run_month(spark, moving_raw, one, 2021, 1)
    monkeypatch.setattr(two, "versions", lambda complete_only=True: [])     # listed before the other's claim
    with pytest.raises(ConcurrentLoadError):
        two.publish_replace(*clean_titles(moving_raw))
    assert one.versions() == [1] and bag(one.read()[0]) == bag(loop(spark, moving_raw, [(2021, 1)])[0])


def test_stage_io(spark, moving_raw, tmp_path):
    root = f"file://{tmp_path}/stage"
    with pytest.raises(MissingInputError):
        read_stage(spark, f"{root}/added_month=2021-01", TITLES_SCHEMA)
    t, _ = clean_titles(moving_raw)
    p = write_month_stage(t, root, 2021, 1)
    assert read_stage(spark, p, TITLES_SCHEMA).count() == t.count()
    p = write_month_stage(t.limit(0), root, 2021, 1)  # an empty month replaces the old one
    assert read_stage(spark, p, TITLES_SCHEMA).count() == 0


def test_run_month_logs_stage_counts(spark, moving_raw, tmp_path, caplog):
    import logging
    caplog.set_level(logging.INFO, logger="marquee.jobs")
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    run_month(spark, moving_raw, store, 2021, 2)
    assert any("titles 2 rows, genres 2 rows" in r.getMessage() for r in caplog.records)


def test_reports_on_store_equal_in_memory(spark, tmp_path):
    from marquee.plans import analyses as A
    from marquee.plans.registry import raw, tables
    from tests.conftest import SF_SMALL
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    source = raw(spark, SF_SMALL, edge=True)
    backfill(spark, source, store, (1990, 1), (1997, 12))
    run_month(spark, source, store, 1998, 1)
    backfill(spark, source, store, (1998, 2), (2010, 12))
    st, sg = store.read()
    from marquee.plans.jobs import backfill_tables
    mt, mg = backfill_tables(*empty(spark), source, (1990, 1), (2010, 12))
    assert bag(st) == bag(mt) and bag(sg) == bag(mg)
    for fn in (lambda t, g: A.d3_genre_pairs(g), lambda t, g: A.d2_rising_genres(g, t, (1996, 1998), (1999, 2001), 1),
               lambda t, g: A.h3_director_breadth(t, g, min_titles=1), lambda t, g: A.j1_yearly_summary(t),
               lambda t, g: A.e3_non_us_share(t, "C1"), lambda t, g: A.f1_ratings(t)):
        assert bag(fn(st, sg)) == bag(fn(mt, mg))


def test_hot_and_null_keys_in_the_store(spark, make_raw, tmp_path):
    hot = [raw_row("h", date_added="January 3, 2021", listed_in="X")] * 30
    hot += [raw_row(None, date_added="January 4, 2021")] * 5
    hot += [raw_row(f"k{i}", date_added="January 5, 2021") for i in range(10)]
    raw = make_raw(hot + [raw_row("a", date_added="February 1, 2021"), raw_row("h", date_added="February 2, 2021")])
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    for m in (1, 2):
        run_month(spark, raw, store, 2021, m)
    t_loop, g_loop = loop(spark, raw, [(2021, 1), (2021, 2)])
    assert bag(store.read()[0]) == bag(t_loop) and bag(store.read()[1]) == bag(g_loop)


def test_month_stage_read_is_partition_pruned(spark, moving_raw, tmp_path):
    from pyspark.sql import types as T
    from marquee.plans.jobs import read_month_stage
    from marquee.operators.ingest import month_slice
    root = f"file://{tmp_path}/stage"
    for m in (1, 2, 3):
        write_month_stage(month_slice(moving_raw, 2021, m), root, 2021, m)
    schema = T.StructType(moving_raw.schema.fields + [T.StructField("added_month", T.StringType())])
    feb = read_month_stage(spark, root, 2021, 2, schema)
    assert sorted(r.show_id for r in feb.collect()) == ["c", "c"]
    plan = feb._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(added_month" in plan and "2021-02" in plan
    with pytest.raises(MissingInputError):
        read_month_stage(spark, root, 2021, 7, schema)


def test_month_stage_requires_existing_folder_on_request(spark, moving_raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        write_month_stage(moving_raw, f"file://{tmp_path}/missing", 2021, 1, require_dir=True)
    (tmp_path / "present").mkdir()
    assert write_month_stage(moving_raw, f"file://{tmp_path}/present", 2021, 1, require_dir=True)


def test_latest_month_takes_two_references(spark, moving_raw):
    from marquee.operators.ingest import latest_month_rows, tag_months
    plan = latest_month_rows(tag_months(moving_raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") == 2 and "Union" not in plan


def test_a_hot_key_is_dealt_to_many_tasks(spark):
    from collections import Counter as C
    from pyspark.sql import functions as F
    from marquee.operators.ingest import latest_month_rows
    rows = spark.range(6000).selectExpr(
        "if(id % 3 = 0, null, if(id % 3 = 1, 'hot', concat('k', id div 5))) show_id", "concat('t', id) title", "date_add(date'2020-01-01', int(id % 90)) d")
    tagged = rows.withColumn("added_month", F.trunc("d", "month"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = [tuple(r) for r in latest_month_rows(tagged).withColumn("_p", F.spark_partition_id()).collect()]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    every = [tuple(r) for r in tagged.collect()]
    last = {}
    for k, _, _, m in every:
        last[k] = max(m, last.get(k, m))
    assert C(r[:-1] for r in got) == C(r for r in every if r[0] is None or r[3] == last[r[0]])
    for k in (None, "hot"):
        places = C(r[-1] for r in got if r[0] == k)
        assert len(places) == 8 and max(places.values()) < sum(places.values()) / 2


def test_apply_months_with_checkpoints_equals_backfill(spark, moving_raw):
    from marquee.plans.jobs import apply_months
    t_loop, g_loop = apply_months(*empty(spark), moving_raw, MONTHS, checkpoint_every=2)
    t_one, g_one = backfill_tables(*empty(spark), moving_raw, MONTHS[0], MONTHS[-1])
    assert bag(t_loop) == bag(t_one) and bag(g_loop) == bag(g_one)
    # the lineage was cut: the plan starts from the checkpointed data and holds
    # only the anti joins of the months after the last checkpoint
    plan = t_loop._jdf.queryExecution().logical().toString()
    assert "LogicalRDD" in plan and plan.count("LeftAnti") == 2


def test_older_versions_stay_readable(spark, moving_raw, tmp_path):
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    v1 = run_month(spark, moving_raw, store, 2021, 1)
    v2 = run_month(spark, moving_raw, store, 2021, 3)
    t1, _ = store.read(v1)
    t2, _ = store.read(v2)
    assert {r.show_id for r in t1.collect() if r.show_id} == {"a", "b"}
    assert [r.rating for r in t1.collect() if r.show_id == "a"] == ["PG"]
    assert [r.rating for r in t2.collect() if r.show_id == "a"] == ["R"]


def test_a_killed_stage_write_leaves_the_old_month(spark, moving_raw, tmp_path, monkeypatch):
    from pyspark.sql import types as T
    from marquee.operators.ingest import month_slice
    from marquee.plans import jobs
    root = f"file://{tmp_path}/stage"
    schema = T.StructType(moving_raw.schema.fields + [T.StructField("added_month", T.StringType())])
    read = lambda: sorted(str(r.show_id) for r in jobs.read_month_stage(spark, root, 2021, 1, schema).collect())
    write_month_stage(month_slice(moving_raw, 2021, 1), root, 2021, 1)
    old = read()
    assert old == ["None", "a", "b"]
    # killed after the data, before the switch
    real = jobs._file_system
    monkeypatch.setattr(jobs, "_file_system", lambda s, p: (real(s, p)[0], type("Dead", (), {
        "exists": real(s, p)[1].exists, "listStatus": real(s, p)[1].listStatus})()))
    with pytest.raises(AttributeError):
        write_month_stage(month_slice(moving_raw, 2021, 2), root, 2021, 1)
    monkeypatch.undo()
    assert read() == old
    # killed in the data: a file that can't be produced
    from pyspark.sql import functions as F
    with pytest.raises(Exception, match="killed"):
        write_month_stage(moving_raw.withColumn("title", F.raise_error(F.lit("killed")).cast("string")), root, 2021, 1)
    assert read() == old
    for m in (2, 3, 1):
        write_month_stage(month_slice(moving_raw, 2021, m), root, 2021, 1)
    assert read() == old
    assert len(list((tmp_path / "stage" / "added_month=2021-01").glob("run=*"))) == 2       # the last and the one before


def test_jobs_count_without_a_second_pass(spark, moving_raw, tmp_path, monkeypatch):
    """L4: the stage write observes the counts; no other job reads the source or the stage for them."""
    from marquee.plans import jobs
    staged, stats = jobs.stage(spark, moving_raw, f"file://{tmp_path}/s")
    genres = clean_titles(moving_raw)[1].count()
    assert (stats.titles, stats.genres) == (moving_raw.count(), genres) and staged.count() == stats.titles
    from marquee.schema import RAW_SCHEMA, empty_frame
    assert jobs.stage(spark, empty_frame(spark, RAW_SCHEMA), f"file://{tmp_path}/e")[1] == jobs.BatchStats(0, 0)
    assert jobs.stage(spark, moving_raw.where("show_id = 'none'"), f"file://{tmp_path}/f")[1] == jobs.BatchStats(0, 0)


class Interleaved:
    """A load in two halves: claimed and written, and published when asked to."""

    def __init__(self, store, titles, genres, **facts):
        self.store, self.facts = store, {"base": False, "streams": {}} | facts
        self.v = store._claim()
        for kind, df in (("titles", titles), ("genres", genres)):
            df.write.parquet(f"{store._vdir(self.v)}/{kind}")

    def finish(self):
        import json
        self.store._write_text(f"{self.store._vdir(self.v)}/_COMPLETE", json.dumps(self.facts))


def one(make_raw, key, title, genre="G"):
    return clean_titles(make_raw([raw_row(key, title=title, listed_in=genre)]))


def state(store):
    t, g = store.read()
    return sorted((str(r.show_id), r.title) for r in t.collect()), sorted((str(r.show_id), r.genre) for r in g.collect())


@pytest.mark.parametrize("compactions", [1, 2])
def test_a_load_that_finishes_after_a_compaction_is_kept(spark, make_raw, tmp_path, compactions):
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    store.publish_replace(*one(make_raw, "a", "a1"))
    late = Interleaved(store, *one(make_raw, "b", "b2"), streams={"q": 7})
    for _ in range(compactions):
        store.compact()
    assert state(store) == ([("a", "a1")], [("a", "G")]) and store.stream_progress("q") is None
    store.prune(keep=1)                                     # never takes what is being written
    late.finish()
    assert state(store) == ([("a", "a1"), ("b", "b2")], [("a", "G"), ("b", "G")])
    assert store.stream_progress("q") == 7
    store.compact()
    store.prune(keep=1)
    assert state(store)[0] == [("a", "a1"), ("b", "b2")] and store.stream_progress("q") == 7


def test_a_late_load_takes_its_place_between_compacted_ones(spark, make_raw, tmp_path):
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    store.publish_replace(*clean_titles(make_raw([raw_row("x", title="x1", listed_in="old"), raw_row("y", title="y1")])))
    rows = [raw_row("x", title="x2", listed_in="two"), raw_row("y", title="y2"), raw_row("z", title="z2")]
    late = Interleaved(store, *clean_titles(make_raw(rows)))
    store.publish_replace(*clean_titles(make_raw([raw_row("x", title="x3", listed_in="three")])))
    want = [("x", "x3"), ("y", "y2"), ("z", "z2")]
    base = store.compact()
    assert store.facts(base)["open"] == [2] and state(store)[0] == [("x", "x3"), ("y", "y1")]
    late.finish()
    assert state(store)[0] == want and ("x", "three") in state(store)[1] and ("x", "two") not in state(store)[1]
    store.compact()
    store.prune(keep=1)
    assert state(store)[0] == want
    store.publish_replace(*one(make_raw, "z", "z5"))
    assert state(store)[0] == [*want[:2], ("z", "z5")]


def test_two_compactions_side_by_side_lose_nothing(spark, make_raw, tmp_path, monkeypatch):
    store, other = (CatalogStore(spark, f"file://{tmp_path}/s") for _ in range(2))
    store.publish_replace(*one(make_raw, "a", "a1"))
    listed = other.parts()
    store.publish_replace(*one(make_raw, "b", "b2"))
    assert store.compact() == 3
    monkeypatch.setattr(other, "parts", lambda version=None: listed)    # it had listed before the load of b
    assert other.compact() == 4
    assert state(store)[0] == [("a", "a1"), ("b", "b2")]
    store.prune(keep=1)
    assert state(store)[0] == [("a", "a1"), ("b", "b2")]


def test_prune_drops_only_abandoned_claims(spark, make_raw, tmp_path):
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    store.publish_replace(*one(make_raw, "a", "a1"))
    Interleaved(store, *one(make_raw, "b", "b2"))
    store.publish_replace(*one(make_raw, "c", "c3"))
    store.compact()
    assert store.prune(keep=1) == [1, 3] and store.versions(complete_only=False) == [2, 4]
    assert store.prune(keep=1, abandoned_after=3600) == []
    assert store.prune(keep=1, abandoned_after=-1) == [2]
    assert state(store)[0] == [("a", "a1"), ("c", "c3")]


def test_a_month_loaded_again_replaces_its_null_ids_on_request(spark, moving_raw, make_raw, tmp_path):
    store = CatalogStore(spark, f"file://{tmp_path}/s")
    load = lambda m, raw=moving_raw: run_month(spark, raw, store, 2021, m, replace_null_ids=True)
    for m in (1, 3):
        load(m)
    once = state(store)
    load(1)
    assert state(store) != once                             # "a" is January's again, as in the original
    load(3)
    assert state(store) == once                             # the null ids of both months are there once
    store.compact()
    load(3)
    assert state(store) == once
    load(1, make_raw([raw_row(None, date_added="January 2, 2021", title="other")]))
    assert sum(k == "None" for k, _ in state(store)[0]) == 2 and ("None", "other") in state(store)[0]
    run_month(spark, moving_raw, store, 2021, 3)            # without it they are appended
    assert sum(k == "None" for k, _ in state(store)[0]) == 3
