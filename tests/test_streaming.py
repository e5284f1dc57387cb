"""File-stream ingestion equals the batch load and loses nothing: reruns
process no file twice, a replayed micro-batch is not applied twice, and
neither other checkpoints nor other loads are mistaken for it."""

from __future__ import annotations

import shutil
from collections import Counter

import pytest

from marquee.__main__ import main
from marquee.operators.clean import clean_titles
from marquee.plans.jobs import backfill_tables, run_month
from marquee.schema import GENRES_SCHEMA, TITLES_SCHEMA, empty_frame
from marquee.sources.export import write_csv
from marquee.sources.store import CatalogStore
from marquee.streaming import catalog_stream, load_batch
from tests.conftest import raw_row


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def arrive(spark, make_raw, tmp_path):
    """Put rows as one new CSV file into the source folder."""
    (tmp_path / "in").mkdir()

    def put(name, rows, raw=None):
        write_csv(make_raw(rows).coalesce(1), f"file://{tmp_path}/made/{name}")
        part = next((tmp_path / "made" / name).glob("part-*"))
        shutil.copy(part, tmp_path / "in" / f"{name}.csv")
    return put


A = [raw_row("a", date_added="January 3, 2021", listed_in="X, Y"), raw_row("b", date_added=" February 9, 2021", director="D1, D2"),
     raw_row(None, date_added="January 10, 2021"), raw_row("u", date_added=None), raw_row("l", title="two\nlines", date_added="May 1, 2021")]
B = [raw_row("a", date_added="March 4, 2021", rating="R", listed_in="W"), raw_row("c", date_added="March 5, 2021", title='a "quoted", title')]


def expected(spark, make_raw, *batches):
    t, g = empty_frame(spark, TITLES_SCHEMA), empty_frame(spark, GENRES_SCHEMA)
    for rows in batches:
        t, g = backfill_tables(t, g, make_raw(rows), (2000, 1), (2030, 12))
    return bag(t), bag(g)


def tables(store):
    t, g = store.read()
    return bag(t), bag(g)


def test_stream_matches_batch_and_is_incremental(spark, make_raw, arrive, tmp_path):
    src, store = f"file://{tmp_path}/in", CatalogStore(spark, f"file://{tmp_path}/store")
    arrive("a", A)
    catalog_stream(spark, src, store).awaitTermination()
    assert tables(store) == expected(spark, make_raw, A) and store.latest() == 1
    catalog_stream(spark, src, store).awaitTermination()        # nothing new, no new version
    assert store.latest() == 1
    arrive("b", B)
    catalog_stream(spark, src, store).awaitTermination()
    assert tables(store) == expected(spark, make_raw, A, B) and store.latest() == 2


def test_another_checkpoint_is_no_replay(spark, make_raw, arrive, tmp_path):
    """A second checkpoint starts over: everything is loaded again, nothing is skipped."""
    src, store = f"file://{tmp_path}/in", CatalogStore(spark, f"file://{tmp_path}/store")
    arrive("a", A)
    catalog_stream(spark, src, store, checkpoint=f"file://{tmp_path}/one").awaitTermination()
    arrive("b", B)
    catalog_stream(spark, src, store, checkpoint=f"file://{tmp_path}/two").awaitTermination()
    assert tables(store) == expected(spark, make_raw, A, A + B)


def test_the_command_run_twice(spark, make_raw, arrive, tmp_path, capsys):
    args = ["stream", "--source", f"file://{tmp_path}/in", "--store", f"file://{tmp_path}/store"]
    arrive("a", A)
    assert main(args) == 0
    arrive("b", B)
    assert main(args) == 0
    assert "latest version 1" in (out := capsys.readouterr().out) and "latest version 2" in out
    assert tables(CatalogStore(spark, f"file://{tmp_path}/store")) == expected(spark, make_raw, A, B)


def test_two_stores_from_one_source(spark, make_raw, arrive, tmp_path):
    src = f"file://{tmp_path}/in"
    stores = [CatalogStore(spark, f"file://{tmp_path}/store{i}") for i in range(2)]
    arrive("a", A)
    catalog_stream(spark, src, stores[0]).awaitTermination()
    arrive("b", B)
    for s in stores:
        catalog_stream(spark, src, s).awaitTermination()
    assert tables(stores[0]) == expected(spark, make_raw, A, B)
    assert tables(stores[1]) == expected(spark, make_raw, A + B)


def test_replay_is_skipped_also_after_other_loads(spark, make_raw, tmp_path):
    store = CatalogStore(spark, f"file://{tmp_path}/store")
    batch = make_raw([raw_row(None, date_added="January 10, 2021"), raw_row("a")])
    assert load_batch(store, batch, 0, "q") == 1
    assert load_batch(store, batch, 0, "q") is None         # replay of batch 0
    run_month(spark, make_raw([raw_row("m", date_added="April 1, 2021")]), store, 2021, 4)
    assert load_batch(store, batch, 0, "q") is None         # still, with another load in between
    store.compact()
    assert load_batch(store, batch, 0, "q") is None         # and after a compaction
    assert load_batch(store, batch, 1, "q") == 4            # a genuinely new batch
    assert load_batch(store, batch, 0, "other") == 5        # another stream's batch 0
    t, _ = store.read()
    assert sum(r.show_id is None for r in t.collect()) == 3
    assert clean_titles(batch)[0].count() == 2


def test_columns_by_name_and_failing_headers(spark, make_raw, tmp_path):
    src, store = tmp_path / "in", CatalogStore(spark, f"file://{tmp_path}/store")
    src.mkdir()
    raw = make_raw(A)
    write_csv(raw.select(*reversed(raw.columns)).coalesce(1), f"file://{tmp_path}/made")
    shutil.copy(next((tmp_path / "made").glob("part-*")), src / "a.csv")
    catalog_stream(spark, f"file://{src}", store).awaitTermination()
    assert tables(store) == expected(spark, make_raw, A)
    write_csv(raw.drop("title").coalesce(1), f"file://{tmp_path}/bad")
    shutil.copy(next((tmp_path / "bad").glob("part-*")), src / "b.csv")
    with pytest.raises(Exception, match="title"):
        catalog_stream(spark, f"file://{src}", store).awaitTermination()
    assert store.latest() == 1
