"""The monthly pipeline fed by newly arrived raw files.

A file stream finds the CSV files that arrived since the last run (tracked in
the streaming checkpoint) and reads their lines in the executors, so no list of
files reaches the driver; ``foreachBatch`` cuts them into records (columns by
name, quoted line breaks, see ``sources.records``) and loads them into the
versioned store; ``trigger(availableNow=True)`` processes what is there as one
batch and stops.

Within one batch a key keeps its latest month's rows (as in the one-pass
backfill); across batches the later batch replaces the key, as a later monthly
run would. A batch may be replayed after a failure, and must then load nothing
twice. Every version records which batch of which stream it came from; the
stream is named by the id in its checkpoint, so another checkpoint's batches are
never taken for replays, and progress is looked up over all versions since the
last base, so loads of other kinds in between don't hide it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.ingest import tag_months
from marquee.plans.jobs import stage, staged_from_tagged
from marquee.sources.raw import raw_from_lines
from marquee.sources.records import text_lines
from marquee.sources.store import CatalogStore


def load_batch(store: CatalogStore, batch: DataFrame, batch_id: int, stream_id: str) -> int | None:
    """Keyed load of one micro-batch of raw rows; returns the new version, or
    None when the stream has published this batch already."""
    done = store.stream_progress(stream_id)
    if done is not None and batch_id <= done:
        return None
    name = f"stream={stream_id}-{batch_id}"
    tagged, _ = stage(batch.sparkSession, tag_months(batch), store.stage_path(name))
    v = store.publish_replace(*staged_from_tagged(tagged), stream=(stream_id, batch_id))
    store.drop_stage(name)
    return v


def catalog_stream(spark: SparkSession, source_dir: str, store: CatalogStore,
                   checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                   available_now: bool = True) -> StreamingQuery:
    """Start the file-stream ingestion; with ``available_now`` it processes
    what has arrived and stops (call ``awaitTermination()``).

    Without ``checkpoint`` the stream's progress lies in the store, under a
    name that follows from ``source_dir``: the same command run again loads
    only what is new. ``max_files_per_trigger`` bounds a batch.
    """
    ckpt = (checkpoint or store.stream_checkpoint(source_dir)).rstrip("/")

    def load(lines: DataFrame, batch_id: int) -> None:
        rows = raw_from_lines(lines, source_dir)
        if rows is not None:
            stream_id = json.loads(store.read_text(f"{ckpt}/metadata"))["id"]
            load_batch(store, rows, batch_id, stream_id)

    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = text_lines(reader, source_dir).writeStream.foreachBatch(load).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
