"""Versioned catalog store: the Spark replacement for an in-place keyed
DELETE + INSERT.

Layout under ``root``::

    v=000001/titles/, v=000001/genres/   Parquet: the rows of one load
    v=000001/_CLAIM                      the writer that took this number
    v=000001/_COMPLETE                   written last; JSON with the facts below
    _stage/<batch>/                      a job's staged input, dropped after the load
    _streams/<id>/                       default checkpoint of a file stream

A load writes its own rows as the next version and nothing else, so it costs
the batch, not the tables. A reader takes the last base and every complete load
that this base doesn't cover, and leaves out every row whose key a later load's
titles hold again: the keyed DELETE, applied on reading. ``compact`` writes the
resolved tables as a new base.

A base names the versions it covers: all up to ``upto`` but those that were
still being written then (``open``). A load that finishes beside or after a
compaction is therefore read whatever its number is; base rows keep the number
of the load they came from, so it takes its place between them.

Readers only see versions with a ``_COMPLETE`` file, so ``titles`` and
``genres`` switch together and a crashed load is invisible and simply redone.
A number is claimed by creating ``_CLAIM`` without overwriting: of two writers
that pick the same number one fails. All files go through the Hadoop FileSystem
API, so the same code works on HDFS and object stores.

``_COMPLETE`` holds ``{"base": bool, "streams": {stream id: last batch id}}``,
for a load with an identity ``"batch"``, and for a base ``"upto"``, ``"open"`` and
``"batches"`` (of the covered loads: number -> identity).
"""

from __future__ import annotations

import hashlib
import json
import re
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marquee.schema import GENRES_SCHEMA, KEY, TITLES_SCHEMA, empty_frame

MARKER, CLAIM = "_COMPLETE", "_CLAIM"
VERSION_COL = "v"
ORIGIN_COL = "_origin"      # in a base: the load that a row came from
_VERSION = re.compile(r"^v=(\d+)$")
_SCHEMAS = {"titles": TITLES_SCHEMA, "genres": GENRES_SCHEMA}


class MissingInputError(FileNotFoundError):
    """A stage input that must exist is absent (missing input is an error, not an empty load)."""


class ConcurrentLoadError(RuntimeError):
    """Another writer has claimed the version this load was about to write."""


@dataclass(frozen=True)
class Parts:
    """What makes up the tables: a base (or none), the loads that it doesn't cover, and their facts."""

    base: int | None
    loads: list[int]
    facts: dict[int, dict]
    open: list[int]             # versions that were being written when this was listed

    @property
    def all(self) -> list[int]:
        return ([self.base] if self.base else []) + self.loads

    @property
    def upto(self) -> int:
        """The last load that the base covers."""
        return self.facts[self.base].get("upto", self.base - 1) if self.base else 0

    def batches(self) -> dict[int, str]:
        """Loads with an identity, the covered ones too."""
        of_base = self.facts[self.base].get("batches", {}) if self.base else {}
        return {int(v): b for v, b in of_base.items()} | {v: b for v in self.loads if (b := self.facts[v].get("batch"))}

    def superseded(self) -> list[int]:
        """Loads that a later load of the same identity replaces whole, rows without a key too."""
        batches = self.batches()
        last = {b: v for v, b in sorted(batches.items())}
        return sorted(v for v, b in batches.items() if v != last[b])


class CatalogStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ paths
    def _vdir(self, v: int) -> str:
        return f"{self.root}/v={v:06d}"

    def stage_path(self, name: str) -> str:
        """Folder for a job's staged batch (ignored by version listing)."""
        return f"{self.root}/_stage/{name}"

    def drop_stage(self, name: str) -> None:
        self._fs.delete(self._Path(self.stage_path(name)), True)

    def stream_checkpoint(self, source: str) -> str:
        """Default checkpoint of the stream that feeds this store from ``source``."""
        return f"{self.root}/_streams/{hashlib.sha256(source.rstrip('/').encode()).hexdigest()[:16]}"

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._Path(path)))

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._Path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._Path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    # ------------------------------------------------------------ versions
    def versions(self, complete_only: bool = True) -> list[int]:
        p = self._Path(self.root)
        if not self._fs.exists(p):
            return []
        found = [int(m.group(1)) for st in self._fs.listStatus(p) if (m := _VERSION.match(st.getPath().getName()))]
        return sorted(v for v in found if not complete_only or self.exists(f"{self._vdir(v)}/{MARKER}"))

    def latest(self) -> int | None:
        vs = self.versions()
        return vs[-1] if vs else None

    def facts(self, v: int) -> dict:
        return json.loads(self.read_text(f"{self._vdir(v)}/{MARKER}"))

    def parts(self, version: int | None = None) -> Parts:
        """What makes up the tables as of ``version`` (default: all that is complete), from one listing."""
        every = [v for v in self.versions(complete_only=False) if version is None or v <= version]
        facts = {v: self.facts(v) for v in every if self.exists(f"{self._vdir(v)}/{MARKER}")}
        bases = [v for v in facts if facts[v]["base"]]
        # of two compactions side by side the one that covers more may be the older one, and its loads may be gone
        base = max(bases, key=lambda v: (facts[v].get("upto", v - 1), -len(facts[v].get("open", [])), v), default=None)
        upto = facts[base].get("upto", base - 1) if base else 0
        was_open = set(facts[base].get("open", [])) if base else set()
        loads = [v for v in sorted(facts) if v not in bases and (v > upto or v in was_open)]
        return Parts(base, loads, facts, [v for v in every if v not in facts])

    def stream_progress(self, stream_id: str) -> int | None:
        """Last batch of a stream that any load since the last base has published."""
        parts = self.parts()
        seen = [parts.facts[v]["streams"].get(stream_id) for v in parts.all]
        return max((b for b in seen if b is not None), default=None)

    # ------------------------------------------------------------ read
    def _scan(self, kind: str, versions: list[int]) -> DataFrame:
        """Rows of the versions; VERSION_COL: the load that each came from."""
        schema = T.StructType([*_SCHEMAS[kind].fields, T.StructField(ORIGIN_COL, T.IntegerType()),
                               T.StructField(VERSION_COL, T.IntegerType())])
        rows = (self.spark.read.schema(schema).option("basePath", self.root)
                .parquet(*[f"{self._vdir(v)}/{kind}" for v in versions]))
        return rows.select(*_SCHEMAS[kind].names, F.coalesce(ORIGIN_COL, VERSION_COL).alias(VERSION_COL))

    def _resolved(self, parts: Parts) -> tuple[DataFrame, DataFrame]:
        """(titles, genres) with the load that each row came from.

        A row goes if a later load's titles hold its key; null keys never match and stay, but for those of a load that
        a later one of the same identity replaces. The replacing keys come from the loads that the base doesn't cover,
        and, if one of these is older than a covered one, from the base's rows of later loads.
        """
        frames = {kind: self._scan(kind, parts.all) for kind in _SCHEMAS}
        if gone := parts.superseded():
            frames = {k: df.where(F.col(KEY).isNotNull() | ~F.col(VERSION_COL).isin(gone)) for k, df in frames.items()}
        if len(parts.all) > 1:
            replacing = self._scan("titles", parts.loads)
            if parts.base and parts.loads[0] < parts.upto:
                replacing = replacing.unionByName(self._scan("titles", [parts.base]).where(F.col(VERSION_COL) > parts.loads[0]))
            last = replacing.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.max(VERSION_COL).alias("_last"))
            frames = {k: df.join(last, KEY, "left").where(F.col("_last").isNull() | (F.col(VERSION_COL) >= F.col("_last")))
                      for k, df in frames.items()}
        return tuple(df.select(*_SCHEMAS[kind].names, VERSION_COL) for kind, df in frames.items())

    def read(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(titles, genres) as of a version (default: the latest); empty tables
        with the target schemas when nothing was loaded yet (CREATE IF NOT EXISTS)."""
        parts = self.parts(version)
        if not parts.all:
            return empty_frame(self.spark, TITLES_SCHEMA), empty_frame(self.spark, GENRES_SCHEMA)
        return tuple(df.drop(VERSION_COL) for df in self._resolved(parts))

    def read_load(self, version: int) -> tuple[DataFrame, DataFrame]:
        """(titles, genres) that one version has written."""
        return tuple(self._scan(kind, [version]).drop(VERSION_COL) for kind in _SCHEMAS)

    # ------------------------------------------------------------ write
    def _claim(self) -> int:
        v = max(self.versions(complete_only=False), default=0) + 1
        try:
            self._write_text(f"{self._vdir(v)}/{CLAIM}", "")
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception.getClass().getName()):
                raise ConcurrentLoadError(f"version {v} of {self.root} is being written by another load") from e
            raise
        return v

    def _publish(self, titles: DataFrame, genres: DataFrame, facts: dict) -> int:
        v = self._claim()

        def write(kind: str, df: DataFrame) -> None:
            origin = [F.col(VERSION_COL).alias(ORIGIN_COL)] if facts["base"] else []
            typed = df.select(*[F.col(f.name).cast(f.dataType) for f in _SCHEMAS[kind].fields], *origin)
            typed.write.parquet(f"{self._vdir(v)}/{kind}")

        # the two tables are independent jobs: run them side by side
        with ThreadPoolExecutor(max_workers=2) as pool:
            for f in [pool.submit(write, "titles", titles), pool.submit(write, "genres", genres)]:
                f.result()
        self._write_text(f"{self._vdir(v)}/{MARKER}", json.dumps(facts))
        return v

    def publish_replace(self, staged_titles: DataFrame, staged_genres: DataFrame,
                        stream: tuple[str, int] | None = None, batch: str | None = None) -> int:
        """L3: publish a batch that replaces every key of its titles in both
        tables. Only the batch is written. ``stream``: (stream id, batch id)
        that the load comes from. ``batch``: the load's identity; a load
        replaces the rows without a key of earlier ones of its identity, which
        no key can name."""
        facts = {"base": False, "streams": dict([stream]) if stream else {}}
        return self._publish(staged_titles, staged_genres, facts | ({"batch": batch} if batch else {}))

    def compact(self) -> int | None:
        """Write the resolved tables as a new base (None if there is nothing); stream progress and identities are
        carried on. Loads that are being written meanwhile stay outside of it and are read beside it."""
        parts = self.parts()
        if not parts.all:
            return None
        streams: dict[str, int] = {}
        for v in parts.all:
            for k, b in parts.facts[v]["streams"].items():
                streams[k] = max(b, streams.get(k, b))
        upto = max([parts.upto, *parts.loads])
        was_open = parts.facts[parts.base].get("open", []) if parts.base else []
        still = sorted(v for v in {*was_open, *parts.open} if v < upto and v not in parts.loads)
        live = {v: b for v, b in parts.batches().items() if v not in parts.superseded()}
        return self._publish(*self._resolved(parts),
                             {"base": True, "streams": streams, "upto": upto, "open": still, "batches": live})

    def _age(self, v: int) -> float:
        """Seconds since a version was claimed; unlimited without a claim."""
        claim = f"{self._vdir(v)}/{CLAIM}"
        if not self.exists(claim):
            return float("inf")
        return time.time() - self._fs.getFileStatus(self._Path(claim)).getModificationTime() / 1000

    def prune(self, keep: int = 2, abandoned_after: float | None = None) -> list[int]:
        """Delete the versions that none of the newest ``keep`` complete ones
        needs. A claimed version without its marker may still be written, so it
        stays unless it was claimed over ``abandoned_after`` seconds ago."""
        complete = self.versions()
        if not complete:
            return []
        needed = {p for v in complete[-max(keep, 1):] for p in self.parts(v).all} | set(self.parts().all)
        dropped = [v for v in complete if v not in needed]
        dropped += [v for v in self.versions(complete_only=False) if v not in complete and v < complete[-1]
                    and self._age(v) > (float("1e18") if abandoned_after is None else abandoned_after)]
        for v in sorted(dropped):
            self._fs.delete(self._Path(self._vdir(v)), True)
        return sorted(dropped)
