"""Bronze ingestion with Structured Streaming.

One file-source stream per feed, each with its own checkpoint, run with
``trigger(availableNow=True)``: it takes every file not yet committed in the checkpoint, in
micro-batches, then stops. Re-running after a new delivery picks up only the new files;
deleting the checkpoint and the table replays everything.

The stream itself carries file names; each batch's files are then read as one frame, by the
layouts of their headers (CSV) or by the schema version in force (JSON lines), and appended
by ``BatchSink``, which makes a replayed batch add nothing and counts rows as they are written.

Checkpoints and table paths must live on shared storage (the folder named by
``spark.checkpoint.dir`` or the warehouse), never on an executor's local disk.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from folio.sources import files, storage
from folio.sources.schemas import SchemaRegistry, observed_json
from folio.streaming.sink import BatchSink

DEFAULT_MAX_FILES = 1000   # files per micro-batch when draining a backlog; their names reach the driver


@dataclass
class IngestResult:
    name: str
    rows: int
    batches: int


def drain(stream: DataFrame, sink: BatchSink, append: Callable[[int, list[str]], int]) -> IngestResult:
    """Run everything new through ``append(batch, paths)``, then stop; rows and batches of this run."""
    sink.claim()
    before = sink.last_batch()

    def on_batch(found: DataFrame, batch: int) -> None:
        append(batch, sorted({r.path for r in found.collect()}))  # at most max_files names

    query: StreamingQuery = (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", sink.checkpoint)
                             .trigger(availableNow=True).start())
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"stream {sink.name} failed: {exc}")
    last = sink.last_batch()
    return IngestResult(sink.name, sink.rows(before, last), last - before)


def csv_registry(spark: SparkSession, checkpoint_root: str, feed: str) -> SchemaRegistry:
    return SchemaRegistry(spark, os.path.join(checkpoint_root, f"{feed}_schema"), files.csv_schema(feed), files.TECHNICAL)


def json_registry(spark: SparkSession, checkpoint_root: str, feed: str = "open_library") -> SchemaRegistry:
    return SchemaRegistry(spark, os.path.join(checkpoint_root, f"{feed}_schema"), files.LOOKUP_SCHEMA, files.TECHNICAL)


def ingest_csv(spark: SparkSession, landing: str, feed: str, checkpoint_root: str,
               table: str | None = None, path: str | None = None, pattern: str | None = None,
               max_files: int | None = DEFAULT_MAX_FILES, archive_dir: str | None = None, flat: bool = False,
               escape: str | None = None) -> IngestResult:
    """One CSV feed -> append-only bronze table.

    Files are ``landing/<feed>/<pattern>`` or, with ``flat``, the feed's glob directly in
    the landing folder (``Books*.csv``, ``Ratings*.csv``, ``Users*.csv``), so a new delivery
    such as ``Ratings_2.csv`` needs no code change. The first batch fixes the columns (the feed's own
    and further ones of its headers); later files may order them otherwise, lack some (NULL) or have
    more (rescue column, and an entry in the drift log). ``max_files`` bounds each micro-batch
    (availableNow still drains everything, in several batches); ``archive_dir`` moves
    committed files out of the landing folder so listing stays cheap as deliveries pile up.
    """
    if flat:
        source = os.path.join(landing, pattern or files.LANDING_GLOB[feed] + ".csv")
    else:
        source = os.path.join(landing, feed, pattern or "*.csv")
    sink = BatchSink(spark, os.path.join(checkpoint_root, feed), feed, table, path)
    registry = csv_registry(spark, checkpoint_root, feed)

    def append(batch: int, paths: list[str]) -> int:
        def build() -> DataFrame:
            if sink.last_batch() < 0:
                registry.default = files.landing_schema(spark, paths, feed, escape)
            _, schema = registry.current()
            more = files.unknown_headers(spark, paths, feed, schema, escape)
            if more.fields:
                registry.admit(more, batch, evolve=False)
            return files.read_csv_files(spark, paths, feed, schema, escape)

        return sink.append(batch, build)

    return drain(files.stream_files(spark, source, max_files, archive_dir), sink, append)


def ingest_json(spark: SparkSession, landing: str, checkpoint_root: str, feed: str = "open_library",
                table: str | None = None, path: str | None = None, max_files: int | None = DEFAULT_MAX_FILES,
                evolve: bool = True) -> IngestResult | None:
    """The JSON-lines lookup feed; skipped (None) while its landing folder does not exist.

    A batch is read by the schema version in force. If lines are rescued, those lines alone are asked for their schema; new
    top-level keys make a new version, the batch is read again by it and the table gets the columns. Changed types are
    logged and stay rescued (see ``folio.sources.schemas``). Without ``evolve`` new keys are only logged.
    """
    source = os.path.join(landing, feed)
    if not storage.path_exists(spark, source):
        return None
    sink = BatchSink(spark, os.path.join(checkpoint_root, feed), feed, table, path)
    registry = json_registry(spark, checkpoint_root, feed)

    def append(batch: int, paths: list[str]) -> int:
        schema: list[T.StructType] = []

        def build() -> DataFrame:
            schema[:] = [registry.current()[1]]
            return files.read_json_files(spark, paths, schema[0])

        def revise(written: DataFrame, rescued: int) -> DataFrame | None:
            seen = observed_json(written.filter(f"{files.RESCUE} IS NOT NULL").select(files.RESCUE), files.RESCUE)
            if seen is None:
                return None
            _, wider, _ = registry.admit(seen, batch, evolve)
            return None if wider == schema[0] else files.read_json_files(spark, paths, wider)

        return sink.append(batch, build, revise, flagged=files.RESCUE)

    return drain(files.stream_files(spark, source, max_files, recursive=True), sink, append)


def ingest_all(spark: SparkSession, landing: str, checkpoint_root: str, tables: dict[str, str] | None = None,
               paths: dict[str, str] | None = None, concurrent: bool = True,
               max_files: int | None = DEFAULT_MAX_FILES, flat: bool = False) -> list[IngestResult]:
    """Run the four independent streams (CSV feeds and the lookup feed).

    Each stream has its own checkpoint and sink, so they can run at the same time; with
    ``concurrent=False`` they run one after another as in the reference. ``max_files``
    bounds every micro-batch, so a large backlog drains in several commits instead of one.
    With ``flat`` the CSV files lie directly in the landing folder (``Books*.csv``, ...).
    """
    tables, paths = tables or {}, paths or {}
    jobs = [lambda f=feed: ingest_csv(spark, landing, f, checkpoint_root, table=tables.get(f), path=paths.get(f),
                                      max_files=max_files, flat=flat)
            for feed in ("books", "ratings", "users")]
    jobs.append(lambda: ingest_json(spark, landing, checkpoint_root, table=tables.get("open_library"),
                                    path=paths.get("open_library"), max_files=max_files))
    if concurrent:
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            results = [f.result() for f in [pool.submit(j) for j in jobs]]
    else:
        results = [j() for j in jobs]
    return [r for r in results if r is not None]
