"""Streaming enrichment: one failover lookup per micro-batch."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tandem.operators.failover import Loader, LookupFailed, failover_lookup, log_frame, subtask_labels
from tandem.operators.lookup import Keys
from tandem.options import LookupOptions
from tandem.session import delete_path
from tandem.sinks.batches import BatchSink


class SnapshotCache:
    """Loader that lets micro-batches share one staged snapshot for ``ttl_s`` seconds.

    Off unless asked for: without it every micro-batch sees the dimension as it is at that time.
    Several queries may share one cache. A snapshot is leased to every lookup that reads it; one that a newer one
    has replaced goes when the last of them has been closed.
    """

    def __init__(self, loader: Loader, ttl_s: float):
        self.loader = loader
        self.ttl_s = ttl_s
        self._lock = threading.Lock()
        self._kept: DataFrame | None = None
        self._path = ""
        self._until = 0.0
        self._leases: dict[str, int] = {}

    def __call__(self, spark: SparkSession) -> DataFrame:
        return self.loader(spark)

    def lease(self) -> tuple[DataFrame | None, Callable[[], None]]:
        """The snapshot while it is fresh, else None, and what gives it back."""
        with self._lock:
            if self._kept is None or time.monotonic() >= self._until:
                return None, lambda: None
            return self._kept, self._leased(self._kept.sparkSession, self._path)

    def keep(self, snapshot: DataFrame, path: str) -> Callable[[], None]:
        """Take over a staged snapshot, leased to the lookup that made it; returns what gives it back."""
        with self._lock:
            spark, before = snapshot.sparkSession, self._path
            self._kept, self._path = snapshot, path
            self._until = time.monotonic() + self.ttl_s
            release = self._leased(spark, path)
            if before and not self._leases.get(before):
                delete_path(spark, before)
        return release

    def _leased(self, spark: SparkSession, path: str) -> Callable[[], None]:
        self._leases[path] = self._leases.get(path, 0) + 1
        held = [True]

        def release() -> None:
            with self._lock:
                if not held:
                    return
                held.clear()
                self._leases[path] -= 1
                if not self._leases[path]:
                    del self._leases[path]
                    if path != self._path:
                        delete_path(spark, path)

        return release


def enrich_stream(
    facts: DataFrame,
    stores: Mapping[str, Loader],
    keys: Keys,
    schema: T.StructType,
    options: LookupOptions,
    *,
    sink: BatchSink,
    checkpoint: str,
    log_sink: BatchSink | None = None,
    name: str = "enrich",
    subtask: str | None = None,
    subtasks: int = 1,
    trigger: Mapping | None = None,
    **lookup,
) -> StreamingQuery:
    """Start a query that enriches ``facts`` batch by batch and leaves one log row per batch.

    With ``subtasks=n`` it leaves n of them, one for each bucket of keys, labelled ``subtask:1/n`` and so on.
    The facts of a batch are not kept: its keys, its join and its log row each read what they need of them.

    The size of a batch is set at the source: for Kafka by ``batch_size`` and ``max_wait_ms`` of
    :func:`tandem.sources.facts.kafka_read_options`, for files by ``maxFilesPerTrigger``.
    ``trigger`` is passed to Spark. When both stores fail the batch is logged, the query stops,
    and a restart from the checkpoint replays that batch. Sinks get the batch id, so a replay can
    replace what it wrote before.
    """
    label = subtask or name

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        try:
            result = failover_lookup(batch, stores, keys, schema, options, **lookup)
        except LookupFailed as failed:
            if log_sink:
                labels = subtask_labels(subtasks, label) if subtasks > 1 else [label]
                counts = {each: (n, None) for each, n in zip(labels, failed.keys_by_subtask(subtasks))}
                log_sink(log_frame(batch.sparkSession, options, failed.attempts, counts, None, None, batch_id), batch_id)
            raise
        try:
            sink(result.df, batch_id)
            if log_sink:
                row = result.log_rows(subtasks, batch_id, label=label) if subtasks > 1 else result.log_row(label, batch_id)
                log_sink(row, batch_id)
        finally:
            result.close()

    writer = facts.writeStream.queryName(name).foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": f"{max(options.batch_max_wait_ms, 1)} milliseconds"})).start()
