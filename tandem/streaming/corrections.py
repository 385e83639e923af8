"""Statistics of a log stream that late rows correct: intervals and totals since the start.

An interval is emitted once it is complete, and again, whole and with a higher ``revision``, whenever
late rows change it or an interval before it. What has been emitted for an interval last is right, so a
reader keeps the row of the highest revision, see :func:`latest_revisions`.

State is two small tables numbered by micro-batch: the counters of the intervals that late rows may still
change, with one row per (table, subtask) for everything before them, and the batches seen in those
intervals, so that a replay counts once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tandem.plans.stats import COUNTERS, GROUP, MAXIMA, interval_counters, with_since
from tandem.session import delete_path, stage, staging_scope
from tandem.sinks.batches import BATCH_FOLDER, BatchSink, folder_sink
from tandem.streaming.monitor import numbered_state

_BATCH = [*GROUP, "batch_id"]
_KEY = [*GROUP, "window_start"]


def _measure(name: str) -> T.StructField:
    return T.StructField(name, T.DoubleType() if name.endswith("_ms") else T.LongType())


# ``closed`` is the one row of a (table, subtask) for all intervals that nothing can change any more.
INTERVAL_STATE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("subtask", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_s", T.LongType()),
        *[_measure(name) for name in (*COUNTERS, *MAXIMA)],
        T.StructField("closed", T.BooleanType()),
        T.StructField("revision", T.LongType()),
    ]
)
SEEN_STATE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("subtask", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
    ]
)


def _start_us(ts: Column, interval_s: int) -> Column:
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, F.lit(interval_s * 1_000_000))


def _summed(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in COUNTERS], *[F.max(name).alias(name) for name in MAXIMA], *more)


def _newest_us(seen: DataFrame) -> int | None:
    return seen.agg(F.max(F.unix_micros("ts"))).first()[0]


def stats_step(
    log: DataFrame, intervals: DataFrame, seen: DataFrame, interval_s: int, late_s: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows to emit, intervals, batches seen) after one micro-batch of the log, given the state before it.

    The newest time in the log, over all tables, is the clock. An interval is complete when the clock has
    reached its end, and closed ``late_s`` after that. Rows of closed intervals are passed over, since they
    may be replays; :func:`tandem.streaming.monitor.remaining_intervals` finds what they would have changed.
    A micro-batch without new rows emits nothing.
    """
    if interval_s <= 0 or late_s < 0:
        raise ValueError(f"an interval over 0 and a lateness of at least 0 are needed, not {interval_s} and {late_s}")
    length, late = interval_s * 1_000_000, late_s * 1_000_000
    before = _newest_us(seen)
    rows = log.drop("primary_message").dropDuplicates(_BATCH).join(seen.select(*_BATCH), _BATCH, "left_anti")
    if before is not None:
        rows = rows.filter(_start_us(F.col("ts"), interval_s) + length > before - late)
    rows = stage(rows, "log-rows")
    all_seen = seen.unionByName(rows.select(*SEEN_STATE.names))
    newest = _newest_us(all_seen)
    if newest is None:
        return _shown(with_since(intervals.filter(F.lit(False)))), intervals, seen

    fresh = interval_counters(rows, interval_s).withColumns({"closed": F.lit(False), "revision": F.lit(None).cast("long"), "fresh": F.lit(True)})
    both = intervals.withColumn("fresh", F.lit(False)).unionByName(fresh)
    summed = _summed(both, [*_KEY, "window_s", "closed"], F.max("revision").alias("revision"), F.max("fresh").alias("fresh"))
    end = F.unix_micros("window_start") + length
    changed_from = F.min(F.when(F.col("fresh"), F.col("window_start"))).over(W.partitionBy(*GROUP))
    due = ~F.col("closed") & (end <= newest) & (F.col("revision").isNull() | F.coalesce(F.col("window_start") >= changed_from, F.lit(False)))
    marked = stage(summed.withColumn("due", due).drop("fresh"), "intervals")
    turned = marked.withColumn("revision", F.when(F.col("due"), F.coalesce(F.col("revision") + 1, F.lit(0))).otherwise(F.col("revision")))

    emitted = _shown(with_since(turned).filter("due"))
    over = F.col("closed") | (end <= newest - late)
    totals = _summed(turned.filter(over), [*GROUP], F.min("window_start").alias("window_start"), F.max("window_s").alias("window_s"))
    totals = totals.withColumns({"closed": F.lit(True), "revision": F.lit(None).cast("long")})
    following = turned.filter(~over).select(*INTERVAL_STATE.names).unionByName(totals.select(*INTERVAL_STATE.names))
    still = all_seen.filter(_start_us(F.col("ts"), interval_s) + length > newest - late)
    return emitted, following, still


def _shown(rows: DataFrame) -> DataFrame:
    names = [*_KEY, "window_s", *COUNTERS, *MAXIMA]
    return rows.select(*names, *[f"since_{name}" for name in names[len(_KEY) :]], "nth", "revision")


def latest_revisions(emitted: DataFrame) -> DataFrame:
    """The last row emitted for each interval; rows are combined per task before they are shuffled."""
    rest = [name for name in emitted.columns if name not in _KEY]
    return emitted.groupBy(*_KEY).agg(F.max_by(F.struct(*rest), "revision").alias("row")).select(*_KEY, "row.*")


def pending_intervals(spark: SparkSession, state_path: str) -> DataFrame:
    """Intervals that a stream which has ended left incomplete, as they would have been emitted."""
    states = spark.read.schema(T.StructType([*INTERVAL_STATE.fields, T.StructField(BATCH_FOLDER, T.LongType())])).parquet(state_path)
    last = states.agg(F.max(BATCH_FOLDER)).first()[0]
    intervals = states.filter(F.col(BATCH_FOLDER) == (-1 if last is None else last)).drop(BATCH_FOLDER)
    waiting = with_since(intervals).filter("NOT closed AND revision IS NULL")
    return _shown(waiting.withColumn("revision", F.lit(0).cast("long")))


def stats_revisions(
    log: DataFrame,
    sink: BatchSink,
    *,
    interval_s: int = 360,
    late_s: int | None = None,
    state_path: str,
    checkpoint: str,
    name: str = "stats",
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch's new and corrected intervals to ``sink``.

    Late rows correct an interval for ``late_s`` seconds after its end, by default for ten intervals. A
    replayed micro-batch starts from the same state and writes the same rows.
    """
    late_s = 10 * interval_s if late_s is None else late_s
    seen_path = f"{state_path.rstrip('/')}-seen"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        intervals = numbered_state(spark, state_path, batch_id, INTERVAL_STATE)
        seen = numbered_state(spark, seen_path, batch_id, SEEN_STATE)
        with staging_scope(spark):
            emitted, following, still = stats_step(batch, intervals, seen, interval_s, late_s)
            sink(emitted, batch_id)
            folder_sink(seen_path)(still, batch_id)
            folder_sink(state_path)(following, batch_id)
        for path in (state_path, seen_path):
            delete_path(spark, f"{path}/{BATCH_FOLDER}={batch_id - 2}")

    writer = log.writeStream.queryName(name).foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
