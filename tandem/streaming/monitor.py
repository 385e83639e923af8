"""Streaming views of the lookup log: statistics and alerts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tandem.operators.sequence import PIECE_ROWS, spaced
from tandem.options import LookupOptions
from tandem.plans.alerts import reason_of, render_events
from tandem.plans.episodes import GROUP, ORDER, with_cooldown, with_streaks
from tandem.plans.log import LOG_SCHEMA
from tandem.plans.stats import interval_counters
from tandem.session import delete_path, folder_bytes, stage, staging_scope
from tandem.sinks.batches import BATCH_FOLDER, BatchSink, folder_sink
from tandem.sinks.delivery import DELIVERY_SCHEMA, AlertSink, Delivery, deliver, delivery_rows


def log_stream(spark, path: str, **options) -> DataFrame:
    """The lookup log as a stream, as :func:`tandem.sinks.batches.folder_sink` writes it.

    A micro-batch takes at most 1,000 files unless told otherwise, so a backlog is worked off in
    steps of bounded size.
    """
    options = {"maxFilesPerTrigger": "1000", **options}
    return spark.readStream.schema(LOG_SCHEMA).options(**options).parquet(f"{path}/{BATCH_FOLDER}=*")


_BATCH = [*GROUP, "batch_id"]


def stats_stream(log: DataFrame, interval_s: int = 360, lateness: str | None = None) -> DataFrame:
    """Interval counters of a log stream, each interval once it is complete.

    ``lateness`` is how far tables that write to one log may be apart, by default an interval and at
    least a minute. A batch that was replayed counts once. What a stream that ends has not
    emitted, and what came later still, :func:`remaining_intervals` gives.
    """
    waiting = log.withWatermark("ts", lateness or f"{max(60, interval_s)} seconds")
    return interval_counters(waiting.dropDuplicatesWithinWatermark(_BATCH), interval_s)


def remaining_intervals(log: DataFrame, emitted: DataFrame, interval_s: int = 360) -> DataFrame:
    """Counters of the intervals of a written log whose rows the stream has not, or not all, emitted."""
    counters = interval_counters(log.dropDuplicates(_BATCH), interval_s)
    same = [*GROUP, "window_start", "primary_batches"]
    return counters.join(emitted.select(*same), same, "left_anti")


def deduplicated_stream(alerts: DataFrame, window_s: int, lateness: str | None = None) -> DataFrame:
    """One alert of each table in each time window, the first that arrives, from any number of producers.

    It is passed on at once and not held until its window has ended. A window is remembered until the
    alerts are ``lateness`` past its end, by default as long as the window; alerts later than that are dropped.
    """
    waiting = alerts.withWatermark("ts", lateness or f"{window_s} seconds")
    # Only the window carries the watermark: it decides how long a window is remembered.
    placed = waiting.withColumn("__window", F.window("ts", f"{window_s} seconds")).withColumn("ts", F.timestamp_micros(F.unix_micros("ts")))
    first = placed.dropDuplicates(["table_name", "__window"])
    return first.withColumn("window_start", F.col("__window.start")).drop("__window")


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("subtask", T.StringType()),
        T.StructField("episode", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("streak", T.LongType()),
        T.StructField("affected_keys", T.LongType()),
        T.StructField("merged", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)

STATE_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("subtask", T.StringType()),
        T.StructField("episode_in", T.LongType()),
        T.StructField("streak_in", T.LongType()),
        T.StructField("keys_in", T.LongType()),
        T.StructField("emitted_ts", T.TimestampType()),
        T.StructField("emitted_streak", T.LongType()),
        T.StructField("last_batch", T.LongType()),
    ]
)

# Alerts that later micro-batches still need; ``ended`` ones only for the cooldown.
ALERTED_SCHEMA = T.StructType([*DELIVERY_SCHEMA.fields, T.StructField("ended", T.BooleanType())])

_LINE = ("episode", "ts", "batch_id", "streak", "affected_keys", "reason")


def episode_step(
    log: DataFrame, state: DataFrame, options: LookupOptions, piece_rows: int = PIECE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(events, new state) of one micro-batch of the log, given the state after the one before.

    Events are ``failover`` log lines after throttling, ``candidate`` when an episode reaches the
    alert threshold, and ``recovered`` when one ends; ``merged`` is the number of failovers since
    the last log line. State is one row per (table, subtask): the
    open episode, its size so far, its last log line, and the last batch it has seen. The batch goes
    through the same operators as a whole log, so a busy (table, subtask) or a long backlog is cut
    into pieces.

    The batch ids of a (table, subtask) only rise, so a row at or below the last one seen is a
    replay and is passed over, and so is a second row of a batch.
    """
    seen = state.select(*GROUP, "last_batch")
    log = log.join(seen, [*GROUP], "left").filter("last_batch IS NULL OR batch_id > last_batch").dropDuplicates(_BATCH)
    narrow = log.select(
        *GROUP, *ORDER, "n_keys", "failed_over", reason_of(F.col("primary_error"), F.col("primary_message")).alias("reason")
    )
    # Rows up to and including the first success of the batch belong to the episode left open.
    first = F.col("episode") == 0
    rows = with_streaks(narrow, piece_rows).join(state, [*GROUP], "left")
    rows = rows.select(
        *GROUP,
        *ORDER,
        "failed_over",
        "reason",
        (F.col("episode") + F.coalesce("episode_in", F.lit(0))).alias("episode"),
        (F.col("streak") + F.when(first, F.coalesce("streak_in", F.lit(0))).otherwise(0)).alias("streak"),
        (F.col("affected_keys") + F.when(first, F.coalesce("keys_in", F.lit(0))).otherwise(0)).alias("affected_keys"),
        F.when(first, F.col("streak_in")).alias("streak_in"),
        F.when(first, F.col("emitted_streak")).alias("line_in"),
    )
    rows = stage(rows, "streaks")
    lines = stage(_log_lines(rows, state, options.failover_log_interval_s, piece_rows), "lines")

    def event(name, found: DataFrame) -> DataFrame:
        return found.select(name.alias("event"), *GROUP, *_LINE[:-1], "merged", "reason")

    crossing = F.col("failed_over") & (F.col("streak") == options.alert_threshold) & F.lit(options.alerts_on)
    ended = ~F.col("failed_over") & (F.col("streak") > 0)
    threshold = F.when(F.col("streak") <= options.alert_threshold, F.col("streak"))
    latest = lines.groupBy(*GROUP, "episode").agg(F.max("streak").alias("line"), F.max(threshold).alias("early_line"))
    turning = rows.filter(crossing | ended).join(latest, [*GROUP, "episode"], "left")
    line = F.coalesce(F.when(F.col("failed_over"), F.col("early_line")).otherwise(F.col("line")), "line_in", F.lit(0))
    turning = turning.withColumn("merged", F.col("streak") - line)
    events = event(F.lit("failover"), lines).unionByName(
        event(F.when(F.col("failed_over"), "candidate").otherwise("recovered"), turning)
    )
    return events.select(*EVENT_SCHEMA.names), _next_state(rows, lines, state)


def _log_lines(rows: DataFrame, state: DataFrame, interval_s: int, piece_rows: int) -> DataFrame:
    """Throttled failovers; the last line of an open episode goes before its new rows."""
    columns = [*GROUP, *_LINE, "streak_in", "line_in"]
    failed = rows.filter("failed_over").select(*columns, F.lit(False).alias("old"))
    old = state.filter("emitted_ts IS NOT NULL").select(
        *GROUP,
        F.col("episode_in").alias("episode"),
        F.col("emitted_ts").alias("ts"),
        F.lit(-1).cast("bigint").alias("batch_id"),
        F.col("emitted_streak").alias("streak"),
        F.lit(0).cast("bigint").alias("affected_keys"),
        F.lit("").alias("reason"),
        F.lit(None).cast("bigint").alias("streak_in"),
        F.lit(None).cast("bigint").alias("line_in"),
        F.lit(True).alias("old"),
    )
    kept = spaced(failed.unionByName(old), [*GROUP, "episode"], ORDER, "ts", interval_s * 1000, piece_rows)
    # The first line of the batch also stands for what was passed over before the batch.
    first = (F.col("streak") - 1 - F.col("merged")) == F.col("streak_in")
    earlier = F.when(first & (interval_s > 0), F.coalesce(F.col("streak_in") - F.col("line_in"), F.lit(0))).otherwise(0)
    return kept.filter("NOT old").select(*GROUP, *_LINE, (F.col("merged") + earlier).alias("merged"))


def _next_state(rows: DataFrame, lines: DataFrame, state: DataFrame) -> DataFrame:
    """State after the batch; a (table, subtask) without rows keeps the one it had."""
    failed = F.col("failed_over")
    ends = rows.groupBy(*GROUP).agg(
        F.max("batch_id").alias("newest"), F.count_if(~failed).alias("oks"), F.max(F.when(failed, F.struct("episode", "streak", "affected_keys"))).alias("tail")
    )
    last = lines.groupBy(*GROUP).agg(F.max(F.struct("episode", "streak", "ts")).alias("line"))
    joined = state.join(ends, [*GROUP], "full").join(last, [*GROUP], "left")
    episode = F.coalesce("episode_in", F.lit(0)) + F.coalesce("oks", F.lit(0))
    is_open = F.col("tail.episode") == episode
    has_line = F.col("line.episode") == episode
    goes_on = F.coalesce("oks", F.lit(0)) == 0
    return joined.select(
        *GROUP,
        episode.cast("bigint").alias("episode_in"),
        F.when(is_open, F.col("tail.streak")).when(goes_on, F.col("streak_in")).otherwise(0).alias("streak_in"),
        F.when(is_open, F.col("tail.affected_keys")).when(goes_on, F.col("keys_in")).otherwise(0).alias("keys_in"),
        F.when(has_line, F.col("line.ts")).when(goes_on, F.col("emitted_ts")).alias("emitted_ts"),
        F.when(has_line, F.col("line.streak")).when(goes_on, F.col("emitted_streak")).alias("emitted_streak"),
        F.greatest("last_batch", "newest").alias("last_batch"),
    )


def numbered_state(spark, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """State after the micro-batch before ``batch_id``; only the very first one starts from nothing."""
    before = f"{path}/{BATCH_FOLDER}={batch_id - 1}"
    if folder_bytes(spark, before) > 0:
        return spark.read.schema(schema).parquet(before)
    if batch_id > 0:
        raise FileNotFoundError(f"{before} is missing: without it episodes would be numbered anew; restore it or start with a new checkpoint")
    return spark.createDataFrame([], schema)


def episode_stream(
    log: DataFrame,
    options: LookupOptions,
    sink: BatchSink,
    *,
    state_path: str,
    checkpoint: str,
    name: str = "episodes",
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch's episode events to ``sink``.

    The state after each micro-batch is a small table under ``state_path``, numbered by batch: a
    replayed batch starts from the same state again. The log is expected in time order from batch
    to batch.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = numbered_state(spark, state_path, batch_id, STATE_SCHEMA)
        with staging_scope(spark):
            events, following = episode_step(batch, state, options)
            sink(events, batch_id)
            folder_sink(state_path)(following, batch_id)
        delete_path(spark, f"{state_path}/{BATCH_FOLDER}={batch_id - 2}")

    writer = log.writeStream.queryName(name).foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def alert_batch(
    events: DataFrame, history: DataFrame, options: LookupOptions
) -> tuple[DataFrame, DataFrame]:
    """(alerts to deliver, alerts the cooldown suppressed) of one micro-batch of events.

    ``history`` is the delivery log so far, or what :func:`alerted_after` keeps of it. The last alert of each table and topic in it goes
    before the new candidates, so the cooldown runs on across batches.
    """
    gone = history.filter("status <> 'suppressed'")
    columns = ["table_name", "subtask", "episode", "ts", "batch_id", "topic", "streak", "affected_keys", "reason"]
    candidates = (
        events.filter("event = 'candidate'").withColumn("topic", F.lit(options.alert_topic)).select(*columns, F.lit(False).alias("old"))
    )
    latest = (
        gone.filter("kind = 'failover'")
        .groupBy("table_name", "topic")
        .agg(F.max(F.struct("ts", "batch_id", "subtask", "episode")).alias("last"))
        .select(
            "table_name", "last.subtask", "last.episode", "last.ts", "last.batch_id", "topic",
            F.lit(0).cast("bigint").alias("streak"), F.lit(0).cast("bigint").alias("affected_keys"),
            F.lit("").alias("reason"), F.lit(True).alias("old"),
        )
    )
    passed = with_cooldown(candidates.unionByName(latest), options.alert_cooldown_min).filter("not old")
    sent = passed.select(*columns)
    suppressed = candidates.join(sent.select("table_name", "subtask", "episode"), ["table_name", "subtask", "episode"], "left_anti")
    recovered = None
    if options.alert_recovery:
        alerted = sent.select("table_name", "subtask", "episode", "topic").unionByName(
            gone.filter("kind = 'failover'").select("table_name", "subtask", "episode", "topic")
        )
        recovered = events.filter("event = 'recovered'").join(alerted.distinct(), ["table_name", "subtask", "episode"])
    return render_events(sent, recovered, options), suppressed


def alerted_after(history: DataFrame, delivered: DataFrame, events: DataFrame) -> DataFrame:
    """What later micro-batches need of the delivery log: alerted episodes that go on, and the last alert per table and topic."""
    gone = "kind = 'failover' AND status <> 'suppressed'"
    fresh = delivered.filter(gone).select(*DELIVERY_SCHEMA.names, F.lit(False).alias("ended"))
    alerts = history.unionByName(fresh)
    over = events.filter("event = 'recovered'").select(*GROUP, "episode").distinct().withColumn("over", F.lit(True))
    latest = alerts.groupBy("table_name", "topic").agg(F.max(F.struct("ts", "batch_id", "subtask", "episode")).alias("last"))
    marked = alerts.join(over, [*GROUP, "episode"], "left").join(latest, ["table_name", "topic"])
    marked = marked.withColumn("ended", F.col("ended") | F.col("over").isNotNull())
    return marked.filter(~F.col("ended") | (F.struct("ts", "batch_id", "subtask", "episode") == F.col("last"))).select(*ALERTED_SCHEMA.names)


def alert_stream(
    log: DataFrame,
    options: LookupOptions,
    sink: AlertSink,
    *,
    delivery_path: str,
    state_path: str,
    checkpoint: str,
    name: str = "alerts",
    trigger: Mapping | None = None,
    sleep: Callable[[float], None] | None = None,
) -> StreamingQuery:
    """Start the alert query: episodes, threshold, cooldown, render, deliver, delivery log.

    It reads the lookup log and not the lookups, so nothing here can slow or fail an enrichment.
    A sink that keeps failing ends in dead letters; the query goes on. What cooldown and recovery
    need of earlier alerts is kept as numbered state next to the episodes', so a micro-batch reads
    no more of the delivery log the longer that gets.
    """
    pause = {"sleep": sleep} if sleep else {}
    write = folder_sink(delivery_path)
    alerted_path = f"{state_path.rstrip('/')}-alerted"

    def on_events(events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        turning = stage(events.filter("event <> 'failover'"), "events")
        history = numbered_state(spark, alerted_path, batch_id, ALERTED_SCHEMA)
        alerts, suppressed = alert_batch(turning, history, options)
        alerts = stage(alerts, "alerts")
        if alerts.isEmpty():
            delivered = spark.createDataFrame([], DELIVERY_SCHEMA)
        else:
            delivered = stage(deliver(alerts, sink, options, **pause), "delivered")
        held = suppressed.withColumns(
            {"kind": F.lit("failover"), "payload": F.lit(None).cast("string"), "status": F.lit("suppressed")}
        )
        write(delivered.unionByName(delivery_rows(held, Delivery(False, 0, 0))), batch_id)
        folder_sink(alerted_path)(alerted_after(history, delivered, turning), batch_id)
        delete_path(spark, f"{alerted_path}/{BATCH_FOLDER}={batch_id - 2}")

    return episode_stream(
        log, options, on_events, state_path=state_path, checkpoint=checkpoint, name=name, trigger=trigger
    )
