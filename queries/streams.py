"""Streaming operators run over the tables as file streams (group S)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from queries.common import CUSTOMER, OPTIONS, down, sql, table, with_misses
from queries.logs import ALERT_OPTIONS, DAY_S, ORACLES as LOG_ORACLES, STREAKS_CTE, THROTTLE_S, THROTTLE_SQL, failover_candidates, lookup_log, ntz
from queries.lookups import orders_oracle, standby_customer, STANDBY_SQL
from tandem.plans.episodes import with_streaks
from tandem.plans.log import LOG_SCHEMA
from tandem.plans.stats import interval_counters, since_lines
from tandem.session import new_staging_path
from tandem.sinks.batches import folder_sink
from tandem.streaming.corrections import latest_revisions, pending_intervals, stats_revisions
from tandem.streaming.enrich import enrich_stream
from tandem.streaming.monitor import EVENT_SCHEMA, deduplicated_stream, episode_stream, log_stream, remaining_intervals, stats_stream

QUERIES = {}
ORACLES = {}

ONCE = {"availableNow": True}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = sql(oracle)
        return function

    return register


def table_stream(spark, sf_dir, name):
    """A given table as a file stream."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query("s2_enrich_stream", orders_oracle("LEFT", "doris", STANDBY_SQL, "'S:' || c.c_name"))
def s2_enrich_stream(spark, sf_dir):
    out, checkpoint = new_staging_path(spark, "enriched"), new_staging_path(spark, "checkpoint")
    started = enrich_stream(
        with_misses(table_stream(spark, sf_dir, "orders")),
        {"hbase": down, "doris": standby_customer(sf_dir)},
        {"o_custkey": "c_custkey"},
        CUSTOMER,
        OPTIONS,
        sink=folder_sink(out),
        checkpoint=checkpoint,
        name="s2",
        trigger=ONCE,
    )
    started.awaitTermination()
    return spark.read.parquet(out).select(
        "o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "lookup_source"
    )


@query(
    "s3_log_by_subtask",
    """
    SELECT CAST(4 AS BIGINT) AS subtasks, CAST(COUNT(k.o_custkey) AS BIGINT) AS n_keys, CAST(COUNT(c.c_custkey) AS BIGINT) AS hits,
           'doris' AS lookup_source
    FROM (SELECT CASE WHEN o_orderkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey FROM orders) k
    LEFT JOIN customer c ON k.o_custkey = c.c_custkey
    """,
)
def s3_log_by_subtask(spark, sf_dir):
    """What the log rows of four buckets of keys add up to, over all micro-batches."""
    out, log, checkpoint = [new_staging_path(spark, name) for name in ("enriched", "log", "checkpoint")]
    enrich_stream(
        with_misses(table_stream(spark, sf_dir, "orders")),
        {"hbase": down, "doris": standby_customer(sf_dir)},
        {"o_custkey": "c_custkey"},
        CUSTOMER,
        OPTIONS,
        sink=folder_sink(out),
        log_sink=folder_sink(log, files=1),
        checkpoint=checkpoint,
        name="s3",
        subtasks=4,
        trigger=ONCE,
    ).awaitTermination()
    rows = spark.read.schema(LOG_SCHEMA).parquet(log)
    return rows.groupBy("lookup_source").agg(
        F.count_distinct("subtask").alias("subtasks"), F.sum("n_keys").alias("n_keys"), F.sum("standby_hits").alias("hits")
    )


def plain_log(spark, sf_dir):
    """The derived lookup log with the columns of a written one."""
    log = lookup_log(spark, sf_dir)
    return log.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA])


def slices(log, parts=3):
    """``log`` in ``parts`` slices of time with about equally many rows."""
    timed = log.withColumn("__t", F.unix_micros("ts"))
    cuts = timed.approxQuantile("__t", [i / parts for i in range(1, parts)], 0.01)
    bounds = [None, *[int(c) for c in cuts], None]
    between = []
    for low, high in zip(bounds, bounds[1:]):
        rows = timed if low is None else timed.filter(F.col("__t") >= low)
        between.append((rows if high is None else rows.filter(F.col("__t") < high)).drop("__t"))
    return between


def fed(spark, batches, start):
    """Write ``batches`` one after the other, each by all tasks, and run the stream on what has come since.

    Every run goes on from the checkpoint and the state of the one before. Returns the path of the log.
    """
    path = new_staging_path(spark, "log")
    for number, rows in enumerate(batches):
        folder_sink(path)(rows, number)
        start(log_stream(spark, path)).awaitTermination()
    return path


EVENTS_SQL = f"""
    {THROTTLE_SQL}
    SELECT 'failover' AS event, e.table_name, e.subtask, CAST(e.episode AS BIGINT) AS episode, e.batch_id, e.streak, k.affected_keys
    FROM emitted e JOIN streaks k ON e.table_name = k.table_name AND e.subtask = k.subtask AND e.batch_id = k.batch_id
    UNION ALL
    SELECT 'candidate', table_name, subtask, CAST(episode AS BIGINT), batch_id, streak, affected_keys
    FROM streaks WHERE failed_over AND streak = 2
    UNION ALL
    SELECT 'recovered', table_name, subtask, CAST(episode AS BIGINT), batch_id, streak, affected_keys
    FROM streaks WHERE NOT failed_over AND streak > 0
"""

EVENT_OPTIONS = replace(ALERT_OPTIONS, failover_log_interval_s=THROTTLE_S)


def episode_events(spark, batches, name):
    paths = [new_staging_path(spark, part) for part in ("events", "state", "checkpoint")]

    def start(log):
        return episode_stream(
            log, EVENT_OPTIONS, folder_sink(paths[0]), state_path=paths[1], checkpoint=paths[2], name=name, trigger=ONCE
        )

    fed(spark, batches, start)
    out = spark.read.schema(EVENT_SCHEMA).parquet(paths[0])
    return out.select("event", "table_name", "subtask", "episode", "batch_id", "streak", "affected_keys")


@query("s4_episode_events", EVENTS_SQL)
def s4_episode_events(spark, sf_dir):
    """Log lines, candidates and recoveries of episodes that go on over micro-batches."""
    return episode_events(spark, slices(plain_log(spark, sf_dir)), "s4")


@query("s5_replayed_episodes", EVENTS_SQL)
def s5_replayed_episodes(spark, sf_dir):
    """Every slice of the log arrives twice and counts once."""
    return episode_events(spark, [rows for rows in slices(plain_log(spark, sf_dir), 2) for _ in range(2)], "s5")


@query(
    "s4_stats_stream",
    f"""
    WITH log AS (SELECT *, CASE user_id % 3 WHEN 0 THEN 'dim_customer' WHEN 1 THEN 'dim_part' ELSE 'dim_supplier' END AS table_name,
                        CONCAT(CAST(user_id % 4 + 1 AS VARCHAR), '/4') AS subtask FROM events)
    SELECT table_name, subtask, DATE_TRUNC('day', ts) AS window_start, COUNT(*) AS primary_batches,
           CAST(SUM(1 + event_id % 50) AS BIGINT) AS primary_keys,
           COUNT(*) FILTER (event_type = 'error' OR value * 10 > 500) AS primary_fails
    FROM log
    GROUP BY ALL
    """,
)
def s4_stats_stream(spark, sf_dir):
    """Intervals as the stream emits them, and those it leaves open when it ends."""
    out_path, checkpoint = new_staging_path(spark, "stats"), new_staging_path(spark, "checkpoint")

    def start(log):
        writer = stats_stream(log, DAY_S).writeStream.format("parquet").option("path", out_path)
        return writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(**ONCE).start()

    path = fed(spark, slices(plain_log(spark, sf_dir)), start)
    out = spark.read.schema(interval_counters(plain_log(spark, sf_dir), DAY_S).schema).parquet(out_path)
    rest = remaining_intervals(spark.read.schema(LOG_SCHEMA).parquet(path), out, DAY_S)
    shown = out.unionByName(rest).select("table_name", "subtask", "window_start", "primary_batches", "primary_keys", "primary_fails")
    return ntz(shown, "window_start")


@query("s4_late_corrections", LOG_ORACLES["d12_stats_lines"])
def s4_late_corrections(spark, sf_dir):
    """Statistics lines of a stream in which every fifth row comes a slice late, and some rows come twice."""
    parts = slices(plain_log(spark, sf_dir))
    late = F.pmod(F.xxhash64("batch_id"), F.lit(5)) == 0
    batches = [parts[0].filter(~late), parts[0].filter(late).union(parts[1].filter(~late)), parts[1].union(parts[2])]
    out, state, checkpoint = [new_staging_path(spark, name) for name in ("stats", "state", "checkpoint")]

    def start(log):
        return stats_revisions(
            log, folder_sink(out), interval_s=DAY_S, late_s=60 * DAY_S, state_path=state, checkpoint=checkpoint, name="s4-late", trigger=ONCE
        )

    fed(spark, batches, start)
    rows = latest_revisions(spark.read.parquet(out).drop("batch").unionByName(pending_intervals(spark, state)))
    return ntz(since_lines(rows, "hbase", "doris"), "window_start")


@query(
    "f10_dedup_stream",
    f"""
    WITH {STREAKS_CTE}
    SELECT DISTINCT table_name, DATE_TRUNC('day', ts) AS window_start FROM streaks WHERE failed_over AND streak = 2
    """,
)
def f10_dedup_stream(spark, sf_dir):
    """Two producers, each of half the subtasks, send alerts in slices of time; a table has one per day."""
    crossed = failover_candidates(with_streaks(plain_log(spark, sf_dir)), ALERT_OPTIONS).select("table_name", "subtask", "batch_id", "ts")
    half = F.substring("subtask", 1, 1).isin("1", "2")
    path, out, checkpoint = [new_staging_path(spark, name) for name in ("alerts", "first", "checkpoint")]
    for number, rows in enumerate(slices(crossed)):
        folder_sink(path)(rows.filter(half), 2 * number)
        folder_sink(path)(rows.filter(~half), 2 * number + 1)
        alerts = spark.readStream.schema(crossed.schema).parquet(f"{path}/batch=*")
        writer = deduplicated_stream(alerts, DAY_S).writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", checkpoint).trigger(**ONCE).start().awaitTermination()
    return ntz(spark.read.parquet(out).select("table_name", "window_start"), "window_start")
