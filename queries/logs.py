"""Statistics, episodes and alerts over a lookup log derived from the events (groups D, E, F)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queries.common import OPTIONS, sql, table
from tandem.functions.template import json_escape
from tandem.plans.alerts import alert_events, failover_candidates, reason_of
from tandem.plans.episodes import (
    alert_candidates,
    deduplicated_alerts,
    recoveries,
    recovery_alerts,
    throttled_failovers,
    with_cooldown,
    with_streaks,
)
from tandem.plans.log import replay_routes
from tandem.plans.stats import (
    COUNTERS,
    cumulative_counters,
    failure_kinds,
    interval_counters,
    remaining_totals,
    stats_lines,
    with_rates,
)
from tandem.session import new_staging_path, stage
from tandem.sinks.delivery import Delivery, deliver, delivery_counters, delivery_rows

QUERIES = {}
ORACLES = {}

# One outcome per event. The text runs unchanged in Spark and in the checking engine.
OUTCOMES_SQL = """
SELECT
  CASE user_id % 3 WHEN 0 THEN 'dim_customer' WHEN 1 THEN 'dim_part' ELSE 'dim_supplier' END AS table_name,
  CONCAT(CAST(user_id % 4 + 1 AS STRING), '/4') AS subtask,
  event_id AS batch_id, ts,
  CAST(1 + event_id % 50 AS INT) AS n_keys,
  CASE WHEN event_type = 'error' OR value * 10 > 500 THEN CAST(500 AS DOUBLE) ELSE value * 10 END AS primary_ms,
  CASE WHEN event_type = 'error' THEN
         CASE event_id % 5 WHEN 0 THEN 'java.util.concurrent.TimeoutException'
                           WHEN 1 THEN 'java.net.ConnectException'
                           WHEN 2 THEN 'java.util.concurrent.RejectedExecutionException'
                           WHEN 3 THEN 'java.sql.SQLException'
                           ELSE 'java.lang.IllegalStateException' END
       WHEN value * 10 > 500 THEN 'java.util.concurrent.TimeoutException' END AS primary_error,
  CASE WHEN event_type = 'error' THEN CONCAT('bad "quote" in ', props)
       WHEN value * 10 > 500 THEN '' END AS primary_message,
  CASE WHEN event_type = 'error' OR value * 10 > 500 THEN NULL
       ELSE CAST((event_id * 7) % (2 + event_id % 50) AS INT) END AS primary_hits,
  CASE WHEN event_type = 'error' OR value * 10 > 500 THEN CAST(1 + event_id % 20 AS DOUBLE) END AS standby_ms,
  CASE WHEN (event_type = 'error' OR value * 10 > 500) AND event_id % 97 = 0 THEN 'java.sql.SQLException' END AS standby_error,
  CASE WHEN (event_type = 'error' OR value * 10 > 500) AND event_id % 97 <> 0
       THEN CAST((event_id * 3) % (2 + event_id % 50) AS INT) END AS standby_hits
FROM events
"""

STREAKS_CTE = f"""
log AS (SELECT *, primary_error IS NOT NULL AS failed_over FROM ({OUTCOMES_SQL}) x),
numbered AS (
  SELECT *, COALESCE(SUM(CASE WHEN failed_over THEN 0 ELSE 1 END) OVER (
              PARTITION BY table_name, subtask ORDER BY ts, batch_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS episode
  FROM log),
streaks AS (
  SELECT *, CAST(SUM(CASE WHEN failed_over THEN 1 ELSE 0 END) OVER run AS BIGINT) AS streak,
         CAST(SUM(CASE WHEN failed_over THEN n_keys ELSE 0 END) OVER run AS BIGINT) AS affected_keys
  FROM numbered
  WINDOW run AS (PARTITION BY table_name, subtask, episode ORDER BY ts, batch_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""

DAY_S = 86_400
THROTTLE_S = 6 * 3600
COOLDOWN_MIN = 2 * 24 * 60

ALERT_OPTIONS = replace(
    OPTIONS,
    alert_threshold=2,
    alert_bootstrap="broker:9092",
    alert_topic="alerts",
    alert_cooldown_min=COOLDOWN_MIN,
)


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = sql(oracle)
        return function

    return register


def lookup_log(spark, sf_dir) -> DataFrame:
    """The derived lookup log with its route columns."""
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    outcomes = spark.sql(OUTCOMES_SQL).withColumn("ts", F.col("ts").cast("timestamp"))
    return replay_routes(outcomes, "hbase", "doris")


def ntz(df: DataFrame, *names: str) -> DataFrame:
    """Time columns without zone, as the checking engine has them."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


# ------------------------------------------------------------------ routes


@query(
    "e1_route_replay",
    f"""
    SELECT batch_id, failed_over,
           CASE WHEN NOT failed_over THEN 'hbase' WHEN standby_error IS NULL THEN 'doris' END AS lookup_source,
           CASE WHEN NOT failed_over THEN CAST(FLOOR(primary_ms) AS BIGINT)
                WHEN standby_error IS NULL THEN CAST(FLOOR(primary_ms + standby_ms) AS BIGINT) END AS lookup_cost_ms,
           failed_over AND standby_error IS NOT NULL AS failed
    FROM (SELECT *, primary_error IS NOT NULL AS failed_over FROM ({OUTCOMES_SQL}) x) y
    """,
)
def e1_route_replay(spark, sf_dir):
    return lookup_log(spark, sf_dir).select("batch_id", "failed_over", "lookup_source", "lookup_cost_ms", "failed")


@query(
    "e1_route_replay_deadline",
    f"""
    SELECT batch_id, primary_error IS NOT NULL OR primary_ms > 250 AS failed_over,
           CASE WHEN NOT (primary_error IS NOT NULL OR primary_ms > 250) THEN 'hbase'
                WHEN standby_error IS NULL THEN 'doris' END AS lookup_source
    FROM ({OUTCOMES_SQL}) x
    """,
)
def e1_route_replay_deadline(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    routed = replay_routes(spark.sql(OUTCOMES_SQL), "hbase", "doris", deadline_ms=250)
    return routed.select("batch_id", "failed_over", "lookup_source")


# ------------------------------------------------------------------ statistics

KIND_SQL = """
  CASE WHEN primary_error LIKE '%.TimeoutException' THEN 'timeout' WHEN primary_error LIKE '%.ConnectException' THEN 'connect'
       WHEN primary_error LIKE '%.RejectedExecutionException' THEN 'pool_full'
       WHEN primary_error LIKE 'java.sql.%' THEN 'database' WHEN primary_error IS NOT NULL THEN 'other' END
"""

COUNTERS_CTE = f"""
log AS (SELECT *, {KIND_SQL} AS kind, primary_error IS NOT NULL AS failed_over FROM ({OUTCOMES_SQL}) x),
counters AS (
  SELECT table_name, subtask, DATE_TRUNC('day', ts) AS window_start,
         COUNT(*) AS primary_batches, CAST(SUM(n_keys) AS BIGINT) AS primary_keys,
         COUNT(*) FILTER (failed_over) AS primary_fails, SUM(primary_ms) AS primary_ms,
         MAX(primary_ms) AS primary_max_ms,
         CAST(COALESCE(SUM(primary_hits) FILTER (NOT failed_over), 0) AS BIGINT) AS primary_hits,
         CAST(COALESCE(SUM(n_keys) FILTER (NOT failed_over), 0) AS BIGINT) AS primary_hit_keys,
         COUNT(*) FILTER (failed_over) AS standby_batches,
         CAST(COALESCE(SUM(n_keys) FILTER (failed_over), 0) AS BIGINT) AS standby_keys,
         COUNT(*) FILTER (failed_over AND standby_error IS NOT NULL) AS standby_fails,
         SUM(standby_ms) FILTER (failed_over) AS standby_ms, MAX(standby_ms) FILTER (failed_over) AS standby_max_ms,
         CAST(COALESCE(SUM(standby_hits) FILTER (failed_over AND standby_error IS NULL), 0) AS BIGINT) AS standby_hits,
         CAST(COALESCE(SUM(n_keys) FILTER (failed_over AND standby_error IS NULL), 0) AS BIGINT) AS standby_hit_keys,
         COUNT(*) FILTER (kind = 'timeout') AS fail_timeout, COUNT(*) FILTER (kind = 'connect') AS fail_connect,
         COUNT(*) FILTER (kind = 'pool_full') AS fail_pool_full, COUNT(*) FILTER (kind = 'database') AS fail_database,
         COUNT(*) FILTER (kind = 'other') AS fail_other
  FROM log GROUP BY ALL)
"""


def day_counters(spark, sf_dir) -> DataFrame:
    return interval_counters(lookup_log(spark, sf_dir), DAY_S)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


@query(
    "d1_interval_stats",
    f"""
    WITH {COUNTERS_CTE}
    SELECT * REPLACE (ROUND(primary_ms, 6) AS primary_ms, ROUND(primary_max_ms, 6) AS primary_max_ms),
           CAST({DAY_S} AS BIGINT) AS window_s FROM counters
    """,
)
def d1_interval_stats(spark, sf_dir):
    return rounded(ntz(day_counters(spark, sf_dir), "window_start"), "primary_ms", "primary_max_ms")


@query(
    "d2_cumulative_stats",
    f"""
    WITH {COUNTERS_CTE}
    SELECT table_name, subtask, window_start,
           CAST(SUM(primary_batches) OVER w AS BIGINT) AS primary_batches,
           CAST(SUM(primary_keys) OVER w AS BIGINT) AS primary_keys,
           CAST(SUM(primary_fails) OVER w AS BIGINT) AS primary_fails, ROUND(SUM(primary_ms) OVER w, 6) AS primary_ms,
           ROUND(MAX(primary_max_ms) OVER w, 6) AS primary_max_ms, CAST(SUM(standby_keys) OVER w AS BIGINT) AS standby_keys,
           MAX(standby_max_ms) OVER w AS standby_max_ms, CAST(SUM(fail_timeout) OVER w AS BIGINT) AS fail_timeout,
           CAST(DATE_DIFF('second', MIN(window_start) OVER w, window_start) + {DAY_S} AS BIGINT) AS window_s
    FROM counters
    WINDOW w AS (PARTITION BY table_name, subtask ORDER BY window_start ROWS UNBOUNDED PRECEDING)
    """,
)
def d2_cumulative_stats(spark, sf_dir):
    totals = cumulative_counters(day_counters(spark, sf_dir)).select(
        "table_name", "subtask", "window_start", "primary_batches", "primary_keys", "primary_fails", "primary_ms",
        "primary_max_ms", "standby_keys", "standby_max_ms", "fail_timeout", "window_s",
    )
    return rounded(ntz(totals, "window_start"), "primary_ms", "primary_max_ms")


@query(
    "d5_latency_and_rates",
    f"""
    WITH {COUNTERS_CTE}
    SELECT table_name, subtask, window_start, primary_keys AS business_keys, primary_keys + standby_keys AS processed_keys,
           ROUND(primary_ms / primary_batches, 6) AS primary_avg_ms,
           ROUND(standby_ms / NULLIF(standby_batches, 0), 6) AS standby_avg_ms,
           primary_fails AS failovers, standby_keys AS failover_keys,
           ROUND(standby_keys / primary_keys, 6) AS failover_share,
           ROUND((primary_keys + standby_keys) / {DAY_S}, 6) AS keys_per_s,
           primary_keys // primary_batches AS primary_batch_size,
           (primary_keys + standby_keys) // (primary_batches + standby_batches) AS overall_batch_size
    FROM counters
    """,
)
def d5_latency_and_rates(spark, sf_dir):
    rates = with_rates(day_counters(spark, sf_dir)).select(
        "table_name", "subtask", "window_start", "business_keys", "processed_keys", "primary_avg_ms", "standby_avg_ms",
        "failovers", "failover_keys", "failover_share", "keys_per_s", "primary_batch_size", "overall_batch_size",
    )
    return rounded(ntz(rates, "window_start"), "primary_avg_ms", "standby_avg_ms", "failover_share", "keys_per_s")


@query(
    "d7_hit_rate",
    f"""
    WITH {COUNTERS_CTE}
    SELECT table_name, subtask, window_start,
           ROUND(primary_hits / NULLIF(primary_hit_keys, 0), 6) AS primary_hit_rate,
           ROUND(standby_hits / NULLIF(standby_hit_keys, 0), 6) AS standby_hit_rate
    FROM counters
    """,
)
def d7_hit_rate(spark, sf_dir):
    rates = with_rates(day_counters(spark, sf_dir))
    rates = rates.select("table_name", "subtask", "window_start", "primary_hit_rate", "standby_hit_rate")
    return rounded(ntz(rates, "window_start"), "primary_hit_rate", "standby_hit_rate")


@query(
    "d10_failure_kinds",
    f"""
    WITH {COUNTERS_CTE}
    SELECT table_name, subtask, window_start,
           CONCAT_WS(',', CASE WHEN fail_timeout > 0 THEN 'timeout=' || fail_timeout END,
                     CASE WHEN fail_connect > 0 THEN 'connect=' || fail_connect END,
                     CASE WHEN fail_pool_full > 0 THEN 'pool_full=' || fail_pool_full END,
                     CASE WHEN fail_database > 0 THEN 'database=' || fail_database END,
                     CASE WHEN fail_other > 0 THEN 'other=' || fail_other END) AS kinds
    FROM counters
    """,
)
def d10_failure_kinds(spark, sf_dir):
    kinds = failure_kinds(day_counters(spark, sf_dir))
    text = F.array_join(
        F.transform(F.map_entries("fail_kinds"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","
    )
    return ntz(kinds.select("table_name", "subtask", "window_start", text.alias("kinds")), "window_start")


def line_sql() -> str:
    """The statistics line of a counters row, spelled in SQL."""
    kinds = ", ".join(
        f"CASE WHEN fail_{k} > 0 THEN '{k}=' || fail_{k} END" for k in ("timeout", "connect", "pool_full", "database", "other")
    )
    return f"""
      '=' || window_s || 's business=' || primary_keys || ' processed=' || (primary_keys + standby_keys)
      || ' rate=' || PRINTF('%.1f/s', ROUND(ROUND((primary_keys + standby_keys) / window_s, 6), 1))
      || ' avg.batch=' || (primary_keys // primary_batches)
      || ' overall.batch=' || ((primary_keys + standby_keys) // (primary_batches + standby_batches))
      || ' | primary(hbase)[batches=' || primary_batches || ' keys=' || primary_keys || ' failed='
      || CASE WHEN primary_fails = 0 THEN '0' ELSE primary_fails || '(' || CONCAT_WS(',', {kinds}) || ')' END
      || ' avg=' || PRINTF('%.1fms', ROUND(ROUND(primary_ms / primary_batches, 6), 1)) || ' max=' || PRINTF('%.1fms', ROUND(ROUND(primary_max_ms, 6), 1))
      || ' hit=' || COALESCE(PRINTF('%.1f%%', ROUND(ROUND(100.0 * primary_hits / NULLIF(primary_hit_keys, 0), 6), 1)), '-')
      || '] standby(doris)[batches=' || standby_batches || ' keys=' || standby_keys || ' failed=' || standby_fails
      || ' avg=' || COALESCE(PRINTF('%.1fms', ROUND(ROUND(standby_ms / NULLIF(standby_batches, 0), 6), 1)), '-')
      || ' max=' || COALESCE(PRINTF('%.1fms', standby_max_ms), '-')
      || ' hit=' || COALESCE(PRINTF('%.1f%%', ROUND(ROUND(100.0 * standby_hits / NULLIF(standby_hit_keys, 0), 6), 1)), '-')
      || '] failover=' || CASE WHEN primary_fails = 0 THEN '0' ELSE primary_fails || ' (' || standby_keys || ' keys, '
      || PRINTF('%.1f%%', ROUND(ROUND(100.0 * standby_keys / primary_keys, 6), 1)) || ')' END
    """


@query(
    "d12_stats_lines",
    f"""
    WITH {COUNTERS_CTE},
    here AS (SELECT *, CAST({DAY_S} AS BIGINT) AS window_s, ROW_NUMBER() OVER w AS nth FROM counters
             WINDOW w AS (PARTITION BY table_name, subtask ORDER BY window_start)),
    since AS (
      SELECT table_name, subtask, window_start, {", ".join(f"SUM({name}) OVER w AS {name}" for name in COUNTERS)},
             MAX(primary_max_ms) OVER w AS primary_max_ms, MAX(standby_max_ms) OVER w AS standby_max_ms,
             CAST(DATE_DIFF('second', MIN(window_start) OVER w, window_start) + {DAY_S} AS BIGINT) AS window_s
      FROM counters
      WINDOW w AS (PARTITION BY table_name, subtask ORDER BY window_start ROWS UNBOUNDED PRECEDING)),
    lines AS (SELECT table_name, subtask, window_start, nth, 'window' || {line_sql()} AS line FROM here),
    totals AS (SELECT table_name, subtask, window_start, 'since.start' || {line_sql()} AS total FROM since)
    SELECT table_name, subtask, window_start,
           'table=' || table_name || ' subtask=' || subtask || ' | '
           || CASE WHEN nth = 1 THEN 'since.start=' || line ELSE line || ' || ' || total END AS line
    FROM lines JOIN totals USING (table_name, subtask, window_start)
    """,
)
def d12_stats_lines(spark, sf_dir):
    return ntz(stats_lines(day_counters(spark, sf_dir), "hbase", "doris"), "window_start")


@query(
    "d13_remaining_totals",
    f"""
    WITH {COUNTERS_CTE}
    SELECT table_name, subtask, COUNT(*) AS primary_batches, CAST(SUM(n_keys) AS BIGINT) AS primary_keys,
           COUNT(*) FILTER (failed_over) AS primary_fails
    FROM log GROUP BY table_name, subtask HAVING MAX(ts) > TIMESTAMP '2024-01-30 23:00:00'
    """,
)
def d13_remaining_totals(spark, sf_dir):
    reported = F.lit("2024-01-30 23:00:00").cast("timestamp")
    totals = remaining_totals(lookup_log(spark, sf_dir), reported)
    return totals.select("table_name", "subtask", "primary_batches", "primary_keys", "primary_fails")


# ------------------------------------------------------------------ episodes


@query(
    "e2_streaks",
    f"WITH {STREAKS_CTE} SELECT table_name, subtask, batch_id, CAST(episode AS BIGINT) AS episode, streak, affected_keys FROM streaks",
)
def e2_streaks(spark, sf_dir):
    streaks = with_streaks(lookup_log(spark, sf_dir))
    return streaks.select("table_name", "subtask", "batch_id", "episode", "streak", "affected_keys")


THROTTLE_SQL = f"""
WITH RECURSIVE {STREAKS_CTE},
failed AS (SELECT table_name, subtask, episode, ts, batch_id, streak FROM streaks WHERE failed_over),
emitted AS (
  SELECT table_name, subtask, episode, ts, batch_id, streak, CAST(0 AS BIGINT) AS merged FROM failed WHERE streak = 1
  UNION ALL
  SELECT table_name, subtask, episode, ts, batch_id, streak, merged FROM (
    SELECT f.*, f.streak - e.streak - 1 AS merged,
           ROW_NUMBER() OVER (PARTITION BY f.table_name, f.subtask, f.episode ORDER BY f.streak) AS nth
    FROM emitted e JOIN failed f ON e.table_name = f.table_name AND e.subtask = f.subtask AND e.episode = f.episode
     AND f.streak > e.streak AND f.ts >= e.ts + INTERVAL {THROTTLE_S} SECOND) nexts
  WHERE nth = 1)
"""


@query(
    "e3_log_throttle",
    f"{THROTTLE_SQL} SELECT table_name, subtask, CAST(episode AS BIGINT) AS episode, batch_id, streak, merged FROM emitted",
)
def e3_log_throttle(spark, sf_dir):
    narrow = with_streaks(lookup_log(spark, sf_dir)).select(
        "table_name", "subtask", "episode", "ts", "batch_id", "streak", "failed_over"
    )
    lines = throttled_failovers(narrow, THROTTLE_S)
    return lines.select("table_name", "subtask", "episode", "batch_id", "streak", "merged")


@query(
    "e4_recoveries",
    f"""
    WITH {STREAKS_CTE}
    SELECT table_name, subtask, batch_id, ts, streak AS episode_batches, affected_keys
    FROM streaks WHERE NOT failed_over AND streak > 0
    """,
)
def e4_recoveries(spark, sf_dir):
    ended = recoveries(with_streaks(lookup_log(spark, sf_dir)))
    return ntz(ended.select("table_name", "subtask", "batch_id", "ts", "episode_batches", "affected_keys"), "ts")


@query(
    "f1_alerts",
    f"WITH {STREAKS_CTE} SELECT table_name, subtask, batch_id, ts, streak, affected_keys FROM streaks WHERE failed_over AND streak = 3",
)
def f1_alerts(spark, sf_dir):
    crossed = alert_candidates(with_streaks(lookup_log(spark, sf_dir)), 3)
    return ntz(crossed.select("table_name", "subtask", "batch_id", "ts", "streak", "affected_keys"), "ts")


SENT_CTE = f"""
{STREAKS_CTE},
candidates AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY table_name ORDER BY ts, batch_id, subtask) AS nth
  FROM streaks WHERE failed_over AND streak = 2),
sent AS (
  SELECT table_name, subtask, episode, ts, batch_id, affected_keys, primary_error, primary_message, nth
  FROM candidates WHERE nth = 1
  UNION ALL
  SELECT table_name, subtask, episode, ts, batch_id, affected_keys, primary_error, primary_message, nth FROM (
    SELECT c.*, ROW_NUMBER() OVER (PARTITION BY c.table_name ORDER BY c.nth) AS pick
    FROM sent s JOIN candidates c ON s.table_name = c.table_name AND c.nth > s.nth
     AND c.ts >= s.ts + INTERVAL {COOLDOWN_MIN} MINUTE) nexts
  WHERE pick = 1)
"""


def sent_alerts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(alerts past the cooldown, all batches with their streaks)."""
    streaks = with_streaks(lookup_log(spark, sf_dir))
    return with_cooldown(failover_candidates(streaks, ALERT_OPTIONS), COOLDOWN_MIN), streaks


@query(
    "f3_cooldown",
    f"WITH RECURSIVE {SENT_CTE} SELECT table_name, subtask, batch_id, ts, affected_keys FROM sent",
)
def f3_cooldown(spark, sf_dir):
    sent, _ = sent_alerts(spark, sf_dir)
    return ntz(sent.select("table_name", "subtask", "batch_id", "ts", "affected_keys"), "ts")


RECOVERED_SQL = """
  SELECT k.table_name, k.subtask, k.episode, k.batch_id, k.ts, k.streak AS episode_batches
  FROM streaks k JOIN sent s ON k.table_name = s.table_name AND k.subtask = s.subtask AND k.episode = s.episode
  WHERE NOT k.failed_over
"""


@query(
    "f4_recovery",
    f"WITH RECURSIVE {SENT_CTE} SELECT table_name, subtask, batch_id, ts, episode_batches FROM ({RECOVERED_SQL}) r",
)
def f4_recovery(spark, sf_dir):
    ended = recovery_alerts(*sent_alerts(spark, sf_dir))
    return ntz(ended.select("table_name", "subtask", "batch_id", "ts", "episode_batches"), "ts")


REASON_SQL = """
  CASE WHEN primary_error IS NULL THEN '' WHEN COALESCE(primary_message, '') = '' THEN REGEXP_EXTRACT(primary_error, '([^.]*)$', 1)
       ELSE REGEXP_EXTRACT(primary_error, '([^.]*)$', 1) || ': ' || primary_message END
"""


@query("f5_reasons", f"SELECT batch_id, {REASON_SQL} AS reason FROM ({OUTCOMES_SQL}) x")
def f5_reasons(spark, sf_dir):
    log = lookup_log(spark, sf_dir)
    return log.select("batch_id", reason_of(F.col("primary_error"), F.col("primary_message")).alias("reason"))


ISO_SQL = "STRFTIME(ts, '%Y-%m-%dT%H:%M:%S.') || STRFTIME(ts, '%g') || 'Z'"
ESCAPED_REASON_SQL = f"""REPLACE(REPLACE({REASON_SQL}, chr(92), chr(92) || chr(92)), '"', chr(92) || '"')"""


@query(
    "f6_render",
    f"""
    WITH RECURSIVE {SENT_CTE}
    SELECT 'failover' AS kind, table_name, subtask, batch_id,
           '{{"alert":"lookup-failover","table":"' || table_name || '","primary":"hbase","standby":"doris","threshold":2,"consecutive":2,"affectedKeys":'
           || affected_keys || ',"reason":"' || {ESCAPED_REASON_SQL} || '","subtask":"' || subtask || '","timestamp":' || (EPOCH_US(ts) // 1000)
           || ',"datetime":"' || {ISO_SQL} || '"}}' AS payload
    FROM sent
    UNION ALL
    SELECT 'recovery', table_name, subtask, batch_id,
           '{{"alert":"lookup-recovered","table":"' || table_name || '","primary":"hbase","standby":"doris","subtask":"' || subtask
           || '","timestamp":' || (EPOCH_US(ts) // 1000) || ',"datetime":"' || {ISO_SQL} || '"}}'
    FROM ({RECOVERED_SQL}) r
    """,
)
def f6_render(spark, sf_dir):
    return alert_events(lookup_log(spark, sf_dir), ALERT_OPTIONS).select(
        "kind", "table_name", "subtask", "batch_id", "payload"
    )


def escaped_sql(text: str) -> str:
    """JSON escape of a text, spelled as nested replacements."""
    text = f"REPLACE(REPLACE({text}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"')"
    short = {8: "b", 9: "t", 10: "n", 12: "f", 13: "r"}
    for code in range(1, 32):
        text = f"REPLACE({text}, chr({code}), chr(92) || '{short.get(code, f'u{code:04x}')}')"
    return text


@query("f7_json_escape", f"SELECT doc_id, MD5({escaped_sql('text')}) AS escaped FROM documents")
def f7_json_escape(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.md5(json_escape(F.col("text")).cast("binary")).alias("escaped"))


@query(
    "f10_alert_dedup",
    f"""
    WITH {STREAKS_CTE},
    ranked AS (
      SELECT *, DATE_TRUNC('day', ts) AS window_start, COUNT(*) OVER (PARTITION BY table_name, DATE_TRUNC('day', ts)) AS alerts,
             ROW_NUMBER() OVER (PARTITION BY table_name, DATE_TRUNC('day', ts) ORDER BY ts, batch_id, subtask) AS nth
      FROM streaks WHERE failed_over AND streak = 2)
    SELECT table_name, window_start, ts, batch_id, subtask, alerts FROM ranked WHERE nth = 1
    """,
)
def f10_alert_dedup(spark, sf_dir):
    crossed = failover_candidates(with_streaks(lookup_log(spark, sf_dir)), ALERT_OPTIONS)
    first = deduplicated_alerts(crossed, DAY_S)
    return ntz(first.select("table_name", "window_start", "ts", "batch_id", "subtask", "alerts"), "window_start", "ts")


@query(
    "d14_delivery_counters",
    f"""
    WITH RECURSIVE {SENT_CTE}
    SELECT c.table_name, COUNT(*) AS triggered, COUNT(s.batch_id) AS sent, CAST(COUNT(s.batch_id) AS BIGINT) AS failed,
           CAST(0 AS BIGINT) AS dropped, CAST(COUNT(s.batch_id) AS BIGINT) AS retries, COUNT(*) - COUNT(s.batch_id) AS suppressed,
           CAST(0 AS BIGINT) AS recovery, CAST(0 AS BIGINT) AS spooled
    FROM candidates c LEFT JOIN sent s ON c.table_name = s.table_name AND c.batch_id = s.batch_id
    GROUP BY c.table_name
    """,
)
def d14_delivery_counters(spark, sf_dir):
    candidates = failover_candidates(with_streaks(lookup_log(spark, sf_dir)), ALERT_OPTIONS).withColumns(
        {"kind": F.lit("failover"), "payload": F.lit("{}")}
    )
    sent = with_cooldown(candidates, COOLDOWN_MIN)
    held = candidates.join(sent, ["table_name", "batch_id"], "left_anti")
    log = delivery_rows(sent.withColumn("status", F.lit("sent")), Delivery(True, 1, 1)).unionByName(
        delivery_rows(held.withColumn("status", F.lit("suppressed")), Delivery(False, 0, 0))
    )
    return delivery_counters(log)


@query(
    "f9_delivery_outcomes",
    f"""
    WITH RECURSIVE {SENT_CTE},
    a AS (SELECT table_name, 'failover' AS kind FROM sent UNION ALL SELECT table_name, 'recovery' FROM ({RECOVERED_SQL}) r),
    n AS (SELECT table_name, COUNT(*) AS n, COUNT(*) FILTER (kind = 'failover') AS f FROM a GROUP BY table_name)
    SELECT table_name, f AS triggered, CASE table_name WHEN 'dim_customer' THEN n ELSE 0 END AS sent,
           CAST(CASE table_name WHEN 'dim_customer' THEN n ELSE 3 * n END AS BIGINT) AS failed,
           CASE table_name WHEN 'dim_supplier' THEN n ELSE 0 END AS dropped,
           CAST(CASE table_name WHEN 'dim_customer' THEN n ELSE 2 * n END AS BIGINT) AS retries,
           CAST(0 AS BIGINT) AS suppressed, n - f AS recovery, CASE table_name WHEN 'dim_part' THEN n ELSE 0 END AS spooled
    FROM n
    """,
)
def f9_delivery_outcomes(spark, sf_dir):
    """One table's sink works at the second try, one's never and its alerts are spooled, one's never and they are dropped."""
    alerts = stage(alert_events(lookup_log(spark, sf_dir), ALERT_OPTIONS), "alerts")
    tries = []

    def second_try(rows):
        tries.append(rows.count())
        if len(tries) < 2:
            raise OSError("broker is away")

    def never(rows):
        raise OSError("broker is away")

    spooling = replace(ALERT_OPTIONS, alert_spool_dir=new_staging_path(spark, "spool"))
    plans = {"dim_customer": (second_try, ALERT_OPTIONS), "dim_part": (never, spooling), "dim_supplier": (never, ALERT_OPTIONS)}
    log = None
    for name, (sink, options) in plans.items():
        rows = deliver(alerts.filter(F.col("table_name") == name), sink, options, sleep=lambda seconds: None)
        log = rows if log is None else log.unionByName(rows)
    return delivery_counters(log)
