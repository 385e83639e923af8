"""Streaming enrichment and monitoring, and the alert sinks."""

import json
import os
from datetime import datetime, timezone

import pytest
from conftest import log_rows
from pyspark.errors.exceptions.base import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.options import LookupOptions
from tandem.plans.log import LOG_SCHEMA
from tandem.sinks.batches import folder_sink, print_sink
from tandem.sinks.deadletter import dead_letter, with_status
from tandem.sinks.delivery import backoff_ms, deliver, delivery_counters, send_with_retries
from tandem.sinks.kafka import kafka_write_options
from tandem.sources.facts import batch_rule, json_facts, kafka_read_options, with_proc_time
from tandem.sources.jdbc import JdbcStore, jdbc_read_options, quote_table, wide_client_properties
from tandem.plans.stats import interval_counters, since_lines, stats_lines
from tandem.streaming.corrections import INTERVAL_STATE, SEEN_STATE, latest_revisions, pending_intervals, stats_revisions, stats_step
from tandem.streaming.enrich import enrich_stream
from tandem.streaming.monitor import (
    STATE_SCHEMA,
    alert_stream,
    deduplicated_stream,
    remaining_intervals,
    episode_step,
    episode_stream,
    log_stream,
    stats_stream,
)

ONCE = {"availableNow": True}
OPTIONS = LookupOptions(table_name="dim_account", deadline_ms=60_000)
ALERTS = LookupOptions(
    table_name="dim_account", alert_threshold=2, alert_bootstrap="b:1", alert_topic="t", alert_cooldown_min=0,
    failover_log_interval_s=10,
)
TRANSACTION = T.StructType([T.StructField(n, T.StringType()) for n in ("trans_jnls_no", "account_no", "amount")])
ACCOUNT = T.StructType(
    [
        T.StructField("account_no", T.StringType()),
        T.StructField("account_name", T.StringType()),
        T.StructField("lookup_source", T.StringType()),
        T.StructField("lookup_cost_ms", T.LongType()),
    ]
)


def messages(tmp_path, *batches):
    """JSON message files, one per micro-batch."""
    folder = tmp_path / "topic"
    folder.mkdir(exist_ok=True)
    for i, batch in enumerate(batches):
        file = folder / f"{i}.txt"
        file.write_text("\n".join(json.dumps(dict(zip(TRANSACTION.names, row))) for row in batch))
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def fact_stream(spark, folder):
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    return with_proc_time(json_facts(raw, TRANSACTION))


@pytest.fixture
def folder(tmp_path):
    return messages(tmp_path, [("1", "a", "10"), ("2", None, "20")], [("3", "b", "30"), ("4", "a", "40")], [("5", "z", "50")])


@pytest.fixture
def accounts(spark):
    return spark.createDataFrame([("a", "A"), ("b", "B")], "account_no string, account_name string")


def start(spark, tmp_path, folder, primary, standby, **more):
    return enrich_stream(
        fact_stream(spark, folder), {"hbase": primary, "doris": standby}, ["account_no"], ACCOUNT, OPTIONS,
        sink=folder_sink(str(tmp_path / "out")), log_sink=folder_sink(str(tmp_path / "log"), files=1),
        checkpoint=str(tmp_path / "checkpoint"), name="enrich", trigger=ONCE, **more,
    )


def test_stream_switches_store_per_batch(spark, tmp_path, folder, accounts):
    calls = []

    def flaky(session):
        calls.append(1)
        if len(calls) == 2:
            raise ConnectionError("down")
        return accounts

    start(spark, tmp_path, folder, flaky, lambda s: accounts).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).orderBy("trans_jnls_no").collect()
    assert [(r.trans_jnls_no, r.account_name, r.lookup_source) for r in out] == [
        ("1", "A", "hbase"), ("2", None, None), ("3", "B", "doris"), ("4", "A", "doris"), ("5", None, None)
    ]
    assert all(isinstance(r.proc_time, datetime) for r in out)
    log = spark.read.parquet(str(tmp_path / "log")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.n_keys, r.primary_hits, r.failed_over, r.standby_hits, r.lookup_source) for r in log] == [
        (0, 1, 1, False, None, "hbase"), (1, 2, None, True, 2, "doris"), (2, 1, 0, False, None, "hbase")
    ]
    assert {r.subtask for r in log} == {"enrich"} and {r.table_name for r in log} == {"dim_account"}


def test_double_failure_stops_the_stream_and_a_restart_replays(spark, tmp_path, folder, accounts):
    def down(session):
        raise ConnectionError("down")

    with pytest.raises(StreamingQueryException):
        start(spark, tmp_path, folder, down, down).awaitTermination()
    log = spark.read.parquet(str(tmp_path / "log")).first()
    assert (log.failed_over, log.standby_error, log.lookup_source, log.n_keys) == (True, "ConnectionError", None, 1)
    start(spark, tmp_path, folder, lambda s: accounts, down).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 5 and out.select("trans_jnls_no").distinct().count() == 5
    assert spark.read.parquet(str(tmp_path / "log")).filter("lookup_source is null").count() == 0


def test_stream_sees_the_dimension_as_it_is(spark, tmp_path, folder, accounts):
    versions = iter(["v0", "v1", "v2"])
    load = lambda s: accounts.withColumn("account_name", F.lit(next(versions)))
    start(spark, tmp_path, folder, load, load).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).filter("account_name is not null").collect()
    assert {r.trans_jnls_no: r.account_name for r in out} == {"1": "v0", "3": "v1", "4": "v1"}


def test_print_sink(spark, capsys):
    print_sink()(spark.range(50), 7)
    out = capsys.readouterr().out
    assert "batch 7" in out and all(f'{{"id":{i}}}' in out for i in range(50))


# ------------------------------------------------------------------ monitoring


def written_log(spark, tmp_path, *batches):
    path = str(tmp_path / "lookup_log")
    for i, batch in enumerate(batches):
        folder_sink(path, files=1)(batch, i)
    return path


def steps(spark, *numbered):
    """Log rows (batch id, second, keys, failed) as one file."""
    rows = log_rows(spark, [(s * 1000, k, f) for _, s, k, f in numbered])
    ids = [b for b, *_ in numbered]
    return rows.withColumn("batch_id", F.element_at(F.array(*[F.lit(b).cast("bigint") for b in ids]), (F.col("batch_id") + 1).cast("int")))


def test_episode_events_carry_state_over_batches(spark, tmp_path):
    path = written_log(
        spark, tmp_path,
        steps(spark, (0, 0, 5, True), (1, 4, 6, True)),
        steps(spark, (2, 8, 7, True), (3, 12, 1, True)),
        steps(spark, (4, 13, 1, False), (5, 14, 2, True)),
    )
    stream = log_stream(spark, path, maxFilesPerTrigger="1")
    out = str(tmp_path / "events")
    episode_stream(
        stream, ALERTS, folder_sink(out), state_path=str(tmp_path / "state"), checkpoint=str(tmp_path / "c"), trigger=ONCE
    ).awaitTermination()
    got = sorted((r.batch_id, r.event, r.episode, r.streak, r.affected_keys, r.merged) for r in spark.read.parquet(out).collect())
    assert got == [
        (0, "failover", 0, 1, 5, 0),
        (1, "candidate", 0, 2, 11, 1),
        (3, "failover", 0, 4, 19, 2),
        (4, "recovered", 0, 4, 19, 0),
        (5, "failover", 1, 1, 2, 0),
    ]


@pytest.mark.parametrize("interval_s, piece_rows", [(1, 10_000), (1, 40), (0, 10_000)])
def test_steps_give_the_events_of_the_whole_log(spark, interval_s, piece_rows):
    """Micro-batches of any size lead to the same events as one pass over the log."""
    from dataclasses import replace

    from test_analytics import random_log

    options = replace(ALERTS, failover_log_interval_s=interval_s)
    log = log_rows(spark, random_log(spark, 300, 5, 0.8)).cache()

    def events(*bounds):
        state, found = spark.createDataFrame([], STATE_SCHEMA), set()
        for low, high in zip(bounds[:-1], bounds[1:]):
            part = log.filter(f"batch_id >= {low} AND batch_id < {high}")
            new, state = episode_step(part, state, options, piece_rows)
            found |= {tuple(r) for r in new.collect()}
        return found

    whole = events(0, 300)
    assert len([e for e in whole if e[0] == "failover"]) > 20
    assert events(0, 90, 91, 250, 300) == whole


def run_alerts(spark, tmp_path, path, sink, options=ALERTS):
    query = alert_stream(
        log_stream(spark, path, maxFilesPerTrigger="1"), options, sink, delivery_path=str(tmp_path / "delivery"),
        state_path=str(tmp_path / "state"), checkpoint=str(tmp_path / "alerts"), trigger=ONCE, sleep=lambda s: None,
    )
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "delivery"))


def test_replayed_batches_count_once(spark, tmp_path):
    """A batch that is written, read, written again and read again; and one that is there twice at once."""
    first, again = steps(spark, (0, 0, 5, True)), steps(spark, (0, 9, 5, True))
    both = steps(spark, (1, 20, 3, False), (1, 21, 3, False), (2, 22, 4, True))
    path = written_log(spark, tmp_path, first, again, both)
    paths = {"state_path": str(tmp_path / "state"), "checkpoint": str(tmp_path / "c")}
    out = str(tmp_path / "events")
    episode_stream(log_stream(spark, path, maxFilesPerTrigger="1"), ALERTS, folder_sink(out), trigger=ONCE, **paths).awaitTermination()
    got = sorted((r.batch_id, r.event, r.episode, r.streak, r.affected_keys) for r in spark.read.parquet(out).collect())
    assert got == [(0, "failover", 0, 1, 5), (1, "recovered", 0, 1, 5), (2, "failover", 1, 1, 4)]
    stats = str(tmp_path / "stats")
    stats_stream(log_stream(spark, path, maxFilesPerTrigger="1"), 60).writeStream.format("parquet").option("path", stats).option(
        "checkpointLocation", str(tmp_path / "s")
    ).trigger(**ONCE).start().awaitTermination()
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    rest = remaining_intervals(log, spark.read.schema(interval_counters(log, 60).schema).parquet(stats), 60)
    assert [(r.primary_batches, r.primary_keys, r.primary_fails) for r in rest.collect()] == [(3, 12, 2)]


def test_lost_state_is_not_an_empty_one(spark, tmp_path):
    path = written_log(spark, tmp_path, steps(spark, (0, 0, 5, True)))
    paths = {"state_path": str(tmp_path / "state"), "checkpoint": str(tmp_path / "c")}
    run = lambda: episode_stream(log_stream(spark, path), ALERTS, folder_sink(str(tmp_path / "e")), trigger=ONCE, **paths).awaitTermination()
    run()
    folder_sink(path, files=1)(steps(spark, (1, 5, 5, True)), 1)
    paths["state_path"] = str(tmp_path / "elsewhere")
    with pytest.raises(Exception, match="is missing"):
        run()


def test_alert_state_does_not_grow_with_the_history(spark, tmp_path):
    batches = [steps(spark, (3 * i, 900 * i, 1, True), (3 * i + 1, 900 * i + 1, 1, True), (3 * i + 2, 900 * i + 2, 1, False)) for i in range(5)]
    path = written_log(spark, tmp_path, *batches)
    log = run_alerts(spark, tmp_path, path, lambda df: df.collect())
    assert sorted((r.kind, r.status) for r in log.collect()) == [("failover", "sent")] * 5 + [("recovery", "sent")] * 5
    assert spark.read.parquet(f"{tmp_path}/state-alerted/batch=4").count() == 1


def test_alert_stream_cooldown_and_recovery(spark, tmp_path):
    from dataclasses import replace

    path = written_log(
        spark, tmp_path,
        steps(spark, (0, 0, 1, True), (1, 1, 1, True)),
        steps(spark, (2, 2, 1, False), (3, 3, 1, True), (4, 4, 1, True), (5, 5, 1, False)),
        steps(spark, (6, 200, 1, True), (7, 201, 3, True), (8, 202, 1, False)),
    )
    sent = []
    log = run_alerts(
        spark, tmp_path, path, lambda df: sent.extend(json.loads(r.payload) for r in df.collect()), replace(ALERTS, alert_cooldown_min=3)
    )
    got = sorted((r.batch_id, r.kind, r.status) for r in log.collect())
    assert got == [
        (1, "failover", "sent"), (2, "recovery", "sent"), (4, "failover", "suppressed"), (7, "failover", "sent"), (8, "recovery", "sent")
    ]
    assert sorted(p["alert"] for p in sent) == ["lookup-failover"] * 2 + ["lookup-recovered"] * 2
    counts = delivery_counters(log).first()
    assert (counts.triggered, counts.sent, counts.suppressed, counts.recovery, counts.failed) == (3, 4, 1, 2, 0)


def test_alert_stream_survives_a_dead_sink(spark, tmp_path):
    from dataclasses import replace

    path = written_log(spark, tmp_path, steps(spark, (0, 0, 1, True), (1, 1, 1, True), (2, 2, 1, False)))
    tries = []

    def dead(df):
        tries.append(1)
        raise IOError("broker unreachable")

    spool = str(tmp_path / "spool")
    log = run_alerts(spark, tmp_path, path, dead, replace(ALERTS, alert_spool_dir=spool))
    assert len(tries) == 3
    counts = delivery_counters(log).first()
    assert (counts.sent, counts.spooled, counts.failed, counts.retries) == (0, 2, 6, 4)
    lines = [json.loads(r.value) for r in spark.read.text(spool).collect()]
    assert {line["clientId"] for line in lines} == {"lookup-alert-dim_account-1_4"}
    assert {line["payload"]["alert"] for line in lines} == {"lookup-failover", "lookup-recovered"}
    assert "broker unreachable" in lines[0]["error"]


def test_stats_stream_emits_complete_intervals(spark, tmp_path):
    path = written_log(
        spark, tmp_path,
        steps(spark, (0, 0, 5, True), (1, 30, 6, False)),
        steps(spark, (2, 70, 7, True), (3, 400, 1, True)),
    )
    out = str(tmp_path / "stats")
    log = log_stream(spark, path)
    stats_stream(log, 60, "10 seconds").writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(**ONCE).start().awaitTermination()
    got = sorted((r.window_start.minute, r.primary_batches, r.primary_keys, r.primary_fails) for r in spark.read.parquet(out).collect())
    assert got == [(0, 2, 11, 1), (1, 1, 7, 1)]
    rest = remaining_intervals(spark.read.schema(LOG_SCHEMA).parquet(path), spark.read.parquet(out), 60).collect()
    assert [(r.window_start.minute, r.primary_keys) for r in rest] == [(6, 1)]


def revised(spark, tmp_path, path, late_s=600):
    out, state = str(tmp_path / "revisions"), str(tmp_path / "stats_state")
    stats_revisions(
        log_stream(spark, path, maxFilesPerTrigger="1"), folder_sink(out), interval_s=60, late_s=late_s, state_path=state,
        checkpoint=str(tmp_path / "stats_checkpoint"), trigger=ONCE,
    ).awaitTermination()
    return spark.read.parquet(out).drop("batch"), pending_intervals(spark, state)


def test_late_rows_correct_what_was_emitted(spark, tmp_path):
    path = written_log(
        spark, tmp_path,
        steps(spark, (0, 0, 5, True), (2, 70, 7, True)),
        steps(spark, (1, 30, 6, False), (0, 0, 5, True)),  # late, and a replay
        steps(spark, (3, 130, 1, False), (2, 70, 7, True)),
        steps(spark, (4, 131, 2, False)),
    )
    emitted, pending = revised(spark, tmp_path, path)
    got = sorted((r.window_start.minute, r.revision, r.primary_keys, r.since_primary_keys) for r in emitted.collect())
    assert got == [(0, 0, 5, 5), (0, 1, 11, 11), (1, 0, 7, 18)]
    assert [(r.window_start.minute, r.primary_keys, r.since_primary_keys, r.nth) for r in pending.collect()] == [(2, 3, 21, 3)]
    last = latest_revisions(emitted.unionByName(pending))
    want = interval_counters(spark.read.schema(LOG_SCHEMA).parquet(path).dropDuplicates(["batch_id"]), 60)
    lines = {(r.window_start, r.line) for r in since_lines(last, "a", "b").collect()}
    assert last.count() == 3 and lines == {(r.window_start, r.line) for r in stats_lines(want, "a", "b").collect()}


def test_a_row_before_an_interval_changes_its_totals_only(spark, tmp_path):
    path = written_log(spark, tmp_path, steps(spark, (1, 30, 6, False), (2, 70, 7, True), (3, 130, 1, False)), steps(spark, (0, 5, 9, False)))
    emitted, _ = revised(spark, tmp_path, path)
    got = sorted((r.window_start.minute, r.revision, r.primary_keys, r.since_primary_keys) for r in emitted.collect())
    assert got == [(0, 0, 6, 6), (0, 1, 15, 15), (1, 0, 7, 13), (1, 1, 7, 22)]


def test_closed_intervals_become_one_row(spark):
    def on_day(*numbered):
        return steps(spark, *numbered).select(*LOG_SCHEMA.names)

    intervals, seen = spark.createDataFrame([], INTERVAL_STATE), spark.createDataFrame([], SEEN_STATE)
    emitted, intervals, seen = stats_step(on_day((0, 0, 5, True), (1, 70, 6, False), (2, 200, 7, False)), intervals, seen, 60, 0)
    assert sorted((r.window_start.minute, r.since_primary_keys) for r in emitted.collect()) == [(0, 5), (1, 11)]
    assert sorted((r.closed, r.window_start.minute, r.primary_keys) for r in intervals.collect()) == [(False, 3, 7), (True, 0, 11)]
    assert [r.batch_id for r in seen.collect()] == [2]
    # A row of a closed interval may be a replay; a micro-batch without rows changes nothing.
    emitted, intervals, seen = stats_step(on_day((1, 70, 6, False)), intervals, seen, 60, 0)
    assert emitted.count() == 0
    emitted, intervals, seen = stats_step(on_day((9, 0, 1, True)).limit(0), intervals, seen, 60, 0)
    assert emitted.count() == 0 and intervals.count() == 2
    emitted, intervals, seen = stats_step(on_day((3, 260, 1, False)), intervals, seen, 60, 0)
    assert [(r.window_start.minute, r.primary_keys, r.since_primary_keys, r.since_window_s, r.nth) for r in emitted.collect()] == [(3, 7, 18, 240, 2)]
    with pytest.raises(ValueError):
        stats_step(on_day((1, 70, 6, False)), intervals, seen, 0, 0)


def test_one_alert_of_two_producers(spark, tmp_path):
    schema = "table_name string, producer int, ts timestamp"
    path, out = str(tmp_path / "alerts"), str(tmp_path / "first")
    batches = [
        [("t", 1, "2026-01-01 00:00:05"), ("u", 1, "2026-01-01 00:00:06")],
        [("t", 2, "2026-01-01 00:00:01"), ("u", 2, "2026-01-01 00:01:00")],
        [("t", 2, "2026-01-01 00:01:10"), ("t", 1, "2026-01-01 00:01:11")],
    ]
    for i, rows in enumerate(batches):
        table = spark.createDataFrame(rows, "table_name string, producer int, ts string")
        folder_sink(path, files=1)(table.withColumn("ts", F.col("ts").cast("timestamp")), i)
    stream = deduplicated_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/batch=*"), 60)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start().awaitTermination()
    got = sorted((r.table_name, r.window_start.minute, r.producer) for r in spark.read.parquet(out).collect())
    assert [g[:2] for g in got] == [("t", 0), ("t", 1), ("u", 0), ("u", 1)] and [g[2] for g in got if g[1] == 0] == [1, 1]


def test_log_rows_by_subtask_of_a_stream(spark, tmp_path, folder, accounts):
    start(spark, tmp_path, folder, lambda s: accounts, lambda s: accounts, subtasks=3).awaitTermination()
    log = spark.read.schema(LOG_SCHEMA).parquet(str(tmp_path / "log")).groupBy("batch_id").agg(F.collect_set("subtask").alias("s"), F.sum("n_keys").alias("n"))
    assert {(r.batch_id, tuple(sorted(r.s)), r.n) for r in log.collect()} == {(i, ("enrich:1/3", "enrich:2/3", "enrich:3/3"), n) for i, n in ((0, 1), (1, 2), (2, 1))}


# ------------------------------------------------------------------ sinks and connector options


def alerts(spark, n=1):
    return spark.range(n).select(
        F.lit("failover").alias("kind"), F.lit("it table").alias("table_name"), F.lit("1/4").alias("subtask"),
        F.lit("t").alias("topic"), F.lit(0).alias("episode"), F.current_timestamp().alias("ts"),
        F.col("id").alias("batch_id"), F.lit('{"alert":"test"}').alias("payload"),
    )


def test_back_off_doubles_to_its_bound():
    assert [backoff_ms(ALERTS, n) for n in range(1, 7)] == [500, 1000, 2000, 4000, 5000, 5000]


def test_retry_until_sent(spark):
    tries, naps = [], []

    def flaky(df):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("no")

    outcome = send_with_retries(alerts(spark), flaky, ALERTS, naps.append)
    assert (outcome.sent, outcome.failures, outcome.retries, naps) == (True, 2, 2, [0.5, 1.0])


def test_no_spool_folder_drops(spark):
    def dead(df):
        raise OSError("no")

    rows = deliver(alerts(spark), dead, ALERTS, lambda s: None).collect()
    assert [(r.status, r.failures, r.retries) for r in rows] == [("dropped", 3, 2)]


def test_dead_letters_are_bounded(spark, tmp_path):
    from dataclasses import replace

    options = replace(ALERTS, alert_spool_dir=str(tmp_path / "spool"), alert_spool_max_bytes=50)
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for expected in ("spooled", "dropped"):
        marked = with_status(alerts(spark), options)
        assert [r.status for r in marked.collect()] == [expected]
        dead_letter(marked, options, "boom\nreason", at)
    lines = spark.read.text(options.alert_spool_dir).collect()
    assert [r.value for r in lines] == [
        '{"timestamp":1704067200000,"clientId":"lookup-alert-it_table-1_4","error":"boom\\nreason","payload":{"alert":"test"}}'
    ]


def test_kafka_sink_options():
    from dataclasses import replace

    options = kafka_write_options(replace(ALERTS, kafka_properties={"security.protocol": "SASL_PLAINTEXT", "acks": "all"}), "1/4")
    assert options["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert options["kafka.acks"] == "all"
    assert options["kafka.client.id"] == "lookup-alert-dim_account-1_4"
    assert (options["kafka.bootstrap.servers"], options["topic"]) == ("b:1", "t")
    assert (options["kafka.enable.idempotence"], options["kafka.compression.type"]) == ("false", "none")


def test_kafka_source_options():
    got = kafka_read_options("b:1", "facts", group_id="g", batch_size=50, max_wait_ms=5, properties={"a": "b"})
    assert got == {
        "kafka.a": "b", "kafka.bootstrap.servers": "b:1", "subscribe": "facts", "startingOffsets": "latest",
        "kafka.group.id": "g", "minOffsetsPerTrigger": "50", "maxTriggerDelay": "5ms", "maxOffsetsPerTrigger": "1000000",
    }
    assert batch_rule(LookupOptions(batch_size=7, batch_max_wait_ms=9)) == {"batch_size": 7, "max_wait_ms": 9}
    assert kafka_read_options("b:1", "f", "earliest-offset")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka_read_options("b:1", "f", "yesterday")


def test_jdbc_options():
    options = LookupOptions.from_dict({"doris.jdbc-url": "jdbc:mysql://h/db", "doris.table-name": "dim.dim_account", "doris.driver": " "})
    read = jdbc_read_options(options)
    assert read["dbtable"] == "`dim`.`dim_account`" and "driver" not in read and read["user"] == "root"
    split = jdbc_read_options(options, "id", "0", "100")
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "4")
    assert quote_table("a.b", "jdbc:postgresql://h/db") == '"a"."b"'


def test_connect_timeout_reaches_the_driver():
    read = lambda url: jdbc_read_options(LookupOptions.from_dict({"doris.jdbc-url": url, "lookup.timeout": 1000}))
    assert read("jdbc:mysql://h/db")["connectTimeout"] == "300"
    assert read("jdbc:postgresql://h/db")["connectTimeout"] == "1"
    assert "connectTimeout" not in read("jdbc:other://h/db")


@pytest.mark.parametrize("kind", ["long", "date"])
def test_keys_are_read_in_ranges(spark, kind):
    options = LookupOptions(jdbc_url="jdbc:mysql://h/db", max_in_keys=10, jdbc_connections=3)
    keys = spark.range(5, 1005, 5).select(F.col("id").cast("int").alias("pk"))
    keys = keys.select(F.date_from_unix_date("pk").alias("pk")) if kind == "date" else keys.select(F.col("pk").cast("long"))
    store = JdbcStore(options, ["pk"])
    ranges = store.predicates(keys)
    assert len(ranges) == 12 and all(r.startswith("`pk` >= ") for r in ranges)
    held = [keys.filter(r).count() for r in ranges]
    assert sum(held) == 200 and max(held) <= 40
    assert store.predicates(keys.limit(10)) == []
    assert JdbcStore(options, ["pk"]).predicates(keys.select(F.col("pk").cast("string"))) == []


def test_wide_client_properties_prefer_explicit_options():
    options = LookupOptions.from_dict(
        {"doris.jdbc-url": "jdbc:x", "properties.hbase.rpc.timeout": "9", "properties.custom": "1", "hbase.rpc.timeout": 200}
    )
    got = wide_client_properties(options)
    assert got["hbase.rpc.timeout"] == "200" and got["custom"] == "1" and got["zookeeper.znode.parent"] == "/hbase"


def test_log_schema_is_complete():
    assert LOG_SCHEMA.names[:5] == ["table_name", "subtask", "batch_id", "ts", "n_keys"] and len(LOG_SCHEMA) == 17
