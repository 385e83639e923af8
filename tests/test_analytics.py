"""Statistics, routes, episodes and alerts over the lookup log."""

import json
import random
from datetime import timedelta

import pytest
from conftest import START, log_rows
from pyspark.sql import functions as F

from tandem.operators import sequence
from tandem.operators.sequence import cut, spaced
from tandem.options import LookupOptions
from tandem.plans.alerts import alert_events, failover_candidates, reason_of
from tandem.plans.episodes import (
    alert_candidates,
    deduplicated_alerts,
    recoveries,
    throttled_failovers,
    with_cooldown,
    with_streaks,
)
from tandem.plans.log import replay_routes
from tandem.plans.stats import (
    config_line,
    cumulative_counters,
    failure_kind,
    failure_kinds,
    interval_counters,
    remaining_totals,
    stats_lines,
    with_rates,
)
from tandem.session import stage

ALERTS = LookupOptions(
    table_name="dim_account", alert_threshold=2, alert_bootstrap="b:1", alert_topic="t", alert_cooldown_min=0
)

STATS = "table_name string, subtask string, batch_id long, ts timestamp, n_keys long, primary_ms double, primary_error string, primary_hits long, failed_over boolean, standby_ms double, standby_error string, standby_hits long"


def stats_log(spark, rows, second=0):
    """A log from (second, keys, primary ms, error, primary hits, standby ms, standby error, standby hits)."""
    data = [
        ("t", "1/4", i, START + timedelta(seconds=s), keys, ms, err, hits, err is not None, sms, serr, shits)
        for i, (s, keys, ms, err, hits, sms, serr, shits) in enumerate(rows)
    ]
    return spark.createDataFrame(data, STATS)


def ok(second, keys, ms, hits=0):
    return (second, keys, ms, None, hits, None, None, None)


def test_interval_reports_its_own_values(spark):
    log = stats_log(spark, [ok(0, 50, 10.0), ok(1, 50, 20.0), ok(400, 1, 5.0)])
    first, second = with_rates(interval_counters(log)).orderBy("window_start").collect()
    assert (first.primary_batches, first.primary_keys, first.primary_avg_ms, first.primary_max_ms) == (2, 100, 15.0, 20.0)
    assert (second.primary_keys, second.primary_max_ms) == (1, 5.0)
    totals = cumulative_counters(interval_counters(log)).orderBy("window_start").collect()
    assert (totals[1].primary_keys, totals[1].primary_max_ms, totals[1].window_s) == (101, 20.0, 720)


def test_hit_rate_counts_successful_lookups_only(spark):
    log = stats_log(spark, [ok(0, 10, 1.0, 7), (1, 5, 500.0, "x.TimeoutException", None, 3.0, None, 4)])
    row = with_rates(interval_counters(log)).first()
    assert (row.primary_hit_rate, row.standby_hit_rate) == (0.7, 0.8)
    assert with_rates(interval_counters(stats_log(spark, [ok(0, 0, 1.0)]))).first().primary_hit_rate is None


def test_failover_is_processed_twice(spark):
    log = stats_log(spark, [(0, 2, 500.0, "java.lang.RuntimeException", None, 3.0, None, 2)])
    row = with_rates(interval_counters(log)).first()
    assert (row.processed_keys, row.business_keys, row.failover_share, row.failovers) == (4, 2, 1.0, 1)
    assert (row.primary_batch_size, row.overall_batch_size) == (2, 2)


def test_rate(spark):
    assert with_rates(interval_counters(stats_log(spark, [ok(0, 720, 1.0)]))).first().keys_per_s == 2.0


@pytest.mark.parametrize(
    "error, kind",
    [
        ("java.util.concurrent.TimeoutException", "timeout"),
        ("java.net.SocketTimeoutException", "timeout"),
        ("DeadlineExceeded", "timeout"),
        ("java.util.concurrent.RejectedExecutionException", "pool_full"),
        ("java.net.ConnectException", "connect"),
        ("java.net.UnknownHostException", "connect"),
        ("ConnectionRefusedError", "connect"),
        ("java.sql.SQLException", "database"),
        ("java.sql.SQLTransientConnectionException", "database"),
        ("io.netty.channel.ConnectTimeoutException", "timeout"),
        ("io.netty.AnnotatedConnectionRefused", "connect"),
        ("java.lang.IllegalStateException", "other"),
        (None, None),
    ],
)
def test_failure_kind(spark, error, kind):
    assert spark.createDataFrame([(error,)], "e string").select(failure_kind(F.col("e"))).first()[0] == kind


def test_five_kinds_once_each(spark):
    errors = ["java.util.concurrent.TimeoutException", "java.net.ConnectException",
              "java.util.concurrent.RejectedExecutionException", "java.sql.SQLException", "java.lang.RuntimeException"]
    log = stats_log(spark, [(i, 1, 1.0, e, None, 1.0, "java.sql.SQLException", None) for i, e in enumerate(errors)])
    row = failure_kinds(interval_counters(log)).first()
    assert row.fail_kinds == {"timeout": 1, "connect": 1, "pool_full": 1, "database": 1, "other": 1}
    assert (row.primary_fails, row.standby_fails, row.standby_hit_keys) == (5, 5, 0)


def test_lines(spark):
    log = stats_log(spark, [ok(0, 50, 10.0, 49), (1, 50, 20.0, "java.net.ConnectException", None, 4.0, None, 50), ok(400, 1, 5.0)])
    first, second = [r.line for r in stats_lines(interval_counters(log), "hbase", "doris").orderBy("window_start").collect()]
    assert first == (
        "table=t subtask=1/4 | since.start=window=360s business=100 processed=150 rate=0.4/s avg.batch=50 overall.batch=50 | "
        "primary(hbase)[batches=2 keys=100 failed=1(connect=1) avg=15.0ms max=20.0ms hit=98.0%] "
        "standby(doris)[batches=1 keys=50 failed=0 avg=4.0ms max=4.0ms hit=100.0%] failover=1 (50 keys, 50.0%)"
    )
    assert "standby(doris)[batches=0 keys=0 failed=0 avg=- max=- hit=-] failover=0 || since.start=720s business=101" in second
    assert config_line(ALERTS, "1/4").startswith("table=dim_account subtask=1/4 config[primary=hbase standby=doris")


def test_no_statistics_when_off(spark):
    assert interval_counters(stats_log(spark, [ok(0, 1, 1.0)]), 0).count() == 0


def test_remaining_totals_only_with_new_activity(spark):
    log = stats_log(spark, [ok(0, 1, 1.0), ok(500, 2, 1.0)])
    assert remaining_totals(log, START + timedelta(seconds=400)).first().primary_keys == 3
    assert remaining_totals(log, START + timedelta(seconds=500)).count() == 0


def test_routes(spark):
    rows = [(1, 10.9, None, None, None), (2, 500.5, None, 3.6, None), (3, 500.0, None, None, None),
            (4, 1.0, "x", 2.0, "y"), (5, 1.6, "x", 2.6, None)]
    df = spark.createDataFrame(rows, "id int, primary_ms double, primary_error string, standby_ms double, standby_error string")
    out = {r.id: (r.failed_over, r.lookup_source, r.lookup_cost_ms, r.failed) for r in replay_routes(df, "p", "s", 500).collect()}
    assert out == {
        1: (False, "p", 10, False), 2: (True, "s", 504, False), 3: (False, "p", 500, False),
        4: (True, None, None, True), 5: (True, "s", 4, False),
    }


# ------------------------------------------------------------------ episodes


def test_streaks(spark):
    log = log_rows(spark, [(0, 5, True), (1, 6, True), (2, 9, False), (3, 9, False), (4, 7, True)])
    rows = with_streaks(log).orderBy("batch_id").collect()
    assert [(r.episode, r.streak, r.affected_keys) for r in rows] == [(0, 1, 5), (0, 2, 11), (0, 2, 11), (1, 0, 0), (2, 1, 7)]


def test_throttle(spark):
    log = log_rows(spark, [(ms, 1, True) for ms in (1000, 1500, 2000, 11000, 11500)])
    lines = throttled_failovers(with_streaks(log), 10).orderBy("ts").collect()
    assert [(r.batch_id, r.merged) for r in lines] == [(0, 0), (3, 2)]
    assert throttled_failovers(with_streaks(log), 0).count() == 5


def test_throttle_restarts_with_the_next_episode(spark):
    log = log_rows(spark, [(0, 1, True), (10, 1, True), (20, 1, False), (30, 1, True)])
    lines = throttled_failovers(with_streaks(log), 10).orderBy("ts").collect()
    assert [(r.batch_id, r.merged) for r in lines] == [(0, 0), (3, 0)]
    ended = recoveries(with_streaks(log)).collect()
    assert [(r.batch_id, r.episode_batches) for r in ended] == [(2, 2)]


def test_one_alert_per_episode(spark):
    log = log_rows(spark, [(i, 1, True) for i in range(5)])
    crossed = alert_candidates(with_streaks(log), 3).collect()
    assert [(r.batch_id, r.streak, r.affected_keys) for r in crossed] == [(2, 3, 3)]
    assert alert_candidates(with_streaks(log), 0).count() == 0


def test_affected_keys_restart(spark):
    log = log_rows(spark, [(0, 50, True), (1, 50, True), (2, 1, False), (3, 7, True), (4, 7, True)])
    assert [r.affected_keys for r in alert_candidates(with_streaks(log), 2).orderBy("ts").collect()] == [100, 14]


def test_cooldown_over_subtasks(spark):
    def alerts(*minutes):
        rows = [("t", f"{i % 2}/2", "x", i, START + timedelta(minutes=m)) for i, m in enumerate(minutes)]
        return spark.createDataFrame(rows, "table_name string, subtask string, topic string, batch_id long, ts timestamp")

    sent = with_cooldown(alerts(0, 1, 2, 3, 4, 5.9, 6), 3).orderBy("ts").collect()
    assert [(r.batch_id, r.suppressed_before) for r in sent] == [(0, 0), (3, 2), (6, 2)]
    assert with_cooldown(alerts(0, 1, 2), 0).count() == 3


def test_alert_and_recovery_payloads(spark):
    message = 'HBase "lookup" timeout\nafter 500ms'
    log = log_rows(spark, [(0, 30, True), (1500, 12, True), (3000, 1, False), (4000, 1, False)],
                   error="java.lang.IllegalStateException", message=message)
    events = {r.kind: r for r in alert_events(log, ALERTS).collect()}
    sent = json.loads(events["failover"].payload)
    assert sent == {
        "alert": "lookup-failover", "table": "dim_account", "primary": "hbase", "standby": "doris", "threshold": 2,
        "consecutive": 2, "affectedKeys": 42, "reason": "IllegalStateException: " + message, "subtask": "1/4",
        "timestamp": 1704067201500, "datetime": "2024-01-01T00:00:01.500Z",
    }
    assert json.loads(events["recovery"].payload)["alert"] == "lookup-recovered"
    assert events["recovery"].batch_id == 2


def test_recovery_only_for_sent_alerts(spark):
    from dataclasses import replace

    steps = [(0, 1, True), (1, 1, True), (2, 1, False), (3, 1, True), (4, 1, True), (5, 1, False), (6, 1, True), (7, 1, False)]
    log = log_rows(spark, steps)
    kinds = sorted((r.kind, r.batch_id) for r in alert_events(log, replace(ALERTS, alert_cooldown_min=3)).collect())
    assert kinds == [("failover", 1), ("recovery", 2)]
    kinds = sorted((r.kind, r.batch_id) for r in alert_events(log, replace(ALERTS, alert_recovery=False)).collect())
    assert kinds == [("failover", 1), ("failover", 4)]


def test_reasons(spark):
    df = spark.createDataFrame([("a.b.C$D", "m"), ("a.B", ""), ("B", None), (None, "x")], "e string, m string")
    assert [r[0] for r in df.select(reason_of(F.col("e"), F.col("m"))).collect()] == ["D: m", "B", "B", ""]


def test_dedup_across_producers(spark):
    log = log_rows(spark, [(0, 1, True), (1, 1, True)]).unionByName(log_rows(spark, [(500, 1, True), (600, 1, True)], subtask="2/4"))
    kept = deduplicated_alerts(failover_candidates(with_streaks(log), ALERTS), 60).collect()
    assert [(r.subtask, r.batch_id, r.alerts) for r in kept] == [("1/4", 1, 2)]


# ------------------------------------------------------------------ groups that are cut into pieces


def random_log(spark, n, seed, fail=0.6, gap=400):
    rng = random.Random(seed)
    ms, steps = 0, []
    for _ in range(n):
        ms += rng.choice([1, 5, gap])
        steps.append((ms, rng.randint(0, 9), rng.random() < fail))
    return steps


def greedy(steps, gap_ms):
    """Straight-line form of the throttle."""
    out, last, merged = [], None, 0
    for i, (ms, _, failed) in enumerate(steps):
        if not failed:
            last, merged = None, 0
        elif last is None or ms - last >= gap_ms:
            out.append((i, merged))
            last, merged = ms, 0
        else:
            merged += 1
    return out


@pytest.mark.parametrize("fail", [0.0, 0.5, 0.97, 1.0])
def test_streaks_do_not_depend_on_the_cut(spark, fail):
    steps = random_log(spark, 400, 1, fail)
    log = log_rows(spark, steps).unionByName(log_rows(spark, steps[:30], subtask="2/4"))
    whole = with_streaks(log)
    pieces = with_streaks(log, piece_rows=37)
    assert not cut(log, ["table_name", "subtask"], ["ts"], 37).whole
    assert pieces.exceptAll(whole).count() == 0 and whole.count() == pieces.count() == 430


@pytest.mark.parametrize("gap_s, fail", [(0.05, 1.0), (1, 1.0), (1, 0.99), (40, 1.0), (10_000, 1.0)])
def test_throttle_does_not_depend_on_the_cut(spark, gap_s, fail):
    steps = random_log(spark, 400, 2, fail)
    streaks = with_streaks(log_rows(spark, steps))
    for piece_rows in (10_000, 60):
        got = sorted((r.batch_id, r.merged) for r in throttled_failovers(streaks, gap_s, piece_rows).collect())
        assert got == greedy(steps, gap_s * 1000)


@pytest.mark.parametrize("pieces", [8, 16, 64])
def test_rounds_grow_with_the_logarithm_of_the_pieces(spark, monkeypatch, pieces):
    """Emissions are handed on by doubling, also where pieces are short against the gap."""
    staged = []
    monkeypatch.setattr(sequence, "stage", lambda df, purpose, path=None: staged.append(purpose) or stage(df, purpose, path))
    steps = random_log(spark, 10 * pieces, 3, 1.0)
    log = log_rows(spark, steps).unionByName(log_rows(spark, steps[:9], table_name="dim_short"))
    got = spaced(log, ["table_name"], ["ts", "batch_id"], "ts", 20_000, 10)
    assert sorted((r.batch_id, r.merged) for r in got.filter("table_name = 'dim_account'").collect()) == greedy(steps, 20_000)
    assert [(r.batch_id, r.merged) for r in got.filter("table_name = 'dim_short'").orderBy("batch_id").collect()] == greedy(steps[:9], 20_000)
    assert staged.count("passed") <= pieces.bit_length() + 1
    assert staged.count("steps") <= pieces.bit_length() + 1


def test_equal_times_and_groups_without_a_name(spark):
    """Rows of one time lie in one piece, and NULL is a group like others."""
    steps = [(1_000 * (i // 40), i % 7, True) for i in range(400)]
    log = log_rows(spark, steps)
    whole = with_streaks(log)
    pieces = with_streaks(log, piece_rows=37)
    assert pieces.exceptAll(whole).count() == 0 and pieces.count() == 400
    got = spaced(log, ["table_name"], ["ts", "batch_id"], "ts", 2_500, 30)
    assert sorted((r.ts, r.merged) for r in got.collect()) == [(START + timedelta(milliseconds=ms), m) for ms, m in [(0, 0), (3_000, 119), (6_000, 119), (9_000, 119)]]
    unnamed = with_streaks(log.withColumn("table_name", F.lit(None).cast("string")), piece_rows=37)
    assert unnamed.agg(F.max("streak"), F.count("*")).first() == (400, 400)


def test_short_groups_are_left_alone(spark):
    """Cutting a long group neither stages nor shuffles the log, and short groups are one piece."""
    steps = random_log(spark, 300, 5, 0.5)
    log = log_rows(spark, steps).unionByName(log_rows(spark, steps[:20], subtask="2/4"))
    parts = cut(log, ["table_name", "subtask"], ["ts", "batch_id"], 50)
    assert parts.df.filter("subtask = '2/4'").agg(F.max(sequence.PIECE)).first()[0] == 0
    assert parts.df.filter("subtask = '1/4'").agg(F.min(sequence.PIECE)).first()[0] == 1
    plan = parts.df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_ten_million_rows_of_one_group(spark):
    rows = spark.range(10_500_000).select(
        F.when(F.col("id") < 10_000_000, "long").otherwise(F.concat(F.lit("short"), F.col("id") % 100)).alias("g"),
        F.timestamp_millis(F.pmod(F.xxhash64("id"), F.lit(10**10))).alias("ts"),
    )
    parts = cut(rows, ["g"], ["ts"], 1_000_000)
    sizes = {tuple(r[:2]): r[2] for r in parts.df.groupBy("g", sequence.PIECE).count().collect()}
    assert len(sizes) == 110 and max(sizes.values()) <= 2_000_000
    assert all(piece == 0 for g, piece in sizes if g != "long")


def test_pieces_are_bounded(spark):
    log = log_rows(spark, random_log(spark, 1000, 4, 1.0))
    parts = cut(log, ["table_name", "subtask"], ["ts", "batch_id"], 100)
    sizes = [r["count"] for r in parts.df.groupBy(sequence.PIECE).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 250
