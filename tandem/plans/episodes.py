"""Failover episodes over the lookup log.

An episode is a run of failed-over batches of one (table, subtask) in (ts, batch_id) order, ended
by the next batch the primary answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.operators.sequence import PIECE, PIECE_ROWS, cut, spaced

GROUP = ("table_name", "subtask")
ORDER = ("ts", "batch_id")


def with_streaks(log: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Add ``episode``, ``streak`` and ``affected_keys`` to every batch.

    ``episode`` is the number of primary successes before the batch, so it is the same for the
    batches of a run and for the success that ends it. On a failed-over batch ``streak`` and
    ``affected_keys`` count the run up to and including it; on a success they are the size of the
    run that just ended, 0 if there was none.

    All of it follows from running totals of successes, failures and failed keys, which add up
    across the pieces of a long group.
    """
    parts = cut(log, GROUP, ORDER, piece_rows)
    upto = W.partitionBy(*GROUP, PIECE).orderBy(*ORDER).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*GROUP, PIECE).orderBy(*ORDER).rowsBetween(W.unboundedPreceding, -1)
    over = F.col("failed_over")
    keys = F.when(over, F.col("n_keys")).otherwise(0).cast("bigint")

    counted = parts.df.withColumns(
        {
            "__oks": F.sum(F.when(over, 0).otherwise(1)).over(upto),
            "__fails": F.sum(F.when(over, 1).otherwise(0)).over(upto),
            "__keys": F.sum(keys).over(upto),
        }
    )
    # Running totals as they stood at the latest success before the row: they never decrease, so
    # the latest one is the largest.
    counted = counted.withColumns(
        {
            "__fails_then": F.max(F.when(~over, F.col("__fails"))).over(before),
            "__keys_then": F.max(F.when(~over, F.col("__keys"))).over(before),
        }
    )
    if parts.whole:
        carry = {name: F.lit(0) for name in _CARRIED}
    else:
        # A row per piece of the groups that are cut; all others carry nothing.
        keys = (*GROUP, PIECE)
        carried = _carry(counted.filter(F.col(PIECE) > 0)).withColumnsRenamed({name: f"__of_{name}" for name in keys})
        same = [F.col(name).eqNullSafe(F.col(f"__of_{name}")) for name in keys]
        counted = counted.join(F.broadcast(carried), same, "left")
        carry = {name: F.coalesce(F.col(name), F.lit(0)) for name in _CARRIED}
    fails_then = F.coalesce(F.col("__fails_then") + carry["__fails_in"], carry["__fails_then_in"])
    keys_then = F.coalesce(F.col("__keys_then") + carry["__keys_in"], carry["__keys_then_in"])
    ok_here = F.when(over, 0).otherwise(1)
    return counted.select(
        *log.columns,
        (F.col("__oks") - ok_here + carry["__oks_in"]).cast("bigint").alias("episode"),
        (F.col("__fails") + carry["__fails_in"] - fails_then).cast("bigint").alias("streak"),
        (F.col("__keys") + carry["__keys_in"] - keys_then).cast("bigint").alias("affected_keys"),
    )


_CARRIED = ("__oks_in", "__fails_in", "__keys_in", "__fails_then_in", "__keys_then_in")


def _carry(counted: DataFrame) -> DataFrame:
    """Running totals at the start of each piece, and as they stood at the latest success before it.

    Running totals never decrease, so those at the end of a piece, and at its last success, are
    plain maxima. What is left for the window is one row per piece.
    """
    ok = ~F.col("failed_over")
    pieces = counted.groupBy(*GROUP, PIECE).agg(
        *[F.max(f"__{name}").alias(name) for name in ("oks", "fails", "keys")],
        *[F.max(F.when(ok, F.col(f"__{name}"))).alias(f"{name}_at_ok") for name in ("fails", "keys")],
    )
    before = W.partitionBy(*GROUP).orderBy(PIECE).rowsBetween(W.unboundedPreceding, -1)
    carried = {f"__{name}_in": F.coalesce(F.sum(name).over(before), F.lit(0)) for name in ("oks", "fails", "keys")}
    pieces = pieces.withColumns(carried)
    then = {
        f"__{name}_then_in": F.max(F.col(f"{name}_at_ok") + F.col(f"__{name}_in")).over(before)
        for name in ("fails", "keys")
    }
    return pieces.withColumns(then).select(*GROUP, PIECE, *_CARRIED)


def throttled_failovers(streaks: DataFrame, interval_s: float, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Failovers worth a log line.

    The first of an episode always is; then one per interval, with the number ``merged`` into it
    since. An interval of 0 keeps every one.
    """
    failed = streaks.filter("failed_over")
    return spaced(failed, [*GROUP, "episode"], ORDER, "ts", int(interval_s * 1000), piece_rows)


def recoveries(streaks: DataFrame) -> DataFrame:
    """Primary successes that end an episode, with its size."""
    return streaks.filter(~F.col("failed_over") & (F.col("streak") > 0)).withColumnRenamed("streak", "episode_batches")


def alert_candidates(streaks: DataFrame, threshold: int) -> DataFrame:
    """The batch at which an episode reaches ``threshold``, once per episode; 0 is off (F1, F2)."""
    if threshold <= 0:
        return streaks.filter(F.lit(False))
    return streaks.filter(F.col("failed_over") & (F.col("streak") == threshold))


def with_cooldown(
    candidates: DataFrame, cooldown_min: float, by: tuple[str, ...] = ("table_name", "topic"), piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Alerts really sent: per table and topic one per cooldown, over all subtasks.

    A suppressed alert does not restart the clock. A cooldown of 0 sends all of them.
    """
    sent = spaced(candidates, by, (*ORDER, "subtask"), "ts", int(cooldown_min * 60_000), piece_rows)
    return sent.withColumnRenamed("merged", "suppressed_before")


def recovery_alerts(sent: DataFrame, streaks: DataFrame) -> DataFrame:
    """The success that ends each episode whose alert was sent, once per episode.

    An episode and the success ending it share (table, subtask, episode), so this is a join on a
    unique key and not a search along the log.
    """
    ended = recoveries(streaks).select(*GROUP, "episode", "ts", "batch_id", "episode_batches")
    alerted = sent.select(*GROUP, "episode", "topic").distinct()
    return ended.join(alerted, [*GROUP, "episode"])


def deduplicated_alerts(alerts: DataFrame, window_s: int) -> DataFrame:
    """The earliest alert of each table in each time window."""
    window = F.window("ts", f"{window_s} seconds")
    rest = [name for name in alerts.columns if name not in ("table_name", "ts", "batch_id", "subtask")]
    first = F.min(F.struct("ts", "batch_id", "subtask", *rest))
    return (
        alerts.groupBy("table_name", window.alias("w"))
        .agg(first.alias("row"), F.count(F.lit(1)).alias("alerts"))
        .select("table_name", F.col("w.start").alias("window_start"), "row.*", "alerts")
    )
