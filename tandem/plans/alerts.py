"""Alert events with rendered payloads (F1-F6), as one batch plan over the lookup log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.template import render_template
from tandem.operators.sequence import PIECE_ROWS
from tandem.options import LookupOptions
from tandem.plans.episodes import alert_candidates, recovery_alerts, with_cooldown, with_streaks
from tandem.plans.stats import simple_name
from tandem.session import stage

RECOVERY_REASON = "primary recovered"


def reason_of(error: Column, message: Column) -> Column:
    """Simple class name and message of the cause; without a message only the name."""
    name = simple_name(error)
    return (
        F.when(error.isNull(), F.lit(""))
        .when(F.coalesce(message, F.lit("")) == "", name)
        .otherwise(F.concat(name, F.lit(": "), message))
    )


def payload(template: str, kind: str, options: LookupOptions) -> Column:
    """Rendered payload of an alert row; ``kind`` is ``failover`` or ``recovery``."""
    at = F.col("ts").cast("timestamp")
    recovery = kind == "recovery"
    return render_template(
        template,
        {
            "table": F.col("table_name"),
            "primary": F.lit(options.primary),
            "standby": F.lit(options.standby),
            "threshold": F.lit(options.alert_threshold),
            "consecutive": F.lit(0) if recovery else F.col("streak"),
            "affectedKeys": F.lit(0) if recovery else F.col("affected_keys"),
            "reason": F.lit(RECOVERY_REASON) if recovery else F.col("reason"),
            "subtask": F.coalesce(F.col("subtask"), F.lit("")),
            "timestamp": F.unix_millis(at),
            "datetime": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"),
        },
    )


def failover_candidates(streaks: DataFrame, options: LookupOptions) -> DataFrame:
    """Threshold crossings with topic and reason, before the cooldown."""
    return alert_candidates(streaks, options.alert_threshold).select(
        "table_name",
        "subtask",
        "episode",
        "ts",
        "batch_id",
        F.lit(options.alert_topic).alias("topic"),
        "streak",
        "affected_keys",
        reason_of(F.col("primary_error"), F.col("primary_message")).alias("reason"),
    )


_OUT = ("kind", "table_name", "subtask", "topic", "episode", "ts", "batch_id", "payload")


def alert_events(log: DataFrame, options: LookupOptions, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Every alert to deliver: failovers past the cooldown and, if wanted, their recoveries.

    The log is passed once. What it leaves behind, at most two rows per episode, is staged, and
    the cooldown and the recoveries are worked out from that.
    """
    needed = ("table_name", "subtask", "ts", "batch_id", "n_keys", "failed_over", "primary_error", "primary_message")
    streaks = with_streaks(log.select(*needed), piece_rows)
    crossing = F.col("failed_over") & (F.col("streak") == options.alert_threshold)
    ended = ~F.col("failed_over") & (F.col("streak") >= max(options.alert_threshold, 1))
    turning = stage(streaks.filter(crossing | ended), "turning")
    sent = with_cooldown(
        failover_candidates(turning, options), options.alert_cooldown_min, piece_rows=piece_rows
    )
    return render_events(sent, recovery_alerts(sent, turning) if options.alert_recovery else None, options)


def render_events(sent: DataFrame, recovered: DataFrame | None, options: LookupOptions) -> DataFrame:
    """Failover and recovery rows with their payloads."""
    events = sent.withColumns(
        {"kind": F.lit("failover"), "payload": payload(options.alert_message, "failover", options)}
    ).select(*_OUT)
    if recovered is None:
        return events
    return events.unionByName(
        recovered.withColumns(
            {"kind": F.lit("recovery"), "payload": payload(options.alert_recovery_message, "recovery", options)}
        ).select(*_OUT)
    )
