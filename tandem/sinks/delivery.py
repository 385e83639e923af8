"""Alert delivery: retry with back-off, dead letters, and the delivery log."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.options import LookupOptions
from tandem.sinks.deadletter import dead_letter, with_status

LOG = logging.getLogger(__name__)

AlertSink = Callable[[DataFrame], None]

DELIVERY_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("subtask", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("episode", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("failures", T.LongType()),
        T.StructField("retries", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Delivery:
    """How often a set of alerts was tried, and the last error when none of it worked."""

    sent: bool
    failures: int
    retries: int
    error: str = ""


def backoff_ms(options: LookupOptions, retry: int) -> int:
    """Pause before the ``retry``-th retry: doubling from the first, up to the largest."""
    return min(options.alert_backoff_max_ms, options.alert_backoff_ms * 2 ** (retry - 1))


def send_with_retries(
    alerts: DataFrame, sink: AlertSink, options: LookupOptions, sleep: Callable[[float], None] = time.sleep
) -> Delivery:
    """Hand the alerts to ``sink`` until it takes them or the retries are used up."""
    error = ""
    for attempt in range(options.alert_retry_max + 1):
        if attempt:
            sleep(backoff_ms(options, attempt) / 1000)
        try:
            sink(alerts)
            return Delivery(True, attempt, attempt)
        except Exception as raised:
            error = f"{type(raised).__name__}: {raised}"
            LOG.warning("alert delivery failed (%d of %d): %s", attempt + 1, options.alert_retry_max + 1, error)
    return Delivery(False, options.alert_retry_max + 1, options.alert_retry_max, error)


def deliver(
    alerts: DataFrame, sink: AlertSink, options: LookupOptions, sleep: Callable[[float], None] = time.sleep
) -> DataFrame:
    """Deliver rendered alerts; returns their delivery-log rows and never raises for a sink.

    ``alerts`` should be staged or cached, since a retry reads it again.
    """
    outcome = send_with_retries(alerts, sink, options, sleep)
    if outcome.sent:
        marked = alerts.withColumn("status", F.lit("sent"))
    else:
        marked = with_status(alerts, options)
        try:
            dead_letter(marked, options, outcome.error)
        except Exception as raised:
            LOG.warning("dead letter not written: %s", raised)
            marked = marked.withColumn("status", F.lit("dropped"))
    return delivery_rows(marked, outcome)


def delivery_rows(alerts: DataFrame, outcome: Delivery) -> DataFrame:
    """Delivery-log rows of alerts that already have a ``status``."""
    return alerts.withColumns(
        {
            "failures": F.lit(outcome.failures),
            "retries": F.lit(outcome.retries),
            "error": F.lit(outcome.error),
        }
    ).select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in DELIVERY_SCHEMA])


def delivery_counters(deliveries: DataFrame) -> DataFrame:
    """The eight delivery counters of each table."""
    status = F.col("status")
    return deliveries.groupBy("table_name").agg(
        F.count_if(F.col("kind") == "failover").alias("triggered"),
        F.count_if(status == "sent").alias("sent"),
        F.sum("failures").alias("failed"),
        F.count_if(status == "dropped").alias("dropped"),
        F.sum("retries").alias("retries"),
        F.count_if(status == "suppressed").alias("suppressed"),
        F.count_if((F.col("kind") == "recovery")).alias("recovery"),
        F.count_if(status == "spooled").alias("spooled"),
    )
