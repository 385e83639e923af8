"""Alert sink to Kafka."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.options import LookupOptions


def kafka_write_options(options: LookupOptions, subtask: str = "") -> dict[str, str]:
    """Options of Spark's Kafka sink for alerts.

    Idempotence is off because it would demand ``acks=all``. Pass-through client properties come
    last and may override any default.
    """
    client = {
        "acks": options.alert_acks,
        "enable.idempotence": "false",
        "compression.type": "none",
        "max.block.ms": str(options.alert_max_block_ms),
        "request.timeout.ms": str(options.alert_request_timeout_ms),
        "delivery.timeout.ms": str(options.alert_delivery_timeout_ms),
        "retries": str(options.alert_client_retries),
        "client.id": options.client_id(subtask),
        **options.kafka_properties,
    }
    return {
        "kafka.bootstrap.servers": options.alert_bootstrap,
        "topic": options.alert_topic,
        **{f"kafka.{key}": value for key, value in client.items()},
    }


def kafka_alert_sink(options: LookupOptions, subtask: str = "") -> Callable[[DataFrame], None]:
    """Sink that writes the ``payload`` column to the alert topic; needs Spark's Kafka package."""

    def send(alerts: DataFrame) -> None:
        writer = alerts.select(F.col("payload").alias("value")).write.format("kafka")
        writer.options(**kafka_write_options(options, subtask)).save()

    return send
