"""Fact streams: JSON messages and the processing-time column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.options import LookupOptions

# How the start-up modes of a topic scan are spelled on both sides.
START_MODES = {"latest-offset": "latest", "earliest-offset": "earliest"}


def json_facts(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """One row per JSON message; works on a stream and on a table."""
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return messages.select(parsed.alias("message")).select("message.*")


def with_proc_time(df: DataFrame, name: str = "proc_time") -> DataFrame:
    """Add the processing time of the batch."""
    return df.withColumn(name, F.current_timestamp())


def kafka_read_options(
    bootstrap: str,
    topic: str,
    start: str = "latest-offset",
    group_id: str | None = None,
    batch_size: int | None = None,
    max_wait_ms: int | None = None,
    max_batch: int = 1_000_000,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source.

    ``batch_size`` and ``max_wait_ms`` are the count-or-time rule of a micro-batch (S1): a batch
    starts once that many messages wait, or once that long has passed since the last one. It takes
    at most ``max_batch``, so a backlog is worked off in steps.
    """
    if start not in START_MODES:
        raise ValueError(f"start must be one of {sorted(START_MODES)}, got {start!r}")
    options = {f"kafka.{key}": value for key, value in (properties or {}).items()}
    options.update(
        {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": START_MODES[start]}
    )
    options["maxOffsetsPerTrigger"] = str(max(max_batch, batch_size or 0))
    if group_id:
        options["kafka.group.id"] = group_id
    if batch_size:
        options["minOffsetsPerTrigger"] = str(batch_size)
        options["maxTriggerDelay"] = f"{max_wait_ms or 0}ms"
    return options


def batch_rule(lookup: LookupOptions) -> dict[str, int]:
    """The count-or-time rule as a table declaration states it."""
    return {"batch_size": lookup.batch_size, "max_wait_ms": lookup.batch_max_wait_ms}


def kafka_facts(spark: SparkSession, schema: T.StructType, lookup: LookupOptions | None = None, **options) -> DataFrame:
    """JSON facts of a Kafka topic as a stream; needs Spark's Kafka package on the class path.

    The rule of a micro-batch comes from ``lookup`` unless it is given.
    """
    options = {**(batch_rule(lookup) if lookup else {}), **options}
    reader = spark.readStream.format("kafka").options(**kafka_read_options(**options))
    return json_facts(reader.load(), schema)
