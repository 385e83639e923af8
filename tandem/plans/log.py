"""The lookup log: one row per batch, and what its outcome was (section 1.4, E1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("subtask", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("n_keys", T.LongType()),
        T.StructField("primary", T.StringType()),
        T.StructField("standby", T.StringType()),
        T.StructField("primary_ms", T.DoubleType()),
        T.StructField("primary_error", T.StringType()),
        T.StructField("primary_message", T.StringType()),
        T.StructField("primary_hits", T.LongType()),
        T.StructField("failed_over", T.BooleanType()),
        T.StructField("standby_ms", T.DoubleType()),
        T.StructField("standby_error", T.StringType()),
        T.StructField("standby_hits", T.LongType()),
        T.StructField("lookup_source", T.StringType()),
        T.StructField("lookup_cost_ms", T.LongType()),
    ]
)


def replay_routes(outcomes: DataFrame, primary: str, standby: str, deadline_ms: int | None = None) -> DataFrame:
    """Derive each batch's route from what the two stores did.

    The primary failed when it has an error or took longer than the deadline; then the standby's
    outcome decides. Cost is the time of every store asked, added up and cut to whole milliseconds.
    """
    late = F.lit(False) if deadline_ms is None else F.coalesce(F.col("primary_ms") > deadline_ms, F.lit(False))
    over = F.col("primary_error").isNotNull() | late
    answered = F.when(~over, F.lit(primary)).when(F.col("standby_error").isNull(), F.lit(standby))
    spent = F.when(~over, F.col("primary_ms")).otherwise(F.col("primary_ms") + F.col("standby_ms"))
    return outcomes.withColumns(
        {
            "primary": F.lit(primary),
            "standby": F.lit(standby),
            "failed_over": over,
            "lookup_source": answered,
            "lookup_cost_ms": F.when(answered.isNotNull(), F.floor(spent).cast("bigint")),
            "failed": answered.isNull(),
        }
    )
