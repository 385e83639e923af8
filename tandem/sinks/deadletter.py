"""Dead letters: alerts that could not be delivered, as JSON lines."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.template import json_escape
from tandem.options import NAME_DIGEST, LookupOptions
from tandem.session import folder_bytes

CLIENT = "client"
CLIENT_CHARS = 120


def client_column(options: LookupOptions) -> Column:
    """Client id of an alert row, safe as a file name: the explicit one, else table and subtask.

    A long one ends in a digest of the whole, so that no two clients share a folder.
    """
    if options.alert_client_id:
        name = F.lit(options.alert_client_id)
    else:
        name = F.concat_ws("-", F.lit("lookup-alert"), F.col("table_name"), F.when(F.col("subtask") != "", F.col("subtask")))
    kept = F.regexp_replace(name, "[^A-Za-z0-9._-]", "_")
    digest = F.substring(F.sha2(name.cast("binary"), 256), 1, NAME_DIGEST)
    short = F.concat(F.substring(kept, 1, CLIENT_CHARS - NAME_DIGEST - 1), F.lit("-"), digest)
    return F.when(F.length(kept) > CLIENT_CHARS, short).otherwise(kept)


def dead_letter_line(client: Column, error: str, at: datetime) -> Column:
    """One line; the payload is JSON already and goes in as it is."""
    return F.concat(
        F.lit(f'{{"timestamp":{int(at.timestamp() * 1000)},"clientId":"'),
        json_escape(client),
        F.lit('","error":"'),
        json_escape(F.lit(error)),
        F.lit('","payload":'),
        F.col("payload"),
        F.lit("}"),
    )


def full_clients(spark, folder: str, max_bytes: int) -> list[str]:
    """Clients whose dead letters have reached the size cap."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [status.getPath() for status in fs.listStatus(path) if status.isDirectory()]
    sizes = {p.getName().removeprefix(f"{CLIENT}="): folder_bytes(spark, p.toString()) for p in found}
    return sorted(name for name, size in sizes.items() if size >= max_bytes)


def with_status(alerts: DataFrame, options: LookupOptions) -> DataFrame:
    """Add ``client`` and ``status``: ``spooled``, or ``dropped`` without a folder or past the cap.

    There is no cap unless ``alert_spool_max_bytes`` sets one. It is looked at before a batch is
    appended, so the last batch may pass it.
    """
    named = alerts.withColumn(CLIENT, client_column(options))
    if not options.alert_spool_dir:
        return named.withColumn("status", F.lit("dropped"))
    cap = options.alert_spool_max_bytes
    full = [] if not cap else full_clients(alerts.sparkSession, options.alert_spool_dir, cap)
    dropped = F.col(CLIENT).isin(full) if full else F.lit(False)
    return named.withColumn("status", F.when(dropped, "dropped").otherwise("spooled"))


def dead_letter(alerts: DataFrame, options: LookupOptions, error: str, at: datetime | None = None) -> None:
    """Append the ``spooled`` rows of :func:`with_status`, one folder of text files per client."""
    if not options.alert_spool_dir:
        return
    kept = alerts.filter("status = 'spooled'")
    line = dead_letter_line(F.col(CLIENT), error, at or datetime.now(timezone.utc)).alias("value")
    kept.select(CLIENT, line).write.mode("append").partitionBy(CLIENT).text(options.alert_spool_dir)
