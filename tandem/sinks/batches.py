"""Sinks of micro-batches: each is a callable taking (rows, batch id)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BatchSink = Callable[[DataFrame, int], None]

BATCH_FOLDER = "batch"


def folder_sink(path: str, files: int | None = None) -> BatchSink:
    """Parquet folder with one sub-folder per micro-batch; a replayed batch replaces itself."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.coalesce(files) if files else rows
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH_FOLDER}={batch_id}")

    return write


def print_sink() -> BatchSink:
    """Print every row of every micro-batch as JSON; the driver holds one partition at a time."""

    def show(df: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        for row in df.select(F.to_json(F.struct("*"))).toLocalIterator():
            print(row[0])

    return show
