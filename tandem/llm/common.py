"""What several operators share: words, labelled folds, per-worker state."""

from __future__ import annotations

import ctypes
import gc
import sys
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.session import stage

# Rows up to which a table of ids or keys is broadcast; a few MB per column.
BROADCAST_ROWS = 200_000

_SEPARATORS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def word_list(text: str | None) -> list[bytes]:
    """Words of ASCII letters in lower case, digits and any character beyond ASCII, in UTF-8."""
    return text.encode().translate(_SEPARATORS).split() if text else []


def held_out(doc_id: Column | str) -> Column:
    """Rows that no label may be learned from. A row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % 4 == 2, F.lit(False))


def worker_store(owner: str) -> dict[str, Any]:
    """State that outlives a task in its Python worker, for caches only.

    Functions reach the workers by value, so a module's own globals are new in every task. A worker
    serves one operator after the other: the state of the last one goes when another asks.
    """
    name = "tandem_worker_store"
    store = vars(sys.modules.setdefault(name, ModuleType(name)))
    if store.get("owner") != owner:
        store.clear()
        store["owner"] = owner
    return store


def within(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one run after the other."""
    before = np.cumsum(counts) - counts
    positions = np.repeat(starts - before, counts)
    positions += np.arange(len(positions))
    return positions


def release() -> None:
    """Give back what a task has needed; its Python worker may wait for the next one for long.

    The C library keeps what was freed for itself unless it is told to return it to the system.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def partitions_for(df: DataFrame, size: int, bytes_each: int = 64 << 20) -> int:
    """Partitions that hold about ``bytes_each`` of ``size`` bytes, at least the session's number."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // bytes_each))


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the counted ``rows`` are within the limit, else leave the join to Spark."""
    return F.broadcast(df) if rows <= limit else df


def numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` with the number from 0 of each row among those of the same ``keys`` (not NULL), in any order. Staged.

    Equal keys may be in many tasks: each numbers its own rows and begins after what earlier tasks hold.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(tasks, *keys, "__row").sortWithinPartitions(*keys)
    placed = stage(spread.withColumn("__row", F.monotonically_increasing_id()), "placed").withColumn("__task", F.shiftright("__row", 33))
    parts = placed.groupBy(*keys, "__task").agg(F.min("__row").alias("first"), F.count("*").alias("n"))
    earlier = F.sum("n").over(W.partitionBy(*keys).orderBy("__task").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select(*keys, "__task", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("__shift"))
    joined = placed.join(parts, [*keys, "__task"]).withColumn(name, F.col("__row") + F.col("__shift"))
    return joined.select(*df.columns, name)
