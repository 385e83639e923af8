"""Where intermediate tables go, and jobs under a deadline."""

from __future__ import annotations

import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_root: str | None = None
_staged: list[str] = []
_scope = threading.local()


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: what the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it then gets a temporary folder of its own.
    """
    global _local_root
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_CHECKPOINT_DIR} must name a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tandem-")
    return _local_root


def new_staging_path(spark: SparkSession, purpose: str) -> str:
    return f"{staging_root(spark)}/tandem/{purpose}-{uuid.uuid4().hex}"


def staged_path(spark: SparkSession, purpose: str) -> str:
    """A new path that goes with the tables staged in the same scope."""
    path = new_staging_path(spark, purpose)
    getattr(_scope, "paths", _staged).append(path)
    return path


def stage(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy has no lineage to the source, keeps its columnar layout and statistics, and is still
    there when executors are lost.
    """
    spark = df.sparkSession
    if path is None:
        path = staged_path(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staged table, whatever file system it is on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def clear_staging(spark: SparkSession) -> None:
    """Remove the tables this process has staged for results that are no longer read."""
    while _staged:
        delete_path(spark, _staged.pop())


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what this thread stages inside the block when it ends, and nothing else."""
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    try:
        yield
    finally:
        inner = _scope.paths
        if outer is None:
            del _scope.paths
        else:
            _scope.paths = outer
        for path in inner:
            delete_path(spark, path)


def stage_result(spark: SparkSession, purpose: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Stage what ``build`` returns, and free every table that was staged on the way to it."""
    path = new_staging_path(spark, purpose)
    with staging_scope(spark):
        result = stage(build(), purpose, path)
    getattr(_scope, "paths", _staged).append(path)
    return result


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Summed size of the files in a folder; 0 when there is none."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan. Sources that cannot tell report a huge number."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def row_bytes(df: DataFrame) -> int:
    """Bytes of the rows of a table as they are in memory: fixed widths, and what text and bytes measure."""
    fixed, variable = 8 * len(df.columns), []
    for column, kind in df.dtypes:
        if kind in ("string", "binary"):
            variable.append(F.coalesce(F.octet_length(df[f"`{column}`"]), F.lit(0)))
        elif kind.startswith(("array", "map", "struct")):
            variable.append(F.octet_length(F.coalesce(F.to_json(F.struct(df[f"`{column}`"])), F.lit(""))))
    width = sum(variable, F.lit(fixed))
    return int(df.agg(F.sum(width.cast("long"))).first()[0] or 0)


def broadcast_limit(spark: SparkSession) -> int:
    """Size in bytes below which Spark broadcasts a join side by itself."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


class DeadlineExceeded(TimeoutError):
    """The jobs of one attempt did not finish in time."""


@dataclass(frozen=True)
class Timed:
    """What an action returned or raised, and how long it took."""

    result: Any
    error: Exception | None
    elapsed_ms: float


def within(spark: SparkSession, action: Callable[[], Any], bound_ms: int) -> Any:
    """What ``action`` returns or raises, or :class:`DeadlineExceeded` if it has not come back by then.

    For calls that wait outside Spark jobs, such as connecting. An action that is late is interrupted in
    the JVM, where drivers and sources wait, and its thread ends; one that waits in Python cannot be
    interrupted, and its thread goes with the process at the latest.
    """
    box: dict[str, Any] = {}

    def run() -> None:
        try:
            # Each Python thread has a JVM thread of its own, which does what this one asks for.
            box["thread"] = spark._jvm.java.lang.Thread.currentThread()
            box["result"] = action()
        except BaseException as error:  # handed over to the caller
            box["error"] = error

    waiting = InheritableThread(target=run)
    waiting.daemon = True
    waiting.start()
    waiting.join(bound_ms / 1000)
    if waiting.is_alive():
        if "thread" in box:
            box["thread"].interrupt()
        raise DeadlineExceeded(f"opening the store took over {bound_ms}ms")
    if "error" in box:
        raise box["error"]
    return box["result"]


def run_with_deadline(spark: SparkSession, action: Callable[[], Any], deadline_ms: int) -> Timed:
    """Run ``action`` and cancel its Spark jobs at the deadline.

    Finishing late counts as missing the deadline, whether or not the cancel came through.
    """
    sc = spark.sparkContext
    tag = f"tandem-{uuid.uuid4().hex}"
    done = threading.Event()

    def watch() -> None:
        if done.wait(deadline_ms / 1000):
            return
        # An action may start further jobs, so keep cancelling until it has returned.
        while not done.is_set():
            sc.cancelJobsWithTag(tag)
            done.wait(0.1)

    watcher = threading.Thread(target=watch, daemon=True)
    interrupted = sc.getLocalProperty("spark.job.interruptOnCancel")
    sc.addJobTag(tag)
    sc.setInterruptOnCancel(True)
    result, error = None, None
    started = time.monotonic()
    watcher.start()
    try:
        result = action()
    except Exception as raised:
        error = raised
    finally:
        elapsed_ms = (time.monotonic() - started) * 1000
        done.set()
        watcher.join()
        sc.removeJobTag(tag)
        sc.setInterruptOnCancel(interrupted == "true")
    if elapsed_ms > deadline_ms:
        late = DeadlineExceeded(f"lookup took {int(elapsed_ms)}ms, deadline is {deadline_ms}ms")
        late.__cause__ = error
        return Timed(None, late, elapsed_ms)
    return Timed(result, error, elapsed_ms)
