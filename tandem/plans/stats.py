"""Lookup statistics over the lookup log (group D).

Every measure is a partial aggregation on (table, subtask, window), so a busy table shrinks to a
few rows per task before anything is shuffled. The running totals only ever see one row per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GROUP = ("table_name", "subtask")

# The failure kinds in the order they are reported.
FAILURE_KINDS = ("timeout", "connect", "pool_full", "database", "other")

# Error classes by kind, as Java and Python name them.
TIMEOUT_ERRORS = ("TimeoutException", "SocketTimeoutException", "TimeoutError", "DeadlineExceeded")
REJECTED_ERRORS = ("RejectedExecutionException",)
CONNECT_ERRORS = (
    "ConnectException",
    "UnknownHostException",
    "NoRouteToHostException",
    "SocketException",
    "ConnectionError",
    "ConnectionRefusedError",
    "ConnectionResetError",
    "ConnectionAbortedError",
)
DATABASE_PACKAGE = "java.sql."


def simple_name(error: Column) -> Column:
    """Class name without its package."""
    return F.substring_index(F.substring_index(error, ".", -1), "$", -1)


def failure_kind(error: Column) -> Column:
    """Kind of a failure by its error class; the first rule that fits wins."""
    name = simple_name(error)
    return (
        F.when(error.isNull(), F.lit(None).cast("string"))
        .when(name.isin(*TIMEOUT_ERRORS), "timeout")
        .when(name.isin(*REJECTED_ERRORS), "pool_full")
        .when(name.isin(*CONNECT_ERRORS), "connect")
        .when(F.startswith(error, F.lit(DATABASE_PACKAGE)), "database")
        .when(F.startswith(name, F.lit("SQL")) & F.endswith(name, F.lit("Exception")), "database")
        .when(F.contains(error, F.lit("ConnectTimeout")), "timeout")
        .when(F.contains(error, F.lit("ConnectionRefused")), "connect")
        .otherwise("other")
    )


KIND = "__kind"


def _with_kind(log: DataFrame) -> DataFrame:
    """Add the failure kind once per batch; a primary that was only late timed out."""
    error = F.when(F.col("failed_over"), F.coalesce(F.col("primary_error"), F.lit("TimeoutException")))
    return log.withColumn(KIND, failure_kind(error))


def _measures() -> list[Column]:
    over = F.col("failed_over")
    standby_ok = over & F.col("standby_error").isNull()
    keys = F.col("n_keys").cast("bigint")

    def total(value: Column, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0)).cast("bigint")

    return [
        F.count(F.lit(1)).alias("primary_batches"),
        F.sum(keys).alias("primary_keys"),
        F.count_if(over).alias("primary_fails"),
        F.sum("primary_ms").alias("primary_ms"),
        F.max("primary_ms").alias("primary_max_ms"),
        total(F.col("primary_hits").cast("bigint"), ~over).alias("primary_hits"),
        total(keys, ~over).alias("primary_hit_keys"),
        F.count_if(over).alias("standby_batches"),
        total(keys, over).alias("standby_keys"),
        F.count_if(over & F.col("standby_error").isNotNull()).alias("standby_fails"),
        F.sum(F.when(over, F.col("standby_ms"))).alias("standby_ms"),
        F.max(F.when(over, F.col("standby_ms"))).alias("standby_max_ms"),
        total(F.col("standby_hits").cast("bigint"), standby_ok).alias("standby_hits"),
        total(keys, standby_ok).alias("standby_hit_keys"),
        *[F.count_if(F.col(KIND) == name).alias(f"fail_{name}") for name in FAILURE_KINDS],
    ]


COUNTERS = (
    "primary_batches",
    "primary_keys",
    "primary_fails",
    "primary_ms",
    "primary_hits",
    "primary_hit_keys",
    "standby_batches",
    "standby_keys",
    "standby_fails",
    "standby_ms",
    "standby_hits",
    "standby_hit_keys",
    *(f"fail_{name}" for name in FAILURE_KINDS),
)
MAXIMA = ("primary_max_ms", "standby_max_ms")


def interval_counters(log: DataFrame, interval_s: int = 360, start_s: int = 0) -> DataFrame:
    """Counters of each (table, subtask) and interval.

    Works on a stream too, once the log has a watermark on ``ts``. ``interval_s = 0`` is off and
    yields no rows (D13).
    """
    if interval_s == 0:
        log, interval_s = log.filter(F.lit(False)), 1
    window = F.window("ts", f"{interval_s} seconds", startTime=f"{start_s} seconds")
    grouped = _with_kind(log).groupBy(*GROUP, window.alias("w")).agg(*_measures())
    return grouped.select(
        *GROUP,
        F.col("w.start").alias("window_start"),
        F.lit(interval_s).cast("bigint").alias("window_s"),
        *COUNTERS,
        *MAXIMA,
    )


def with_rates(counters: DataFrame) -> DataFrame:
    """Means, hit rates, shares and rates next to the counters (D5, D7, D9); NULL without a sample."""
    processed = F.col("primary_keys") + F.col("standby_keys")
    batches = F.col("primary_batches") + F.col("standby_batches")
    return counters.withColumns(
        {
            "business_keys": F.col("primary_keys"),
            "processed_keys": processed,
            "failovers": F.col("primary_fails"),
            "failover_keys": F.col("standby_keys"),
            "primary_avg_ms": F.try_divide("primary_ms", "primary_batches"),
            "standby_avg_ms": F.try_divide("standby_ms", "standby_batches"),
            "primary_hit_rate": F.try_divide("primary_hits", "primary_hit_keys"),
            "standby_hit_rate": F.try_divide("standby_hits", "standby_hit_keys"),
            "failover_share": F.try_divide("standby_keys", "primary_keys"),
            "keys_per_s": F.try_divide(processed, F.col("window_s")),
            "primary_batch_size": _whole_quotient(F.col("primary_keys"), F.col("primary_batches")),
            "overall_batch_size": _whole_quotient(processed, batches),
        }
    )


def _whole_quotient(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0).cast("bigint")).otherwise(
        F.call_function("div", part, F.when(whole != 0, whole))
    )


def _running_totals(prefix: str = "") -> dict[str, Column]:
    so_far = W.partitionBy(*GROUP).orderBy("window_start").rowsBetween(W.unboundedPreceding, 0)
    start = F.unix_seconds(F.col("window_start").cast("timestamp"))
    return {
        f"{prefix}window_s": start - F.min(start).over(so_far) + F.col("window_s"),
        **{prefix + name: F.sum(name).over(so_far) for name in COUNTERS},
        **{prefix + name: F.max(name).over(so_far) for name in MAXIMA},
    }


def cumulative_counters(counters: DataFrame) -> DataFrame:
    """Totals since the first interval, one row per interval.

    Maxima are running maxima and never differences. ``window_s`` becomes the time covered.
    """
    return counters.withColumns(_running_totals())


def remaining_totals(log: DataFrame, reported_until) -> DataFrame:
    """Since-start totals of the groups with batches after the last reported window."""
    totals = _with_kind(log).groupBy(*GROUP).agg(*_measures(), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    covered = F.greatest(
        F.unix_seconds(F.col("last_ts").cast("timestamp")) - F.unix_seconds(F.col("first_ts").cast("timestamp")),
        F.lit(1),
    )
    return totals.filter(F.col("last_ts") > F.lit(reported_until)).select(
        *GROUP, F.col("first_ts").alias("window_start"), covered.alias("window_s"), *COUNTERS, *MAXIMA
    )


def failure_kinds(counters: DataFrame) -> DataFrame:
    """The non-zero failure kinds of each row as a map, in fixed order."""
    pairs = [item for name in FAILURE_KINDS for item in (F.lit(name), F.col(f"fail_{name}"))]
    return counters.withColumn("fail_kinds", F.map_filter(F.create_map(*pairs), lambda _, n: n > 0))


def _decimal1(value: Column, suffix: str) -> Column:
    # Sums of doubles carry noise in the last digits, which must not decide a tie.
    number = F.round(value.cast("double"), 6)
    text = F.format_string("%.1f" + suffix.replace("%", "%%"), number)
    return F.when(number.isNull(), F.lit("-")).otherwise(text)


def _percent(part: Column, whole: Column) -> Column:
    return _decimal1(F.try_divide(part * 100.0, whole), "%")


def _kind_text(name_of) -> Column:
    shown = [
        F.when(F.col(name_of(f"fail_{n}")) > 0, F.concat(F.lit(f"{n}="), F.col(name_of(f"fail_{n}")).cast("string")))
        for n in FAILURE_KINDS
    ]
    return F.concat_ws(",", *shown)


def stats_text(label: str, primary: str, standby: str, prefix: str = "") -> Column:
    """One line of statistics from the counters of a row, whose names start with ``prefix``.

    A failed batch is shown with its kinds, a mean or rate without a sample as ``-``.
    """

    def name_of(name: str) -> str:
        return prefix + name

    def c(name: str) -> Column:
        return F.col(name_of(name))

    processed = c("primary_keys") + c("standby_keys")
    fails = F.when(c("primary_fails") == 0, F.lit("0")).otherwise(
        F.concat(c("primary_fails").cast("string"), F.lit("("), _kind_text(name_of), F.lit(")"))
    )
    failovers = F.when(c("primary_fails") == 0, F.lit("0")).otherwise(
        F.format_string(
            "%d (%d keys, %s)", c("primary_fails"), c("standby_keys"), _percent(c("standby_keys"), c("primary_keys"))
        )
    )

    def store(role: str, name: str, failed: Column) -> Column:
        return F.format_string(
            f"{role}({name})[batches=%d keys=%d failed=%s avg=%s max=%s hit=%s]",
            c(f"{role}_batches"),
            c(f"{role}_keys"),
            failed,
            _decimal1(F.try_divide(c(f"{role}_ms"), c(f"{role}_batches")), "ms"),
            F.when(c(f"{role}_batches") > 0, _decimal1(c(f"{role}_max_ms"), "ms")).otherwise("-"),
            _percent(c(f"{role}_hits"), c(f"{role}_hit_keys")),
        )

    return F.format_string(
        f"{label}=%ds business=%d processed=%d rate=%s avg.batch=%d overall.batch=%d | %s %s failover=%s",
        c("window_s"),
        c("primary_keys"),
        processed,
        _decimal1(F.try_divide(processed, c("window_s")), "/s"),
        _whole_quotient(c("primary_keys"), c("primary_batches")),
        _whole_quotient(processed, c("primary_batches") + c("standby_batches")),
        store("primary", primary, fails),
        store("standby", standby, c("standby_fails").cast("string")),
        failovers,
    )


def with_since(counters: DataFrame) -> DataFrame:
    """Totals since the first interval as ``since_`` columns, and the number of the interval in its group as ``nth``."""
    in_order = W.partitionBy(*GROUP).orderBy("window_start")
    return counters.withColumns({**_running_totals("since_"), "nth": F.row_number().over(in_order)})


def since_lines(both: DataFrame, primary: str, standby: str) -> DataFrame:
    """Rows of :func:`with_since` as log lines.

    The first window of a group covers the same span twice, so it is printed once.
    """
    line = stats_text("window", primary, standby)
    since = stats_text("since.start", primary, standby, "since_")
    return both.select(
        *GROUP,
        "window_start",
        F.concat(
            F.lit("table="),
            F.col("table_name"),
            F.when(F.col("subtask") != "", F.concat(F.lit(" subtask="), F.col("subtask"))).otherwise(""),
            F.lit(" | "),
            F.when(F.col("nth") == 1, F.concat(F.lit("since.start="), line)).otherwise(
                F.concat(line, F.lit(" || "), since)
            ),
        ).alias("line"),
    )


def stats_lines(counters: DataFrame, primary: str, standby: str) -> DataFrame:
    """Interval and since-start statistics of every window as one log line."""
    return since_lines(with_since(counters), primary, standby)


def config_line(options, subtask: str = "") -> str:
    """The line that echoes the options once."""
    label = f"table={options.table_name}" + (f" subtask={subtask}" if subtask else "")
    return f"{label} config[{options.summary()}]"
