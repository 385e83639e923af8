"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on ``local[$BENCH_CPUS]``. Every query is
run once to warm up and then three times; its time is the median. Results go to the noop sink, so a
query is run whole and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from queries import QUERIES  # noqa: E402
from queries.common import META, OPTIONS, down, table  # noqa: E402
from tandem.operators.failover import failover_lookup  # noqa: E402
from tandem.operators.lookup import lookup_join  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

PART = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()),
        T.StructField("p_retailprice", T.DoubleType()),
        *META,
    ]
)
KEY = {"l_partkey": "p_partkey"}


def part(spark: SparkSession) -> DataFrame:
    return table(spark, SF_DIR, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")


def enrich(spark: SparkSession, primary, **how) -> DataFrame:
    return failover_lookup(table(spark, SF_DIR, "lineitem"), {"hbase": primary, "doris": part}, KEY, PART, **how).df


def hanging(spark: SparkSession) -> DataFrame:
    def wait(batches):
        for batch in batches:
            time.sleep(600)
            yield batch

    return part(spark).mapInArrow(wait, part(spark).schema)


def skewed_lines(spark: SparkSession) -> DataFrame:
    """Line items of which every second one carries the same key and some carry none."""
    lines = table(spark, SF_DIR, "lineitem")
    key = F.when(F.col("l_returnflag") == "R", F.lit(1)).when(F.col("l_returnflag") == "N", F.col("l_partkey"))
    return lines.withColumn("l_partkey", key.cast("bigint"))


BENCH = {
    "join_plain": lambda s: table(s, SF_DIR, "lineitem").join(part(s), F.col("l_partkey") == F.col("p_partkey"), "left"),
    "lookup_join": lambda s: lookup_join(table(s, SF_DIR, "lineitem"), part(s), KEY),
    "lookup_join_shuffled_skew": lambda s: lookup_join(skewed_lines(s), part(s), KEY, hint="merge"),
    "failover_healthy": lambda s: enrich(s, part, options=OPTIONS),
    "failover_healthy_by_keys": lambda s: enrich(s, part, options=OPTIONS, strategy="keys"),
    "failover_primary_raises": lambda s: enrich(s, down, options=OPTIONS),
    "failover_deadline_2s": lambda s: enrich(s, hanging, options=replace(OPTIONS, deadline_ms=2_000)),
    **{
        name: (lambda s, run=QUERIES[name]: run(s, SF_DIR))
        for name in (
            "a4_composite_key",
            "a7_rowkey_multi_get",
            "b1_conform_types",
            "b15_bytes_round_trip",
            "c4_cells_pivot",
            "d2_cumulative_stats",
            "d12_stats_lines",
            "e2_streaks",
            "e3_log_throttle",
            "f4_recovery",
            "f6_render",
            "s2_enrich_stream",
        )
    },
}


def timed(spark: SparkSession, run) -> float:
    started = time.perf_counter()
    run(spark).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    wanted = sys.argv[1:] or list(BENCH)
    seconds = {}
    for name in wanted:
        timed(spark, BENCH[name])
        seconds[name] = round(statistics.median(timed(spark, BENCH[name]) for _ in range(RUNS)), 3)
        print(name, seconds[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "median seconds over all headline queries, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
