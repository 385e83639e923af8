"""Tables, dimensions and options shared by the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.options import LookupOptions

OPTIONS = LookupOptions(table_name="dim_customer", deadline_ms=600_000, operator_timeout_ms=3_600_000)

META = [T.StructField("lookup_source", T.StringType()), T.StructField("lookup_cost_ms", T.LongType())]

CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
        *META,
    ]
)

# The foreign keys of the tables have no misses, so every fifth order carries a key of no customer.
ORDERS_SQL = "(SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey) FROM orders)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_misses(orders: DataFrame) -> DataFrame:
    """Orders of which every fifth has a key of no customer."""
    return orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 5 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")))


def customers(sf_dir: str):
    """Loader of the customer dimension."""
    return lambda spark: table(spark, sf_dir, "customer")


def down(_spark):
    """Loader of a store that cannot be reached."""
    raise ConnectionError("store is down")


def sql(text: str) -> str:
    return "\n".join(line.rstrip() for line in text.strip().splitlines())
