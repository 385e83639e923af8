"""Lookup joins, probes and failover (groups P and A)."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries.common import CUSTOMER, META, OPTIONS, ORDERS_SQL, customers, down, sql, table, with_misses
from tandem.operators.failover import failover_lookup
from tandem.operators.lookup import distinct_keys, lookup_join, probe

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = sql(oracle)
        return function

    return register


KEY = {"o_custkey": "c_custkey"}
SHOWN = ["o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "lookup_source"]


def enrich_orders(spark, sf_dir, stores, schema=CUSTOMER, options=OPTIONS, **lookup):
    orders = with_misses(table(spark, sf_dir, "orders"))
    return failover_lookup(orders, stores, KEY, schema, options, **lookup)


def orders_oracle(join: str, source: str, dim: str = "customer", name: str = "c.c_name") -> str:
    return f"""
        SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, {name} AS c_name, c.c_nationkey, c.c_acctbal,
               c.c_mktsegment, CASE WHEN c.c_custkey IS NOT NULL THEN '{source}' END AS lookup_source
        FROM {ORDERS_SQL} o {join} JOIN {dim} c ON o.o_custkey = c.c_custkey
    """


@query("a1_lookup_left", orders_oracle("LEFT", "hbase"))
def a1_lookup_left(spark, sf_dir):
    held = customers(sf_dir)
    return enrich_orders(spark, sf_dir, {"hbase": held, "doris": held}).df.select(*SHOWN)


@query("a2_lookup_inner", orders_oracle("INNER", "hbase"))
def a2_lookup_inner(spark, sf_dir):
    held = customers(sf_dir)
    return enrich_orders(spark, sf_dir, {"hbase": held, "doris": held}, how="inner").df.select(*SHOWN)


@query(
    "a3_null_key_miss",
    f"""
    SELECT o.o_orderkey, o.buyer, c.c_name
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS buyer FROM {ORDERS_SQL}) o
    LEFT JOIN customer c ON o.buyer = c.c_custkey
    """,
)
def a3_null_key_miss(spark, sf_dir):
    orders = with_misses(table(spark, sf_dir, "orders")).select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("buyer")
    )
    held = customers(sf_dir)(spark)
    return lookup_join(orders, held, {"buyer": "c_custkey"}).select("o_orderkey", "buyer", "c_name")


SUPPLY = T.StructType(
    [
        T.StructField("ps_partkey", T.LongType()),
        T.StructField("ps_suppkey", T.LongType()),
        T.StructField("ps_lines", T.LongType()),
        T.StructField("ps_quantity", T.DoubleType()),
    ]
)


def supply(sf_dir: str):
    """Loader of a dimension keyed by (part, supplier)."""

    def load(spark):
        return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")).agg(
            F.count(F.lit(1)).alias("ps_lines"), F.sum("l_quantity").alias("ps_quantity")
        )

    return load


@query(
    "a4_composite_key",
    """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, d.ps_lines,
           ROUND(d.ps_quantity, 6) AS ps_quantity
    FROM (SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE -l_suppkey END AS l_suppkey) FROM lineitem) l
    LEFT JOIN (SELECT l_partkey, l_suppkey, COUNT(*) AS ps_lines, SUM(l_quantity) AS ps_quantity
               FROM lineitem GROUP BY l_partkey, l_suppkey) d
      ON l.l_partkey = d.l_partkey AND l.l_suppkey = d.l_suppkey
    """,
)
def a4_composite_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")).otherwise(-F.col("l_suppkey")).alias("l_suppkey"), "l_extendedprice"
    )
    keys = {"l_partkey": "ps_partkey", "l_suppkey": "ps_suppkey"}
    stores = {"hbase": supply(sf_dir), "doris": supply(sf_dir)}
    found = failover_lookup(lines, stores, keys, SUPPLY, OPTIONS, strategy="keys").df
    return found.withColumn("ps_quantity", F.round("ps_quantity", 6))


@query(
    "a5_one_to_many",
    """
    SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    """,
)
def a5_one_to_many(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return lookup_join(customers, orders, {"c_custkey": "o_custkey"})


@query(
    "a5_first_row_per_key",
    """
    SELECT c.c_custkey, c.c_name, o.o_orderkey
    FROM customer c
    LEFT JOIN (SELECT o_custkey, MIN(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey) o
      ON c.c_custkey = o.o_custkey
    """,
)
def a5_first_row_per_key(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    found = lookup_join(customers, orders, {"c_custkey": "o_custkey"}, dim_unique="first")
    return found.select("c_custkey", "c_name", "o_orderkey")


def urgent_parts(spark, sf_dir):
    """Keys of the parts in urgent orders, each with the number of lines that carry it."""
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    lines = lines.join(urgent, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    schema = T.StructType([T.StructField("p_partkey", T.LongType())])
    return distinct_keys(lines, {"l_partkey": "p_partkey"}, schema)


URGENT_SQL = """
    SELECT l_partkey, COUNT(*) AS n FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY l_partkey
"""


@query("a4_distinct_keys", f"SELECT l_partkey AS p_partkey, n FROM ({URGENT_SQL}) k")
def a4_distinct_keys(spark, sf_dir):
    return urgent_parts(spark, sf_dir)


@query(
    "a6_probe_semi_join",
    f"""
    SELECT p_partkey, p_name, p_brand, p_retailprice FROM part
    WHERE p_partkey IN (SELECT l_partkey FROM ({URGENT_SQL}) k)
    """,
)
def a6_probe_semi_join(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    return probe(parts, urgent_parts(spark, sf_dir), ["p_partkey"])


@query(
    "p2_probe_in_list",
    """
    SELECT c_custkey, c_name, c_nationkey FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
                          WHERE r_name = 'ASIA')
    """,
)
def p2_probe_in_list(spark, sf_dir):
    asia = table(spark, sf_dir, "region").filter("r_name = 'ASIA'")
    keys = table(spark, sf_dir, "nation").join(asia, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    keys = keys.select(F.col("n_nationkey").alias("c_nationkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return probe(customers, keys, ["c_nationkey"], max_in_keys=100)


@query(
    "p3_probe_composite",
    """
    SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
    WHERE EXISTS (SELECT 1 FROM nation JOIN region ON n_regionkey = r_regionkey
                  WHERE r_name = 'ASIA' AND n_nationkey = c_nationkey AND c_mktsegment = 'MACHINERY')
    """,
)
def p3_probe_composite(spark, sf_dir):
    asia = table(spark, sf_dir, "region").filter("r_name = 'ASIA'")
    keys = table(spark, sf_dir, "nation").join(asia, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    keys = keys.select(F.col("n_nationkey").alias("c_nationkey"), F.lit("MACHINERY").alias("c_mktsegment"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return probe(customers, keys, ["c_nationkey", "c_mktsegment"], max_in_keys=100)


STANDBY_SQL = "(SELECT * FROM customer)"


def standby_customer(sf_dir):
    """The standby's copy, told apart by its names."""
    return lambda spark: table(spark, sf_dir, "customer").withColumn("c_name", F.concat(F.lit("S:"), "c_name"))


@query("a8_failover_primary_raises", orders_oracle("LEFT", "doris", STANDBY_SQL, "'S:' || c.c_name"))
def a8_failover_primary_raises(spark, sf_dir):
    return enrich_orders(spark, sf_dir, {"hbase": down, "doris": standby_customer(sf_dir)}).df.select(*SHOWN)


@query("a9_roles_swapped", orders_oracle("LEFT", "doris", STANDBY_SQL, "'S:' || c.c_name"))
def a9_roles_swapped(spark, sf_dir):
    stores = {"hbase": down, "doris": standby_customer(sf_dir)}
    return enrich_orders(spark, sf_dir, stores, options=replace(OPTIONS, primary="doris")).df.select(*SHOWN)


def slow_customer(sf_dir):
    """A store whose rows take far longer than the deadline."""

    def wait(batches):
        for batch in batches:
            time.sleep(600)
            yield batch

    def load(spark):
        customer = table(spark, sf_dir, "customer")
        return customer.mapInArrow(wait, customer.schema)

    return load


@query("a10_late_primary", orders_oracle("LEFT", "doris", STANDBY_SQL, "'S:' || c.c_name"))
def a10_late_primary(spark, sf_dir):
    """The slow primary is given 10 s, and so is the standby, which reads the same table."""
    stores = {"hbase": slow_customer(sf_dir), "doris": standby_customer(sf_dir)}
    return enrich_orders(spark, sf_dir, stores, options=replace(OPTIONS, deadline_ms=10_000)).df.select(*SHOWN)


@query("a12_miss_no_failover", orders_oracle("LEFT", "hbase"))
def a12_miss_no_failover(spark, sf_dir):
    stores = {"hbase": customers(sf_dir), "doris": standby_customer(sf_dir)}
    return enrich_orders(spark, sf_dir, stores, strategy="keys").df.select(*SHOWN)


@query("a14_store_lacks_key", orders_oracle("LEFT", "doris", STANDBY_SQL, "'S:' || c.c_name"))
def a14_store_lacks_key(spark, sf_dir):
    stores = {"hbase": lambda s: customers(sf_dir)(s).drop("c_custkey"), "doris": standby_customer(sf_dir)}
    return enrich_orders(spark, sf_dir, stores).df.select(*SHOWN)


BALANCE_TEXT = T.StructType(
    [T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("balance", T.DecimalType(6, 2))]
)
BALANCE_SOURCE = T.StructType([*BALANCE_TEXT, T.StructField("lookup_source", T.StringType())])
AS_TEXT_SQL = """
    SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' ELSE ' ' || CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS VARCHAR) END AS balance
    FROM customer
"""


def balance_as_text(sf_dir):
    """A store that keeps the balance as text, and not always a number."""
    balance = F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(
        F.concat(F.lit(" "), F.col("c_acctbal").cast("decimal(10,2)").cast("string"))
    )
    return lambda spark: table(spark, sf_dir, "customer").select("c_custkey", "c_name", balance.alias("balance"))


@query(
    "a16_bad_rows_null",
    f"""
    SELECT o.o_orderkey, c.c_name, TRY_CAST(TRIM(c.balance) AS DECIMAL(6,2)) AS balance
    FROM {ORDERS_SQL} o LEFT JOIN ({AS_TEXT_SQL}) c ON o.o_custkey = c.c_custkey
    """,
)
def a16_bad_rows_null(spark, sf_dir):
    stores = {"hbase": balance_as_text(sf_dir), "doris": balance_as_text(sf_dir)}
    found = enrich_orders(spark, sf_dir, stores, BALANCE_TEXT, on_bad_row="null").df
    return found.select("o_orderkey", "c_name", "balance")


@query(
    "a16_bad_rows_quarantined",
    f"""
    SELECT c_custkey, balance FROM ({AS_TEXT_SQL}) c
    WHERE TRY_CAST(TRIM(balance) AS DECIMAL(6,2)) IS NULL AND c_custkey IN (SELECT o_custkey FROM {ORDERS_SQL})
    """,
)
def a16_bad_rows_quarantined(spark, sf_dir):
    stores = {"hbase": balance_as_text(sf_dir), "doris": balance_as_text(sf_dir)}
    found = enrich_orders(spark, sf_dir, stores, BALANCE_TEXT, on_bad_row="quarantine")
    return found.bad_rows.select("c_custkey", "balance")


@query(
    "a16_bad_row_other_key",
    f"""
    SELECT o.o_orderkey, strategy, c.c_name, CASE WHEN c.c_custkey IS NOT NULL THEN 'hbase' END AS lookup_source
    FROM {ORDERS_SQL} o LEFT JOIN customer c ON o.o_custkey = c.c_custkey, (VALUES ('snapshot'), ('keys')) s(strategy)
    """,
)
def a16_bad_row_other_key(spark, sf_dir):
    """A balance that is no number, of a customer without orders, is nobody's business, whatever the strategy."""

    def store(spark):
        held = balance_as_text(sf_dir)(spark)
        asked = with_misses(table(spark, sf_dir, "orders")).select(F.col("o_custkey").alias("c_custkey"), F.lit("0").alias("asked")).distinct()
        return held.join(asked, "c_custkey", "left").withColumn("balance", F.coalesce("asked", "balance")).drop("asked")

    found = None
    for strategy in ("snapshot", "keys"):
        one = enrich_orders(spark, sf_dir, {"hbase": store, "doris": down}, BALANCE_SOURCE, strategy=strategy).df
        one = one.select("o_orderkey", F.lit(strategy).alias("strategy"), "c_name", "lookup_source")
        found = one if found is None else found.unionByName(one)
    return found


@query(
    "b17_lossy_keys",
    """
    SELECT l.l_orderkey, l.l_linenumber, l.half, p.p_name
    FROM (SELECT l_orderkey, l_linenumber, l_quantity / 2 AS half FROM lineitem) l LEFT JOIN part p ON p.p_partkey = l.half
    """,
)
def b17_lossy_keys(spark, sf_dir):
    """A key of 12.5 matches no whole number."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 2).alias("half"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return lookup_join(lines, parts, {"half": "p_partkey"})


@query(
    "a17_log_row",
    f"""
    SELECT 'dim_customer' AS table_name, '1/1' AS subtask, 7 AS batch_id,
           (SELECT COUNT(*) FROM orders) AS n_keys, 'ConnectionError' AS primary_error,
           'store is down' AS primary_message, TRUE AS failed_over,
           (SELECT COUNT(*) FROM {ORDERS_SQL} WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS standby_hits,
           'doris' AS lookup_source
    """,
)
def a17_log_row(spark, sf_dir):
    row = enrich_orders(spark, sf_dir, {"hbase": down, "doris": customers(sf_dir)}).log_row(batch_id=7)
    return row.select(
        "table_name", "subtask", "batch_id", "n_keys", "primary_error", "primary_message", "failed_over",
        "standby_hits", "lookup_source",
    )


NATION = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()), *META])


@query(
    "a19_two_dims",
    f"""
    SELECT o.o_orderkey, c.c_name, CASE WHEN c.c_custkey IS NOT NULL THEN 'hbase' END AS lookup_source,
           n.n_name AS nation_n_name, CASE WHEN n.n_nationkey IS NOT NULL THEN 'doris' END AS nation_lookup_source
    FROM {ORDERS_SQL} o
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    """,
)
def a19_two_dims(spark, sf_dir):
    held = customers(sf_dir)
    first = enrich_orders(spark, sf_dir, {"hbase": held, "doris": held}).df
    nations = {"hbase": down, "doris": lambda s: table(s, sf_dir, "nation")}
    both = failover_lookup(first, nations, {"c_nationkey": "n_nationkey"}, NATION, OPTIONS, prefix="nation_").df
    return both.select("o_orderkey", "c_name", "lookup_source", "nation_n_name", "nation_lookup_source")


@query(
    "a18_salted_join",
    """
    SELECT l.l_orderkey, l.l_linenumber, p.p_name, s.s_name
    FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
    """,
)
def a18_salted_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    found = lookup_join(lines, parts, {"l_partkey": "p_partkey"}, hint="merge", salt=4)
    found = lookup_join(found, suppliers, {"l_suppkey": "s_suppkey"}, hint="shuffle_hash")
    return found.select("l_orderkey", "l_linenumber", "p_name", "s_name")
