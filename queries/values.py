"""Conforming, key forms, cells and JSON facts (groups B and C)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries.common import OPTIONS, sql, table
from tandem.functions import binary
from tandem.functions.conform import conform, time_field, timestamp_field
from tandem.functions.keys import key_normal_form, rowkey
from tandem.operators.failover import failover_lookup
from tandem.sinks.deadletter import client_column, dead_letter_line
from tandem.sources.cells import WideStore, cells_dim
from tandem.sources.facts import json_facts

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = sql(oracle)
        return function

    return register


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


@query(
    "b1_conform_types",
    """
    SELECT o_orderkey AS id, CAST(o_custkey AS INTEGER) AS buyer, o_custkey % 2 <> 0 AS odd,
           o_orderstatus = 'O' AS is_open, CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(12,1)) AS price,
           CAST(o_custkey AS DECIMAL(20,2)) AS buyer_decimal, CAST(o_totalprice AS FLOAT) AS price_float,
           CAST(o_orderdate AS DATE) AS day, o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS absent
    FROM orders
    """,
)
def b1_conform_types(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(
        F.col("o_orderkey").alias("ID"),
        F.col("o_custkey").alias("buyer"),
        (F.col("o_custkey") % 2).alias("odd"),
        F.when(F.col("o_orderstatus") == "O", "TRUE").otherwise("yes").alias("is_open"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("buyer_decimal"),
        F.col("o_totalprice").alias("price_float"),
        F.date_format("o_orderdate", " yyyy-MM-dd ").alias("day"),
        F.col("o_orderpriority").alias("Priority"),
    )
    schema = T.StructType(
        [
            field("id", T.LongType()),
            field("buyer", T.IntegerType()),
            field("odd", T.BooleanType()),
            field("is_open", T.BooleanType()),
            field("price", T.DecimalType(12, 1)),
            field("buyer_decimal", T.DecimalType(20, 2)),
            field("price_float", T.FloatType()),
            field("day", T.DateType()),
            field("priority", T.StringType()),
            field("absent", T.StringType()),
        ]
    )
    return conform(raw, schema)


@query(
    "b9_conform_time",
    """
    SELECT event_id, CAST(EXTRACT(hour FROM ts) * 3600000 + EXTRACT(minute FROM ts) * 60000
                          + EXTRACT(millisecond FROM ts) AS INTEGER) AS from_text,
           CAST(EXTRACT(hour FROM ts) * 3600000 + EXTRACT(minute FROM ts) * 60000
                + EXTRACT(millisecond FROM ts) AS INTEGER) AS from_timestamp,
           CAST(EXTRACT(hour FROM ts) * 3600000 + EXTRACT(minute FROM ts) * 60000 AS INTEGER) AS to_the_minute,
           CAST(event_id AS INTEGER) AS from_number
    FROM events
    """,
)
def b9_conform_time(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "HH:mm:ss.SSSSSS").alias("from_text"),
        F.col("ts").alias("from_timestamp"),
        F.date_format("ts", "HH:mm").alias("to_the_minute"),
        F.col("event_id").alias("from_number"),
    )
    times = ("from_text", "from_timestamp", "to_the_minute", "from_number")
    return conform(raw, T.StructType([field("event_id", T.LongType()), *[time_field(name) for name in times]]))


@query(
    "b10_conform_timestamps",
    """
    SELECT event_id, DATE_TRUNC('milliseconds', ts) AS ts3, ts AS ts6, ts AS ts9, ts AS from_text,
           ts AS from_iso, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS from_date, CAST(ts AS DATE) AS day
    FROM events
    """,
)
def b10_conform_timestamps(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    raw = events.select(
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts3"),
        micros.alias("ts6"),
        (micros * 1000 + 7).alias("ts9"),
        F.date_format("ts", " yyyy-MM-dd HH:mm:ss.SSSSSS").alias("from_text"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789123")).alias("from_iso"),
        F.to_date("ts").alias("from_date"),
        F.unix_date(F.to_date("ts")).alias("day"),
    )
    schema = T.StructType(
        [
            field("event_id", T.LongType()),
            timestamp_field("ts3", 3),
            timestamp_field("ts6", 6),
            timestamp_field("ts9", 9),
            timestamp_field("from_text"),
            timestamp_field("from_iso", 9),
            timestamp_field("from_date"),
            field("day", T.DateType()),
        ]
    )
    return conform(raw, schema)


@query(
    "b13_key_normal_form",
    """
    SELECT o_orderkey,
           CAST(o_custkey AS VARCHAR) || chr(1)
           || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END || chr(1)
           || RTRIM(RTRIM(CAST(CAST(o_totalprice AS DECIMAL(14,3)) AS VARCHAR), '0'), '.') || chr(1)
           || STRFTIME(o_orderdate, '%Y-%m-%dT%H:%M') || chr(1)
           || STRFTIME(o_orderdate, '%Y-%m-%d') || chr(1)
           || TO_BASE64(ENCODE(o_orderpriority)) || chr(1) AS key_text
    FROM orders
    """,
)
def b13_key_normal_form(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    parts = [
        (F.col("o_custkey"), field("o_custkey", T.LongType())),
        (F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), field("status", T.StringType())),
        (F.col("o_totalprice").cast("decimal(14,3)"), field("price", T.DecimalType(14, 3))),
        (F.col("o_orderdate"), timestamp_field("o_orderdate")),
        (F.to_date("o_orderdate"), field("day", T.DateType())),
        (F.encode("o_orderpriority", "UTF-8"), field("priority", T.BinaryType())),
    ]
    return orders.select("o_orderkey", key_normal_form(parts).alias("key_text"))


@query(
    "b14_rowkey_string",
    """
    SELECT o_orderkey,
           HEX(ENCODE(o_orderpriority || '|' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR) END
                      || '|' || CAST(CAST(o_totalprice AS DECIMAL(14,3)) AS VARCHAR)
                      || '|' || STRFTIME(o_orderdate, '%Y-%m-%d %H:%M:%S.0'))) AS rowkey
    FROM orders
    """,
)
def b14_rowkey_string(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    parts = [
        (F.col("o_orderpriority"), field("o_orderpriority", T.StringType())),
        (F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")), field("o_custkey", T.LongType())),
        (F.col("o_totalprice").cast("decimal(14,3)"), field("price", T.DecimalType(14, 3))),
        (F.col("o_orderdate"), timestamp_field("o_orderdate")),
    ]
    return orders.select("o_orderkey", F.hex(rowkey(parts)).alias("rowkey"))


@query(
    "b15_rowkey_typed_int",
    """
    SELECT l_orderkey, l_linenumber,
           LPAD(PRINTF('%X', l_orderkey), 16, '0') || '7C' || LPAD(PRINTF('%X', l_linenumber), 8, '0') || '7C'
           || LPAD(PRINTF('%X', CAST(DATE_DIFF('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT)), 8, '0') || '7C'
           || LPAD(PRINTF('%X', EPOCH_MS(l_shipdate)), 16, '0') || '7C' || CASE WHEN l_returnflag = 'R' THEN 'FF' ELSE '00' END
           AS rowkey
    FROM lineitem
    """,
)
def b15_rowkey_typed_int(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    parts = [
        (F.col("l_orderkey"), field("l_orderkey", T.LongType())),
        (F.col("l_linenumber"), field("l_linenumber", T.IntegerType())),
        (F.to_date("l_shipdate"), field("day", T.DateType())),
        (F.col("l_shipdate"), timestamp_field("l_shipdate", 3)),
        (F.col("l_returnflag") == "R", field("returned", T.BooleanType())),
    ]
    return lines.select("l_orderkey", "l_linenumber", F.hex(rowkey(parts, "typed")).alias("rowkey"))


# No SQL engine at hand yields IEEE bits, so this one writes the bytes and reads them back.
@query(
    "b15_bytes_round_trip",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice AS price, CAST(l_discount AS FLOAT) AS discount,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS price12, CAST(-l_extendedprice AS DECIMAL(30,4)) AS price30,
           8 AS double_width, 4 AS float_width
    FROM lineitem
    """,
)
def b15_bytes_round_trip(spark, sf_dir):
    narrow, wide = T.DecimalType(12, 2), T.DecimalType(30, 4)
    coded = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        binary.double_bytes(F.col("l_extendedprice")).alias("d"),
        binary.float_bytes(F.col("l_discount").cast("float")).alias("f"),
        binary.decimal_bytes(F.col("l_extendedprice").cast(narrow), narrow).alias("n"),
        binary.decimal_bytes((-F.col("l_extendedprice")).cast(wide), wide).alias("w"),
    )
    return coded.select(
        "l_orderkey",
        "l_linenumber",
        binary.bytes_double(F.col("d")).alias("price"),
        binary.bytes_float(F.col("f")).alias("discount"),
        binary.bytes_decimal(F.col("n"), narrow).alias("price12"),
        binary.bytes_decimal(F.col("w"), wide).alias("price30"),
        F.length("d").alias("double_width"),
        F.length("f").alias("float_width"),
    )


CELL_SCHEMA = T.StructType(
    [
        field("c_custkey", T.LongType()),
        field("c_name", T.StringType()),
        field("c_nationkey", T.IntegerType()),
        field("c_acctbal", T.DoubleType()),
        field("c_mktsegment", T.StringType()),
    ]
)


def customer_cells(spark, sf_dir):
    """The customer table as cells: the typed key as rowkey, an older version of the name, no cell for NULL."""
    customer = table(spark, sf_dir, "customer")
    key = rowkey([(F.col("c_custkey"), CELL_SCHEMA["c_custkey"])], "typed")
    values = {
        "c_custkey": binary.long_bytes(F.col("c_custkey")),
        "c_name": F.encode("c_name", "UTF-8"),
        "c_nationkey": binary.int_bytes(F.col("c_nationkey")),
        "c_acctbal": binary.double_bytes(F.col("c_acctbal")),
        "c_mktsegment": F.when(F.col("c_mktsegment") != "BUILDING", F.encode("c_mktsegment", "UTF-8")),
    }
    cells = [
        F.struct(F.lit("info").alias("family"), F.lit(name).alias("qualifier"), value.alias("value"), F.lit(2).alias("ts"))
        for name, value in values.items()
    ]
    for family, qualifier, text in (("info", "c_name", "old name"), ("other", "c_name", "foreign")):
        cells.append(
            F.struct(
                F.lit(family).alias("family"), F.lit(qualifier).alias("qualifier"),
                F.encode(F.lit(text), "UTF-8").alias("value"), F.lit(1 if family == "info" else 3).alias("ts"),
            )
        )
    long = customer.select(key.alias("rowkey"), F.explode(F.array(*cells)).alias("cell"))
    return long.select("rowkey", "cell.*").filter("value IS NOT NULL")


CELLS_SQL = """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment
    FROM customer
"""


@query("c4_cells_pivot", CELLS_SQL)
def c4_cells_pivot(spark, sf_dir):
    return cells_dim(customer_cells(spark, sf_dir), CELL_SCHEMA).drop("rowkey")


@query(
    "a7_rowkey_multi_get",
    f"""
    SELECT o.o_orderkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
    FROM orders o LEFT JOIN ({CELLS_SQL}) c ON o.o_custkey = c.c_custkey
    """,
)
def a7_rowkey_multi_get(spark, sf_dir):
    store = WideStore(lambda s: customer_cells(s, sf_dir), CELL_SCHEMA, ["c_custkey"], encoding="typed")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    found = failover_lookup(orders, {"hbase": store, "doris": store}, {"o_custkey": "c_custkey"}, CELL_SCHEMA, OPTIONS)
    return found.df.drop("o_custkey")


@query(
    "a7_rowkeys_of_large_orders",
    f"""
    SELECT o.o_orderkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
    FROM orders o LEFT JOIN ({CELLS_SQL}) c ON o.o_custkey = c.c_custkey
    WHERE o.o_totalprice > 495000
    """,
)
def a7_rowkeys_of_large_orders(spark, sf_dir):
    """Orders worth a call have few customers, whose rowkeys the scan is asked for one by one."""
    store = WideStore(lambda s: customer_cells(s, sf_dir), CELL_SCHEMA, ["c_custkey"], encoding="typed")
    orders = table(spark, sf_dir, "orders").filter("o_totalprice > 495000").select("o_orderkey", "o_custkey")
    found = failover_lookup(orders, {"hbase": store, "doris": store}, {"o_custkey": "c_custkey"}, CELL_SCHEMA, OPTIONS)
    return found.df.drop("o_custkey")


MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@query("c1_json_facts", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def c1_json_facts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    messages = events.select(F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value", "props"), MICROS).alias("value"))
    schema = T.StructType(
        [
            field("event_id", T.LongType()),
            field("ts", events.schema["ts"].dataType),
            field("user_id", T.LongType()),
            field("event_type", T.StringType()),
            field("value", T.DoubleType()),
            field("props", T.StringType()),
        ]
    )
    return json_facts(messages, schema)


@query(
    "c6_dead_letter_lines",
    """
    SELECT event_id,
           '{"timestamp":1700000000000,"clientId":"lookup-alert-dim_' || event_type || '-' || CAST(user_id AS VARCHAR)
           || '_4","error":"boom\\nreason","payload":' || props || '}' AS line
    FROM events
    """,
)
def c6_dead_letter_lines(spark, sf_dir):
    alerts = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("dim_"), "event_type").alias("table_name"),
        F.concat(F.col("user_id").cast("string"), F.lit("/4")).alias("subtask"),
        F.col("props").alias("payload"),
    )
    at = datetime.fromtimestamp(1_700_000_000, timezone.utc)
    return alerts.select("event_id", dead_letter_line(client_column(OPTIONS), "boom\nreason", at).alias("line"))


@query(
    "b8_malformed_dates",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1) THEN CAST(o_orderdate AS DATE) END AS day
    FROM orders
    """,
)
def b8_malformed_dates(spark, sf_dir):
    """Text that only begins with a date, or is only a year, is no date."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.element_at(
        F.array(day, F.concat(F.lit(" "), day, F.lit(" ")), F.substring(day, 1, 4), F.concat(day, F.lit(" 10:00:00")), F.concat(day, F.lit(" x"))),
        (F.col("o_orderkey") % 5 + 1).cast("int"),
    )
    raw = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day"))
    return conform(raw, T.StructType([field("o_orderkey", T.LongType()), field("day", T.DateType())]), "null")


@query(
    "b11_malformed_text",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1, 2) THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL '10 hours' + INTERVAL '123456 microseconds' END AS at
    FROM orders
    """,
)
def b11_malformed_text(spark, sf_dir):
    """Digits beyond microseconds are dropped; a zone or anything else behind a timestamp makes it bad."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    ends = ["T10:00:00.123456", " 10:00:00.123456789", " 10:00:00.1234567891234", " 10:00:00.123456 garbage", "T10:00:00.123456+08:00", ""]
    text = F.concat(day, F.element_at(F.array(*map(F.lit, ends)), (F.col("o_orderkey") % 6 + 1).cast("int")))
    raw = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("at"))
    return conform(raw, T.StructType([field("o_orderkey", T.LongType()), timestamp_field("at", 6)]), "null")
