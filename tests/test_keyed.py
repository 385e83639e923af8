"""Key-batched SQL lookup against a stand-in for a DB-API driver."""

import json
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.operators.failover import failover_lookup
from tandem.options import LookupOptions
from tandem.sources.keyed import KeyedSqlStore, key_statement

HELD = T.StructType([T.StructField("pk", T.StringType()), T.StructField("n", T.LongType()), T.StructField("v", T.StringType())])


def driver(folder, table, broken=False):
    """``connect`` of a store that holds ``table`` {key: row} and writes down what it is asked, one file per connection."""
    folder = str(folder)

    class Cursor:
        def __init__(self, log):
            self.log, self.rows = log, []

        def execute(self, statement, parameters):
            if broken:
                raise ConnectionError("gone away")
            with open(self.log, "a") as out:
                out.write(json.dumps([statement, list(parameters)]) + "\n")
            parts = len(re.findall(r"[(]\W?\w+\W? = ", statement)) and len(parameters) // statement.count("(") or 1
            asked = [tuple(parameters[i : i + parts]) for i in range(0, len(parameters), parts)]
            self.rows = [row for key in asked for row in table.get(key, [])]

        def fetchmany(self, count):
            taken, self.rows = self.rows[:count], self.rows[count:]
            return taken

        def close(self):
            pass

    class Connection:
        def __init__(self):
            self.log = os.path.join(folder, uuid.uuid4().hex)
            open(self.log, "w").close()

        def cursor(self):
            return Cursor(self.log)

        def close(self):
            os.rename(self.log, self.log + ".closed")

    return Connection


def asked(folder):
    return [[json.loads(line) for line in open(os.path.join(folder, name))] for name in os.listdir(folder)]


def options(**more):
    return LookupOptions(jdbc_url="jdbc:mysql://h/db", jdbc_table="dim.t", **{"max_in_keys": 10, "jdbc_connections": 3, **more})


def test_statements():
    one = key_statement(options(), ["pk", "v"], ["pk"], 3)
    assert one == "SELECT `pk`, `v` FROM `dim`.`t` WHERE `pk` IN (?, ?, ?)"
    two = key_statement(options(), ["a", "b"], ["a", "b"], 2, "numeric")
    assert two == "SELECT `a`, `b` FROM `dim`.`t` WHERE (`a` = :1 AND `b` = :2) OR (`a` = :3 AND `b` = :4)"
    assert "(%s, %s)" in key_statement(options(), ["pk"], ["pk"], 2, "pyformat")
    with pytest.raises(ValueError, match="paramstyle"):
        KeyedSqlStore(options(), ["pk"], HELD, lambda: None, "named")
    with pytest.raises(ValueError, match="lack key columns"):
        KeyedSqlStore(options(), ["other"], HELD, lambda: None)


def test_each_key_is_asked_for_once_over_few_connections(spark, tmp_path):
    table = {(f"k{i}",): [(f"k{i}", i, "v")] * (1 + (i == 7)) for i in range(0, 200, 2)}
    keys = spark.createDataFrame([(f"k{i}", 1) for i in range(95)] + [(None, 5)], "pk string, n long")
    store = KeyedSqlStore(options(), ["pk"], HELD, driver(tmp_path, table))
    got = store.for_keys(spark, keys).collect()
    assert sorted(r.pk for r in got) == sorted(f"k{i}" for i in range(0, 95, 2))
    logs = asked(tmp_path)
    assert len(logs) <= 3 and all(name.endswith(".closed") for name in os.listdir(tmp_path))
    sent = [p for log in logs for _, parameters in log for p in parameters]
    assert sorted(sent) == sorted(f"k{i}" for i in range(95))
    assert max(len(p) for log in logs for _, p in log) == 10
    assert all(re.search(r"WHERE `pk` IN [(]", statement) for log in logs for statement, _ in log)


def test_more_than_a_thousand_text_keys_are_no_scan(spark, tmp_path):
    table = {(f"é{i}",): [(f"é{i}", i, None)] for i in range(5_000)}
    keys = spark.range(3_000).select(F.concat(F.lit("é"), "id").alias("pk"), F.lit(1).alias("n"))
    found = KeyedSqlStore(options(max_in_keys=1_000), ["pk"], HELD, driver(tmp_path, table)).for_keys(spark, keys)
    assert found.count() == 3_000
    assert "JDBC" not in found._jdf.queryExecution().toString()
    assert {len(p) for log in asked(tmp_path) for _, p in log} <= set(range(1, 1_001))


def test_composite_keys_and_no_keys(spark, tmp_path):
    held = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType()), T.StructField("v", T.StringType())])
    table = {("x", i): [("x", i, f"v{i}")] for i in range(30)}
    keys = spark.createDataFrame([("x", i) for i in range(25)] + [("y", 1), ("x", None)], "a string, b long")
    store = KeyedSqlStore(options(), ["a", "b"], held, driver(tmp_path, table))
    assert store.for_keys(spark, keys).count() == 25
    before = len(os.listdir(tmp_path))
    assert store.for_keys(spark, keys.filter("a = 'z'")).count() == 0 and len(os.listdir(tmp_path)) == before


@pytest.mark.parametrize("broken", [False, True])
def test_lookup_through_the_store(spark, tmp_path, broken):
    table = {(f"k{i}",): [(f"k{i}", i, str(i))] for i in range(50)}
    facts = spark.createDataFrame([(i, f"k{i % 60}" if i % 9 else None) for i in range(300)], "id long, pk string")
    schema = T.StructType([T.StructField("pk", T.StringType()), T.StructField("v", T.IntegerType())])
    standby = spark.createDataFrame([("k1", 100)], "pk string, v int")
    stores = {"hbase": KeyedSqlStore(options(), ["pk"], HELD, driver(tmp_path, table, broken)), "doris": lambda s: standby}
    result = failover_lookup(facts, stores, ["pk"], schema, options())
    got = {r.id: r.v for r in result.df.collect()}
    if broken:
        assert result.source == "doris" and got[1] == 100 and got[2] is None
    else:
        assert result.source == "hbase" and got == {i: (i % 60 if i % 9 and i % 60 < 50 else None) for i in range(300)}
        sent = [p for log in asked(tmp_path) for _, parameters in log for p in parameters]
        assert len(sent) == len(set(sent))
    result.close()
