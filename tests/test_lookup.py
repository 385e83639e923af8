"""Lookup join, probes and failover."""

import os
import threading
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.operators.failover import FactsFailed, LookupFailed, error_of, failover_lookup
from tandem.operators.lookup import distinct_keys, in_predicate, lookup_join, probe
from tandem.options import LookupOptions
from tandem.session import DeadlineExceeded, folder_bytes, run_with_deadline, stage, staging_root, staging_scope
from tandem.streaming.enrich import SnapshotCache

SCHEMA = T.StructType(
    [
        T.StructField("pk", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("LOOKUP_SOURCE", T.StringType()),
        T.StructField("lookup_cost_ms", T.LongType()),
    ]
)
OPTIONS = LookupOptions(deadline_ms=60_000)


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "z")], "id int, key string")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "pk string, name string")


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def slow(df, seconds):
    """A store whose rows take their time."""

    def wait(batches):
        for batch in batches:
            time.sleep(seconds)
            yield batch

    return lambda spark: df.mapInArrow(wait, df.schema)


def boom(error=ConnectionError("down")):
    def load(spark):
        raise error

    return load


def look(facts, primary, standby, options=OPTIONS, schema=SCHEMA, **how):
    return failover_lookup(facts, {"hbase": primary, "doris": standby}, {"key": "pk"}, schema, options, **how)


# ------------------------------------------------------------------ join


@pytest.mark.parametrize("how", [{}, {"hint": "merge"}, {"hint": "shuffle_hash"}, {"hint": "broadcast"}, {"salt": 3}])
def test_left_and_inner(facts, dim, how):
    left = lookup_join(facts, dim, {"key": "pk"}, **how)
    assert left.columns == ["id", "key", "name"]
    assert rows(left, "id", "name") == [(1, "A"), (2, "B"), (3, "A"), (4, None), (5, None)]
    assert rows(lookup_join(facts, dim, {"key": "pk"}, "inner", **how), "id", "name") == [(1, "A"), (2, "B"), (3, "A")]


@pytest.mark.parametrize(
    "kind, values, dim_kind, held, matched",
    [
        ("double", [12.7, 12.0, float("nan"), None], "long", [12], [1]),
        ("decimal(10,2)", ["12.70", "12.00"], "int", [12], [1]),
        ("long", [2**40, 7], "int", [7, 0], [1]),
        ("timestamp_ntz", ["2024-05-06 07:00:00", "2024-05-06 00:00:00"], "date", ["2024-05-06"], [1]),
        ("string", ["12.7", "12", "x"], "long", [12], [1]),
    ],
)
def test_keys_match_only_without_loss(spark, kind, values, dim_kind, held, matched):
    facts = spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(values)], "id int, key string")
    facts = facts.select("id", F.col("key").cast(kind).alias("key"))
    dim = spark.createDataFrame([(str(h),) for h in held], "pk string").select(F.col("pk").cast(dim_kind).alias("pk"), F.lit(1).alias("name"))
    found = lookup_join(facts, dim, {"key": "pk"}, "inner")
    assert [r.id for r in found.orderBy("id").collect()] == matched
    schema = T.StructType([dim.schema["pk"]])
    assert distinct_keys(facts, {"key": "pk"}, schema).join(dim, "pk").count() == len(matched)


@pytest.mark.parametrize("hint", ["merge", "shuffle_hash"])
def test_keyless_facts_are_spread_under_a_shuffling_hint(facts, dim, hint):
    plan = lookup_join(facts, dim, {"key": "pk"}, hint=hint)._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan


def test_same_key_name_and_prefix(spark, dim):
    facts = spark.createDataFrame([("a", "mine")], "pk string, name string")
    with pytest.raises(ValueError, match="prefix"):
        lookup_join(facts, dim, ["pk"])
    assert rows(lookup_join(facts, dim, ["pk"], prefix="d_"), "pk", "name", "d_name") == [("a", "mine", "A")]


def test_null_in_any_key_part_is_a_miss(spark):
    facts = spark.createDataFrame([(1, "a", None), (2, None, 1), (3, "a", 1)], "id int, k1 string, k2 int")
    dim = spark.createDataFrame([("a", None, "x"), (None, 1, "y"), ("a", 1, "z")], "k1 string, k2 int, v string")
    for hint in (None, "merge"):
        assert rows(lookup_join(facts, dim, ["k1", "k2"], hint=hint), "id", "v") == [(1, None), (2, None), (3, "z")]


def test_keys_of_another_type_are_converted(spark, dim):
    facts = spark.createDataFrame([(1, "10"), (2, "x")], "id int, key string")
    numbers = spark.createDataFrame([(10, "ten")], "pk long, name string")
    assert rows(lookup_join(facts, numbers, {"key": "pk"}), "id", "name") == [(1, "ten"), (2, None)]


def test_many_rows_per_key(spark, facts):
    dim = spark.createDataFrame([("a", "A2"), ("a", "A1"), ("b", "B")], "pk string, name string")
    assert rows(lookup_join(facts, dim, {"key": "pk"}, "inner"), "id", "name") == [
        (1, "A1"), (1, "A2"), (2, "B"), (3, "A1"), (3, "A2")
    ]
    first = lookup_join(facts, dim, {"key": "pk"}, "inner", dim_unique="first")
    assert rows(first, "id", "name") == [(1, "A1"), (2, "B"), (3, "A1")]
    with pytest.raises(PySparkException, match="more than one dimension row"):
        lookup_join(facts, dim, {"key": "pk"}, dim_unique="error").collect()
    assert len(rows(lookup_join(facts, dim.filter("name <> 'A2'"), {"key": "pk"}, dim_unique="error"), "id")) == 5


def test_facts_without_key_are_spread(spark, dim):
    """In a shuffled left join the keyless facts must not meet in one partition."""
    facts = spark.range(0, 2000, 1, 64).select("id", F.when(F.col("id") < 10, "a").alias("key"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for how in ({}, {"spread_by": ["id"]}, {"salt": 64}):
            joined = lookup_join(facts, dim, {"key": "pk"}, **how)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) == 4 and max(sizes) < 1000
            assert joined.filter("name = 'A'").count() == 10 and joined.count() == 2000
        together = lookup_join(facts, dim, {"key": "pk"}, spread_nulls=False)
        assert max(r["count"] for r in together.groupBy(F.spark_partition_id()).count().collect()) >= 1990
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_spreading_keeps_pruning_and_pushdown(spark, sf_dir):
    orders, customer = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("orders", "customer"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = lookup_join(orders, customer, {"o_custkey": "c_custkey"}).select("o_orderkey", "c_name")
        plan = found._jdf.queryExecution().executedPlan().toString()
        by_id = lookup_join(orders, customer, {"o_custkey": "c_custkey"}, spread_by=["o_orderkey"])
        filtered = by_id.filter("o_totalprice > 1000")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    assert "GreaterThan(o_totalprice,1000.0)" in filtered


def test_arguments(facts, dim):
    for bad in ({"how": "outer"}, {"dim_unique": "some"}):
        with pytest.raises(ValueError):
            lookup_join(facts, dim, {"key": "pk"}, **bad)
    with pytest.raises(ValueError, match="at least one"):
        lookup_join(facts, dim, [])
    with pytest.raises(ValueError, match="top-level"):
        lookup_join(facts, dim, {"a.b": "pk"})
    with pytest.raises(ValueError, match="lacks key"):
        lookup_join(facts, dim, {"key": "nope"})


# ------------------------------------------------------------------ probe


def test_distinct_keys_count_queryable_facts(facts):
    schema = T.StructType([SCHEMA["pk"]])
    assert rows(distinct_keys(facts, {"key": "pk"}, schema), "pk", "n") == [("a", 2), ("b", 1), ("z", 1)]


@pytest.mark.parametrize("max_in_keys", [0, 1, 100])
def test_probe_same_rows_either_way(spark, facts, dim, max_in_keys):
    keys = distinct_keys(facts, {"key": "pk"}, T.StructType([SCHEMA["pk"]]))
    assert rows(probe(dim, keys, ["pk"], max_in_keys), "pk") == [("a",), ("b",)]


@pytest.mark.parametrize("max_in_keys", [0, 100])
def test_probe_composite(spark, max_in_keys):
    dim = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k1 string, k2 int, v string")
    keys = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1), ("a", None)], "k1 string, k2 int")
    assert rows(probe(dim, keys, ["k1", "k2"], max_in_keys), "v") == [("x",), ("z",)]


def test_probe_without_keys_reads_nothing(spark, dim):
    keys = spark.createDataFrame([], "pk string")
    assert probe(dim, keys, ["pk"], 10).count() == 0


def test_few_keys_are_pushed_to_the_scan(spark, sf_dir):
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    keys = customer.select("c_custkey").filter("c_acctbal > 5000")
    plan = probe(customer, keys, ["c_custkey"], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(c_custkey, [" in plan
    two = customer.filter(in_predicate([(1, "BUILDING"), (2, "MACHINERY")], [F.col("c_custkey"), F.col("c_mktsegment")]))
    assert "Or(And(EqualTo(c_custkey,1),EqualTo(c_mktsegment,BUILDING))" in two._jdf.queryExecution().toString()


# ------------------------------------------------------------------ failover


@pytest.mark.parametrize("strategy", ["auto", "snapshot", "keys"])
def test_primary_answers(facts, dim, strategy):
    result = look(facts, lambda s: dim, boom(), strategy=strategy)
    assert result.df.columns == ["id", "key", "name", "LOOKUP_SOURCE", "lookup_cost_ms"]
    assert rows(result.df, "id", "name", "LOOKUP_SOURCE") == [
        (1, "A", "hbase"), (2, "B", "hbase"), (3, "A", "hbase"), (4, None, None), (5, None, None)
    ]
    assert {r.lookup_cost_ms for r in result.df.filter("name is not null").collect()} == {result.cost_ms}
    assert not result.failed_over
    log = result.log_row("1/4", 7).first()
    assert (log.n_keys, log.primary_hits, log.failed_over, log.batch_id, log.subtask) == (4, 3, False, 7, "1/4")
    assert log.lookup_source == "hbase" and log.primary_error is None and log.standby_ms is None
    result.close()


def test_metadata_only_when_declared(facts, dim):
    plain = T.StructType(SCHEMA.fields[:2])
    assert look(facts, lambda s: dim, boom(), schema=plain).df.columns == ["id", "key", "name"]


def test_all_keys_null_ask_for_nothing(spark, dim):
    facts = spark.createDataFrame([(1, None)], "id int, key string")
    for strategy in ("keys", "snapshot"):
        result = look(facts, lambda s: dim, boom(), strategy=strategy)
        assert rows(result.df, "id", "name", "LOOKUP_SOURCE") == [(1, None, None)]
        assert result.log_row().first().n_keys == 0


def test_primary_error_leads_to_standby_for_the_whole_batch(facts, dim):
    standby = dim.withColumn("name", F.concat(F.lit("S:"), "name"))
    result = look(facts, boom(), lambda s: standby)
    assert rows(result.df, "id", "name", "LOOKUP_SOURCE")[:3] == [(1, "S:A", "doris"), (2, "S:B", "doris"), (3, "S:A", "doris")]
    log = result.log_row().first()
    assert (log.primary_error, log.primary_message, log.failed_over) == ("ConnectionError", "down", True)
    assert (log.primary_hits, log.standby_hits, log.lookup_source) == (None, 3, "doris")


def test_error_inside_a_job_leads_to_standby(facts, dim):
    broken = dim.withColumn("name", F.raise_error(F.lit("row is broken")).cast("string"))
    result = look(facts, lambda s: broken, lambda s: dim)
    assert result.source == "doris"
    assert "row is broken" in result.attempts[0].error_message


@pytest.mark.parametrize("loader", [lambda s: None, lambda s: [], lambda s: s.range(3)])
def test_no_result_or_no_key_column_is_a_failure(facts, dim, loader):
    assert look(facts, loader, lambda s: dim).source == "doris"


def test_unreachable_sql_store_is_a_failure(facts, dim):
    from tandem.sources.jdbc import jdbc_dim

    down = jdbc_dim(LookupOptions(jdbc_url="jdbc:nosuchstore://nowhere/db", jdbc_driver="", table_name="t"))
    result = look(facts, down, lambda s: dim)
    assert result.source == "doris" and "driver" in result.attempts[0].error_message.lower()


def test_miss_is_no_failure(facts, dim):
    empty = dim.filter("false")
    result = look(facts, lambda s: empty, boom(AssertionError("standby must not be asked")))
    assert result.source == "hbase" and not result.failed_over
    assert result.df.filter("name is not null").count() == 0 and result.df.count() == 5


def test_both_fail(facts):
    with pytest.raises(LookupFailed, match="first.*second") as failed:
        look(facts, boom(ConnectionError("first")), boom(ValueError("second")))
    assert [a.error_class for a in failed.value.attempts] == ["ConnectionError", "ValueError"]
    assert failed.value.n_keys == 4


def test_broken_facts_blame_no_store(facts, dim):
    broken = facts.withColumn("key", F.raise_error(F.lit("no facts")).cast("string"))
    with pytest.raises(FactsFailed, match="no facts"):
        look(broken, lambda s: dim, lambda s: dim, strategy="keys")


def test_deadline_cancels_and_leads_to_standby(facts, dim):
    started = time.monotonic()
    result = look(facts, slow(dim, 60), lambda s: dim, LookupOptions(deadline_ms=3000))
    assert time.monotonic() - started < 30
    assert result.source == "doris" and result.attempts[0].error_class == "DeadlineExceeded"
    assert result.cost_ms >= 3000 and result.attempts[0].elapsed_ms < 20_000


def test_late_success_is_a_failure(spark):
    timed = run_with_deadline(spark, lambda: time.sleep(0.3), 100)
    assert isinstance(timed.error, DeadlineExceeded) and timed.elapsed_ms >= 300
    assert run_with_deadline(spark, lambda: 5, 10_000).result == 5


def test_connecting_is_not_timed(facts, dim):
    def connects_slowly(spark):
        time.sleep(3.5)
        return dim

    result = look(facts, connects_slowly, boom(), LookupOptions(deadline_ms=3300))
    assert result.source == "hbase" and result.cost_ms < 3300


def test_answer_survives_the_store_going_down(spark, facts, dim, tmp_path):
    path = str(tmp_path / "dim")
    dim.write.parquet(path)
    result = look(facts, lambda s: s.read.parquet(path), boom())
    spark.createDataFrame([("a", "changed")], dim.schema).write.mode("overwrite").parquet(path)
    assert rows(result.df, "id", "name")[0] == (1, "A")


def test_a_store_that_never_opens(facts, dim):
    result = look(facts, lambda s: time.sleep(600), lambda s: dim, LookupOptions(deadline_ms=9_000, connect_bound_ms=2_000))
    assert result.source == "doris" and result.attempts[0].error_class == "DeadlineExceeded"


def test_a_late_connect_is_ended_in_the_jvm(spark):
    """What waits in the JVM is interrupted, so no thread is left behind."""
    from tandem.session import DeadlineExceeded, within

    before = {t.name for t in threading.enumerate()}
    with pytest.raises(DeadlineExceeded):
        within(spark, lambda: spark._jvm.java.lang.Thread.sleep(600_000), 300)
    deadline = time.monotonic() + 10
    while {t.name for t in threading.enumerate()} - before and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not {t.name for t in threading.enumerate() if t.is_alive()} - before


def test_conversions_run_once_per_dimension_row(spark, facts):
    """Casts and patterns stand below the join; above it a fact only looks whether its row has a note."""
    schema = T.StructType([T.StructField("pk", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("d", T.DateType())])
    store = spark.createDataFrame([("a", "1", "2024-01-02"), ("b", "x", "no date")], "pk string, v string, d string")
    result = look(facts, lambda s: store, boom(), schema=schema)
    plan = result.df._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join", 1)
    above = above.replace("cast(raise_error", "")  # the type of what never returns
    assert "cast(" not in above and "RLIKE" not in above.upper() and "RLIKE" in below.upper()
    assert rows(result.df.filter("id = 1").select("id", "v"), "id", "v") == [(1, 1)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT.*column d"):
        result.df.select("id", "d").collect()


def test_bad_rows(spark, facts):
    schema = T.StructType([T.StructField("pk", T.StringType()), T.StructField("v", T.IntegerType())])
    store = spark.createDataFrame([("a", "1"), ("b", "x")], "pk string, v string")
    failing = look(facts, lambda s: store, boom(), schema=schema)
    assert failing.source == "hbase" and not failing.failed_over
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        failing.df.collect()
    assert rows(look(facts, lambda s: store, boom(), schema=schema, on_bad_row="null").df, "id", "v")[:3] == [(1, 1), (2, None), (3, 1)]
    kept = look(facts, lambda s: store, boom(), schema=schema, on_bad_row="quarantine")
    assert rows(kept.df, "id", "v")[:3] == [(1, 1), (2, None), (3, 1)]
    assert rows(kept.bad_rows, "pk", "v") == [("b", "x")]


@pytest.mark.parametrize("strategy", ["snapshot", "keys"])
@pytest.mark.parametrize("on_bad_row", ["fail", "null", "quarantine"])
@pytest.mark.parametrize("dim_unique", ["all", "first", "error"])
def test_bad_row_of_a_key_nobody_asks_for(spark, facts, strategy, on_bad_row, dim_unique):
    schema = T.StructType([T.StructField("pk", T.StringType()), T.StructField("v", T.IntegerType())])
    store = spark.createDataFrame([("a", "1"), ("b", "2"), ("zz", "oops"), ("zz", "7")], "pk string, v string")
    found = look(facts, lambda s: store, boom(), schema=schema, strategy=strategy, on_bad_row=on_bad_row, dim_unique=dim_unique)
    assert found.source == "hbase" and not found.failed_over
    assert rows(found.df, "id", "v")[:3] == [(1, 1), (2, 2), (3, 1)]
    assert found.df.schema["v"].dataType == T.IntegerType()
    assert found.bad_rows is None or found.bad_rows.count() == 0


@pytest.mark.parametrize("max_in_keys", [0, 100])
def test_stored_keys_of_another_type(spark, max_in_keys):
    facts = spark.createDataFrame([(1, 10), (2, 11)], "id int, key long")
    schema = T.StructType([T.StructField("pk", T.LongType()), T.StructField("name", T.StringType())])
    store = spark.createDataFrame([("10", "ten"), ("x", "bad")], "PK string, name string")
    options = LookupOptions(deadline_ms=60_000, max_in_keys=max_in_keys)
    result = look(facts, lambda s: store, boom(), options, schema, strategy="keys", on_bad_row="null")
    assert rows(result.df, "id", "name") == [(1, "ten"), (2, None)]


def test_role_swap(facts, dim):
    result = look(facts, boom(), lambda s: dim, LookupOptions(primary="doris", deadline_ms=60_000))
    assert result.source == "doris" and not result.failed_over


def test_store_names_are_checked(facts, dim):
    with pytest.raises(ValueError, match="loaders are needed"):
        failover_lookup(facts, {"hbase": lambda s: dim}, {"key": "pk"}, SCHEMA, OPTIONS)


def test_hits_count_keys_and_not_rows(spark, facts):
    many = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "pk string, name string")
    result = look(facts, lambda s: many, boom())
    assert result.df.count() == 7
    log = result.log_row().first()
    assert (log.n_keys, log.primary_hits) == (4, 3)


def test_snapshot_cache(facts, dim):
    calls = []

    def load(spark):
        calls.append(1)
        return dim

    cache = SnapshotCache(load, ttl_s=60)
    for _ in range(2):
        result = look(facts, cache, boom(), strategy="snapshot")
        assert rows(result.df, "id", "name")[0] == (1, "A")
        result.close()
    assert len(calls) == 1
    cache.ttl_s = cache._until = 0
    look(facts, cache, boom(), strategy="snapshot")
    assert len(calls) == 2


def test_a_snapshot_is_kept_as_long_as_a_lookup_reads_it(facts, dim):
    cache = SnapshotCache(lambda spark: dim, ttl_s=60)
    made = look(facts, cache, boom(), strategy="snapshot")
    shared = look(facts, cache, boom(), strategy="snapshot")
    path, spark = cache._path, facts.sparkSession
    cache._until = 0
    newer = look(facts, cache, boom(), strategy="snapshot")
    made.close()
    made.close()
    assert folder_bytes(spark, path) > 0 and rows(shared.df, "id", "name")[0] == (1, "A")
    shared.close()
    assert folder_bytes(spark, path) == 0
    newer.close()
    assert folder_bytes(spark, cache._path) > 0 and cache._leases == {}


@pytest.mark.parametrize("strategy", ["snapshot", "keys"])
def test_log_rows_by_subtask_add_up(facts, dim, strategy):
    result = look(facts, boom(), lambda s: dim, strategy=strategy)
    whole, parts = result.log_row().first(), result.log_rows(5, 3, label="q").collect()
    assert [r.subtask for r in parts] == [f"q:{i}/5" for i in range(1, 6)]
    assert {(r.batch_id, r.lookup_source, r.failed_over, r.primary_error) for r in parts} == {(3, whole.lookup_source, True, whole.primary_error)}
    assert (sum(r.n_keys for r in parts), sum(r.standby_hits for r in parts)) == (whole.n_keys, whole.standby_hits)
    assert len({r.n_keys for r in parts}) > 1 and all(r.standby_hits <= r.n_keys for r in parts)
    assert [r.n_keys for r in result.log_rows(1).collect()] == [whole.n_keys]
    with pytest.raises(LookupFailed) as failed:
        look(facts, boom(), boom())
    assert sum(failed.value.keys_by_subtask(5)) == failed.value.n_keys == whole.n_keys
    assert failed.value.keys_by_subtask(5) == [r.n_keys for r in parts]


def test_large_answer_is_not_broadcast(facts, dim):
    from dataclasses import replace

    old = facts.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    facts.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        small = look(facts, lambda s: dim, boom()).df._jdf.queryExecution().toString()
        large = look(facts, lambda s: dim, boom(), replace(OPTIONS, broadcast_bytes=0)).df._jdf.queryExecution().toString()
    finally:
        facts.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in small and "SortMergeJoin" in large


def test_staging_follows_the_session(spark, dim):
    assert staging_root(spark) == (spark.conf.get("spark.checkpoint.dir", None) or staging_root(spark)).rstrip("/")
    assert stage(dim, "test").inputFiles()[0].split("://")[-1].replace("file:", "").startswith(staging_root(spark))


def test_error_of_jvm_failures(spark):
    try:
        spark.read.format("jdbc").options(url="jdbc:nosuchstore:x", dbtable="t").load()
    except Exception as error:
        assert error_of(error)[0] == "java.sql.SQLException"


def test_staging_scope_removes_only_its_own(spark, dim):
    def file_of(df):
        return df.inputFiles()[0].removeprefix("file:").replace("///", "/")

    kept = file_of(stage(dim, "test"))
    with staging_scope(spark):
        gone = file_of(stage(dim, "test"))
        with staging_scope(spark):
            inner = file_of(stage(dim, "test"))
        assert os.path.exists(gone) and not os.path.exists(inner)
    assert os.path.exists(kept) and not os.path.exists(gone)
