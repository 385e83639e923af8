"""Conforming, key forms, byte codecs and cells."""

import datetime as dt
import decimal
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.functions import binary
from tandem.functions.conform import conform, split_bad_rows, time_field, timestamp_field
from tandem.functions.keys import key_normal_form, rowkey
from tandem.functions.template import json_escape, render_template
from tandem.sources.cells import WideStore, cells_dim, rowkey_ranges

D = decimal.Decimal


def f(name, kind):
    return T.StructField(name, kind)


def one(df):
    return tuple(df.first())


def test_each_type(spark):
    raw = spark.createDataFrame([(1, 42, "123.4", 99, 7)], "flag int, cnt bigint, amount string, ratio int, big int")
    schema = T.StructType(
        [f("flag", T.BooleanType()), f("cnt", T.IntegerType()), f("amount", T.DecimalType(10, 2)),
         f("ratio", T.DoubleType()), f("big", T.LongType())]
    )
    out = conform(raw, schema)
    assert one(out) == (True, 42, D("123.40"), 99.0, 7)
    assert [x.dataType for x in out.schema] == [x.dataType for x in schema]


def test_names_ignore_case_and_missing_is_null(spark):
    raw = spark.createDataFrame([("A-1", 1)], "account_no string, extra int")
    out = conform(raw, T.StructType([f("ACCOUNT_NO", T.StringType()), f("party_name", T.StringType())]))
    assert out.columns == ["ACCOUNT_NO", "party_name"] and one(out) == ("A-1", None)


@pytest.mark.parametrize(
    "value, kind, want",
    [
        ("0.5D", "double", False), ("-1.0D", "double", True), ("double('NaN')", "double", False),
        ("4294967296L", "bigint", False), ("2L", "bigint", True), ("0", "int", False), ("0.9BD", "decimal(2,1)", False),
        ("'TRUE'", "string", True), ("'yes'", "string", False), ("' true'", "string", False), ("'1'", "string", False),
        ("CAST(NULL AS STRING)", "string", None),
    ],
)
def test_boolean(spark, value, kind, want):
    raw = spark.sql(f"SELECT CAST({value} AS {kind}) AS b")
    assert one(conform(raw, T.StructType([f("b", T.BooleanType())]))) == (want,)


def test_decimal_keeps_large_integers(spark):
    raw = spark.createDataFrame([(2**53 + 1, " 1.005 ", 0.1)], "a bigint, b string, c double")
    schema = T.StructType([f(n, T.DecimalType(38, 2)) for n in "abc"])
    assert one(conform(raw, schema)) == (D("9007199254740993.00"), D("1.01"), D("0.10"))


def test_dates_and_times(spark):
    raw = spark.createDataFrame(
        [(20000, " 2024-10-04 ", 45015000, "12:30:15", "12:30", "12:30:15.9876")],
        "d1 int, d2 string, t1 int, t2 string, t3 string, t4 string",
    )
    schema = T.StructType(
        [f("d1", T.DateType()), f("d2", T.DateType()), *[time_field(n) for n in ("t1", "t2", "t3", "t4")]]
    )
    day = dt.date(2024, 10, 4)
    assert one(conform(raw, schema)) == (day, day, 45015000, 45015000, 45000000, 45015987)


def test_time_outside_the_day_is_bad(spark):
    raw = spark.createDataFrame([("25:00:00",)], "t string")
    schema = T.StructType([time_field("t")])
    assert one(conform(raw, schema, "null")) == (None,)
    with pytest.raises(PySparkException):
        conform(raw, schema).collect()


def test_numbers_as_timestamps_by_precision(spark):
    raw = spark.sql("SELECT -1L AS ts3, -1L AS ts6, -1L AS ts9, 1759149015123456789L AS n9")
    schema = T.StructType(
        [timestamp_field("ts3", 3), timestamp_field("ts6", 6), timestamp_field("ts9", 9), timestamp_field("n9", 9)]
    )
    before = dt.datetime(1969, 12, 31, 23, 59, 59)
    assert one(conform(raw, schema)) == (
        before.replace(microsecond=999000), before.replace(microsecond=999999), before.replace(microsecond=999999),
        dt.datetime(2025, 9, 29, 12, 30, 15, 123456),
    )


def test_text_as_timestamp(spark):
    raw = spark.createDataFrame(
        [(" 2026-09-29T12:30:15.123456789123 ", "2026-09-29 12:30:15", "2026-09-29T12:30:15.1")], "a string, b string, c string"
    )
    at = dt.datetime(2026, 9, 29, 12, 30, 15)
    out = conform(raw, T.StructType([timestamp_field(n, 9) for n in "abc"]))
    assert one(out) == (at.replace(microsecond=123456), at, at.replace(microsecond=100000))


def test_other_to_bytes_and_text(spark):
    raw = spark.createDataFrame([(12, dt.date(2024, 1, 2))], "n int, d date")
    out = conform(raw, T.StructType([f("n", T.BinaryType()), f("d", T.StringType())]))
    assert one(out) == (b"12", "2024-01-02")


def test_bad_rows(spark):
    raw = spark.createDataFrame([("a", "1.5"), ("b", "n/a"), ("c", None)], "k string, v string")
    schema = T.StructType([f("k", T.StringType()), f("v", T.DecimalType(5, 1))])
    with pytest.raises(PySparkException):
        conform(raw, schema).collect()
    assert {tuple(r) for r in conform(raw, schema, "null").collect()} == {("a", D("1.5")), ("b", None), ("c", None)}
    good, bad = split_bad_rows(raw, schema)
    assert sorted(r.k for r in good.collect()) == ["a", "c"]
    assert [tuple(r) for r in bad.collect()] == [("b", "n/a")]
    with pytest.raises(ValueError):
        conform(raw, schema, "skip")


# ------------------------------------------------------------------ keys


def key_text(spark, value, kind):
    df = spark.createDataFrame([(value,)], T.StructType([kind]))
    return df.select(key_normal_form([(F.col(kind.name), kind)])).first()[0]


def test_normal_form_is_content_equality(spark):
    assert key_text(spark, D("123.00"), f("k", T.DecimalType(10, 2))) == "123\u0001"
    assert key_text(spark, D("123"), f("k", T.DecimalType(10, 0))) == "123\u0001"
    assert key_text(spark, D("100"), f("k", T.DecimalType(10, 0))) == "100\u0001"
    assert key_text(spark, D("0.00"), f("k", T.DecimalType(10, 2))) == "0\u0001"
    assert key_text(spark, b"\x01\x02", f("k", T.BinaryType())) == "AQI=\u0001"
    assert key_text(spark, None, f("k", T.StringType())) == "\u0001"
    at = dt.datetime(2026, 9, 29, 12, 30)
    assert key_text(spark, at, timestamp_field("k")) == "2026-09-29T12:30\u0001"
    assert key_text(spark, at.replace(second=5, microsecond=120000), timestamp_field("k")) == "2026-09-29T12:30:05.120\u0001"
    assert key_text(spark, at.replace(microsecond=7), timestamp_field("k")) == "2026-09-29T12:30:00.000007\u0001"
    assert key_text(spark, 45015000, time_field("k")) == "12:30:15\u0001"


def key_bytes(spark, parts, **how):
    df = spark.createDataFrame([tuple(v for v, _ in parts)], T.StructType([k for _, k in parts]))
    return bytes(df.select(rowkey([(F.col(k.name), k) for _, k in parts], **how)).first()[0])


LONG, INT, TEXT, DEC = f("l", T.LongType()), f("i", T.IntegerType()), f("s", T.StringType()), f("d", T.DecimalType(10, 2))


def test_string_rowkeys(spark):
    assert key_bytes(spark, [(123, LONG)]) == b"123"
    assert key_bytes(spark, [("acc-1", TEXT), (7, INT)]) == b"acc-1|7"
    assert key_bytes(spark, [(D("123.45"), DEC)]) == b"123.45"
    assert key_bytes(spark, [("a", TEXT), (None, LONG), (b"\xff", f("b", T.BinaryType()))], delimiter="::") == b"a::::\xff"
    at = dt.datetime(2026, 9, 29, 12, 30, 15, 120000)
    assert key_bytes(spark, [(at, timestamp_field("t"))]) == b"2026-09-29 12:30:15.12"


def test_typed_rowkeys(spark):
    assert key_bytes(spark, [(123, LONG)], encoding="typed") == struct.pack(">q", 123)
    assert key_bytes(spark, [(-7, INT)], encoding="typed") == struct.pack(">i", -7)
    assert key_bytes(spark, [(12.5, f("x", T.DoubleType()))], encoding="typed") == struct.pack(">d", 12.5)
    assert key_bytes(spark, [(12.5, f("x", T.FloatType()))], encoding="typed") == struct.pack(">f", 12.5)
    assert key_bytes(spark, [("acc-1", TEXT), (7, LONG)], encoding="typed") == b"acc-1|" + struct.pack(">q", 7)
    assert key_bytes(spark, [(True, f("x", T.BooleanType()))], encoding="typed") == b"\xff"
    assert key_bytes(spark, [(dt.date(1970, 1, 3), f("x", T.DateType()))], encoding="typed") == struct.pack(">i", 2)
    assert key_bytes(spark, [(D("123.45"), DEC)], encoding="typed") == struct.pack(">i", 2) + (12345).to_bytes(2, "big")
    at, epoch_us = dt.datetime(2026, 9, 29, 12, 30, 15, 123456), 1790685015123456
    assert key_bytes(spark, [(at, timestamp_field("t", 3))], encoding="typed") == struct.pack(">q", epoch_us // 1000)
    assert key_bytes(spark, [(at, timestamp_field("t", 6))], encoding="typed") == struct.pack(">q", epoch_us)
    assert key_bytes(spark, [(at, timestamp_field("t", 6))], encoding="typed", legacy_micros=True) == struct.pack(
        ">q", epoch_us // 1000 * 1000
    )
    with pytest.raises(ValueError):
        rowkey([], "other")


def minimal(number):
    return number.to_bytes((number if number >= 0 else ~number).bit_length() // 8 + 1, "big", signed=True)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    numbers=st.lists(st.integers(-(10**18) + 1, 10**18 - 1), min_size=1, max_size=40),
    wide=st.integers(-(10**30), 10**30),
    real=st.floats(allow_nan=False, allow_infinity=False),
)
def test_bytes_round_trip(spark, numbers, wide, real):
    edge = [0, 127, 128, -128, -129, 255, 256, 32767, -32769]
    rows = [(n, D(n).scaleb(-4), D(wide).scaleb(-4), real) for n in numbers + edge]
    narrow_t, wide_t = T.DecimalType(18, 4), T.DecimalType(38, 4)
    df = spark.createDataFrame(rows, T.StructType([f("n", T.LongType()), f("a", narrow_t), f("w", wide_t), f("x", T.DoubleType())]))
    coded = df.select(
        "*", binary.long_bytes(F.col("n")).alias("nb"), binary.decimal_bytes(F.col("a"), narrow_t).alias("ab"),
        binary.decimal_bytes(F.col("w"), wide_t).alias("wb"), binary.double_bytes(F.col("x")).alias("xb"),
    )
    back = coded.select(
        "*", binary.bytes_long(F.col("nb")).alias("n2"), binary.bytes_decimal(F.col("ab"), narrow_t).alias("a2"),
        binary.bytes_decimal(F.col("wb"), wide_t).alias("w2"), binary.bytes_double(F.col("xb")).alias("x2"),
    )
    for r in back.collect():
        assert (r.n2, r.a2, r.w2, r.x2) == (r.n, r.a, r.w, r.x)
        assert bytes(r.nb) == struct.pack(">q", r.n) and bytes(r.xb) == struct.pack(">d", r.x)
        assert bytes(r.ab) == struct.pack(">i", 4) + minimal(r.n)
        assert bytes(r.wb) == struct.pack(">i", 4) + minimal(wide)


def test_null_bytes(spark):
    df = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DECIMAL(30,2)) AS w, CAST(NULL AS BINARY) AS b")
    row = df.select(
        binary.double_bytes(F.col("x")), binary.decimal_bytes(F.col("w"), T.DecimalType(30, 2)),
        binary.bytes_double(F.col("b")), binary.bytes_long(F.col("b")), binary.bytes_decimal(F.col("b"), T.DecimalType(9, 2)),
    ).first()
    assert list(row) == [None] * 5


def test_cells(spark):
    schema = T.StructType([f("name", T.StringType()), f("age", T.ShortType()), f("born", T.DateType()), time_field("at"), timestamp_field("seen", 3)])
    rows = [
        (b"k1", "cf", "name", b"new", 2), (b"k1", "cf", "name", b"old", 1), (b"k1", "cf", "age", struct.pack(">i", 7), 1),
        (b"k1", "cf", "born", struct.pack(">i", 1), 1), (b"k1", "cf", "at", struct.pack(">i", 1000), 1),
        (b"k1", "cf", "seen", struct.pack(">q", 1500), 1), (b"k1", "other", "name", b"no", 9),
        (b"k2", "cf", "name", b"", 1), (b"k2", "cf", "junk", b"x", 1),
    ]
    cells = spark.createDataFrame(rows, "rowkey binary, family string, qualifier string, value binary, ts long")
    out = {bytes(r.rowkey): tuple(r)[1:] for r in cells_dim(cells, schema, "cf").collect()}
    assert out[b"k1"] == ("new", 7, dt.date(1970, 1, 2), 1000, dt.datetime(1970, 1, 1, 0, 0, 1, 500000))
    assert out[b"k2"] == (None,) * 5
    unversioned = cells.filter("value <> X'6F6C64'").drop("ts")
    assert {bytes(r.rowkey): r.name for r in cells_dim(unversioned, schema, "cf").collect()} == {b"k1": "new", b"k2": None}


def test_wide_store_by_keys_needs_no_key_cells(spark):
    schema = T.StructType([f("k", T.StringType()), f("name", T.StringType())])
    cells = spark.createDataFrame(
        [(b"a", "info", "name", b"A"), (b"b", "info", "name", b"B")], "rowkey binary, family string, qualifier string, value binary"
    )
    store = WideStore(lambda s: cells, schema, ["k"])
    got = store.for_keys(spark, spark.createDataFrame([("a", 3), ("z", 1)], "k string, n long"))
    assert [(r.k, r.name) for r in got.collect()] == [("a", "A")]


def test_many_keys_are_read_in_ranges(spark, tmp_path):
    cells = spark.range(0, 4_000).select(
        F.format_string("k%05d", "id").cast("binary").alias("rowkey"), F.lit("info").alias("family"), F.lit("name").alias("qualifier"),
        F.col("id").cast("string").cast("binary").alias("value"),
    )
    cells.repartition(2).write.parquet(str(tmp_path / "cells"))
    schema = T.StructType([f("k", T.StringType()), f("name", T.StringType())])
    store = WideStore(lambda s: s.read.parquet(str(tmp_path / "cells")), schema, ["k"], max_in_keys=10, max_ranges=4)
    ids = [*range(100, 140), *range(3_000, 3_040), 9_000]
    wanted = spark.createDataFrame([(f"k{i:05d}", 1) for i in ids], "k string, n long")
    got = store.for_keys(spark, wanted)
    assert sorted((r.k, r.name) for r in got.collect()) == [(f"k{i:05d}", str(i)) for i in ids[:-1]]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rowkey" in plan and "LessThanOrEqual(rowkey" in plan
    ranges = rowkey_ranges(wanted.select(F.col("k").cast("binary").alias("rowkey")), 4)
    assert len(ranges) <= 4 and all(low <= high for low, high in ranges) and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert all(any(low <= f"k{i:05d}".encode() <= high for low, high in ranges) for i in ids)
    assert rowkey_ranges(wanted.limit(0).select(F.col("k").cast("binary").alias("rowkey")), 4) == []
    few = store.for_keys(spark, wanted.limit(2))
    assert few.count() == 2


# ------------------------------------------------------------------ templates


def test_json_escape(spark):
    text = 'bad "quote" at\nline 2\ttab \\ \r\b\f \x01\x1f é literal \\u001F'
    df = spark.createDataFrame([(text,), (None,)], "t string").select(json_escape(F.col("t")).alias("e"))
    import json

    escaped = [r.e for r in df.collect()]
    assert json.loads('"' + escaped[0] + '"') == text
    assert "\\u0001\\u001f" in escaped[0] and '\\"quote\\" at\\nline' in escaped[0]
    assert escaped[1] == ""


def test_render_keeps_unknown_names(spark):
    template = '{"t":"${table}","n":${consecutive},"x":"${nope}"}'
    values = {"table": F.lit("dim_account"), "consecutive": F.lit(1)}
    assert spark.range(1).select(render_template(template, values)).first()[0] == '{"t":"dim_account","n":1,"x":"${nope}"}'
    assert spark.range(1).select(render_template("{plain}", values)).first()[0] == "{plain}"
    assert spark.range(1).select(render_template("{a ${open", values)).first()[0] == "{a ${open"


MALFORMED = ["2024", "2024-01", "2024-01-01 10:00:00.123456 garbage", "2024-01-01T10:00:00+08:00", "2024-01-01 10:00:00.123456+08:00", "garbage", ""]


@pytest.mark.parametrize("field", [timestamp_field("v", 6), T.StructField("v", T.TimestampType()), T.StructField("v", T.DateType())])
def test_malformed_text_is_bad(spark, field):
    schema = T.StructType([field])
    good = "2024-01-01" if isinstance(field.dataType, T.DateType) else "2024-1-01T10:00:00.123456789"
    bad = MALFORMED + (["2024-01-01 10:00:00", "2024-1-1"] if isinstance(field.dataType, T.DateType) else ["2024-01-01"])
    raw = spark.createDataFrame([(v,) for v in [*bad, good, None]], "v string")
    kept, aside = split_bad_rows(raw, schema)
    assert sorted(r.v for r in aside.collect()) == sorted(bad)
    assert kept.count() == 2 and conform(raw, schema, "null").filter("v IS NOT NULL").count() == 1
    with pytest.raises(Exception, match="not a"):
        conform(raw.filter("v = '2024'"), schema).collect()


def test_decimal_booleans_are_cut_to_32_bits(spark):
    schema = T.StructType([T.StructField("v", T.BooleanType())])
    raw = spark.sql("SELECT * FROM VALUES (4294967296BD), (0.9BD), (-1.5BD), (4294967297BD) AS t(v)")
    assert [r.v for r in conform(raw, schema).collect()] == [False, False, True, True]
