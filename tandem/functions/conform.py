"""Bring a store's rows to the declared schema.

Everything is a column expression in one ``select``, so Catalyst prunes and pushes through it.

Two declared types have no Spark type of their own and are marked by field metadata:

* TIME is an ``IntegerType`` holding milliseconds of the day, see :func:`time_field`;
* a timestamp's precision says how numbers are read (ms, us or ns), see :func:`timestamp_field`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MS_PER_DAY = 86_400_000

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)
_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def time_field(name: str) -> T.StructField:
    """A TIME column: milliseconds of the day as an integer."""
    return T.StructField(name, T.IntegerType(), True, {"logical": "time"})


def timestamp_field(name: str, precision: int = 6) -> T.StructField:
    """A TIMESTAMP(p) column without zone; ``precision`` decides the unit of numeric input."""
    return T.StructField(name, T.TimestampNTZType(), True, {"precision": precision})


def is_time(field: T.StructField) -> bool:
    return (field.metadata or {}).get("logical") == "time"


def precision_of(field: T.StructField) -> int:
    """Declared timestamp precision: 6 without zone and 3 with local zone when not said."""
    default = 3 if isinstance(field.dataType, T.TimestampType) else 6
    return (field.metadata or {}).get("precision", default)


def source_column(df: DataFrame, name: str) -> str | None:
    """The column of ``df`` that feeds ``name``: exact match first, then ignoring case (B2)."""
    if name in df.columns:
        return name
    return {column.lower(): column for column in df.columns}.get(name.lower())


def _cast(value: Column, to: T.DataType, strict: bool) -> Column:
    return value.cast(to) if strict else value.try_cast(to)


def to_boolean(value: Column, source: T.DataType) -> Column:
    """Numbers are true when non-zero as a 32-bit integer, text only when it spells "true" (B4)."""
    if isinstance(source, T.BooleanType):
        return value
    if isinstance(source, _INTEGRAL):
        return value.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)) != 0
    if isinstance(source, _FRACTIONAL):
        return F.when(F.isnan(value), F.lit(False)).otherwise(F.abs(value) >= 1)
    if isinstance(source, T.DecimalType):
        return F.floor(F.abs(value)) % F.lit(2**32) != 0
    return F.lower(value.cast("string")) == "true"


def to_decimal(value: Column, source: T.DataType, target: T.DecimalType, strict: bool) -> Column:
    """Integers exactly, floats through their decimal text, text trimmed."""
    if isinstance(source, (*_INTEGRAL, T.DecimalType)):
        return _cast(value, target, strict)
    return _cast(F.trim(value.cast("string")), target, strict)


def _shaped(value: Column, shape: str, what: str, strict: bool) -> Column:
    """Trimmed text if the whole of it has the shape; otherwise an error, or NULL when not strict."""
    text = F.trim(value.cast("string"))
    shaped = F.when(text.rlike(shape), text)
    if strict:
        shaped = F.coalesce(shaped, F.when(value.isNotNull(), F.raise_error(F.concat(F.lit(f"not a {what}: "), text))))
    return shaped


def to_date(value: Column, source: T.DataType, strict: bool) -> Column:
    """Numbers are days since the epoch, text is ``yyyy-MM-dd`` and nothing else."""
    if isinstance(source, (T.DateType, *_TIMESTAMPS)):
        return value.cast("date")
    if isinstance(source, (*_INTEGRAL, *_FRACTIONAL, T.DecimalType)):
        return F.date_from_unix_date(_cast(value, T.IntegerType(), strict))
    return _cast(_shaped(value, r"^\d{4}-\d{2}-\d{2}$", "date", strict), T.DateType(), strict)


def to_time_ms(value: Column, source: T.DataType, strict: bool) -> Column:
    """Numbers are milliseconds of the day, text is ``HH:mm[:ss[.fraction]]``."""
    if isinstance(source, (*_INTEGRAL, *_FRACTIONAL, T.DecimalType)):
        return _cast(value, T.IntegerType(), strict)
    if isinstance(source, _TIMESTAMPS):
        return (
            F.hour(value) * 3_600_000
            + F.minute(value) * 60_000
            + F.floor(F.date_format(value, "s.SSSSSS").cast("decimal(9,6)") * 1000)
        ).cast("int")
    # A valid time of day on a fixed day is a valid timestamp, so Spark's parser does the checking.
    shaped = _shaped(value, r"^\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$", "time", strict)
    whole = F.when(F.length(shaped) == 5, F.concat(shaped, F.lit(":00"))).otherwise(shaped)
    at = F.substring(F.concat(F.lit("1970-01-01 "), whole), 1, 26)
    micros = F.unix_micros(_cast(F.concat(at, F.lit("Z")), T.TimestampType(), strict))
    return F.floor(micros / 1000).cast("int")


def to_timestamp(value: Column, source: T.DataType, field: T.StructField, strict: bool) -> Column:
    """Numbers by declared precision, text with ``T`` or a blank between date and time.

    Fraction digits beyond microseconds are dropped; text with a zone or anything else is bad.
    """
    target = field.dataType
    if isinstance(source, (T.DateType, *_TIMESTAMPS)):
        return value.cast(target)
    if isinstance(source, (*_INTEGRAL, *_FRACTIONAL, T.DecimalType)):
        number = _cast(value, T.LongType(), strict)
        precision = precision_of(field)
        if precision <= 3:
            instant = F.timestamp_millis(number)
        elif precision <= 6:
            instant = F.timestamp_micros(number)
        else:
            instant = F.timestamp_micros(F.call_function("div", number - F.pmod(number, F.lit(1000)), F.lit(1000)))
        return instant.cast(target)
    text = _shaped(value, r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}(\.\d+)?$", "timestamp", strict)
    text = F.regexp_replace(F.regexp_replace(text, "T", " "), r"(\.\d{6})\d+$", "$1")
    return _cast(text, target, strict)


def to_binary(value: Column, source: T.DataType) -> Column:
    """Bytes as they are, anything else as UTF-8 text."""
    return value if isinstance(source, T.BinaryType) else F.encode(value.cast("string"), "UTF-8")


def coerce(value: Column, source: T.DataType, field: T.StructField, strict: bool = True) -> Column:
    """``value`` as the declared type; ``strict`` raises on a bad value, otherwise it is NULL."""
    target = field.dataType
    if isinstance(source, T.NullType):
        return F.lit(None).cast(target)
    if is_time(field):
        return to_time_ms(value, source, strict)
    if isinstance(target, T.BooleanType):
        return to_boolean(value, source)
    if isinstance(target, T.DecimalType):
        return to_decimal(value, source, target, strict)
    if isinstance(target, T.DateType):
        return to_date(value, source, strict)
    if isinstance(target, _TIMESTAMPS):
        return to_timestamp(value, source, field, strict)
    if isinstance(target, T.BinaryType):
        return to_binary(value, source)
    if source == target:
        return value
    return _cast(value, target, strict)


def conform(df: DataFrame, schema: T.StructType, on_bad_row: str = "fail") -> DataFrame:
    """Project ``df`` to ``schema``, coercing every column; a column the store lacks is NULL.

    ``on_bad_row``: ``"fail"`` raises when a value does not convert, ``"null"`` makes that value
    NULL. To keep bad rows apart use :func:`split_bad_rows`.
    """
    if on_bad_row not in ("fail", "null"):
        raise ValueError(f"on_bad_row must be fail or null, got {on_bad_row!r}")
    return df.select(*_columns(df, schema, strict=on_bad_row == "fail"))


def split_bad_rows(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: conformed rows, and the untouched rows with a value that does not convert."""
    broken = F.lit(False)
    for field in schema:
        name = source_column(df, field.name)
        if name is not None:
            converted = coerce(df[name], df.schema[name].dataType, field, strict=False)
            broken = broken | (df[name].isNotNull() & converted.isNull())
    return conform(df.filter(~broken), schema, "null"), df.filter(broken)


def held_columns(df: DataFrame, schema: T.StructType, keys: dict[str, Column]) -> DataFrame:
    """The declared columns as the store has them, under their declared names; ``keys`` already conform.

    A column the store lacks, or has without a type, is NULL of the declared type.
    """
    columns = []
    for field in schema:
        name = source_column(df, field.name)
        if field.name in keys:
            value = keys[field.name]
        elif name is None or isinstance(df.schema[name].dataType, T.NullType):
            value = F.lit(None).cast(field.dataType)
        else:
            value = df[name]
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _columns(df: DataFrame, schema: T.StructType, strict: bool) -> list[Column]:
    columns = []
    for field in schema:
        name = source_column(df, field.name)
        if name is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = coerce(df[name], df.schema[name].dataType, field, strict)
        columns.append(value.alias(field.name, metadata=dict(field.metadata or {})))
    return columns
