"""Key forms: content-equal text (B13) and rowkey bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.functions.binary import (
    decimal_bytes,
    double_bytes,
    float_bytes,
    int_bytes,
    long_bytes,
)
from tandem.functions.conform import is_time, precision_of

# Fixed value: the character that ends every part of a normal-form key.
KEY_PART_END = "\u0001"


def _plain_decimal(value: Column) -> Column:
    text = value.cast("string")
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def _iso_seconds(whole: Column, seconds: Column, micros: Column) -> Column:
    """``HH:mm`` text followed by seconds and fraction, each left out when zero."""
    fraction = (
        F.when(micros == "000000", F.lit(""))
        .when(F.endswith(micros, F.lit("000")), F.concat(F.lit("."), F.substring(micros, 1, 3)))
        .otherwise(F.concat(F.lit("."), micros))
    )
    return F.concat(
        whole,
        F.when((seconds == "00") & (micros == "000000"), F.lit("")).otherwise(
            F.concat(F.lit(":"), seconds, fraction)
        ),
    )


def _iso_timestamp(value: Column) -> Column:
    return _iso_seconds(
        F.date_format(value, "yyyy-MM-dd'T'HH:mm"), F.date_format(value, "ss"), F.date_format(value, "SSSSSS")
    )


def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _clock(ms_of_day: Column) -> tuple[Column, Column, Column]:
    """``HH:mm``, seconds and microseconds of a TIME value."""
    hours, minutes, seconds = (F.floor(ms_of_day / unit) for unit in (3_600_000, 60_000, 1_000))
    return (
        F.concat(_digits(hours, 2), F.lit(":"), _digits(minutes % 60, 2)),
        _digits(seconds % 60, 2),
        F.concat(_digits(ms_of_day % 1000, 3), F.lit("000")),
    )


def normal_part(value: Column, field: T.StructField) -> Column:
    """Text of one key part such that equal content means equal text."""
    kind = field.dataType
    if is_time(field):
        text = _iso_seconds(*_clock(value))
    elif isinstance(kind, T.BinaryType):
        text = F.base64(value)
    elif isinstance(kind, T.DecimalType):
        text = _plain_decimal(value)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = _iso_timestamp(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def key_normal_form(parts: Sequence[tuple[Column, T.StructField]]) -> Column:
    """All parts of a key as one text, each part ended by U+0001."""
    return F.concat(*[piece for value, field in parts for piece in (normal_part(value, field), F.lit(KEY_PART_END))])


def _string_part(value: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.BinaryType):
        return value
    if is_time(field):
        minutes, seconds, _ = _clock(value)
        return F.encode(F.concat(minutes, F.lit(":"), seconds), "UTF-8")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        text = F.regexp_replace(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"(\.\d+?)0+$", "$1")
        return F.encode(text, "UTF-8")
    return F.encode(value.cast("string"), "UTF-8")


def _typed_part(value: Column, field: T.StructField, legacy_micros: bool) -> Column:
    kind = field.dataType
    if isinstance(kind, T.BinaryType):
        return value
    if isinstance(kind, T.BooleanType):
        return F.when(value, F.unhex(F.lit("FF"))).when(~value, F.unhex(F.lit("00")))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return int_bytes(value)
    if isinstance(kind, T.LongType):
        return long_bytes(value)
    if isinstance(kind, T.FloatType):
        return float_bytes(value)
    if isinstance(kind, T.DoubleType):
        return double_bytes(value)
    if isinstance(kind, T.DecimalType):
        return decimal_bytes(value, kind)
    if isinstance(kind, T.DateType):
        return int_bytes(F.unix_date(value))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return long_bytes(_timestamp_number(value, field, legacy_micros))
    return F.encode(value.cast("string"), "UTF-8")


def _timestamp_number(value: Column, field: T.StructField, legacy_micros: bool) -> Column:
    micros = F.unix_micros(value.cast("timestamp"))
    precision = precision_of(field)
    if precision <= 3:
        return F.unix_millis(value.cast("timestamp"))
    if legacy_micros:
        return F.unix_millis(value.cast("timestamp")) * 1000
    return micros if precision <= 6 else micros * 1000


def rowkey(
    parts: Sequence[tuple[Column, T.StructField]],
    encoding: str = "string",
    delimiter: str = "|",
    legacy_micros: bool = False,
) -> Column:
    """Rowkey bytes of a key.

    ``string`` writes each part's text as UTF-8, ``typed`` big-endian bytes by declared type.
    Parts are joined by the delimiter's bytes, a NULL part is empty. With ``legacy_micros`` every
    typed timestamp finer than milliseconds is written as milliseconds x 1000.
    """
    if encoding not in ("string", "typed"):
        raise ValueError(f"rowkey encoding must be string or typed, got {encoding!r}")
    empty = F.unhex(F.lit(""))
    between = F.encode(F.lit(delimiter), "UTF-8")
    pieces: list[Column] = []
    for value, field in parts:
        part = _string_part(value, field) if encoding == "string" else _typed_part(value, field, legacy_micros)
        if pieces:
            pieces.append(between)
        pieces.append(F.coalesce(part, empty))
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)
