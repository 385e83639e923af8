"""Big-endian bytes of numbers and back.

Whole numbers, and decimals of up to 18 digits, stay in the JVM as hex text. Only IEEE floats and
wider decimals go through Arrow, since no built-in function yields their bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

JVM_DECIMAL_DIGITS = 18


# ------------------------------------------------------------------ encode


def long_bytes(value: Column) -> Column:
    """8 bytes, two's complement."""
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def int_bytes(value: Column) -> Column:
    """4 bytes, two's complement; the low half of the 8-byte form."""
    return F.unhex(F.right(F.lpad(F.hex(value.cast("bigint")), 16, "0"), F.lit(8)))


def _fixed_width(array: pa.Array, dtype: str) -> pa.Array:
    numbers = array.fill_null(0).to_numpy(zero_copy_only=False).astype(dtype)
    width = numbers.dtype.itemsize
    packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(numbers), [None, pa.py_buffer(numbers.tobytes())])
    return pa.compute.if_else(array.is_valid(), packed.cast(pa.binary()), pa.scalar(None, pa.binary()))


@F.arrow_udf(T.BinaryType())
def double_bytes(value: pa.Array) -> pa.Array:
    return _fixed_width(value, ">f8")


@F.arrow_udf(T.BinaryType())
def float_bytes(value: pa.Array) -> pa.Array:
    return _fixed_width(value, ">f4")


@F.arrow_udf(T.BinaryType())
def _wide_decimal_bytes(value: pa.Array) -> pa.Array:
    n = len(value)
    if n == 0:
        return pa.array([], pa.binary())
    # Arrow keeps a decimal as 16 little-endian bytes of its unscaled number.
    raw = np.frombuffer(value.buffers()[1], np.uint8, n * 16, value.offset * 16).reshape(n, 16)[:, ::-1]
    negative = raw[:, :1] >= 0x80
    padding = np.logical_and.accumulate(raw == np.where(negative, 0xFF, 0), axis=1).sum(axis=1)
    first = np.minimum(padding, 15)
    lead_negative = raw[np.arange(n), first] >= 0x80
    first -= (lead_negative != negative[:, 0]).astype(first.dtype)
    scale = np.frombuffer(value.type.scale.to_bytes(4, "big", signed=True), np.uint8)
    whole = np.concatenate([np.broadcast_to(scale, (n, 4)), raw], axis=1)
    kept = (np.arange(20) < 4) | (np.arange(20) - 4 >= first[:, None])
    ends = np.concatenate([[0], np.cumsum(20 - first)]).astype(np.int32)
    out = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(whole[kept].tobytes())])
    return pa.compute.if_else(value.is_valid(), out, pa.scalar(None, pa.binary()))


def decimal_bytes(value: Column, kind: T.DecimalType) -> Column:
    """4-byte scale, then the unscaled number in as few two's-complement bytes as hold it."""
    if kind.precision > JVM_DECIMAL_DIGITS:
        return _wide_decimal_bytes(value)
    unscaled = (value * F.lit(10**kind.scale).cast(f"decimal({kind.scale + 1},0)")).cast("bigint")
    hexed = F.lpad(F.hex(unscaled), 16, "0")
    minimal = F.regexp_replace(hexed, "^(?:(?:00)+(?=[0-7])|(?:FF)+(?=[89A-F]))", "")
    return F.unhex(F.concat(F.lit(f"{kind.scale:08X}"), minimal))


# ------------------------------------------------------------------ decode


def bytes_long(value: Column) -> Column:
    """8 bytes to a whole number."""
    return F.conv(F.hex(value), 16, -10).cast("bigint")


def bytes_int(value: Column) -> Column:
    """4 bytes to a whole number: unsigned first, then the sign bit is applied."""
    unsigned = F.conv(F.hex(value), 16, 10).cast("bigint")
    return F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned).cast("int")


def bytes_boolean(value: Column) -> Column:
    return F.hex(value) != "00"


def _from_fixed_width(array: pa.Array, dtype: str, out: pa.DataType) -> pa.Array:
    width = np.dtype(dtype).itemsize
    packed = array.fill_null(b"\0" * width).cast(pa.binary(width))
    size = len(packed)
    start = packed.offset * width
    raw = packed.buffers()[1].slice(start, size * width) if size else pa.py_buffer(b"")
    numbers = np.frombuffer(raw, dtype=dtype).astype(np.dtype(dtype).newbyteorder("="))
    return pa.array(numbers, out, mask=np.asarray(array.is_null()))


@F.arrow_udf(T.DoubleType())
def bytes_double(value: pa.Array) -> pa.Array:
    return _from_fixed_width(value, ">f8", pa.float64())


@F.arrow_udf(T.FloatType())
def bytes_float(value: pa.Array) -> pa.Array:
    return _from_fixed_width(value, ">f4", pa.float32())


@F.arrow_udf(T.DecimalType(38, 0))
def _wide_unscaled(value: pa.Array) -> pa.Array:
    filled = value.fill_null(b"\0")
    n = len(filled)
    if n == 0:
        return pa.array([], pa.decimal128(38, 0))
    ends = np.frombuffer(filled.buffers()[1], np.int32, n + 1, filled.offset * 4)
    data = np.frombuffer(filled.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    sizes = np.diff(ends)
    starts = ends[:-1] - ends[0]
    # Sign-extend every number to 16 bytes, then turn them into Arrow's byte order.
    out = np.repeat(np.where(data[starts] >= 0x80, 0xFF, 0).astype(np.uint8)[:, None], 16, axis=1)
    row = np.repeat(np.arange(n), sizes)
    out[row, 16 - sizes[row] + np.arange(len(data)) - starts[row]] = data
    little = np.ascontiguousarray(out[:, ::-1])
    numbers = pa.Array.from_buffers(pa.decimal128(38, 0), n, [None, pa.py_buffer(little.tobytes())])
    return pa.compute.if_else(value.is_valid(), numbers, pa.scalar(None, pa.decimal128(38, 0)))


def bytes_decimal(value: Column, kind: T.DecimalType) -> Column:
    """Scale and unscaled bytes to the declared decimal."""
    number = F.substring(value, 5, 2**31 - 1)
    if kind.precision > JVM_DECIMAL_DIGITS:
        unscaled = _wide_unscaled(number).cast("string")
    else:
        hexed = F.hex(number)
        fill = F.when(F.substring(hexed, 1, 1).rlike("[89A-F]"), F.lit("F")).otherwise(F.lit("0"))
        unscaled = F.conv(F.lpad(hexed, 16, fill), 16, -10)
    scale = bytes_int(F.substring(value, 1, 4))
    return F.concat(unscaled, F.lit("E"), (-scale).cast("string")).cast(kind)
