"""Wide-column dimension from a table of cells.

A cells table has one row per stored cell: ``rowkey BINARY, family STRING, qualifier STRING,
value BINARY`` and, when versions are kept, ``ts``. Any connector or export that yields it will do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.functions import binary
from tandem.functions.conform import coerce, is_time
from tandem.functions.keys import rowkey
from tandem.operators.lookup import probe


def decode_cell(value: Column, field: T.StructField) -> Column:
    """Bytes to the declared type; an empty or absent cell is NULL."""
    value = F.when(F.length(value) > 0, value)
    kind = field.dataType
    if is_time(field):
        return binary.bytes_int(value)
    if isinstance(kind, T.BinaryType):
        return value
    if isinstance(kind, T.BooleanType):
        return binary.bytes_boolean(value)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return binary.bytes_int(value).cast(kind)
    if isinstance(kind, T.LongType):
        return binary.bytes_long(value)
    if isinstance(kind, T.FloatType):
        return binary.bytes_float(value)
    if isinstance(kind, T.DoubleType):
        return binary.bytes_double(value)
    if isinstance(kind, T.DecimalType):
        return binary.bytes_decimal(value, kind)
    if isinstance(kind, T.DateType):
        return coerce(binary.bytes_int(value), T.IntegerType(), field)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return coerce(binary.bytes_long(value), T.LongType(), field)
    return F.decode(value, "UTF-8")


def cells_dim(cells: DataFrame, schema: T.StructType, family: str = "info") -> DataFrame:
    """One typed row per rowkey: ``rowkey`` followed by the columns of ``schema``.

    Only the wanted qualifiers are read. With a ``ts`` column the newest version of a cell wins.
    The aggregation is partial before the shuffle, and no group is larger than one stored row.
    """
    wanted = cells.filter(
        (F.col("family") == family) & F.col("qualifier").isin([field.name for field in schema])
    )
    versioned = "ts" in cells.columns

    def pick(field: T.StructField) -> Column:
        own = F.when(F.col("qualifier") == field.name, F.col("value"))
        if versioned:
            return F.max_by(own, F.when(F.col("qualifier") == field.name, F.col("ts")))
        return F.max(own)

    wide = wanted.groupBy("rowkey").agg(*[pick(field).alias(field.name) for field in schema])
    return wide.select("rowkey", *[decode_cell(F.col(f.name), f).alias(f.name, metadata=dict(f.metadata or {})) for f in schema])


class WideStore:
    """Loader of a wide-column dimension that can be asked for single keys.

    ``cells`` returns the cells table. A full load reads key columns from their own qualifiers, as
    every other column. Asked for keys, it encodes them as rowkeys and reads only those rows: up to
    ``max_in_keys`` of them as a predicate that the scan evaluates, more as a semi join with the
    rowkeys, after ``max_ranges`` ranges of them that the scan evaluates. The ranges are cut so
    that they hold about equally many of the wanted rowkeys each.
    """

    def __init__(
        self,
        cells: Callable[[SparkSession], DataFrame],
        schema: T.StructType,
        keys: list[str],
        family: str = "info",
        encoding: str = "string",
        delimiter: str = "|",
        max_in_keys: int = 1_000,
        max_ranges: int = 64,
    ):
        self.max_ranges = max_ranges
        self.cells = cells
        self.schema = schema
        self.keys = keys
        self.family = family
        self.encoding = encoding
        self.delimiter = delimiter
        self.max_in_keys = max_in_keys

    def __call__(self, spark: SparkSession) -> DataFrame:
        return cells_dim(self.cells(spark), self.schema, self.family).drop("rowkey")

    def for_keys(self, spark: SparkSession, keys_df: DataFrame) -> DataFrame:
        parts = [(keys_df[name], self.schema[name]) for name in self.keys]
        wanted = keys_df.select(*self.keys, rowkey(parts, self.encoding, self.delimiter).alias("rowkey"))
        cells = self.cells(spark)
        if wanted.limit(self.max_in_keys + 1).count() > self.max_in_keys:
            cells = cells.filter(_within_ranges(rowkey_ranges(wanted, self.max_ranges)))
        asked = probe(cells, wanted, ["rowkey"], self.max_in_keys)
        return cells_dim(asked, self.schema, self.family).drop(*self.keys).join(wanted, "rowkey").drop("rowkey")


def rowkey_ranges(wanted: DataFrame, count: int) -> list[tuple]:
    """At most ``count`` ranges (lowest, highest) that hold every rowkey of ``wanted``; only they come to the driver."""
    dealt = wanted.select("rowkey").filter("rowkey IS NOT NULL").repartitionByRange(count, "rowkey")
    bounds = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min("rowkey").alias("low"), F.max("rowkey").alias("high"))
    return sorted((row.low, row.high) for row in bounds.collect())


def _within_ranges(ranges: list[tuple]) -> Column:
    """Whether a rowkey is in one of ``ranges``, as a balanced tree of conditions, which stays shallow."""
    if not ranges:
        return F.lit(False)
    if len(ranges) == 1:
        low, high = ranges[0]
        return F.col("rowkey").between(F.lit(low), F.lit(high))
    half = len(ranges) // 2
    return _within_ranges(ranges[:half]) | _within_ranges(ranges[half:])
