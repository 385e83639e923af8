"""A SQL dimension asked for any number of keys of any type, statement by statement.

Spark's own JDBC source reads ranges of a column, which text keys do not have: their order is the
store's affair. Here the distinct keys of a batch stay distributed. Every task holds a share of them
and one connection, and sends one prepared statement after the other with up to ``max_in_keys`` keys
bound as parameters. No key comes to the driver, and the store is never scanned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tandem.options import LookupOptions
from tandem.sources.jdbc import JdbcStore, quote_column, quote_table

FETCH_ROWS = 10_000
# How DB-API drivers spell the n-th parameter.
MARKS: dict[str, Callable[[int], str]] = {"qmark": lambda n: "?", "format": lambda n: "%s", "pyformat": lambda n: "%s", "numeric": lambda n: f":{n}"}


def key_statement(options: LookupOptions, columns: Sequence[str], keys: Sequence[str], count: int, paramstyle: str = "qmark") -> str:
    """The statement that asks for ``count`` keys: an IN list, or equalities of the parts of composite keys."""
    quoted = [quote_column(name, options.jdbc_url) for name in keys]
    mark = MARKS[paramstyle]
    if len(keys) == 1:
        where = f"{quoted[0]} IN ({', '.join(mark(n + 1) for n in range(count))})"
    else:
        parts = (" AND ".join(f"{q} = {mark(n * len(keys) + i + 1)}" for i, q in enumerate(quoted)) for n in range(count))
        where = " OR ".join(f"({part})" for part in parts)
    selected = ", ".join(quote_column(name, options.jdbc_url) for name in columns)
    return f"SELECT {selected} FROM {quote_table(options.jdbc_table, options.jdbc_url)} WHERE {where}"


class KeyedSqlStore(JdbcStore):
    """Loader of a SQL dimension that is asked for a batch's keys over connections of the tasks.

    ``held`` says what the store's columns are; ``connect`` opens a DB-API connection and runs in the
    tasks. At most ``options.jdbc_connections`` of them are open at a time. Asked for the whole table, it
    reads over JDBC as :class:`JdbcStore` does.
    """

    def __init__(self, options: LookupOptions, keys: Sequence[str], held: T.StructType, connect: Callable[[], Any], paramstyle: str = "qmark", **partitioning):
        super().__init__(options, keys, **partitioning)
        if paramstyle not in MARKS:
            raise ValueError(f"paramstyle must be one of {sorted(MARKS)}, got {paramstyle!r}")
        missing = [name for name in keys if name not in held.names]
        if missing:
            raise ValueError(f"the declared columns of the store lack key columns {missing}")
        self.held = held
        self.connect = connect
        self.paramstyle = paramstyle

    def for_keys(self, spark: SparkSession, keys_df: DataFrame) -> DataFrame:
        """The store's rows of ``keys_df``, which holds each key once. A key with a NULL part is not asked for."""
        wanted = keys_df.select(*self.keys).dropna()
        # A count of key rows is the only thing the driver learns.
        tasks = max(1, min(self.options.jdbc_connections, -(-wanted.count() // self.options.max_in_keys)))
        dealt = wanted.repartition(tasks, *[F.col(name) for name in self.keys])
        return dealt.mapInArrow(_asker(self.options, self.held, self.keys, self.connect, self.paramstyle), self.held)


def _asker(options: LookupOptions, held: T.StructType, keys: Sequence[str], connect: Callable[[], Any], paramstyle: str):
    schema = to_arrow_schema(held)
    size = options.max_in_keys

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (key for batch in batches for key in zip(*[batch.column(name).to_pylist() for name in keys]))
        connection = None
        try:
            # Without keys nothing is opened.
            while chunk := list(islice(rows, size)):
                if connection is None:
                    connection = connect()
                cursor = connection.cursor()
                try:
                    cursor.execute(key_statement(options, held.names, keys, len(chunk), paramstyle), [part for key in chunk for part in key])
                    while fetched := cursor.fetchmany(FETCH_ROWS):
                        columns = [pa.array(values, field.type) for values, field in zip(zip(*fetched), schema)]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)
                finally:
                    cursor.close()
        finally:
            if connection is not None:
                connection.close()

    return ask
