"""SQL-store dimension over JDBC (C3, C3b) and the client properties of the wide store."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.operators.lookup import probe
from tandem.options import LookupOptions

# Ranges a large set of keys is read in, for every connection the store allows.
RANGES_PER_CONNECTION = 4


def quote_table(name: str, url: str) -> str:
    """``db.table`` with each part quoted the way the store spells identifiers."""
    mark = "`" if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else '"'
    return ".".join(f"{mark}{part.strip(mark)}{mark}" for part in name.split("."))


def quote_column(name: str, url: str) -> str:
    mark = "`" if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else '"'
    return f"{mark}{name}{mark}"


def connect_properties(options: LookupOptions) -> dict[str, str]:
    """The connect time-out in the unit the store's driver reads it in; none for drivers unknown here."""
    if options.jdbc_url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        return {"connectTimeout": str(options.jdbc_connect_timeout_ms)}
    if options.jdbc_url.startswith("jdbc:postgresql:"):
        return {"connectTimeout": str(-(-options.jdbc_connect_timeout_ms // 1000))}
    return {}


def jdbc_read_options(options: LookupOptions, partition_column: str | None = None,
                      lower: str | None = None, upper: str | None = None) -> dict[str, str]:
    """Options of Spark's JDBC source.

    A blank driver is left out, so Spark infers it from the URL. The read is split over as many
    connections as the store allows when a partition column and its bounds are given.
    """
    read = {
        "url": options.jdbc_url,
        "dbtable": quote_table(options.jdbc_table, options.jdbc_url),
        "user": options.jdbc_user,
        "password": options.jdbc_password,
        "driver": options.jdbc_driver,
        "queryTimeout": str(options.jdbc_query_timeout_effective_s),
        "fetchsize": "10000",
        **connect_properties(options),
    }
    if partition_column:
        read.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(options.jdbc_connections),
        )
    return {key: value for key, value in read.items() if key != "driver" or value.strip()}


def jdbc_dim(options: LookupOptions, **partitioning) -> Callable[[SparkSession], DataFrame]:
    """Loader of the SQL store. Nothing is opened before the loader is called."""

    def load(spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**jdbc_read_options(options, **partitioning)).load()

    return load


def key_ranges(keys_df: DataFrame, key: str, column: str, count: int) -> list[str]:
    """Predicates that split the key's range into parts with about equally many wanted keys.

    Whole numbers and dates only, since their order is the same in every store; other types give
    none. What lies below the smallest or above the largest wanted key is in no part.
    """
    kind = keys_df.schema[key].dataType
    if not isinstance(kind, (T.IntegralType, T.DateType)):
        return []
    number = F.unix_date(key) if isinstance(kind, T.DateType) else F.col(key).cast("long")
    shares = [i / count for i in range(count + 1)]
    found = keys_df.select(number.alias("k")).agg(F.percentile_approx("k", shares).alias("cuts"), F.min("k").alias("low"), F.max("k").alias("high")).first()
    if found["low"] is None:
        return []
    # Cuts are approximate, the ends are not.
    cuts = [found["low"], *sorted({c for c in found["cuts"] if found["low"] < c < found["high"]}), found["high"] + 1]

    def literal(value: int) -> str:
        return str(value) if isinstance(kind, T.IntegralType) else f"DATE '{(date(1970, 1, 1) + timedelta(days=value)).isoformat()}'"

    return [f"{column} >= {literal(a)} AND {column} < {literal(b)}" for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


class JdbcStore:
    """Loader of a SQL dimension that can be asked for the keys of a batch.

    Up to ``options.max_in_keys`` keys go into one statement. More are read in ranges of the first
    key part, each a statement of its own, on as many connections as the store allows at a time.
    """

    def __init__(self, options: LookupOptions, keys: Sequence[str], **partitioning):
        self.options = options
        self.keys = list(keys)
        self.partitioning = partitioning

    def __call__(self, spark: SparkSession) -> DataFrame:
        return jdbc_dim(self.options, **self.partitioning)(spark)

    def predicates(self, keys_df: DataFrame) -> list[str]:
        """Ranges to read, none when the keys fit into one statement."""
        limit = self.options.max_in_keys
        if keys_df.select(*self.keys).limit(limit + 1).count() <= limit:
            return []
        column = quote_column(self.keys[0], self.options.jdbc_url)
        return key_ranges(keys_df, self.keys[0], column, self.options.jdbc_connections * RANGES_PER_CONNECTION)

    def for_keys(self, spark: SparkSession, keys_df: DataFrame) -> DataFrame:
        ranges = self.predicates(keys_df)
        if not ranges:
            raw = self(spark)
        else:
            read = jdbc_read_options(self.options)
            properties = {k: v for k, v in read.items() if k not in ("url", "dbtable")}
            raw = spark.read.jdbc(read["url"], read["dbtable"], predicates=ranges, properties=properties)
        return probe(raw, keys_df, self.keys, self.options.max_in_keys)


def wide_client_properties(options: LookupOptions) -> dict[str, str]:
    """Client properties of the wide-column store for whichever connector reads it.

    Pass-through properties come first, so an explicit option of the same name wins.
    """
    explicit = {
        "hbase.zookeeper.quorum": options.wide_quorum,
        "hbase.zookeeper.property.clientPort": options.wide_port,
        "zookeeper.znode.parent": options.wide_znode,
        "hbase.rpc.timeout": str(options.wide_rpc_timeout_ms),
        "hbase.client.operation.timeout": str(options.wide_operation_timeout_ms),
        "hbase.client.retries.number": str(options.wide_retries),
        "hbase.security.authentication": options.wide_authentication,
        "hbase.rpc.protection": options.wide_rpc_protection,
        "hbase.client.keytab.file": options.wide_keytab,
        "hbase.client.kerberos.principal": options.wide_principal,
        "hbase.regionserver.kerberos.principal": options.wide_region_principal,
        "hbase.master.kerberos.principal": options.wide_master_principal,
    }
    return {**options.wide_properties, **{key: value for key, value in explicit.items() if value}}
