"""Keyed lookup join and the batched key probe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.functions.conform import source_column
from tandem.session import broadcast_limit, estimated_bytes

Keys = Sequence[str] | Mapping[str, str]

# Keyless facts go to up to this many places.
NULL_SPREAD = 16_384

# A broadcast hint is followed up to this estimated size; beyond it the join shuffles.
BROADCAST_HINT_BYTES = 512 * 1024 * 1024

# Types that narrow when one is cast to another.
_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)

# Hints under which the sides are shuffled, whatever their size.
_SHUFFLING = ("merge", "shuffle_hash", "shuffle_merge", "mergejoin", "shuffle_replicate_nl")


def key_pairs(keys: Keys) -> list[tuple[str, str]]:
    """(fact column, dimension column) for every part of the key."""
    pairs = list(keys.items()) if isinstance(keys, Mapping) else [(name, name) for name in keys]
    if not pairs:
        raise ValueError("a lookup needs at least one key column")
    nested = [name for pair in pairs for name in pair if "." in name]
    if nested:
        raise ValueError(f"key columns must be top-level columns, got {nested}")
    return pairs


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def _typed_key(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """A fact's key in the dimension's type; a value that does not convert without loss can match nothing."""
    value, source = df[name], df.schema[name].dataType
    if source == kind:
        return value
    typed = value.try_cast(kind)
    if isinstance(source, _ORDERED) and isinstance(kind, _ORDERED):
        return F.when(typed.try_cast(source) == value, typed)
    return typed


def one_row_per_key(dim: DataFrame, keys: Sequence[str], dim_unique: str) -> DataFrame:
    """``"all"`` keeps every row, ``"first"`` the smallest row of a key, ``"error"`` raises on a second one.

    Both reductions aggregate before the shuffle, so a key with very many rows is harmless.
    """
    if dim_unique == "all":
        return dim
    if dim_unique not in ("first", "error"):
        raise ValueError(f"dim_unique must be all, first or error, got {dim_unique!r}")
    rest = [name for name in dim.columns if name not in keys]
    kept = F.min(F.struct(*rest)).alias("row") if rest else F.lit(None).alias("row")
    grouped = dim.groupBy(*keys).agg(kept, F.count(F.lit(1)).alias("copies"))
    if dim_unique == "error":
        text = F.concat(F.lit("more than one dimension row for key "), F.to_json(F.struct(*keys)))
        grouped = grouped.filter(F.when(F.col("copies") > 1, F.raise_error(text).cast("boolean")).otherwise(True))
    return grouped.select(*[F.col(n) if n in keys else F.col(f"row.{n}").alias(n) for n in dim.columns])


def _spread(facts: DataFrame, spread_by: Sequence[str] | None) -> Column:
    """A number that differs between facts of one key and is the same when a task is run again.

    Without columns to go by it is the number of the input partition, which reads no column.
    """
    return F.xxhash64(*spread_by) if spread_by else F.spark_partition_id()


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Keys,
    how: str = "left",
    *,
    dim_unique: str = "all",
    hint: str | None = None,
    prefix: str = "",
    salt: int = 0,
    spread_nulls: bool = True,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join each fact with the dimension rows of its key: fact columns, then dimension columns.

    A NULL in any key part is a miss. ``how`` is ``"left"`` (a miss gives NULL columns) or
    ``"inner"`` (a miss drops the fact). ``prefix`` goes before the dimension's column names.

    The join strategy is Catalyst's: broadcast for a small dimension, otherwise a shuffle join
    whose hot keys AQE splits. ``salt=n`` splits every key over n tasks by itself, at the price of
    n copies of the dimension. In a shuffled left join, facts without a key are spread over the
    tasks and do not meet in one of them; ``spread_nulls=False`` keeps the plain key for a
    dimension that is bucketed by it. Both spread by input partition, or by the values of
    ``spread_by``, which lets later filters through to the scan.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, got {how!r}")
    pairs = key_pairs(keys)
    dim_keys = [dim_name for _, dim_name in pairs]
    missing = [name for name in dim_keys if name not in dim.columns]
    if missing:
        raise ValueError(f"dimension lacks key columns {missing}")
    dim = one_row_per_key(dim, dim_keys, dim_unique)
    values = [name for name in dim.columns if name not in dim_keys]
    names = [prefix + name for name in values]
    clash = sorted({n.lower() for n in names} & {n.lower() for n in facts.columns})
    if clash:
        raise ValueError(f"dimension columns {clash} also exist in the facts; give a prefix")

    right = dim.select(
        *[F.col(name).alias(f"__key{i}") for i, name in enumerate(dim_keys)],
        *[F.col(name).alias(out) for name, out in zip(values, names)],
    )
    probe = [_typed_key(facts, fact, dim.schema[name].dataType) for fact, name in pairs]
    left = facts.withColumns({f"__probe{i}": value for i, value in enumerate(probe)})
    on = [f"__probe{i} = __key{i}" for i in range(len(pairs))]

    size = estimated_bytes(right)
    if hint == "broadcast" and size > BROADCAST_HINT_BYTES:
        hint = None
    if salt > 1:
        left = left.withColumn("__salt", F.pmod(_spread(facts, spread_by), F.lit(salt)).cast("int"))
        right = right.withColumn("__slot", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        on.append("__salt = __slot")
    elif spread_nulls and how == "left" and hint != "broadcast" and (
        (hint or "").lower() in _SHUFFLING or size > broadcast_limit(dim.sparkSession)
    ):
        keyless = _any([value.isNull() for value in probe])
        spread = F.when(keyless, F.pmod(_spread(facts, spread_by), F.lit(NULL_SPREAD)).cast("int")).otherwise(0)
        left = left.withColumn("__salt", spread)
        # Always 0, but not a literal: the optimizer would turn that into a filter and the join
        # would again shuffle on the key alone.
        right = right.withColumn("__slot", F.pmod(F.xxhash64("__key0"), F.lit(1)).cast("int"))
        on.append("__salt = __slot")
    if hint:
        right = right.hint(hint)
    joined = left.join(right, F.expr(" AND ".join(on)), how)
    return joined.select(*[joined[name] for name in facts.columns], *[joined[name] for name in names])


def distinct_keys(facts: DataFrame, keys: Keys, schema: T.StructType) -> DataFrame:
    """Each queryable key once, under its dimension name, with the number ``n`` of facts that carry it.

    A key is queryable when its first part is not NULL. Counting happens before the shuffle.
    """
    pairs = key_pairs(keys)
    typed = facts.select(
        *[_typed_key(facts, fact, schema[dim_name].dataType).alias(dim_name) for fact, dim_name in pairs]
    )
    names = [dim_name for _, dim_name in pairs]
    return typed.filter(F.col(names[0]).isNotNull()).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def in_predicate(rows: Sequence[Sequence], columns: Sequence[Column]) -> Column:
    """``key IN (...)``, or an OR of ANDed equalities for a key of several parts; sources push both."""
    if len(columns) == 1:
        return columns[0].isin([row[0] for row in rows])
    return _any([_all([column == value for column, value in zip(columns, row)]) for row in rows])


def probe(
    dim: DataFrame,
    keys_df: DataFrame,
    keys: Sequence[str],
    max_in_keys: int = 0,
    columns: Sequence[Column] | None = None,
) -> DataFrame:
    """Rows of ``dim`` whose key is in ``keys_df``; each key is asked for once.

    ``columns`` are the key's parts as expressions over ``dim``, by default its columns.

    Up to ``max_in_keys`` keys go into a predicate that the store evaluates itself. More than that
    never come to the driver: a semi join does the work. No key at all asks the store for nothing.
    """
    columns = columns or [dim[source_column(dim, name)] for name in keys]
    if max_in_keys > 0:
        rows = keys_df.select(*keys).limit(max_in_keys + 1).collect()
        if not rows:
            return dim.filter(F.lit(False))
        whole = [row for row in rows if all(part is not None for part in row)]
        if len(rows) <= max_in_keys:
            return dim.filter(in_predicate(whole, columns)) if whole else dim.filter(F.lit(False))
    wanted = keys_df.select(*[F.col(name).alias(f"__want{i}") for i, name in enumerate(keys)])
    return dim.join(wanted, _all([column == wanted[f"__want{i}"] for i, column in enumerate(columns)]), "left_semi")
