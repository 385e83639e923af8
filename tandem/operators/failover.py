"""Primary/standby lookup of a whole batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.functions.conform import coerce, conform, held_columns, is_time, source_column, split_bad_rows
from tandem.operators.lookup import Keys, distinct_keys, key_pairs, lookup_join, one_row_per_key, probe
from tandem.options import LookupOptions
from tandem.plans.log import LOG_SCHEMA
from tandem.session import delete_path, estimated_bytes, new_staging_path, row_bytes, run_with_deadline, stage, within

Loader = Callable[[SparkSession], DataFrame]

SOURCE_COLUMN = "lookup_source"
COST_COLUMN = "lookup_cost_ms"


class LookupFailed(RuntimeError):
    """Neither store could answer; the batch must not be padded with NULLs."""

    def __init__(self, attempts: "list[Attempt]", count: Callable[[int], list[int]]):
        self.attempts = attempts
        self._count = count
        super().__init__("; ".join(f"{a.source}: {a.error_class}: {a.error_message}" for a in attempts))

    @property
    def n_keys(self) -> int:
        """Queryable keys of the batch, counted when asked for."""
        return self._count(1)[0]

    def keys_by_subtask(self, subtasks: int) -> list[int]:
        """Queryable keys of each of ``subtasks`` buckets of keys."""
        return self._count(subtasks)


class FactsFailed(RuntimeError):
    """The facts themselves could not be read; no store is to blame."""


@dataclass
class Attempt:
    """One store asked for one batch."""

    source: str
    elapsed_ms: float = 0.0
    error_class: str | None = None
    error_message: str | None = None

    @property
    def ok(self) -> bool:
        return self.error_class is None


@dataclass
class LookupResult:
    """An enriched batch and what it took to get it.

    ``df`` reads the staged answer of one store, so evaluating it later or twice cannot mix stores
    or see a store go down. Call :meth:`close` once it has been written.
    """

    df: DataFrame
    source: str
    cost_ms: int
    attempts: list[Attempt]
    options: LookupOptions
    bad_rows: DataFrame | None = None
    _count: Callable[[int], list[tuple[int, int]]] = lambda buckets: [(0, 0)] * buckets
    _paths: list[str] = field(default_factory=list)
    _release: Callable[[], None] = lambda: None

    @property
    def failed_over(self) -> bool:
        return len(self.attempts) > 1

    def log_row(self, subtask: str = "1/1", batch_id: int = 0, ts: datetime | None = None) -> DataFrame:
        """The batch's row of the lookup log.

        Keys and hits are counted here, over the key columns only: a key counts once for every
        fact that carries it, and is one hit however many dimension rows it has.
        """
        return self._log({subtask: self._count(1)[0]}, batch_id, ts)

    def log_rows(self, subtasks: int, batch_id: int = 0, ts: datetime | None = None, label: str = "") -> DataFrame:
        """A row of the lookup log for each of ``subtasks`` buckets of keys, from one aggregation (S3).

        The batch has one route, so the rows differ in their keys and hits only, which add up to
        those of :meth:`log_row`.
        """
        return self._log(dict(zip(subtask_labels(subtasks, label), self._count(subtasks))), batch_id, ts)

    def _log(self, counts: Mapping[str, tuple[int, int]], batch_id: int, ts: datetime | None) -> DataFrame:
        return log_frame(self.df.sparkSession, self.options, self.attempts, counts, self.source, self.cost_ms, batch_id, ts)

    def close(self) -> None:
        self._release()
        for path in self._paths:
            delete_path(self.df.sparkSession, path)


def subtask_labels(subtasks: int, label: str = "") -> list[str]:
    """``1/n`` to ``n/n``, after ``label`` and a colon where there is one."""
    return [f"{label}:{i}/{subtasks}" if label else f"{i}/{subtasks}" for i in range(1, subtasks + 1)]


def log_frame(
    spark, options, attempts, counts: Mapping[str, tuple[int | None, int | None]], source, cost_ms, batch_id=0, ts=None
) -> DataFrame:
    """Rows of the lookup log of one batch, one for each subtask of ``counts`` (subtask -> keys, hits)."""
    first, second = attempts[0], attempts[1] if len(attempts) > 1 else None
    ts = ts or datetime.now(timezone.utc)
    rows = [
        (
            options.table_name,
            subtask,
            batch_id,
            ts,
            n_keys,
            options.primary,
            options.standby,
            first.elapsed_ms,
            first.error_class,
            first.error_message,
            hits if first.ok else None,
            not first.ok,
            second.elapsed_ms if second else None,
            second.error_class if second else None,
            hits if second and second.ok else None,
            source,
            cost_ms,
        )
        for subtask, (n_keys, hits) in counts.items()
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def error_of(error: BaseException) -> tuple[str, str]:
    """Class name and message of the root cause, the JVM's when the failure came from there."""
    origin = getattr(error, "_origin", None) or getattr(error, "java_exception", None)
    if origin is not None:
        while origin.getCause() is not None:
            origin = origin.getCause()
        return origin.getClass().getName(), origin.getMessage() or ""
    return type(error).__name__, str(error)


def split_schema(schema: T.StructType) -> tuple[T.StructType, dict[str, str]]:
    """Business columns, and the metadata columns as (lower-case name -> declared name)."""
    wanted = {SOURCE_COLUMN, COST_COLUMN}
    business = T.StructType([f for f in schema if f.name.lower() not in wanted])
    return business, {f.name.lower(): f.name for f in schema if f.name.lower() in wanted}


def stored_keys(raw: DataFrame, keys: list[str], schema: T.StructType) -> list[Column]:
    """A store's key columns in the declared types; untouched, and so pushable, when they already are."""
    names = [source_column(raw, name) for name in keys]
    kinds = [raw.schema[name].dataType for name in names]
    return [
        raw[name] if kind == schema[key].dataType else coerce(raw[name], kind, schema[key], strict=False)
        for key, name, kind in zip(keys, names, kinds)
    ]


def failover_lookup(
    facts: DataFrame,
    stores: Mapping[str, Loader],
    keys: Keys,
    schema: T.StructType,
    options: LookupOptions | None = None,
    *,
    how: str = "left",
    dim_unique: str = "all",
    on_bad_row: str = "fail",
    strategy: str = "auto",
    prefix: str = "",
    hint: str | None = None,
    salt: int = 0,
) -> LookupResult:
    """Enrich ``facts`` from the primary store, or from the standby when the primary fails or is late.

    ``stores`` maps the two names of ``options.stores`` to loaders. ``schema`` declares the
    dimension; declaring ``lookup_source`` or ``lookup_cost_ms`` in it adds those columns.

    One store answers the whole batch. Its answer is written to the shared staging folder inside
    the deadline, and the facts are joined with that copy. ``strategy`` says what is asked for:

    * ``"snapshot"``: the whole dimension, when its size is known to be small;
    * ``"keys"``: only the rows of keys that occur in the facts;
    * ``"auto"``: a snapshot up to ``options.snapshot_bytes``, otherwise by keys.

    Only an error or the deadline leads to the standby; a miss never does. When both stores fail
    :class:`LookupFailed` is raised.

    What the store holds is brought to the declared types after the route is decided, and only for
    keys that occur: a value that does not convert belongs to its key, whatever the strategy, and
    never sends the batch to the standby. ``on_bad_row="fail"`` raises when ``df`` is evaluated.
    """
    options = options or LookupOptions()
    spark = facts.sparkSession
    if set(stores) != set(options.stores):
        raise ValueError(f"loaders are needed for {options.stores}, got {sorted(stores)}")
    if on_bad_row not in ("fail", "null", "quarantine"):
        raise ValueError(f"on_bad_row must be fail, null or quarantine, got {on_bad_row!r}")
    if strategy not in ("auto", "snapshot", "keys"):
        raise ValueError(f"strategy must be auto, snapshot or keys, got {strategy!r}")
    pairs = key_pairs(keys)
    dim_keys = [name for _, name in pairs]
    business, metadata = split_schema(schema)
    paths: list[str] = []
    key_table: list[DataFrame] = []

    def keys_once() -> DataFrame:
        """The batch's keys, read from the facts once and shared by both attempts."""
        if not key_table:
            paths.append(new_staging_path(spark, "keys"))
            try:
                key_table.append(stage(distinct_keys(facts, keys, business), "keys", paths[-1]))
            except Exception as error:
                raise FactsFailed(f"keys of the facts could not be read: {error}") from error
        return key_table[0]

    def answer(raw: DataFrame, by_keys: bool) -> tuple[DataFrame, str]:
        """The store's rows as it holds them, with the key in its declared type. Staged."""
        typed = stored_keys(raw, dim_keys, business)
        if by_keys:
            raw = probe(raw, keys_once(), dim_keys, options.max_in_keys, typed)
        held = held_columns(raw, business, dict(zip(dim_keys, typed))).dropna(subset=dim_keys)
        path = new_staging_path(spark, "answer")
        paths.append(path)
        return stage(held, "answer", path), path

    def conformed(hits: DataFrame, by_keys: bool) -> tuple[DataFrame, DataFrame | None]:
        """Declared rows, one per key where asked for, and the rows put aside."""
        if on_bad_row != "quarantine" and dim_unique == "all":
            return converted_once(hits, business, dim_keys, on_bad_row), None
        asked = hits if by_keys else probe(hits, keys_once(), dim_keys)
        if on_bad_row == "quarantine":
            good, bad = split_bad_rows(asked, business)
        else:
            good, bad = conform(asked, business, on_bad_row), None
        return one_row_per_key(good, dim_keys, dim_unique), bad

    attempts: list[Attempt] = []
    for source in (options.primary, options.standby):
        attempt = Attempt(source)
        attempts.append(attempt)
        loader = stores[source]
        hits, release, by_keys = *(loader.lease() if hasattr(loader, "lease") else (None, lambda: None)), False
        if hits is None:
            try:
                raw, by_keys = _open(spark, loader, strategy, options, dim_keys, keys_once)
            except FactsFailed:
                raise
            except Exception as error:
                attempt.error_class, attempt.error_message = error_of(error)
                continue
            asked = by_keys and not hasattr(loader, "for_keys")
            timed = run_with_deadline(spark, lambda: answer(raw, asked), options.deadline_ms)
            attempt.elapsed_ms = timed.elapsed_ms
            if timed.error is not None:
                attempt.error_class, attempt.error_message = error_of(timed.error)
                continue
            hits, path = timed.result
            if hasattr(loader, "keep") and not by_keys:
                release = loader.keep(hits, path)
                paths.remove(path)
        cost_ms = int(sum(a.elapsed_ms for a in attempts))
        extra = {SOURCE_COLUMN: F.lit(source), COST_COLUMN: F.lit(cost_ms).cast("bigint")}
        declared, bad = conformed(hits, by_keys)
        answered = declared.withColumns({name: extra[lower] for lower, name in metadata.items()})
        noted = [BAD_COLUMN] if BAD_COLUMN in answered.columns else []
        ordered = answered.select(*[field.name for field in schema], *noted)
        # The answer lies in files by now, so its rows are measured and not estimated; files that are
        # too large compressed need no measuring.
        if hint is None and salt <= 1 and estimated_bytes(hits) <= options.broadcast_bytes and row_bytes(hits) <= options.broadcast_bytes:
            hint = "broadcast"
        enriched = raise_bad(lookup_join(facts, ordered, keys, how, hint=hint, prefix=prefix, salt=salt), business, dim_keys, prefix)

        def count(buckets: int) -> list[tuple[int, int]]:
            counted = key_table[0] if key_table else distinct_keys(facts, keys, business)
            return count_keys(counted, hits, dim_keys, buckets)

        return LookupResult(enriched, source, cost_ms, attempts, options, bad, count, paths, release)
    for path in paths:
        delete_path(spark, path)
    raise LookupFailed(attempts, lambda buckets: count_facts(distinct_keys(facts, keys, business), dim_keys, buckets))


BAD_COLUMN = "__tandem_bad"


def converted_once(held: DataFrame, schema: T.StructType, keys: list[str], on_bad_row: str) -> DataFrame:
    """Dimension rows in the declared types, a value that does not convert as NULL.

    With ``on_bad_row="fail"`` a row with such values also says what was wrong with which column, so that
    conversions run per dimension row and errors are raised per fact, see :func:`raise_bad`.
    """
    columns, errors = [], []
    for field in schema:
        kind = held.schema[field.name].dataType
        value = held[f"`{field.name}`"]
        if field.name in keys or kind == field.dataType and not is_time(field):
            columns.append(value)
            errors.append(F.lit(None).cast("string"))
            continue
        converted = coerce(value, kind, field, strict=False)
        columns.append(converted.alias(field.name, metadata=dict(field.metadata or {})))
        text = F.concat(F.lit(f"[CAST_INVALID_INPUT] column {field.name} of the dimension: "), value.cast("string"), F.lit(f" is no {field.dataType.simpleString()}"))
        errors.append(F.when(value.isNotNull() & converted.isNull(), text))
    if on_bad_row != "fail":
        return held.select(*columns)
    any_bad = F.coalesce(*errors).isNotNull()
    return held.select(*columns, F.when(any_bad, F.array(*errors)).alias(BAD_COLUMN))


def raise_bad(enriched: DataFrame, schema: T.StructType, keys: list[str], prefix: str) -> DataFrame:
    """Joined rows without their note of bad values; reading a value that did not convert raises."""
    note = prefix + BAD_COLUMN
    if note not in enriched.columns:
        return enriched
    checked = {}
    for at, field in enumerate(schema):
        if field.name not in keys:
            name = prefix + field.name
            error = F.get(enriched[f"`{note}`"], F.lit(at))
            checked[name] = F.when(error.isNotNull(), F.raise_error(error)).otherwise(enriched[f"`{name}`"]).alias(name, metadata=dict(field.metadata or {}))
    return enriched.select(*[checked.get(name, enriched[f"`{name}`"]) for name in enriched.columns if name != note])


def _open(spark, loader, strategy, options, dim_keys, keys_once) -> tuple[DataFrame, bool]:
    """Connect to a store and decide how to ask it; not part of the timed query, and bounded apart from it."""
    if hasattr(loader, "for_keys") and strategy != "snapshot":
        wanted = keys_once()
        raw, by_keys = within(spark, lambda: loader.for_keys(spark, wanted), options.connect_bound_ms), True
    else:
        raw = within(spark, lambda: loader(spark), options.connect_bound_ms)
        if not isinstance(raw, DataFrame):
            raise TypeError(f"loader returned {type(raw).__name__}, not a DataFrame")
        by_keys = strategy == "keys" or (strategy == "auto" and estimated_bytes(raw) > options.snapshot_bytes)
        if by_keys:
            keys_once()
    missing = [name for name in dim_keys if source_column(raw, name) is None]
    if missing:
        raise LookupError(f"store lacks key columns {missing}")
    return raw, by_keys


def _by_bucket(keys_df: DataFrame, keys: list[str], buckets: int, *measures: Column) -> list:
    """One aggregated row per bucket of keys, None where a bucket has no key. A key is always in the same bucket."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    rows = {row.bucket: row for row in keys_df.groupBy(bucket.alias("bucket")).agg(*measures).collect()}
    return [rows.get(i) for i in range(buckets)]


def count_facts(keys_df: DataFrame, keys: list[str], buckets: int = 1) -> list[int]:
    """Queryable keys of each bucket, weighted by their facts."""
    return [int(row.n_keys) if row else 0 for row in _by_bucket(keys_df, keys, buckets, F.sum("n").alias("n_keys"))]


def count_keys(keys_df: DataFrame, hits: DataFrame, keys: list[str], buckets: int = 1) -> list[tuple[int, int]]:
    """(queryable keys, keys with a dimension row) of each bucket, each key weighted by its facts.

    Both sides hold a key once, so neither hot facts nor a key with many rows is skewed here.
    """
    found = hits.select(*keys).distinct().withColumn("found", F.lit(True))
    measures = F.sum("n").alias("n_keys"), F.sum(F.when(F.col("found"), F.col("n"))).alias("hits")
    rows = _by_bucket(keys_df.join(found, keys, "left"), keys, buckets, *measures)
    return [(int(row.n_keys), int(row.hits or 0)) if row else (0, 0) for row in rows]
