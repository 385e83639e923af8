"""Ordered analytics over groups of any size: cutting, and greedy spacing.

Some measures run along a group in time order. A window function would put a whole group into one
task; a group may be a third of all rows. :func:`cut` therefore numbers pieces of over-long groups by
quantiles of their time, so that a piece is of bounded size whatever the group; other groups stay as
they are, and nothing is moved or written. Measures are computed per (group, piece) and corrected by
what the earlier pieces carry over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.session import stage

PIECE = "__piece"
PIECE_ROWS = 2_000_000


PIECES_PER_SLOT = 8
LEAST_PIECES = 64


@dataclass(frozen=True)
class Cut:
    """A log with a piece number: 0 in groups that are one piece, from 1 in those that are cut; ``whole`` when none is."""

    df: DataFrame
    whole: bool


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def cut(df: DataFrame, group: Sequence[str], order: Sequence[str], piece_rows: int = PIECE_ROWS) -> Cut:
    """Number the pieces of the groups of more than ``piece_rows`` rows, by quantiles of the first ``order`` column.

    Groups are counted first, which is one partial aggregation. Only of the long ones are bounds
    taken, from a sketch, and broadcast as they are few: at most a bound per ``piece_rows`` rows. The
    piece is a function of the row's time, so it is the same for every reader and the log is neither
    staged nor shuffled here. Rows of one time share a piece. There are at most ``PIECES_PER_SLOT``
    pieces for each task that can run at a time (at least ``LEAST_PIECES``); beyond that they grow.
    """
    spark = df.sparkSession
    sizes = stage(df.groupBy(*group).agg(F.count("*").alias("__rows")).filter(F.col("__rows") > piece_rows), "long-groups")
    largest = sizes.agg(F.max("__rows")).first()[0] or 0
    if not largest:
        return Cut(df.withColumn(PIECE, F.lit(0)), True)
    pieces = min(-(-largest // piece_rows), max(LEAST_PIECES, PIECES_PER_SLOT * spark.sparkContext.defaultParallelism))
    same = [df[name].eqNullSafe(F.col(f"__group{i}")) for i, name in enumerate(group)]
    keys = {name: f"__group{i}" for i, name in enumerate(group)}
    long_ = df.join(F.broadcast(sizes.withColumnsRenamed(keys)), reduce(and_, same)).select(*keys.values(), "__rows", micros(order[0]).alias("__us"))
    shares = [i / pieces for i in range(1, pieces)]
    bounds = long_.groupBy(*keys.values(), "__rows").agg(F.percentile_approx("__us", shares, max(10_000, 20 * pieces)).alias("all"))
    # A group shorter than the longest takes fewer of its bounds.
    need = F.least(F.ceil(F.col("__rows") / piece_rows), F.lit(pieces))
    taken = F.transform(F.sequence(F.lit(1).cast("long"), need - 1), lambda i: F.element_at("all", F.greatest(F.lit(1), F.floor(i * pieces / need)).cast("int")))
    bounds = stage(bounds.select(*keys.values(), F.array_sort(F.array_distinct(taken)).alias("__bounds")), "piece-bounds")
    stride = max(1, int(pieces**0.5))
    # Bounds below the row's time are counted in two steps: whole strides of them, then singly.
    us = micros(order[0])
    strides = F.size(F.filter(F.transform(F.sequence(F.lit(0), F.floor((F.size("__bounds") - 1) / stride).cast("int")), lambda i: F.element_at("__bounds", i * stride + 1)), lambda b: b < us))
    begin = F.greatest(strides - 1, F.lit(0)) * stride
    number = begin + F.size(F.filter(F.slice("__bounds", begin + 1, F.lit(stride)), lambda b: b < us)) + 1
    numbered = df.join(F.broadcast(bounds), reduce(and_, same), "left")
    return Cut(numbered.select(*df.columns, F.when(F.col("__bounds").isNull(), 0).otherwise(number).cast("int").alias(PIECE)), False)


# ------------------------------------------------------------------ greedy spacing


def spaced(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    ts: str,
    gap_ms: int,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Rows kept when each group may emit again only ``gap_ms`` after its last emission.

    The first row of a group is kept, then the first one at least ``gap_ms`` later, and so on.
    ``merged`` counts the rows passed over since the emission before. ``gap_ms = 0`` keeps all.

    Each task streams over its sorted rows and remembers one emission. For a group that spans
    pieces, what every piece receives from the pieces before it is worked out first, so the result
    is that of one pass over the whole group. ``df`` is staged, as it is read more than once.
    """
    if gap_ms <= 0:
        return df.withColumn("merged", F.lit(0).cast("bigint"))
    parts = cut(stage(df, "spaced"), group, order, piece_rows)
    if parts.whole:
        return _scan(_without_entry(parts.df), df.schema, group, order, ts, gap_ms)

    spanning = parts.df.filter(F.col(PIECE) > 0)
    spans = stage(spanning.groupBy(*group, PIECE).agg(F.count(F.lit(1)).alias("rows")), "spans")
    entries = _entries(_runs(spanning, group, ts, gap_ms), spans, group, gap_ms, piece_rows)
    return _scan(_with_entry(parts.df, entries, group), df.schema, group, order, ts, gap_ms)


def _runs(spanning: DataFrame, group: Sequence[str], ts: str, gap_ms: int) -> DataFrame:
    """What each piece does with every emission it may receive.

    The emission before a piece is less than a gap away or does not matter, so the first emission
    inside is one of the rows of the piece's first gap. For each of those the pass through the
    piece is followed to its last emission. First emissions that end in the same last one are
    merged, which leaves few rows when a piece is long against the gap.
    """
    keys = [*group, PIECE]
    gap = gap_ms * 1000
    narrow = spanning.select(*keys, micros(ts).alias("__us"))
    out = T.StructType([spanning.schema[name] for name in keys])
    for name in ("rows", "start", "exit", "exit_row"):
        out = out.add(name, T.LongType())

    def follow(key: tuple, piece: pa.Table) -> pa.Table:
        times = np.sort(piece.column("__us").to_numpy())
        first = int(np.searchsorted(times, times[0] + gap))
        starts = np.unique(times[: first + 1])
        at = np.searchsorted(times, starts)
        while True:
            following = np.searchsorted(times, times[at] + gap)
            inside = following < len(times)
            if not inside.any():
                break
            at = np.where(inside, following, at)
        ends = np.append(at[1:] != at[:-1], True)
        columns = [pa.array([value.as_py()] * int(ends.sum()), field.type) for value, field in zip(key, piece.select(keys).schema)]
        columns.append(pa.array(np.full(int(ends.sum()), len(times)), pa.int64()))
        columns += [pa.array(values[ends], pa.int64()) for values in (starts, times[at], at + 1)]
        return pa.Table.from_arrays(columns, names=out.names)

    return narrow.groupBy(*keys).applyInArrow(follow, out)


def _entries(runs: DataFrame, spans: DataFrame, group: Sequence[str], gap_ms: int, piece_rows: int) -> DataFrame:
    """What each piece of a group receives from the pieces before it.

    A run of a piece leads to the run of a later piece that begins first a gap after it ends. These steps
    are composed with themselves, so that they lead over 1, 2, 4 … pieces, and the runs really
    passed are reached by doubling from the first run of each group: in rounds of the logarithm of the
    number of pieces, each an equi-join of runs.
    """
    runs = stage(runs.withColumn("run", F.monotonically_increasing_id()), "runs")
    steps = stage(_following(runs, group, gap_ms, piece_rows), "steps")
    first = F.min(F.struct(PIECE, "start", "run"))
    passed = runs.groupBy(*group).agg(first.alias("first")).select(F.col("first.run").alias("run"))
    most = spans.groupBy(*group).count().agg(F.max("count")).first()[0] or 1
    for k in range((most - 1).bit_length()):
        ahead = passed.join(steps, "run").select(F.col("following").alias("run"))
        passed = stage(passed.union(ahead), "passed")
        if (2 << k) < most:
            second = steps.select(F.col("run").alias("following"), F.col("following").alias("then"))
            steps = stage(steps.join(second, "following").select("run", F.col("then").alias("following")), "steps")
    left = runs.join(passed, "run").select(*group, PIECE, F.col("exit").alias("exit_last"), "exit_row")
    exits = spans.join(left, [*group, PIECE], "left").withColumn("exit_since", F.col("rows") - F.col("exit_row"))
    return stage(_entries_from_exits(exits, group), "entries")


def _following(runs: DataFrame, group: Sequence[str], gap_ms: int, piece_rows: int) -> DataFrame:
    """run, following: the first run of the group that begins a gap after the end of ``run`` or later, if there is one.

    Beginnings and ends are sorted together over all tasks; what a task does not find among its own rows is
    the first beginning that later tasks hold of the group.
    """
    nothing = F.lit(None).cast("long")
    begins = runs.select(*group, F.col("start").alias("at"), F.lit(1).alias("kind"), PIECE, F.col("run").alias("begins"), nothing.alias("ends"))
    ends = runs.select(*group, (F.col("exit") + gap_ms * 1000).alias("at"), F.lit(0).alias("kind"), PIECE, nothing.alias("begins"), F.col("run").alias("ends"))
    both = begins.union(ends)
    order = ["at", "kind", PIECE]
    tasks = -(-2 * runs.count() // piece_rows)
    ranged = stage(both.repartitionByRange(max(1, tasks), *group, *order).withColumn("__task", F.spark_partition_id()), "run-ends")
    onward = W.partitionBy(*group, "__task").orderBy(*order).rowsBetween(0, W.unboundedFollowing)
    heads = ranged.groupBy(*group, "__task").agg(F.min(F.when(F.col("kind") == 1, F.struct("at", PIECE, "begins"))).alias("head"))
    later = W.partitionBy(*group).orderBy("__task").rowsBetween(1, W.unboundedFollowing)
    heads = heads.select(*group, "__task", F.first("head.begins", ignorenulls=True).over(later).alias("later"))
    found = ranged.withColumn("near", F.first("begins", ignorenulls=True).over(onward)).filter("kind = 0").join(heads, [*group, "__task"])
    following = F.coalesce("near", "later")
    return found.filter(following.isNotNull()).select(F.col("ends").alias("run"), following.alias("following"))


_ENTRY = T.StructType(
    [T.StructField("__last", T.LongType()), T.StructField("__since", T.LongType())]
)


def _without_entry(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in _ENTRY})


def _with_entry(df: DataFrame, entries: DataFrame | None, group: Sequence[str]) -> DataFrame:
    """Add what the earlier pieces hand over: time of the last emission, rows passed over since."""
    if entries is None:
        return _without_entry(df)
    return df.join(entries, [*group, PIECE], "left")


def _entries_from_exits(exits: DataFrame, group: Sequence[str]) -> DataFrame:
    """What each piece of a group receives: the last emission before it, and the rows since.

    There is one row per piece here, so the window is as small as the number of pieces.
    """
    before = W.partitionBy(*group).orderBy(PIECE).rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy(*group).orderBy(PIECE).rowsBetween(W.unboundedPreceding, 0)
    marked = exits.withColumn("seen", F.sum("rows").over(upto))
    # Rows passed over since the last emission = rows seen so far - position of that emission.
    at = F.when(F.col("exit_last").isNotNull(), F.col("seen") - F.col("exit_since"))
    return marked.withColumn("at", at).select(
        *group,
        PIECE,
        F.last("exit_last", ignorenulls=True).over(before).alias("__last"),
        (F.sum("rows").over(before) - F.last("at", ignorenulls=True).over(before)).alias("__since"),
    )


def _scan(df, schema, group, order, ts, gap_ms) -> DataFrame:
    """Keep the emitted rows of every (group, piece), in one pass over sorted partitions."""
    keys = [*group, PIECE]
    ready = (
        df.withColumn("__us", micros(ts))
        .repartition(*keys)
        .sortWithinPartitions(*keys, *order)
        .select(*schema.names, PIECE, *_ENTRY.names, "__us")
    )
    out = T.StructType([*schema.fields, T.StructField("merged", T.LongType())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Spacing(keys, gap_ms * 1000)
        for batch in batches:
            kept, merged = state.advance(batch)
            taken = batch.take(pa.array(kept, pa.int64()))
            columns = [taken.column(name) for name in schema.names] + [pa.array(merged, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return ready.mapInArrow(emit, out)


class _Spacing:
    """Position of the greedy pass within one task: the current group and its last emission."""

    def __init__(self, keys: Sequence[str], gap_us: int):
        self.keys = keys
        self.gap = gap_us
        self.key = None
        self.last = None
        self.since = 0

    def advance(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Emitted rows of a sorted batch: row number, rows merged into it."""
        if batch.num_rows == 0:
            return (np.zeros(0, np.int64),) * 2
        us = batch.column("__us").to_numpy(zero_copy_only=False)
        starts = self._group_starts(batch)
        ends = np.append(starts[1:], batch.num_rows)
        # A group that lies within the batch and within one gap emits its first row and no other.
        short = us[ends - 1] - us[starts] < self.gap
        short &= batch.column("__last").is_null().to_numpy(zero_copy_only=False)[starts]
        short[0] = short[-1] = False
        found = [np.stack([starts[short], np.zeros_like(starts[short])])]

        heads = batch.take(pa.array(starts[~short]))
        keys = zip(*[heads.column(name).to_pylist() for name in self.keys])
        entries = zip(heads.column("__last").to_pylist(), heads.column("__since").to_pylist())
        for begin, end, key, (last, since) in zip(starts[~short], ends[~short], keys, entries):
            if key != self.key:
                self.key, self.last, self.since = key, last, since or 0
            found.append(self._pass(us[begin:end]) + [[begin], [0]])
        kept, merged = np.concatenate(found, axis=1)
        in_order = np.argsort(kept)
        return kept[in_order], merged[in_order]

    def _pass(self, times: np.ndarray) -> np.ndarray:
        """Emissions within the rows of one group: offset, merged."""
        emitted, at, passed = [], 0, -1
        if self.last is not None:
            at = int(np.searchsorted(times, self.last + self.gap))
        while at < len(times):
            emitted.append((at, self.since + at - passed - 1))
            self.last, self.since, passed = int(times[at]), 0, at
            at = int(np.searchsorted(times, self.last + self.gap))
        self.since += len(times) - passed - 1
        return np.array(emitted, np.int64).reshape(-1, 2).T

    def _group_starts(self, batch: pa.RecordBatch) -> np.ndarray:
        """Row numbers at which a group begins within the batch."""
        changed = np.zeros(batch.num_rows, dtype=bool)
        changed[0] = True
        for name in self.keys:
            codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            changed[1:] |= codes[1:] != codes[:-1]
        return np.flatnonzero(changed)
