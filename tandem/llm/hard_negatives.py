"""Hard-negative mining with Kronecker-packed inner products.

Vectors become integers. Components of a signed vector are made non-negative by a bias, and the same
component of several candidates is put side by side into the *fields* of one wide integer. Multiplying
it by the anchor's biased component multiplies all of its candidates at once; summed over the components,
each field holds the biased inner product of one candidate, since fields are as wide as the largest
possible sum. Taking the biases off gives the exact scores. As long as all fields of a word stay below
2**53, words are doubles, which multiply exactly and let the products be one matrix product; vectors with larger components
take Python integers of any width.

Anchors are a stated query set, scored against all rows in blocks: a pass holds a bounded number of
anchors, which go to all tasks. Each task streams over its candidates and keeps, for every anchor, the
best rows so far, so memory is bounded by the pass. A first scan finds the positives, a second the
negatives within each positive's window of scores. Only the best rows of a task are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.session import stage, stage_result

ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LEAST_PERCENT = 80
SCALE = 256
PASS_ANCHORS = 8_192
ANCHOR_ROWS = 256
BLOCK_ROWS = 2_048

_WORD_BITS = 53
_FIELDS_OF_INTEGERS = 64
_NONE = -(2**63)


# ------------------------------------------------------------------ packed products


@dataclass(frozen=True)
class Packing:
    """How wide a field must be for vectors of ``dims`` components between ``low`` and ``high``."""

    dims: int
    low: int
    high: int

    @property
    def bias(self) -> int:
        return max(0, -self.low)

    @property
    def bits(self) -> int:
        return max(1, (max(1, self.dims) * (self.high + self.bias) ** 2).bit_length())

    @property
    def exact_doubles(self) -> bool:
        return self.bits <= _WORD_BITS

    @property
    def fields(self) -> int:
        return _WORD_BITS // self.bits if self.exact_doubles else _FIELDS_OF_INTEGERS

    def biased(self, rows: np.ndarray) -> np.ndarray:
        return (rows + self.bias).astype(np.float64) if self.exact_doubles else rows.astype(object) + self.bias

    def packed(self, rows: np.ndarray) -> np.ndarray:
        """Words of ``fields`` rows each; (dims, words)."""
        words = -(-len(rows) // self.fields)
        padded = self.biased(np.concatenate([rows, np.zeros((words * self.fields - len(rows), rows.shape[1]), rows.dtype)]))
        shifts = [2 ** (self.bits * k) for k in range(self.fields)]
        scale = np.array(shifts, np.float64 if self.exact_doubles else object)
        # Row w * fields + k is field k of word w.
        return (padded.reshape(words, self.fields, -1) * scale[None, :, None]).sum(axis=1).T

    def scores(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products (anchors, rows) as 64-bit integers; OverflowError if one does not fit."""
        if not len(anchors) or not len(rows):
            return np.zeros((len(anchors), len(rows)), np.int64)
        product = self.biased(anchors) @ self.packed(rows)
        if self.exact_doubles:
            word, mask = product.astype(np.int64), (1 << self.bits) - 1
            fields = np.stack([(word >> (self.bits * k)) & mask for k in range(self.fields)], axis=2)
            a, r = anchors.astype(np.int64), rows.astype(np.int64)
        else:
            mask = (1 << self.bits) - 1
            fields = np.stack([(product >> (self.bits * k)) & mask for k in range(self.fields)], axis=2)
            a, r = anchors.astype(object), rows.astype(object)
        sums = fields.reshape(len(anchors), -1)[:, : len(rows)]
        off = self.bias * (a.sum(axis=1)[:, None] + r.sum(axis=1)[None, :]) + anchors.shape[1] * self.bias**2
        exact = sums - off
        if exact.dtype == object:
            if max(abs(int(exact.max())), abs(int(exact.min()))) >= 2**63:
                raise OverflowError("an inner product does not fit 64 bits")
            exact = exact.astype(np.int64)
        return exact


def best(scores: np.ndarray, take: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, column) of the ``count`` highest scores of each row where ``take`` holds, earlier columns first."""
    width = scores.shape[1]
    masked = np.where(take, scores, _NONE)
    if width > count:
        # The count-th best score of a row; of those equal to it, the first columns are taken.
        bar = np.partition(masked, width - count, axis=1)[:, width - count][:, None]
        above, level = masked > bar, masked == bar
        room = count - above.sum(axis=1, keepdims=True)
        masked_in = above | (level & (np.cumsum(level, axis=1) <= room))
    else:
        masked_in = np.ones_like(take)
    return np.nonzero(masked_in & take)


# ------------------------------------------------------------------ rows


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, x (whole numbers as doubles) of the rows that take part. Staged.

    Rows with a NULL id, label or vector, or any NULL or non-finite component, take no part. Rows that share an id are
    one row, the smallest by label and components. Where vec_id is divisible by 7, the label moves on by one modulo 10.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = embeddings.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(finite)
    label = F.col("label").cast("long")
    # SQL's floor is a LONG; rounding through the remainder stays a double whatever its size.
    scaled = F.transform(x, lambda v: v * F.lit(float(SCALE)))
    floor = F.transform(scaled, lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v))
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.struct(F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), floor.alias("x")).alias("row"),
    )
    return stage(rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.x"), "vectors")


def _matrix(column: pa.Array, packing: Packing) -> np.ndarray:
    """Rows of ``dims`` components; those a shorter vector lacks are 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), packing.dims))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    if packing.exact_doubles:
        return out.astype(np.int64)
    return np.array([[int(v) for v in r] for r in out], object).reshape(out.shape)


class _Best:
    """The best rows so far of every slot, in order."""

    def __init__(self, slots: int, count: int) -> None:
        self.count = count
        self.scores = np.full((slots, count), _NONE, np.int64)
        self.ids = np.full((slots, count), np.iinfo(np.int64).max, np.int64)
        self.filled = np.zeros((slots, count), bool)

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, take: np.ndarray) -> None:
        """``scores`` and ``take`` have a row per slot; ``ids`` one entry per column, ascending."""
        hopeful = take & ((scores > self.scores[slots, -1:]) | (scores == self.scores[slots, -1:]) & (ids[None, :] < self.ids[slots, -1:]) | ~self.filled[slots, -1:])
        some = hopeful.any(axis=1)
        if not some.any():
            return
        slots, scores, hopeful = slots[some], scores[some], hopeful[some]
        at, column = best(scores, hopeful, self.count)
        touched = np.unique(at)
        rows = np.concatenate([np.repeat(touched, self.count), at])
        merged_scores = np.concatenate([self.scores[slots[touched]].ravel(), scores[at, column]])
        merged_ids = np.concatenate([self.ids[slots[touched]].ravel(), ids[column]])
        merged_filled = np.concatenate([self.filled[slots[touched]].ravel(), np.ones(len(at), bool)])
        order = np.lexsort((merged_ids, -1 - merged_scores, ~merged_filled, rows))
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = rank < self.count
        where, order, rank = slots[rows[keep]], order[keep], rank[keep]
        self.scores[where, rank], self.ids[where, rank], self.filled[where, rank] = merged_scores[order], merged_ids[order], merged_filled[order]

    def batch(self, names: list[str]) -> pa.RecordBatch:
        slot, rank = np.nonzero(self.filled)
        return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(self.ids[slot, rank]), pa.array(self.scores[slot, rank])], names)


def _blocks(batches: Iterator[pa.RecordBatch], packing: Packing) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """vec_id, label and components of at most ``BLOCK_ROWS`` candidates, ascending by vec_id."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            ids, labels = (part.column(c).to_numpy() for c in ("vec_id", "label"))
            order = np.argsort(ids, kind="stable")
            yield ids[order], labels[order], _matrix(part.column("x"), packing)[order]


def _positives(held, packing: Packing, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_ids, anchor_labels, anchors = held.value
        top = _Best(len(anchor_ids), count)
        for ids, labels, rows in _blocks(batches, packing):
            for at in range(0, len(anchor_ids), ANCHOR_ROWS):
                slots = np.arange(at, min(at + ANCHOR_ROWS, len(anchor_ids)))
                same = (anchor_labels[slots][:, None] == labels[None, :]) & (anchor_ids[slots][:, None] != ids[None, :])
                if same.any():
                    top.add(slots, packing.scores(anchors[slots], rows), ids, same)
        yield top.batch(["slot", "vec_id", "score"])

    return run


def _negatives(held, packing: Packing, count: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, anchor_labels, anchors, owner, bars = held.value
        # Slots here are (anchor, positive) pairs, in order of the anchor; 100 * n >= percent * p over integers.
        least = np.array([-((-percent * int(p)) // 100) for p in bars], np.int64)
        top = _Best(len(owner), count)
        for ids, labels, rows in _blocks(batches, packing):
            for at in range(0, len(anchors), ANCHOR_ROWS):
                to = min(at + ANCHOR_ROWS, len(anchors))
                slots = np.arange(np.searchsorted(owner, at), np.searchsorted(owner, to))
                if not len(slots):
                    continue
                scores = packing.scores(anchors[at:to], rows)
                other = anchor_labels[at:to][:, None] != labels[None, :]
                for part in np.array_split(slots, -(-len(slots) // ANCHOR_ROWS)):
                    mine = scores[owner[part] - at]
                    window = other[owner[part] - at] & (mine <= bars[part][:, None]) & (mine >= least[part][:, None])
                    if window.any():
                        top.add(part, mine, ids, window)
        yield top.batch(["slot", "vec_id", "score"])

    return run


def mine_negatives(
    embeddings: DataFrame,
    anchor_every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    pass_anchors: int = PASS_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``embeddings`` (vec_id, embedding, label).

    Anchors are the rows whose vec_id is divisible by ``anchor_every``. Scores are inner products of whole numbers,
    ``floor(256 * x)`` of each component; higher ones come first, ties by smaller vec_id. An anchor's positives are its
    first ``positives`` other rows of its label. For each, the first ``negatives`` rows of other labels with
    ``least_percent * positive <= 100 * negative <= 100 * positive`` are returned. :func:`quantised` says which rows take
    part. Components that the shorter of two vectors lacks are 0. A product beyond 64 bits is an OverflowError. Other
    columns are ignored; a table without anchors has no rows in the result.
    """
    spark = embeddings.sparkSession

    def build() -> DataFrame:
        rows = quantised(embeddings)
        ends = rows.agg(
            F.max(F.size("x")).alias("dims"), F.min(F.array_min("x")).alias("low"), F.max(F.array_max("x")).alias("high"),
            F.count(F.when(F.col("vec_id") % anchor_every == 0, 1)).alias("anchors"),
        ).first()
        packing = Packing(ends["dims"] or 0, int(min(ends["low"] or 0, 0)), int(max(ends["high"] or 0, 0)))
        passes = max(1, -(-2 * ends["anchors"] // pass_anchors)) if ends["anchors"] > pass_anchors else 1
        anchors = rows.filter(F.col("vec_id") % anchor_every == 0).withColumn("pass", F.pmod(F.xxhash64("vec_id"), F.lit(passes)))
        found: list[DataFrame] = []
        for number in range(passes):
            table = anchors.filter(F.col("pass") == number).select("vec_id", "label", "x").orderBy("vec_id").toArrow()
            # Dealt by a hash, a pass has its bound with near certainty; if not, it is scanned in slices.
            for at in range(0, table.num_rows, pass_anchors):
                found.append(_one_pass(rows, table.slice(at, pass_anchors).combine_chunks(), packing, positives, negatives, least_percent))
        if not found:
            return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out

    return stage_result(spark, "hard-negatives", build)


def _one_pass(rows: DataFrame, table: pa.Table, packing: Packing, positives: int, negatives: int, percent: int) -> DataFrame:
    """The result for the anchors of ``table``, of which there is a bounded number. Staged."""
    context = rows.sparkSession.sparkContext
    ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
    matrix = _matrix(table.column("x"), packing)
    schema = "slot long, vec_id long, score long"

    def first(scored: DataFrame, count: int) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("slot").orderBy(F.desc("score"), "vec_id"))
        return scored.withColumn("rank", rank).filter(F.col("rank") <= count)

    held = context.broadcast((ids, labels, matrix))
    near = first(rows.mapInArrow(_positives(held, packing, positives), schema), positives).orderBy("slot", "rank").toArrow()
    held.unpersist()
    owner, bars, positive_ids = (near.column(c).to_numpy() for c in ("slot", "score", "vec_id"))
    held = context.broadcast((ids, labels, matrix, owner, bars))
    hard = stage(first(rows.mapInArrow(_negatives(held, packing, negatives, percent), schema), negatives), "negatives")
    held.unpersist()
    pairs = rows.sparkSession.createDataFrame(
        pa.table({"slot": pa.array(np.arange(len(owner))), "anchor_id": pa.array(ids[owner]), "positive_id": pa.array(positive_ids), "positive_score": pa.array(bars)})
    )
    return stage(
        hard.join(F.broadcast(pairs), "slot").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ),
        "hard-negatives",
    )
