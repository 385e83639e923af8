"""Exact deduplication: counting quotient filters find repeated fingerprints, bytes decide.

Every task builds one counting quotient filter over the fingerprints of its rows, cut into ranges of
the quotient. The filters of a range meet in one task and merge without loss, since a filter lists
its (quotient, remainder, count) triples in sorted order: the merged filter holds exactly what one
filter over all rows would. Fingerprints counted once belong to rows without copies, which are done.
Rows whose fingerprint counts more are compared by their bytes: they are grouped by the normalised
text itself, with partial aggregation, so a hot group of copies shrinks to a row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import partitions_for, small, worker_store
from tandem.session import stage, stage_result

QUOTIENT_BITS = 16
MAX_RANGES = 1 << QUOTIENT_BITS
_BLANK = r"[\x20\x09-\x0D]"


# ------------------------------------------------------------------ the filter


@dataclass(frozen=True)
class QuotientFilter:
    """Slots of remainders with three bits each, for 64-bit fingerprints.

    ``occupied[q]`` says that quotient ``q`` has a run; ``run_end[s]`` that slot ``s`` ends one;
    ``counter[s]`` that slot ``s`` holds the count of the remainder before it. A remainder without a
    counter counts once. Runs stand in order of their quotient and shift to the right of their home
    slot where that is taken; remainders ascend within a run.
    """

    occupied: np.ndarray
    run_end: np.ndarray
    counter: np.ndarray
    slots: np.ndarray
    used: np.ndarray

    @classmethod
    def build(cls, quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray, size: int) -> QuotientFilter:
        """From distinct pairs, sorted by quotient and remainder; quotients are below ``size``."""
        width = 1 + (counts > 1)
        first = np.cumsum(width) - width  # offset of a pair among all the slots taken
        home = np.maximum.accumulate(quotients - first) + first if len(quotients) else quotients
        total = int(home[-1] + width[-1]) if len(quotients) else 0
        occupied, run_end, counter, used = np.zeros(size, bool), np.zeros(total, bool), np.zeros(total, bool), np.zeros(total, bool)
        slots = np.zeros(total, np.uint64)
        occupied[quotients] = True
        slots[home] = remainders
        used[home] = True
        many = counts > 1
        slots[home[many] + 1] = counts[many].astype(np.uint64)
        counter[home[many] + 1] = used[home[many] + 1] = True
        last = np.flatnonzero(np.append(quotients[1:] != quotients[:-1], True)) if len(quotients) else quotients
        run_end[home[last] + width[last] - 1] = True
        return cls(occupied, run_end, counter, slots, used)

    def triples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Quotients, remainders and counts, sorted by the first two."""
        place = np.flatnonzero(self.used & ~self.counter)
        runs_before = np.cumsum(self.run_end) - self.run_end
        quotients = np.flatnonzero(self.occupied)[runs_before[place]]
        counts = np.ones(len(place), np.int64)
        after = place + 1
        inside = after < len(self.slots)
        has = np.zeros(len(place), bool)
        has[inside] = self.counter[after[inside]]
        counts[has] = self.slots[after[has]].astype(np.int64)
        return quotients, self.slots[place], counts

    def to_bytes(self) -> bytes:
        head = np.array([len(self.occupied), len(self.slots)], "<u8").tobytes()
        bits = b"".join(np.packbits(b).tobytes() for b in (self.occupied, self.run_end, self.counter, self.used))
        return head + bits + self.slots.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> QuotientFilter:
        size, total = (int(n) for n in np.frombuffer(raw, "<u8", 2))
        at, parts = 16, []
        for n in (size, total, total, total):
            parts.append(np.unpackbits(np.frombuffer(raw, np.uint8, -(-n // 8), at), count=n).astype(bool))
            at += -(-n // 8)
        return cls(*parts[:3], np.frombuffer(raw, "<u8", total, at), parts[3])


def count_pairs(quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with their counts summed."""
    order = np.lexsort((remainders, quotients))
    quotients, remainders, counts = quotients[order], remainders[order], counts[order]
    if not len(order):
        return quotients, remainders, counts
    new = np.append(True, (quotients[1:] != quotients[:-1]) | (remainders[1:] != remainders[:-1]))
    return quotients[new], remainders[new], np.add.reduceat(counts, np.flatnonzero(new))


def merge_filters(filters: list[QuotientFilter]) -> QuotientFilter:
    parts = [f.triples() for f in filters]
    quotients, remainders, counts = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return QuotientFilter.build(*count_pairs(quotients, remainders, counts), size=max(len(f.occupied) for f in filters))


def repeated_fingerprints(fingerprints: DataFrame, ranges: int) -> DataFrame:
    """Values of the long column ``fp`` that occur more than once, by merging filters per range.

    ``ranges`` cut the quotients; a range should hold few enough distinct values for one task. A
    hot value is one counter in the filter of a task, however often it occurs there.
    """
    ranges = min(ranges, MAX_RANGES)
    quotient_bits = QUOTIENT_BITS

    def split(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bits = values.view(np.uint64)
        top = (bits >> np.uint64(64 - quotient_bits)).astype(np.int64)
        part = top * ranges >> quotient_bits
        start = -(-(part << quotient_bits) // ranges)
        return part, top - start, bits & np.uint64((1 << (64 - quotient_bits)) - 1)

    size = -(-MAX_RANGES // ranges) + 1

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        values = np.concatenate(values).astype(np.int64) if values else np.empty(0, np.int64)
        part, quotient, remainder = split(values)
        order = np.argsort(part, kind="stable")
        part, quotient, remainder = part[order], quotient[order], remainder[order]
        found, at = np.unique(part, return_index=True)
        for number, a, b in zip(found, at, np.append(at[1:], len(part))):
            pairs = count_pairs(quotient[a:b], remainder[a:b], np.ones(b - a, np.int64))
            image = QuotientFilter.build(*pairs, size=size).to_bytes()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([image], pa.binary())], ["part", "image"])

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        merged = merge_filters([QuotientFilter.from_bytes(i.as_py()) for i in table.column("image")])
        quotients, remainders, counts = merged.triples()
        start = -(-(int(key[0].as_py()) << quotient_bits) // ranges)
        top = (quotients + start).astype(np.uint64) << np.uint64(64 - quotient_bits)
        return pa.table({"fp": (top | remainders)[counts > 1].view(np.int64)})

    filters = fingerprints.select("fp").mapInArrow(build, "part int, image binary")
    return filters.groupBy("part").applyInArrow(merge, "fp long")


# ------------------------------------------------------------------ documents


def _normal(text: str | None) -> bytes:
    return text.encode().translate(None, b" \t\n\v\f\r") if text else b""


def digests(texts: pa.Array) -> pa.Array:
    """Fingerprint and SHA-256 of every normalised text."""
    import xxhash

    worker_store("exact_dedup")
    fps, hashes = np.empty(len(texts), np.uint64), []
    for i, value in enumerate(texts):
        normal = _normal(value.as_py())
        fps[i] = xxhash.xxh3_64_intdigest(normal)
        hashes.append(hashlib.sha256(normal).digest())
    return pa.StructArray.from_arrays([pa.array(fps.view(np.int64)), pa.array(hashes, pa.binary())], ["fp", "sha"])


digests.__annotations__ = {"texts": pa.Array, "return": pa.Array}


def mark_copies(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; texts are equal without blanks.

    Of equal texts the row with the most code points stays, then the smallest doc_id. NULL counts as
    the empty text. Rows that share an id as well stay or go together, and all of them count in
    ``group_size``; a missing id comes after all others and equals other missing ones. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    digest = F.arrow_udf(digests, "fp long, sha binary")

    def build() -> DataFrame:
        text = F.coalesce(F.col("text"), F.lit(""))
        read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).alias("n_points"), digest("text").alias("d"))
        rows = stage(read.select("doc_id", "n_points", "d.fp", "d.sha"), "digests")
        total = rows.count()
        # Eight bytes per fingerprint: a range of 64 MB.
        repeated = stage(repeated_fingerprints(rows, ranges or partitions_for(rows, 16 * total)), "repeated")
        n_repeated = repeated.count()
        # Verification by bytes: rows with a repeated fingerprint, grouped by the normalised text itself.
        suspects = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), digest("text")["fp"].alias("fp"))
        suspects = suspects.join(small(repeated, n_repeated), "fp", "left_semi")
        normal = suspects.select("doc_id", F.char_length("text").alias("n_points"), F.regexp_replace("text", _BLANK, "").alias("normal"))
        order = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"))
        groups = (
            normal.groupBy("normal")
            .agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
            .filter("group_size > 1")
            .select(F.unhex(F.sha2("normal", 256)).alias("sha"), F.col("first.doc_id").alias("keep"), F.col("first.col1").alias("rank"), "group_size")
        )
        groups = stage(groups, "copies")
        n_groups = groups.count()
        joined = rows.join(small(groups, n_groups), "sha", "left")
        alone = F.col("group_size").isNull()
        return joined.select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (alone | (F.col("doc_id").eqNullSafe(F.col("keep")) & (F.col("n_points") == -F.col("rank")))).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )

    return stage_result(spark, "exact-dedup", build)
