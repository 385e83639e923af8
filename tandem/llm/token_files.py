"""Token-ID files: documents in id order as patched frame-of-reference blocks.

Documents are range-partitioned by doc_id; every task walks its sorted range and cuts it into
*segments*. A segment is one self-contained binary image, and the dataset is a Parquet folder with an
image per row: Spark commits it task by task, so lost executors leave no half-written file, and it
can be on any store that Spark writes. Layout of an image, all numbers little-endian::

    header   magic "TPF1", documents u32, blocks u32, ids u64
    docs     doc_id i64 per document, then ids u32 per document, then 1 byte per document: doc_id is NULL
    index    per block: minimum u32, width u8, exceptions u8, then start of every block u64 (one more than blocks)
    blocks   each: values minus minimum at `width` bits, then exception positions u8, then their high parts u32

A block holds 128 consecutive ids of the segment. The width is the number of bits that the given
percentile of the block's values fits in; the bits beyond it of the others are the exceptions. Value
``i`` of a block is at bit ``i * width`` of the packed words. The last block is filled up with its
own minimum.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.llm.common import partitions_for, release, within
from tandem.llm.encoding import SpacedEncoder
from tandem.session import estimated_bytes

BLOCK = 128
PERCENTILE = 90
SEGMENT_IDS = 1 << 18
MAX_PARTITIONS = 1_000_000
BEGIN_CHARS = 32

_HEADER = "<4sIIQ"
_MAGIC = b"TPF1"
_SEGMENTS = "part int, segment int, base long, n_ids long, image binary"


# ------------------------------------------------------------------ blocks


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 values below 2**width as rows of 16 * width bytes."""
    lanes = np.ascontiguousarray(values.T)
    words = np.zeros((2 * width, values.shape[0]), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        words[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False).view(np.uint8)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").T)
    lanes = np.empty((BLOCK, packed.shape[0]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        lanes[i] = value & mask
    return np.ascontiguousarray(lanes.T)


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimum, width and exception count per block, block starts, and the bytes of all blocks."""
    blocks = -(-len(ids) // BLOCK)
    values = np.empty(blocks * BLOCK, np.uint64)
    values[: len(ids)] = ids
    if blocks:
        values[len(ids) :] = ids[(blocks - 1) * BLOCK :].min()
    values = values.reshape(blocks, BLOCK)
    least = values.min(axis=1) if blocks else np.empty(0, np.uint64)
    values -= least[:, None]
    bits = _bit_lengths(values)
    rank = max(0, -(-BLOCK * percentile // 100) - 1)
    widths = np.partition(bits, rank, axis=1)[:, rank] if blocks else np.empty(0, np.uint8)
    outlying = bits > widths[:, None]
    exceptions = outlying.sum(axis=1)
    body = 16 * widths.astype(np.int64)
    starts = np.zeros(blocks + 1, np.int64)
    np.cumsum(body + 5 * exceptions, out=starts[1:])
    out = np.zeros(starts[-1], np.uint8)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        if width:
            low = values[rows] & np.uint64((1 << int(width)) - 1)
            out[starts[rows, None] + np.arange(16 * int(width))] = _pack(low, int(width))
    block, position = np.nonzero(outlying)
    out[within(starts[:-1] + body, exceptions)] = position.astype(np.uint8)
    high = (values[block, position] >> widths[block].astype(np.uint64)).astype("<u4")
    out[within(starts[:-1] + body + exceptions, 4 * exceptions)] = high.view(np.uint8)
    return least.astype("<u4"), widths, exceptions.astype(np.uint8), starts, out


def unpack_blocks(least, widths, exceptions, starts, data, n: int) -> np.ndarray:
    """The ids that :func:`pack_blocks` was given."""
    values = np.zeros((len(widths), BLOCK), np.uint64)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        if width:
            values[rows] = _unpack(data[starts[rows, None] + np.arange(16 * int(width))], int(width))
    exceptions = exceptions.astype(np.int64)
    body = starts[:-1] + 16 * widths.astype(np.int64)
    block = np.repeat(np.arange(len(widths)), exceptions)
    position = data[within(body, exceptions)]
    high = data[within(body + exceptions, 4 * exceptions)].view("<u4").astype(np.uint64)
    values[block, position] |= high << widths[block].astype(np.uint64)
    values += least.astype(np.uint64)[:, None]
    return values.reshape(-1)[:n].astype("<u4")


# ------------------------------------------------------------------ segments


def segment_image(doc_ids: list[int | None], encoded: list[np.ndarray], percentile: int = PERCENTILE) -> bytes:
    ids = np.concatenate(encoded) if encoded else np.empty(0, "<u4")
    least, widths, exceptions, starts, data = pack_blocks(ids, percentile)
    return b"".join(
        (
            struct.pack(_HEADER, _MAGIC, len(doc_ids), len(widths), len(ids)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([len(e) for e in encoded], "<u4").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            least.tobytes(),
            widths.tobytes(),
            exceptions.tobytes(),
            starts.astype("<u8").tobytes(),
            data.tobytes(),
        )
    )


def read_segment(image: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, where each document starts in the ids (one more than documents), and the ids."""
    magic, docs, blocks, n = struct.unpack_from(_HEADER, image)
    if magic != _MAGIC:
        raise ValueError("not a token segment")
    at = struct.calcsize(_HEADER)

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(image, dtype, count, at)
        at += values.nbytes
        return values

    doc_ids, sizes, missing = take("<i8", docs), take("<u4", docs), take("u1", docs)
    least, widths, exceptions, starts = take("<u4", blocks), take("u1", blocks), take("u1", blocks), take("<u8", blocks + 1)
    ids = unpack_blocks(least, widths, exceptions, starts.astype(np.int64), take("u1", len(image) - at), n)
    offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    return [None if m else int(d) for d, m in zip(doc_ids, missing)], offsets, ids


# ------------------------------------------------------------------ Spark


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    percentile: int = PERCENTILE,
    segment_ids: int = SEGMENT_IDS,
    partitions: int | None = None,
) -> None:
    """Encode ``text`` of every row and write the ids to ``path`` in ascending order of ``doc_id``.

    NULL text counts as empty; every document ends with ``end_id``. Rows without an id come first,
    rows with the same id stand in order of how their text begins, then as they were read, so that
    they can be dealt to several tasks; every row is written, repeated or not.
    A document is never cut: a segment is closed by the document that fills it. Other columns are
    ignored. An empty table gives a dataset without segments.
    """
    partitions = min(partitions or partitions_for(docs, estimated_bytes(docs)), MAX_PARTITIONS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = SpacedEncoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        doc_ids, encoded, held, base, number = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, encoded, held, base, number
            row = [[part], [number], [base], [held], [segment_image(doc_ids, encoded, percentile)]]
            doc_ids, encoded, held, base, number = [], [], 0, base + held, number + 1
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "segment", "base", "n_ids", "image"])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids_of(batch.column(1))):
                doc_ids.append(doc_id)
                encoded.append(np.concatenate((ids, end)))
                held += len(ids) + 1
                if held >= segment_ids:
                    yield close()
        if doc_ids:
            yield close()
        release()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumns({"begin": F.substring("text", 1, BEGIN_CHARS), "place": F.monotonically_increasing_id()})
        .repartitionByRange(partitions, "doc_id", "begin", "place")
        .sortWithinPartitions("doc_id", "begin", "place")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(encode, _SEGMENTS).write.mode("overwrite").option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a dataset: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and ids.

    Every task decodes whole segments. A segment knows what stands before it in its partition;
    what stands in earlier partitions is a running sum over one row per partition.
    """
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # One row per partition, of which there are at most MAX_PARTITIONS.
    bases = F.broadcast(totals.select("part", before.alias("part_base")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                doc_ids, at, ids = read_segment(image.as_py())
                raw = memoryview(ids).cast("B")
                columns = [
                    pa.array([part] * len(doc_ids), pa.int32()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(at[:-1] + base),
                    pa.array(np.diff(at)),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "part int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    read = segments.select("part", "base", "image").mapInArrow(decode, schema)
    columns = ["doc_id", (F.col("start") + F.col("part_base")).alias("start"), "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return read.join(bases, "part").select(*columns)
