"""WARC archives: write records through Spark's text sink, read them back by boundary chains.

A record is the version line, named fields, an empty line, the payload and two line ends. Written as
text with the line separator ``\\r\\n\\r\\n``, a row is exactly a record, so any store that Spark
writes will do and a lost executor leaves no broken archive.

Reading splits an archive anywhere. Every occurrence of the version line is a *candidate*; payloads
may hold it too. A task that walks a split emits, for each candidate, where its declared length says
the next record starts. Since a split's candidates are known to its task, it also finds where the
chain from each candidate leaves the split. Pointer jumping over those exits, from the start of each
file, finds the true first record of every split in a logarithmic number of rounds; the chain from
there separates records from magic inside payloads. A record whose payload holds the version line is
put together from its parts.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.llm.common import small
from tandem.session import stage, stage_result

MAGIC = "WARC/1.1\r\n"
_END = "\r\n\r\n"
_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+) *\r\n", re.IGNORECASE)
_BROKEN = -1  # where the chain of a candidate without a successor leads

_FIELDS = "file string, block long, pos long, next long, ends long, headers string, payload_bytes long, digest string"


# ------------------------------------------------------------------ writing


def record_text(page_id, url, html, written):
    """A response record, written at the time ``written``, as one string without its final line ends."""
    payload = F.coalesce(html, F.lit(""))
    clean = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", " ")
    return F.concat(
        F.lit(MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Date: "),
        F.date_format(F.to_utc_timestamp(written, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Target-URI: "),
        clean,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(_END),
        payload,
    )


def write_archives(pages: DataFrame, path: str, written: Column | None = None) -> None:
    """A record per row of ``pages`` (page_id, url, html), NULL html with an empty payload, NULL ids with an empty id.

    ``written`` is the date of the records, by default the time of the write; where it is NULL, the
    start of the epoch. Line ends in a URL become blanks; other columns are ignored. Every task writes one archive.
    """
    date = F.current_timestamp() if written is None else F.coalesce(written.cast("timestamp"), F.timestamp_seconds(F.lit(0)))
    records = pages.select(record_text(F.col("page_id"), F.col("url"), F.col("html"), date).alias("value"))
    records.write.mode("overwrite").option("lineSep", _END).text(path)


# ------------------------------------------------------------------ reading


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@contextmanager
def steady_splits(spark: SparkSession) -> Iterator[None]:
    """Keep how files are split apart from the number of executors, which may change between two reads.

    Spark makes splits for as many cores as there are; inside the block it makes them for the cores
    of its start.
    """
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
    spark.conf.set(name, before or str(cores))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _parts(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """What stands after every version line, with the file and the split it was read in."""
    lines = spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", str(recursive).lower()).text(path)
    return lines.select(
        F.col("value").cast("binary").alias("part"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """File, split, position within the split's own rows, and bytes of every row, in order."""
    key, at = None, 0
    for batch in batches:
        for part, file, block in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if (file, block) != key:
                key, at = (file, block), 0
            raw = part.as_py()
            yield file, block, at, raw
            at += len(raw) + len(MAGIC)


def candidate(raw: bytes) -> tuple[bytes, int, int] | None:
    """Header fields, payload start and payload length of a candidate; None if it cannot be a record."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    found = _LENGTH.search(b"\r\n" + raw[: end + 2])
    return (raw[:end], end + 4, int(found[1])) if found else None


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
    names = ["file", "block", "pos", "next", "ends", "headers", "payload_bytes", "digest"]

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for file, block, at, raw in _walk(batches):
        ends = at + len(raw) + len(MAGIC)
        parsed = candidate(raw)
        if parsed is None:
            rows.append((file, block, at, None, ends, None, None, None))
        else:
            headers, start, length = parsed
            digest = base32_sha1(raw[start : start + length]) if start + length <= len(raw) else None
            rows.append((file, block, at, at + start + length + len(_END) + len(MAGIC), ends, headers.decode(errors="replace"), length, digest))
        if len(rows) >= 5_000:
            yield flush()
    if rows:
        yield flush()


def exits(pos: np.ndarray, following: np.ndarray, end: int) -> np.ndarray:
    """Where the chain from every candidate of a split first lands at or beyond ``end``; -1 where it breaks."""
    out = np.full(len(pos), _BROKEN, np.int64)
    place = {int(p): i for i, p in enumerate(pos)}
    for i in range(len(pos) - 1, -1, -1):
        to = int(following[i])
        if to >= end:
            out[i] = to
        elif to in place and place[to] > i:
            out[i] = out[place[to]]
    return out


def _absolute(parts: DataFrame) -> DataFrame:
    """Positions in the file instead of in the split: what earlier splits of the file hold is added up."""
    splits = parts.groupBy("file", "block").agg(F.max("ends").alias("size"))
    before = F.coalesce(F.sum("size").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    splits = stage(splits.select("file", "block", before.alias("base"), (before + F.col("size")).alias("limit")), "splits")
    placed = parts.join(small(splits, splits.count()), ["file", "block"])
    return placed.select(
        "file", "block", (F.col("pos") + F.col("base")).alias("pos"), (F.col("next") + F.col("base")).alias("next"),
        "limit", "headers", "payload_bytes", "digest",
    )


def _entries(placed: DataFrame) -> DataFrame:
    """file, block, entry: the first true record of every split that the chain from the file's start enters."""

    def leave(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        pos = table.column("pos").to_numpy()
        following = table.column("next").fill_null(_BROKEN).to_numpy()
        out = exits(pos, following, table.column("limit")[0].as_py())
        return pa.table({"file": table.column("file"), "block": table.column("block"), "pos": pos, "exit": out})

    left = placed.select("file", "block", "pos", "next", "limit").groupBy("file", "block").applyInArrow(leave, "file string, block long, pos long, exit long")
    left = stage(left, "exits")
    # Only what some chain jumps to, or what stands first in its file, can be an entry.
    targets = left.filter(F.col("exit") >= 0).select("file", F.col("exit").alias("pos")).distinct()
    first = F.col("pos") == len(MAGIC)
    jumps = left.join(targets, ["file", "pos"], "left_semi").unionByName(left.filter(first)).distinct()
    jumps = stage(jumps.select("file", "block", "pos", "exit"), "jumps")
    reached = jumps.filter(first).select("file", "block", "pos")
    hops = jumps.select("file", "pos", F.col("exit").alias("to"))
    while True:
        reached = stage(reached, "reached")
        landed = reached.join(hops, ["file", "pos"]).select("file", F.col("to").alias("pos"))
        landed = landed.join(jumps.select("file", "pos", "block"), ["file", "pos"]).select("file", "block", "pos")
        grown = stage(reached.union(landed).distinct(), "reached")
        if grown.count() == reached.count():
            return grown.select("file", "block", F.col("pos").alias("entry"))
        reached = grown
        far = hops.alias("a").join(hops.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.to") == F.col("b.pos")))
        hops = stage(far.select("a.file", "a.pos", "b.to"), "hops")


def read_archives(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """file, pos, headers, payload_bytes, payload_digest of every record of the archives under ``path``.

    ``pos`` is the byte after the record's version line. The digest is the bare base32 SHA-1 of the
    payload. A chain ends where a record is cut off or has no valid length; what follows in that
    file is not returned, and ``payload_digest`` is NULL for a record whose payload is cut off. A
    folder without archives, or with empty ones, gives no rows. Records with the version line in
    their payload are read twice, with the same splits; should they differ after all, reading raises.
    """

    def build() -> DataFrame:
        parts = stage(_parts(spark, path, recursive).mapInArrow(_scan, _FIELDS), "candidates")
        placed = stage(_absolute(parts), "placed")
        entries = _entries(placed)
        marked = placed.join(small(entries, entries.count()), ["file", "block"], "left")

        def follow(table: pa.Table) -> pa.Table:
            table = table.sort_by("pos")
            pos, to = table.column("pos").to_pylist(), table.column("next").to_pylist()
            place = {p: i for i, p in enumerate(pos)}
            keep, at = np.zeros(len(pos), bool), table.column("entry")[0].as_py()
            while at in place and not keep[place[at]]:
                keep[place[at]] = True
                at = to[place[at]]
            return table.append_column("record", pa.array(keep)).select(names)

        names = ["file", "block", "pos", "next", "headers", "payload_bytes", "digest", "record"]
        schema = "file string, block long, pos long, next long, headers string, payload_bytes long, digest string, record boolean"
        chained = stage(marked.groupBy("file", "block").applyInArrow(follow, schema), "chained")
        records = chained.filter("record")
        parted = records.filter("digest IS NULL")
        if not parted.isEmpty():
            records = records.join(_joined_payloads(spark, path, recursive, chained), ["file", "pos"], "left")
            records = records.withColumn("digest", F.coalesce("digest", "joined"))
        return records.select("file", "pos", "headers", "payload_bytes", F.col("digest").alias("payload_digest"))

    with steady_splits(spark):
        return stage_result(spark, "warc-records", build)


def _joined_payloads(spark: SparkSession, path: str, recursive: bool, chained: DataFrame) -> DataFrame:
    """file, pos and joined digest of records whose payload holds the version line.

    The owner of a part is the last record before it. Within a split that is a running value; where
    a split starts inside a payload, it is the last record of an earlier split.
    """
    in_split = F.last(F.when(F.col("record"), F.col("pos")), True).over(W.partitionBy("file", "block").orderBy("pos"))
    lasts = chained.groupBy("file", "block").agg(F.max(F.when(F.col("record"), F.col("pos"))).alias("last"))
    earlier = F.last("last", True).over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    carried = stage(lasts.select("file", "block", earlier.alias("carried")), "carried")
    owned = chained.withColumn("owner", in_split).join(small(carried, carried.count()), ["file", "block"])
    owned = owned.select("file", "block", "pos", F.coalesce("owner", "carried").alias("owner"))
    open_records = chained.filter("record AND digest IS NULL").select("file", F.col("pos").alias("owner"), "payload_bytes")
    wanted = stage(owned.join(open_records, ["file", "owner"]), "parts")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, at, raw in _walk(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block], pa.int64()), pa.array([at], pa.int64()), pa.array([raw], pa.binary())], ["file", "block", "at", "part"]
            )

    # Positions within a split are turned into positions in the file as before.
    first = chained.groupBy("file", "block").agg(F.min("pos").alias("base"))
    parts = _parts(spark, path, recursive).mapInArrow(place, "file string, block long, at long, part binary")
    parts = parts.join(first, ["file", "block"]).withColumn("pos", F.col("at") + F.col("base"))
    matched = parts.join(small(wanted, wanted.count()).drop("block"), ["file", "pos"])
    whole = matched.groupBy("file", "owner", "payload_bytes").agg(F.sort_array(F.collect_list(F.struct("pos", "part"))).alias("parts"))
    counts = wanted.groupBy("file", "owner").agg(F.count("*").alias("n_parts"))
    whole = counts.join(whole, ["file", "owner"], "left")

    def digest(parts: pa.Array, lengths: pa.Array) -> pa.Array:
        out = []
        for row, length in zip(parts.to_pylist(), lengths.to_pylist()):
            if row is None:  # no part was found; the caller raises
                out.append(None)
                continue
            raw = MAGIC.encode().join(p["part"] for p in row)
            start = raw.find(b"\r\n\r\n") + 4
            payload = raw[start : start + length]
            out.append(base32_sha1(payload) if len(payload) == length else None)
        return pa.array(out, pa.string())

    digest.__annotations__ = {"parts": pa.Array, "lengths": pa.Array, "return": pa.Array}
    found = F.coalesce(F.size("parts"), F.lit(0)) == F.col("n_parts")
    moved = F.raise_error(F.concat(F.lit("the archives were split in another way when read again: "), "file")).cast("string")
    joined = F.arrow_udf(digest, "string")("parts", "payload_bytes")
    return whole.select("file", F.col("owner").alias("pos"), F.when(found, joined).otherwise(moved).alias("joined"))


# ------------------------------------------------------------------ copies


def header(name: str):
    """Value of a named field of a record; NULL where it is missing or empty."""
    value = F.regexp_extract("headers", rf"(?im)(?:^|\n){name}: *([^\r\n]*?) *(?:\r|$)", 1)
    return F.when(value != "", value)


def mark_revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the smallest
    page_id is the response and the others revisit it. Equal ids are all the response; records
    without an id revisit the smallest id if there is one. Digests are summed per task before they
    are brought together, and only those that occur more than once are joined back.
    """
    page = F.regexp_extract("headers", r"WARC-Record-ID: *<urn:page:(-?\d+)>", 1)
    rows = records.select(F.when(page != "", page.cast("long")).alias("page_id"), "payload_bytes", "payload_digest")
    shared = (
        rows.filter(F.col("payload_digest").isNotNull() & (F.col("payload_bytes") >= least_bytes))
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    shared = stage(shared, "revisited")
    first = F.col("first")
    revisit = first.isNotNull() & ~F.col("page_id").eqNullSafe(first)
    return rows.join(small(shared, shared.count()), ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, first).alias("refers_to"),
    )
