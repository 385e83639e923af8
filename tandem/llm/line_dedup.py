"""Line deduplication over levelled sorted runs of line hashes, in DataFrame functions only.

Every line of some length becomes a hash of 96 bits. Documents come in batches, those with the
largest ids first. The *runs* hold each line hash once: with the document that may keep the line, which
is the largest of the batch that brought it, and the documents of that batch that hold it. A new
batch is summed to one row per hash and merge-anti-joined with all runs: what none of them has is the
batch's own run, and the rest only adds to the counts of older runs, as a *tally*. Runs are tables
bucketed and sorted by hash, so that these joins, and merging runs, need no shuffle of what is
there. When a level holds ``fanout`` runs, they are merged into one of the next level.

At the end the tallies are added to the runs. Hashes found in enough documents are *common*, and
their lines go from all documents but the one the run names. Sums per hash are combined before they
are shuffled, so a line that every document holds costs a row per task; where common hashes are too
many to broadcast, Spark splits the join's hot partitions.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import small
from tandem.session import stage, stage_result, staged_path

MIN_POINTS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2
RESULT = "line_dedup"

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """A line without blanks at both ends, ASCII letters in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _UPPER.lower())


def line_hashes(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """doc_id, version, at, h1 and h2 of every line of at least ``min_points`` code points.

    ``docs`` has __id and __text. ``version`` tells rows of one id apart by their text, ``at`` counts
    lines from 0. Rows without an id have no lines here.
    """
    held = docs.filter("__id IS NOT NULL").select(
        F.col("__id").alias("doc_id"),
        F.xxhash64("__text").alias("version"),
        F.posexplode(F.transform(F.split("__text", "\n", -1), line_key)).alias("at", "key"),
    )
    # A seed of its own makes the second hash independent of the first.
    return held.filter(F.length("key") >= min_points).select("doc_id", "version", "at", F.xxhash64("key").alias("h1"), F.hash(F.lit(1), "key").alias("h2"))


@dataclass(frozen=True)
class Run:
    level: int
    rows: DataFrame


class LineRuns:
    """An index of line hashes that grows by batches.

    Batches must come in descending order of their documents' ids: then the largest document of the
    batch in which a hash is new is the largest of all.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, fanout
        # As many buckets as a shuffle has partitions: sums per hash are dealt as the buckets are.
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[Run] = []
        self.tallies: list[DataFrame] = []
        self._names: list[str] = []

    def _written(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        self._names.append(name)
        write = rows.write.format("parquet").bucketBy(self.buckets, *_HASH).sortBy(*_HASH)
        write.option("path", staged_path(self.spark, "line-run")).saveAsTable(name)
        return self.spark.table(name)

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch of ``lines`` (doc_id, h1, h2). Returns what it has brought that is new: h1, h2, docs, top."""
        own = self._written(lines.groupBy(*_HASH).agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("top")))
        fresh = own
        for run in self.runs:
            fresh = fresh.join(run.rows.select(*_HASH).hint("merge"), _HASH, "left_anti")
        if self.runs:
            fresh = self._written(fresh)
            self.tallies.append(self._written(own.join(fresh.select(*_HASH).hint("merge"), _HASH, "left_anti").select(*_HASH, "docs")))
        self.runs.append(Run(0, fresh))
        self._compact()
        return fresh

    def _compact(self) -> None:
        level = 0
        while any(run.level >= level for run in self.runs):
            full = [run for run in self.runs if run.level == level]
            if len(full) >= self.fanout:
                merged = full[0].rows
                for run in full[1:]:
                    # Runs share no hash, so a full outer merge join is the merge of both.
                    other = run.rows.withColumnsRenamed({"docs": "docs_", "top": "top_"}).hint("merge")
                    merged = merged.join(other, _HASH, "full_outer").select(*_HASH, F.coalesce("docs", "docs_").alias("docs"), F.coalesce("top", "top_").alias("top"))
                self.runs = [run for run in self.runs if run.level != level] + [Run(level + 1, self._written(merged))]
            level += 1

    def common(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """h1, h2 and top of the hashes that at least ``min_docs`` documents hold."""
        more = None
        for tally in self.tallies:
            more = tally if more is None else more.unionByName(tally)
        out = None
        for run in self.runs:
            rows = run.rows
            if more is None:
                found = rows.filter(F.col("docs") >= min_docs)
            else:
                sums = more.groupBy(*_HASH).agg(F.sum("docs").alias("more"))
                found = rows.join(sums.hint("merge"), _HASH, "left").filter(F.col("docs") + F.coalesce("more", F.lit(0)) >= min_docs)
            found = found.select(*_HASH, "top")
            out = found if out is None else out.unionByName(found)
        return out

    def close(self) -> None:
        """Take the runs out of the catalog; their files go with what was staged."""
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch_bounds(ids: DataFrame, batches: int) -> list[tuple[int | None, int | None]]:
    """Ranges (above, up to) of ``__id`` with about equally many rows, largest ids first."""
    cuts: list[int] = []
    if batches > 1:
        shares = [i / batches for i in range(1, batches)]
        cuts = sorted(set(ids.agg(F.percentile_approx("__id", shares, 10_000)).first()[0] or []))
    return list(zip([*reversed(cuts), None], [None, *reversed(cuts)]))


def dedup_lines(docs: DataFrame, min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT, result: str = RESULT) -> DataFrame:
    """``docs`` (doc_id, text) with a column ``result`` of n_lines, n_dropped and kept, the text that is left.

    Lines end at ``\\n``; NULL and empty texts are one empty line. A line's key is the line without blanks
    at both ends, ASCII letters in lower case. Keys of at least ``min_points`` code points that at least
    ``min_docs`` documents hold lose all their lines except in the largest doc_id holding them, which
    keeps all of its own. Rows that share an id are one document. Rows without an id keep all lines and
    count for none. Other columns stay; one named like the result is replaced.
    """
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))

    def dropped() -> DataFrame:
        lines = stage(line_hashes(read, min_points), "lines")
        runs = LineRuns(spark, fanout)
        try:
            for above, to in batch_bounds(read.filter("__id IS NOT NULL"), batches):
                batch = lines if above is None else lines.filter(F.col("doc_id") > above)
                runs.add(batch if to is None else batch.filter(F.col("doc_id") <= to))
            common = stage(runs.common(min_docs), "common-lines")
            # A set, since rows repeated whole have the same lines.
            gone = lines.join(small(common, common.count()), _HASH).filter("doc_id < top")
            gone = gone.groupBy("doc_id", "version").agg(F.collect_set("at").alias("at"))
            return gone.withColumnsRenamed({"doc_id": "__id", "version": "__version", "at": "__at"})
        finally:
            runs.close()

    gone = stage_result(spark, "line-drops", dropped)
    # Only the positions are in the hash table, never the texts.
    wide = docs.drop(result).withColumns(
        {"__id": F.col("doc_id").cast("long"), "__text": F.coalesce(F.col("text").cast("string"), F.lit("")), "__version": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))}
    )
    wide = wide.join(gone.hint("shuffle_hash"), ["__id", "__version"], "left")
    lines = F.split("__text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__at"))
    kept = F.when(F.col("__at").isNull(), F.col("__text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    outcome = F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("__at"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
    return wide.select(*[F.col(f"`{c}`") for c in docs.drop(result).columns], outcome.alias(result))


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the text that :func:`dedup_lines` leaves; NULL stays NULL. Columns stay as they are."""
    found = dedup_lines(docs, result="__left", **options)
    text = F.when(F.col("text").isNotNull(), F.col("__left.kept"))
    return found.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])
