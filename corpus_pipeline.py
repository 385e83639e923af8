"""From raw documents to token files: five stages, each on all that the one before it kept.

Toxic documents go, one document of each near-duplicate group stays, contaminated documents go, the
rest is mixed to its target weights, and the mix is written as token files and read back. Every stage
takes (spark, docs, sf_dir); all but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tandem.llm.decontaminate import decontaminate
from tandem.llm.mixture import mix
from tandem.llm.near_dedup import drop_near_duplicates
from tandem.llm.token_files import read_token_files, write_token_files
from tandem.llm.toxicity import drop_toxic
from tandem.session import stage, staged_path

TOKENIZER = "byte_bpe_50k.json"
# Words of a shingle of near duplicates; op6_near_dedup alone takes two.
SHINGLE = 5

# Texts go to Python in batches of this many bytes and rows at most, as workers of several stages share an executor.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 1_000
# Rows that Parquet's reader takes at once; whole texts make its usual 4096 several arrays of many MB in every task.
READ_ROWS = 128

# Tokenising, sampling and a trained model are beyond SQL.
ORACLE_SQL = None


def _bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded_batches(spark)
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded_batches(spark)
    return drop_near_duplicates(docs, SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded_batches(spark)
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded_batches(spark)
    return mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded_batches(spark)
    path = staged_path(spark, "token-files")
    write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
    return read_token_files(spark, path, with_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: doc_id, start, n_tokens and ids_crc32 per document of the mix."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
