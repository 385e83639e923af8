"""The pipeline against plain versions of its stages, each on what the stage before it kept."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tandem.llm.toxicity import score_documents

from .test_decontaminate import brute as contamination
from .test_mixture import water_fill
from .test_near_dedup import brute as components

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, rows = docs.columns, [docs.collect()]
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, SF_DIR).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        if name != "token_files":
            assert docs.columns == columns
        rows.append(docs.collect())
    return rows


def key(rows):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows)


def test_rejected_documents_go(spark, stages):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rejected = {r.doc_id for r in score_documents(docs, labels).filter("predicted = 1").collect()}
    assert key(stages[1]) == key(r for r in stages[0] if r.doc_id not in rejected)


def test_one_document_of_each_group_stays(stages):
    kept = {r[0] for r in components([(r.doc_id, r.text) for r in stages[1]]) if r[3]}
    assert len(kept) < len(stages[1]) and key(stages[2]) == key(r for r in stages[1] if r.doc_id in kept)


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    gone = {r.doc_id for r in stages[2] if contamination(r.text, items)[3]}
    assert gone and key(stages[3]) == key(r for r in stages[2] if r.doc_id not in gone)


def test_sources_are_mixed_to_their_targets(stages):
    size = lambda r: len((r.text or "").encode().split())
    before, after = key(stages[3]), key(stages[4])
    assert set(after) <= set(before) and max(after.values()) <= 2
    sources = sorted({r.source for r in stages[3]})
    sizes = [sum(size(r) for r in stages[3] if r.source == s) for s in sources]
    targets = water_fill(sizes, [(3.0, 1.0, 2.0)[i % 3] for i in range(len(sources))], 1.5 * sum(sizes), 2.0)
    for source, target in zip(sources, targets):
        rows = [r for r in stages[3] if r.source == source]
        taken = sum(size(r) for r in stages[4] if r.source == source)
        assert abs(taken - target) <= max(3, 0.02 * target)


def test_token_files_hold_the_mix(stages):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    start, want = 0, []
    for r in sorted(stages[4], key=lambda r: (r.doc_id, r.text)):
        ids = np.array(library.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, stages[5])) == sorted(want)


def test_run_chains_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(tuple, stages[5]))


def test_odd_rows_pass_through(spark):
    from .helpers import docs, odd_rows

    table = docs(spark, odd_rows())
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, table, SF_DIR)
        assert name == "token_files" or out.columns == table.columns
        out.collect()
