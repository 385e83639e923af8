import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tandem.llm.line_dedup import LineRuns, batch_bounds, dedup_lines, drop_lines, line_hashes

from .helpers import docs, odd_rows


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, min_points=20, min_docs=3):
    """(doc_id, n_lines, n_dropped, kept) per row."""
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= min_points:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [doc_id is not None and len(h := holders.get(key(x), ())) >= min_docs and doc_id != max(h) for x in lines]
        out.append((doc_id, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


def check(spark, rows, **options):
    table = docs(spark, [(*r[:2], *[None] * 6) for r in rows]).repartition(3)
    found = dedup_lines(table, **options).select("doc_id", "line_dedup.*")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, brute([r[:2] for r in rows])))


def lines_of(rng, count, pool):
    return "\n".join(rng.choice(pool) for _ in range(count))


@pytest.mark.parametrize("batches, fanout", [(1, 2), (3, 2), (6, 3)])
def test_lines_of_many_documents(spark, batches, fanout):
    rng = random.Random(batches)
    pool = [f"line number {i} of a licence, {'x' * rng.randrange(12)}" for i in range(60)]
    pool += ["Über die Brücke gehen", "  UPPER case and\tblanks \r", "upper case and\tBLANKS", "short", "", " \t", "ÄÖÜ" * 7, "äöü" * 7]
    rows = [(rng.randrange(10**9), lines_of(rng, rng.randrange(1, 9), pool + [f"only here {i} {rng.random()}"])) for i in range(120)]
    check(spark, rows, batches=batches, fanout=fanout)


def test_a_line_in_every_document_stays_in_the_largest(spark):
    rows = [(i, f"a line that all documents hold\nown line of document {i}, which stays") for i in range(-20, 20)]
    check(spark, rows)
    check(spark, rows[:2])


def test_odd_rows(spark):
    check(spark, odd_rows())
    repeated = [(7, "this line is found in all of them\n" * 3)] * 40 + [(7, "another text\nthis line is found in all of them"), (8, "THIS line is found in all of them "), (9, None)]
    check(spark, repeated + [(None, "this line is found in all of them")] * 3 + [(10, "\tthis line is found in all of them")])
    check(spark, [])
    check(spark, [(1, "x" * 19 + "\n" + "x" * 20), (2, "x" * 19 + "\n" + "x" * 20), (3, "x" * 19 + "\n" + "x" * 20)])


def test_a_very_long_document(spark):
    text = "\n".join(f"line {i % 1_000} of a very long document" for i in range(50_000))
    check(spark, [(1, text), (2, text), (3, "\n".join(text.split("\n")[:700]))])


def test_other_columns_stay(spark):
    rows = [(i, "the same line of twenty points and more", "en", "s", i, True, 2, "c") for i in range(4)]
    table = docs(spark, rows).withColumn("line_dedup", F.lit(1)).withColumn("h1", F.lit("mine")).withColumn("at", F.lit(3))
    left = drop_lines(table)
    assert left.columns == table.columns
    assert sorted((r.doc_id, r.text, r.line_dedup, r.h1, r.at) for r in left.collect()) == [(i, "" if i < 3 else rows[3][1], 1, "mine", 3) for i in range(4)]


def test_runs_are_disjoint_and_levelled(spark):
    rng = random.Random(4)
    rows = [(i, lines_of(rng, 5, [f"a line that several may hold: {n}" for n in range(80)])) for i in range(64)]
    lines = line_hashes(spark.createDataFrame(rows, "__id long, __text string")).cache()
    runs = LineRuns(spark, 2)
    brought = [runs.add(lines.filter(f"doc_id > {at - 8} AND doc_id <= {at}")) for at in range(63, 0, -8)]
    assert [r.level for r in runs.runs] == [3]  # eight batches by two
    hashes = [(r.h1, r.h2) for run in runs.runs for r in run.rows.collect()]
    assert len(hashes) == len(set(hashes)) == lines.select("h1", "h2").distinct().count()
    assert sum(b.count() for b in brought) == len(hashes)
    runs.close()


def test_new_batches_meet_the_runs_without_a_shuffle_of_them(spark):
    lines = line_hashes(spark.createDataFrame([(i, f"some line of document number {i // 2}") for i in range(40)], "__id long, __text string"))
    runs = LineRuns(spark, 9)
    runs.add(lines.filter("doc_id >= 20"))
    fresh = lines.filter("doc_id < 20").groupBy("h1", "h2").count().join(runs.runs[0].rows.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    joined = plan[plan.index("SortMergeJoin"):]
    bucketed = next(part for part in joined.split("\n") if "Bucketed: true" in part)
    assert bucketed and joined.count("Exchange") == 1  # that of the new batch's sums
    runs.close()


def test_batches_go_from_large_to_small_ids(spark):
    ids = spark.range(1_000).withColumnRenamed("id", "__id")
    bounds = batch_bounds(ids, 4)
    assert len(bounds) == 4 and bounds[0][1] is None and bounds[-1][0] is None
    assert [b[0] for b in bounds[:-1]] == [b[1] for b in bounds[1:]]
    assert batch_bounds(ids.filter("__id < 0"), 4) == [(None, None)] and batch_bounds(ids, 1) == [(None, None)]


def test_query_against_plain_python(spark, sf_dir):
    from tandem.llm.queries import op11_line_dedup

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: (n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute(rows)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op11_line_dedup(spark, sf_dir).collect()} == want
    assert any(g for _, g, _ in want.values())
