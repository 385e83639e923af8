import random

import pytest
from pyspark.sql import functions as F

from tandem.llm.mixture import mix, sample_repetitions, settle, source_targets

from .helpers import docs, odd_rows


def water_fill(sizes, weights, total, cap):
    """Targets by raising one source after the other to its cap."""
    left, open_, out = total, set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        first = min(open_, key=lambda i: cap * sizes[i] / weights[i])
        if cap * sizes[first] / weights[first] >= left / sum(weights[i] for i in open_):
            unit = left / sum(weights[i] for i in open_)
            for i in open_:
                out[i] = weights[i] * unit
            break
        out[first] = cap * sizes[first]
        left -= out[first]
        open_.remove(first)
    return out


@pytest.mark.parametrize("sizes,share", [([10, 10, 10], 1.5), ([1000, 1, 1, 5, 300], 1.5), ([5, 5, 5, 5], 2.5), ([0, 7], 1.5), ([], 1.5), ([100, 40, 3, 3, 2000, 1, 9], 1.0)])
def test_targets(spark, sizes, share):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    got = source_targets(spark.createDataFrame(rows, "source string, size long"), share=share).orderBy("source").collect()
    weights = [(3.0, 1.0, 2.0)[i % 3] for i in range(len(sizes))]
    assert [r.target for r in got] == pytest.approx(water_fill(sizes, weights, share * sum(sizes), 2.0))


def test_sources_stand_in_code_point_order_with_null_last(spark):
    rows = [(s, 100) for s in ("b", "B", "é", "\U00010000", "￿", None)]
    got = source_targets(spark.createDataFrame(rows, "source string, size long"), share=0.6).collect()
    assert {r.source: round(r.target) for r in got} == {"B": 90, "b": 30, "é": 60, "￿": 90, "\U00010000": 30, None: 60}


@pytest.fixture
def many(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.1) * 5)), "en", "hot" if i % 3 else f"s{i % 5}", 1, True, 1, "c") for i in range(3_000)]
    return docs(spark, rows).repartition(5)


def test_taken_words_come_near_their_targets(spark, many):
    first = sample_repetitions(many, lane_docs=200)
    sums = first.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size"), F.first("source_size").alias("n")).collect()
    for r in sums:
        assert r.size == r.n
        assert r.taken == pytest.approx(r.target, rel=0.02)
    assert first.filter("taken > 2 * size").count() == 0
    again = sample_repetitions(many.repartition(2), lane_docs=200)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    other = sample_repetitions(many, seed=99, lane_docs=200)
    assert sorted(map(tuple, first.collect())) != sorted(map(tuple, other.collect()))


def test_mix_repeats_rows(spark, many):
    mixed = mix(many)
    assert mixed.columns == many.columns
    want = {r.doc_id: r.repeats for r in sample_repetitions(many).collect() if r.repeats}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_odd_rows(spark):
    rows = odd_rows()
    drawn = sample_repetitions(docs(spark, rows))
    assert drawn.count() == len(rows)
    sizes = {r.doc_id: r["size"] for r in drawn.collect()}
    assert (sizes[0], sizes[2], sizes[3], sizes[4], sizes[6]) == (8, 0, 0, 0, 40_000)
    assert mix(docs(spark, rows)).count() == drawn.agg(F.sum("repeats")).first()[0]
    assert sample_repetitions(docs(spark, [])).collect() == [] and mix(docs(spark, [])).collect() == []


def test_settling_finds_the_best_choice():
    from itertools import product

    rng = random.Random(6)
    for _ in range(60):
        sizes = [rng.randrange(1, 60) for _ in range(5)]
        counts = [1, 1, 1, rng.choice([1, 2]), 1]
        repeats = [rng.randrange(c + 1) for c in counts]
        due = rng.uniform(-80, 200)
        wanted = sum(s * r for s, r in zip(sizes, repeats)) + due
        best = min(abs(sum(s * t for s, t in zip(sizes, times)) - wanted) for times in product(*[range(2 * c + 1) for c in counts]))
        settle(sizes, counts, repeats, list(range(5)), due, 2)
        assert abs(sum(s * r for s, r in zip(sizes, repeats)) - wanted) == pytest.approx(best)
        assert all(0 <= r <= 2 * c for r, c in zip(repeats, counts))


def test_rows_without_an_id_and_repeated_rows(spark):
    """Half of the rows have no id, and a fifth is one row: targets are met, and reruns agree over partitionings."""
    rng = random.Random(7)
    rows = [(None if i % 2 else i, f"w{i} " * rng.randrange(1, 30), "en", f"s{i % 3}", 1, True, 1, "c") for i in range(800)]
    rows += [(5, "one row many times", "en", "s1", 1, True, 1, "c")] * 200
    table = docs(spark, rows)
    drawn = sample_repetitions(table.repartition(3), lane_docs=100)
    for r in drawn.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("repeats").alias("most")).collect():
        assert abs(r.taken - r.target) <= 8 and r.most <= 2  # half a word per lane
    counts = [
        sorted((r.text, r["count"]) for r in mix(table.repartition(n)).groupBy("text").count().collect()) for n in (2, 7)
    ]
    assert counts[0] == counts[1]


def test_query_against_its_targets(spark, sf_dir):
    from tandem.llm.queries import op9_mixture

    rows = op9_mixture(spark, sf_dir).collect()
    by_source = {}
    for r in rows:
        by_source.setdefault((r.source is None, r.source or ""), []).append(r)
    sizes = [sum(r["size"] for r in by_source[s]) for s in sorted(by_source)]
    targets = water_fill(sizes, [(3.0, 1.0, 2.0)[i % 3] for i in range(len(sizes))], 1.5 * sum(sizes), 2.0)
    for s, size, target in zip(sorted(by_source), sizes, targets):
        assert all(r.source_size == size and r.target == pytest.approx(target) for r in by_source[s])
        reachable = {0}
        for r in by_source[s]:
            reachable |= {x + k * r["size"] for x in reachable for k in (1, 2)}
        best = min(abs(x - target) for x in reachable)
        assert abs(sum(r.taken for r in by_source[s]) - target) == pytest.approx(best)
        assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in by_source[s])
