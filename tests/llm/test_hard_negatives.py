import math
import random

import numpy as np
import pytest

from tandem.llm.hard_negatives import Packing, best, mine_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, slot int"


def brute(rows, every=100, count=5):
    """Rows of the result; every row stands for its id once."""
    table = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        x = tuple(math.floor(256 * float(np.float32(v))) for v in vector)
        entry = ((label + 1) % 10 if vec_id % 7 == 0 else label, x)
        table[vec_id] = min(entry, table.get(vec_id, entry))
    out = []
    for anchor, (label, x) in table.items():
        if anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i, mark == label) for i, (mark, y) in table.items() if i != anchor)
        for score, positive, _ in [s for s in scored if s[2]][:count]:
            near = [s for s in scored if not s[2] and 80 * -score <= 100 * -s[0] <= 100 * -score][:count]
            out += [(anchor, positive, rank, s[1], -score, -s[0]) for rank, s in enumerate(near, 1)]
    return sorted(out)


def check(spark, rows, **options):
    table = spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA).repartition(3)
    got = mine_negatives(table, **options)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def vectors(rng, ids, dims=16, scale=0.4):
    return [(i, [rng.uniform(-scale, scale) for _ in range(dims)], rng.randrange(3)) for i in ids]


@pytest.mark.parametrize("pass_anchors", [3, 8_192])
def test_against_all_pairs(spark, pass_anchors):
    check(spark, vectors(random.Random(2), range(0, 3_000, 5)), pass_anchors=pass_anchors)


def test_ties_and_one_vector_everywhere(spark):
    rng = random.Random(3)
    same = [(i, [0.25] * 8, i % 4) for i in range(0, 900, 3)]
    check(spark, same + vectors(rng, range(1, 300, 3), 8))


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = vectors(rng, range(0, 400, 4), 6)
    rows += [(None, [1.0] * 6, 1), (401, None, 1), (402, [1.0, None], 1), (403, [float("nan")] * 6, 1), (404, [float("inf")] * 6, 1), (405, [0.5] * 6, None)]
    rows += [(500, [], 1), (501, [0.5], 1), (502, [0.5] * 9, 2), (-100, [0.1] * 6, 2), (-7, [0.3] * 6, 2), (-3, [0.3] * 6, -4)]
    rows += [rows[0], (0, [9.0] * 6, 2), (8, [0.5] * 6, 0)]  # a row twice, and other rows of its id
    check(spark, rows)
    check(spark, [])
    check(spark, [(1, [0.5], 1)])
    check(spark, [(100, [0.5], 1), (200, [0.0], 2)])


def test_components_that_need_wide_integers(spark):
    rng = random.Random(5)
    check(spark, vectors(rng, range(0, 600, 10), 4, 3e5))
    check(spark, [(i, [rng.choice([-1, 1]) * 2.0**20, 0.5], i % 2) for i in range(0, 300, 10)])


def test_products_beyond_64_bits_raise(spark):
    rows = spark.createDataFrame([(i, [1e30, 1.0], 1) for i in (100, 101)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="does not fit 64 bits"):
        mine_negatives(rows).collect()


@pytest.mark.parametrize("low, high, fields", [(-160, 155, 2), (0, 1, 7), (-2, 2, 4), (-(2**20), 2**20, 1), (-(2**31), 2**31, 64)])
def test_packed_products_are_exact(low, high, fields):
    rng = np.random.default_rng(7)
    packing = Packing(64, low, high)
    assert packing.fields == fields
    a, b = (rng.integers(low, high, (n, 64), endpoint=True) for n in (5, 23))
    a[0], b[0], b[1] = low, low, high
    kind = np.int64 if packing.exact_doubles else object
    want = a.astype(object) @ b.astype(object).T
    if max(abs(int(v)) for v in want.ravel()) < 2**63:
        assert (packing.scores(a.astype(kind), b.astype(kind)) == want).all()


def test_best_takes_the_first_of_equal_scores():
    scores = np.array([[3, 1, 3, 3, 2], [0, 0, 0, 0, 0]])
    take = np.array([[True, True, False, True, True], [False, True, False, False, True]])
    row, column = best(scores, take, 2)
    assert list(zip(row.tolist(), column.tolist())) == [(0, 0), (0, 3), (1, 1), (1, 4)]


def test_query_against_all_pairs(spark, sf_dir):
    from tandem.llm.queries import op13_hard_negatives

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(map(tuple, op13_hard_negatives(spark, sf_dir).collect()))
    assert got and got == brute(rows)
