import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tandem.llm.exact_dedup import QuotientFilter, count_pairs, mark_copies, merge_filters, repeated_fingerprints

from .helpers import docs, odd_rows


@pytest.mark.parametrize("size,n", [(1, 0), (1, 50), (64, 1), (64, 20), (64, 5_000)])
def test_filter_lists_what_it_was_given(size, n):
    rng = np.random.default_rng(n)
    pairs = count_pairs(rng.integers(0, size, n), rng.integers(0, 40, n).astype(np.uint64), np.ones(n, np.int64))
    filter_ = QuotientFilter.from_bytes(QuotientFilter.build(*pairs, size=size).to_bytes())
    assert all((a == b).all() for a, b in zip(filter_.triples(), pairs))


def test_filters_merge_without_loss():
    rng = np.random.default_rng(2)
    values = [(rng.integers(0, 16, 300), rng.integers(0, 30, 300).astype(np.uint64)) for _ in range(5)]
    built = [QuotientFilter.build(*count_pairs(q, r, np.ones(300, np.int64)), size=16) for q, r in values]
    want = Counter((int(q), int(r)) for qs, rs in values for q, r in zip(qs, rs))
    got = merge_filters(built).triples()
    assert {(int(q), int(r)): int(c) for q, r, c in zip(*got)} == want


@pytest.mark.parametrize("ranges", [1, 3, 100])
def test_repeated_fingerprints(spark, ranges):
    rng = random.Random(4)
    values = [rng.randrange(-(2**63), 2**63) for _ in range(400)]
    values += values[:50] + [values[0]] * 700 + [-1, -1, 2**63 - 1, 0, 0, -(2**63), -(2**63)]
    table = spark.createDataFrame([(v,) for v in values], "fp long").repartition(3)
    want = sorted(v for v, n in Counter(values).items() if n > 1)
    assert sorted(r.fp for r in repeated_fingerprints(table, ranges).collect()) == want


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")].append((row[0], len(row[1] or "")))
    out = []
    for normal, members in groups.items():
        keep, points = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        sha = hashlib.sha256(normal.encode()).hexdigest()
        out += [(i, keep, len(members), (i, n) == (keep, points), sha) for i, n in members]
    return sorted(map(repr, out))


def test_copies(spark):
    rows = odd_rows() + odd_rows(["a b", "a  b", "ab", "é é", "é\x0bé", "A b", " ab"])
    rows = [(r[0] if i % 11 else None, *r[1:]) for i, r in enumerate(rows)]
    assert sorted(repr(tuple(r)) for r in mark_copies(docs(spark, rows).repartition(4)).collect()) == brute(rows)


def test_no_rows_and_no_copies(spark):
    assert mark_copies(docs(spark, [])).collect() == []
    assert [tuple(r)[1:4] for r in mark_copies(docs(spark, odd_rows()[:1])).collect()] == [(0, 1, True)]
