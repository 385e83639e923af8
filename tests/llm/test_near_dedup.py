import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import tandem.llm.near_dedup as near
from tandem.llm.near_dedup import CHUNKS, COMPONENTS, DISTANCE, components, drop_near_duplicates, index_keys, near_duplicates, shingle_set, signature

from .helpers import docs, odd_rows, prose


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size=5):
    """Component per row: rows of one id, and sets of similarity 0.8, are linked."""
    sets = [shingles(r[1], size) for r in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            common = len(sets[i] & sets[j])
            near_enough = common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common)
            if near_enough or rows[i][0] == rows[j][0] and sets[i] and sets[j]:
                label[root(i)] = root(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[root(i)] = min(r[0], smallest.get(root(i), r[0]))
    component = [None if r[0] is None else smallest[root(i)] for i, r in enumerate(rows)]
    return [(r[0], len(s), c, r[0] is None or r[0] == c) for r, s, c in zip(rows, sets, component)]


def check(spark, rows, size=2):
    got = sorted(repr(tuple(r)) for r in near_duplicates(docs(spark, rows).repartition(3), size).collect())
    assert got == sorted(map(repr, brute(rows, size)))


def edited(rng, words, share):
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_near_copies_of_every_distance(spark):
    rng, texts = random.Random(3), []
    for _ in range(12):
        base = prose(rng, rng.choice([12, 60, 300]))
        texts += [" ".join(edited(rng, base, share)) for share in (0, 0.02, 0.04, 0.05, 0.06, 0.08, 0.15)]
    rng.shuffle(texts)
    check(spark, [(i, t, None, None, None, None, None, None) for i, t in enumerate(texts)])


@pytest.mark.parametrize("edges", [40, 200_000])
def test_group_in_which_only_some_are_linked(spark, monkeypatch, edges):
    """Variants of one text, half of them beyond the threshold of each other, with edges for many tasks and for one."""
    monkeypatch.setattr(near, "CONTRACT_EDGES", edges)
    rng = random.Random(8)
    base = prose(rng, 150)
    texts = [" ".join(edited(rng, base, rng.choice([0.04, 0.07, 0.1]))) for _ in range(60)]
    check(spark, [(1_000 - i, t, None, None, None, None, None, None) for i, t in enumerate(texts)])


def test_odd_rows(spark):
    check(spark, odd_rows())
    check(spark, odd_rows(["one", "One", "one two", "two\x0bone", "", None]))
    check(spark, [])


def test_rows_of_one_id_are_one_document(spark):
    rng = random.Random(6)
    a, b = " ".join(prose(rng, 40)), " ".join(prose(rng, 40))
    rows = [(5, a, *[None] * 6), (5, b, *[None] * 6), (2, a, *[None] * 6), (7, b, *[None] * 6), (8, a + " z", *[None] * 6)]
    check(spark, rows)


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(2)
    base = prose(rng, 80)
    rows = odd_rows([" ".join(edited(rng, base, 0.01)) for _ in range(5)] + [" ".join(prose(rng, 50)), "", None])
    table = docs(spark, rows)
    left = drop_near_duplicates(table, 2)
    assert left.columns == table.columns
    assert sorted(left.agg(F.collect_list("doc_id")).first()[0]) == [0, 5, 6, 7]
    assert left.filter("doc_id IS NULL").count() == 1


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(1)
    for errors in range(DISTANCE + 1):
        one = rng.integers(0, 1 << near.BITS, COMPONENTS).astype(np.uint16)
        other = one.copy()
        other[rng.permutation(COMPONENTS)[:errors]] ^= 1
        keys = index_keys(np.stack([one, other]))
        assert set(keys[0]) & set(keys[1]), errors
    spread = one.copy()
    spread[[c * near.CHUNK + i for c in range(CHUNKS) for i in (0, 1)]] ^= 1  # one error more than the distance
    keys = index_keys(np.stack([one, spread]))
    assert not set(keys[0]) & set(keys[1])


def test_signatures_estimate_similarity():
    rng = random.Random(9)
    base = prose(rng, 4_000, 10**6)
    a, b = shingle_set(" ".join(base)), shingle_set(" ".join(base[:3_000] + prose(rng, 1_000, 10**6)))
    similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a) == signature(b)).mean() - similarity) < 0.25
    assert len(shingle_set(None)) == 0 and len(shingle_set("A")) == 1 and len(shingle_set("a b A B a b", 2)) == 2


@pytest.mark.parametrize("edges", [30, 200_000])
def test_components_of_a_long_chain(spark, monkeypatch, edges):
    monkeypatch.setattr(near, "CONTRACT_EDGES", edges)
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(900, 901), (901, 900)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_links_beyond_the_distance_are_found_by_a_shared_key(spark):
    """Pairs of similarity just above 0.8 whose signatures differ in more than 15 components: each stands alone."""
    rng, rows = random.Random(41), []
    while len(rows) < 8:
        base = [f"u{rng.randrange(10**9)}" for _ in range(150)]
        other = list(base)
        for at in rng.sample(range(75), 8):
            other[2 * at + 1 - (at == 74)] = f"v{rng.randrange(10**9)}"
        a, b = shingle_set(" ".join(base), 2), shingle_set(" ".join(other), 2)
        common = len(np.intersect1d(a, b))
        one, two = signature(a), signature(b)
        shared = set(index_keys(one[None])[0]) & set(index_keys(two[None])[0])
        if 100 * common >= 80 * (len(a) + len(b) - common) and (one != two).sum() > DISTANCE and shared:
            rows += [(len(rows), " ".join(base), *[None] * 6), (len(rows) + 1, " ".join(other), *[None] * 6)]
    check(spark, rows)
    assert near_duplicates(docs(spark, rows), 2).filter("NOT kept").count() == 4


def test_pipeline_stage_takes_five_words(spark):
    """The stage against plain sets of five-word shingles; two words would drop ten documents more."""
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    words = [(t or "").encode().lower().split() for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                label = [label[j] if x == label[i] else x for x in label]
    smallest = {}
    for (doc_id, _), x in zip(rows, label):
        smallest[x] = min(doc_id, smallest.get(x, doc_id))
    left = corpus_pipeline.near_duplicates(spark, table, sf_dir)
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == sorted(smallest.values())


def test_edges_per_document_do_not_grow_with_the_group(spark):
    """Variants of one text: what the tasks report is a forest, whatever the number of keys they share."""
    rng, counts = random.Random(11), []
    base = prose(rng, 120)
    for n in (100, 400):
        sets = [shingle_set(" ".join(edited(rng, base, 0.05))) for _ in range(n)]
        keys = index_keys(np.stack([signature(s) for s in sets]))
        open_ = spark.createDataFrame([(int(k), i, len(s)) for i, s in enumerate(sets) for k in keys[i]], "key long, node long, n long")
        counts.append(near._chains(open_.coalesce(1), 80).count())
        assert counts[-1] <= 5 * n
    assert counts[1] <= 5 * counts[0]


def test_query_against_brute_force(spark, sf_dir):
    from tandem.llm.queries import op6_near_dedup

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op6_near_dedup(spark, sf_dir).collect())) == sorted(brute(rows, 2))
