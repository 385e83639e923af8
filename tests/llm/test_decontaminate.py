import random
import re

import pytest
from pyspark.sql import functions as F

from tandem.llm.decontaminate import decontaminate, find_hits, item_windows, without_spans

from .helpers import docs, odd_rows, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    got, hit, found = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        for i in range(max(1, len(w) - 12)) if w else ():
            window = w[i : i + 13]
            for j in range(len(got) - len(window) + 1):
                if got[j : j + len(window)] == window:
                    hit.update(range(j, j + len(window)))
                    found.add("" if item_id is None else str(item_id))
    return len(got), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(got)


@pytest.fixture
def case(spark):
    rng = random.Random(5)
    long_item, other = prose(rng, 30), prose(rng, 14)
    items = [(10, " ".join(long_item).upper()), (9, " ".join(other)), (None, "Éclair, von"), (2, None), (3, "..."), (4, " ".join(long_item[5:20]))]
    texts = [
        " ".join(prose(rng, 40) + long_item[3:25] + prose(rng, 10)),
        "; ".join(long_item[:12]),
        " ".join(prose(rng, 600) + other),
        "un Éclair\nvon hier",
        "un éclair von hier",
        "éclair von. Éclair von",
        "",
        None,
        " ".join(prose(rng, 3_000)),
    ]
    return odd_rows(texts), items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("windows_per_pass", [7, 1_000])
def test_hits(spark, case, windows_per_pass):
    rows, items, benchmark = case
    hits = find_hits(docs(spark, rows), benchmark, windows_per_pass=windows_per_pass)
    c = F.col("contamination")
    got = hits.select("doc_id", c.n_words, c.n_hit, c["items"], c.contaminated).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], *brute(r[1], items))) for r in rows)


def test_documents_and_spans_are_removed(spark, case):
    rows, items, benchmark = case
    table = docs(spark, rows)
    kept = decontaminate(table, benchmark)
    assert kept.columns == table.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(repr(r) for r in rows if not brute(r[1], items)[3])
    cut = decontaminate(table, benchmark, remove="spans")
    assert cut.count() == len(rows)
    assert all(brute(r.text, items[:3])[1] == 0 for r in cut.collect() if r.doc_id != 5)
    with pytest.raises(ValueError):
        decontaminate(table, benchmark, remove="words")


def test_nothing_to_look_for(spark, case):
    rows, _, benchmark = case
    assert find_hits(docs(spark, rows), benchmark.limit(0)).filter("contamination.n_hit > 0").count() == 0
    assert find_hits(docs(spark, []), benchmark).collect() == []


def test_windows_and_cutting():
    assert item_windows("A b, c") == [b"a b c"] and item_windows(" .") == [] and item_windows(None) == []
    assert len(item_windows("x " * 15)) == 3
    assert without_spans("One, two: three four", [1, 3]) == "One,  four"
