"""Benchmark decontamination: find test n-grams in training texts, drop the documents or cut the spans.

The benchmark's windows of normalised words become a hash set that is broadcast. A task maps the
words of a text to the benchmark's vocabulary, hashes only windows that lie wholly in it, looks the
hashes up and verifies every hit word by word. Documents are neither shuffled nor joined.

The set is bounded: a benchmark of more than ``windows_per_pass`` windows is dealt into as many sets
as it takes, the texts pass all of them, and the hits are put together before anything is decided.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.llm.common import word_list, worker_store

WINDOW = 13
WINDOWS_PER_PASS = 1_000_000
# A document is contaminated when one word in so many is hit.
RATIO = 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


@dataclass
class WindowSet:
    """Windows of a benchmark: vocabulary, hashes by window length, and the items of every window."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    items: dict[tuple[int, ...], set[str]] = field(default_factory=dict)
    hashes: dict[int, np.ndarray] = field(default_factory=dict)

    def add(self, window: list[bytes], items: list[str]) -> None:
        key = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in window)
        self.items.setdefault(key, set()).update(items)

    def close(self) -> WindowSet:
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for key in self.items:
            by_length.setdefault(len(key), []).append(key)
        self.hashes = {n: np.unique(_rolling(np.array(keys, np.uint64).T)) for n, keys in by_length.items()}
        return self


def _rolling(columns) -> np.ndarray:
    """Hash of windows given as their first words, second words, and so on."""
    value = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        value = (value ^ column) * _FACTOR
        value ^= value >> np.uint64(29)
    return value


def item_windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The windows of a benchmark item, words joined by a blank; an item of fewer words is one window."""
    words = word_list(text)
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def scan(words: list[bytes], windows: WindowSet) -> tuple[list[int], set[str]]:
    """Merged word spans [start, end) covered by windows, flat, and the items they belong to."""
    known = np.fromiter(map(windows.vocabulary.get, words, [0] * len(words)), np.uint64, len(words))
    inside = np.concatenate(([0], np.cumsum(known > 0)))
    covered = np.zeros(len(words) + 1, np.int64)
    items: set[str] = set()
    for size, hashes in windows.hashes.items():
        if len(words) < size:
            continue
        whole = np.flatnonzero(inside[size:] - inside[:-size] == size)
        if not len(whole):
            continue
        value = _rolling([known[whole + j] for j in range(size)])
        at = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
        for start in whole[hashes[at] == value]:
            found = windows.items.get(tuple(known[start : start + size].tolist()))
            if found is not None:
                items |= found
                covered[start] += 1
                covered[start + size] -= 1
    if not items:
        return [], items
    hit = np.concatenate(([0], np.cumsum(covered[:-1]) > 0, [0])).astype(np.int8)
    return np.flatnonzero(np.diff(hit)).tolist(), items


def window_sets(benchmark: DataFrame, window: int = WINDOW, windows_per_pass: int = WINDOWS_PER_PASS) -> list[WindowSet]:
    """Distinct windows of ``benchmark`` (item_id, text), in sets of about ``windows_per_pass`` at most.

    NULL texts and texts without words have none; a NULL item_id is written as the empty string.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, windows = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in item_windows(text, window):
                    items.append(item)
                    windows.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(windows, pa.binary())], ["item", "window"])

    cuts = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    grouped = cuts.mapInArrow(cut, "item string, window binary").groupBy("window").agg(F.collect_set("item").alias("items"))
    passes = max(1, -(-grouped.count() // windows_per_pass))
    sets = []
    for number in range(passes):
        chosen = WindowSet()
        for row in grouped.filter(F.pmod(F.xxhash64("window"), F.lit(passes)) == number).toLocalIterator():
            chosen.add(bytes(row["window"]).split(b" "), row["items"])
        sets.append(chosen.close())
    return sets


def _scanner(docs: DataFrame, windows: WindowSet):
    sent = docs.sparkSession.sparkContext.broadcast(windows)

    def run(texts: pa.Array) -> pa.Array:
        worker_store("decontaminate")
        n_words, spans, items = [], [], []
        for value in texts:
            words = word_list(value.as_py())
            found, of = scan(words, sent.value) if words else ([], set())
            n_words.append(len(words))
            spans.append(found)
            items.append(sorted(of))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
            ["n_words", "spans", "items"],
        )

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, _HITS)


def merged(spans: list[int]) -> list[int]:
    """Flat spans as the fewest flat spans that cover the same words, in order."""
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, windows_per_pass: int = WINDOWS_PER_PASS, into: str = "contamination") -> DataFrame:
    """``docs`` with one more column, ``into``: n_words, spans, items, n_hit, contaminated.

    ``spans`` are word positions [start, end), flat and merged; ``items`` are the item ids as sorted
    strings. NULL and empty texts have no words and no hits. Rows and other columns stay as they are;
    a column that is named like the new one is replaced.
    """
    sets = window_sets(benchmark, window, windows_per_pass)

    def finish(hits: pa.Array) -> pa.Array:
        rows = []
        for hit in hits.to_pylist():
            spans = merged([s for h in hit for s in h["spans"]])
            n_hit = sum(spans[1::2]) - sum(spans[::2])
            n_words = hit[0]["n_words"]
            rows.append(
                {
                    "n_words": n_words,
                    "spans": spans,
                    "items": sorted({i for h in hit for i in h["items"]}),
                    "n_hit": n_hit,
                    "contaminated": n_hit > 0 and RATIO * n_hit >= n_words,
                }
            )
        kind = pa.struct(
            [("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("n_hit", pa.int64()), ("contaminated", pa.bool_())]
        )
        return pa.array(rows, kind)

    finish.__annotations__ = {"hits": pa.Array, "return": pa.Array}
    result = F.arrow_udf(finish, "n_words long, spans array<int>, items array<string>, n_hit long, contaminated boolean")
    return docs.withColumn(into, result(F.array(*[_scanner(docs, s)(docs["text"]) for s in sets])))


def items_sha256(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def without_spans(text: str, spans: list[int]) -> str:
    """A text without the words in ``spans`` and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    out.append(text[at:])
    return "".join(out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``) or without the hit spans (``"spans"``).

    With ``"spans"`` every row stays and only texts with hits change. Columns stay as they are.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    hits = find_hits(docs, benchmark, window, into="__hits")
    if remove == "documents":
        return hits.filter(~F.col("__hits.contaminated")).select(*docs.columns)

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([without_spans(t, s) if s else t for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())

    cut.__annotations__ = {"texts": pa.Array, "spans": pa.Array, "return": pa.Array}
    return hits.withColumn("text", F.arrow_udf(cut, "string")("text", "__hits.spans")).select(*docs.columns)
