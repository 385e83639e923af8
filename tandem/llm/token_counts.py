"""Token counts: how many ids a tokenizer gives a text, without ever returning the ids.

An Arrow function takes the texts of a batch, cuts those that are long at white space, deals the
parts out to groups of about equal bytes, has the library encode each group as a batch and returns
only lengths. The tokenizer must drop white space, so that a blank is a boundary no token and no
special string crosses; hence a group goes to the library as its distinct words, without those whose
length the worker still knows, and never holds more of the library's output than a group has bytes for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.encoding import BlankFreeCounter

PART_CHARS = 1 << 16
GROUP_BYTES = 512 << 10


def safe_parts(text: str, part_chars: int = PART_CHARS) -> Iterator[str]:
    """A text in parts of about ``part_chars``, cut at spaces or line breaks; a part without any stays whole."""
    start = 0
    while len(text) - start > part_chars:
        cut = max(text.rfind(" ", start, start + part_chars), text.rfind("\n", start, start + part_chars))
        if cut <= start:
            ends = [at for at in (text.find(" ", start + part_chars), text.find("\n", start + part_chars)) if at >= 0]
            if not ends:
                break
            cut = min(ends)
        yield text[start:cut]
        start = cut
    yield text[start:]


def byte_groups(sizes: list[int], group_bytes: int = GROUP_BYTES) -> list[list[int]]:
    """Positions in groups of about equal bytes: largest first, each to the group with least so far."""
    count = max(1, -(-sum(sizes) // group_bytes))
    groups: list[list[int]] = [[] for _ in range(count)]
    filled = np.zeros(count, np.int64)
    for at in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        least = int(filled.argmin()) if count > 1 else 0
        groups[least].append(at)
        filled[least] += sizes[at]
    return groups


def token_counts(text: str | Column, tokenizer: str, part_chars: int = PART_CHARS) -> Column:
    """Column with the number of tokens of a text; 0 for NULL and empty texts."""

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = BlankFreeCounter(tokenizer)
        for batch in batches:
            totals = np.zeros(len(batch), np.int64)
            owners, parts = [], []
            for row, value in enumerate(batch):
                whole = value.as_py()
                if whole:
                    for part in safe_parts(whole, part_chars):
                        owners.append(row)
                        parts.append(part)
            for group in byte_groups([len(p.encode()) for p in parts]):
                for at, n in zip(group, counter.count([parts[at] for at in group])):
                    totals[owners[at]] += n
            yield pa.array(totals)

    count.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(count, "long")(F.col(text) if isinstance(text, str) else text)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int, part_chars: int = PART_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    NULL text has neither bytes nor tokens. Rows are neither joined nor shuffled: rows with the same
    id, or none, each keep their own counts. Other columns are ignored.
    """
    read = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), token_counts("text", tokenizer, part_chars).alias("n_tokens"))
    return read.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
