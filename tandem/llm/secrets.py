"""Secret scan: fixed patterns, and strings that a language tokenizer finds expensive.

Text of a language costs few tokens per character, since the vocabulary was made of such text; a
random key costs many. A string of key-like characters is reported when its ratio of characters to
tokens is low and it is neither a digest, nor an identifier, nor already inside a pattern's span.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import worker_store

# Fixed patterns: kind, expression, group that counts, least length of that group.
PATTERNS = (
    ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
KINDS = ("assign", "access", "hex", "random")

RATIO = 2.2
LEAST_CHARS = 20
LEAST_CLASSES = 2
DIGEST_CHARS = (32, 40, 56, 64, 96, 128)

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_CHARS)
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORD = re.compile("password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
# Words, numbers and single separators in turn: names of files, variables, pages.
_IDENTIFIER = re.compile(r"[A-Z]?[a-z]+(?:[A-Z][a-z]+)*\d{0,4}(?:[-_/=+][A-Z]?[a-z]+(?:[A-Z][a-z]+)*\d{0,4}|[-_/=+]\d{1,8})*[-_/=+]?")
_DIGEST = re.compile(r"[0-9a-fA-F]+")
_RUN = re.compile(r"(.)\1{7}")


def _encoding(path: str, pattern: str):
    store = worker_store("encoding")
    if ("tiktoken", path) not in store:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        store["tiktoken", path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return store["tiktoken", path]


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of the fixed patterns as (start, index of the kind, end), unsorted."""
    spans = []
    for index, (_, pattern, group, least) in enumerate(PATTERNS):
        if index == 0 and not _KEYWORD.search(text) or index == 1 and "AKIA" not in text:
            continue
        # A run of hexadecimal digits is found by its length at once, the others are matched and then judged.
        found = _HEX.finditer(text) if index == 2 else re.finditer(pattern, text)
        spans += [(m.start(), index, m.end()) for m in found if m.end(group) - m.start(group) >= least]
    return spans


def is_known(value: str) -> bool:
    """Digests by length, identifiers, and strings that repeat themselves."""
    if _UUID.fullmatch(value) or _IDENTIFIER.fullmatch(value) or _RUN.search(value):
        return True
    return bool(_DIGEST.fullmatch(value)) and (len(value) in DIGEST_CHARS or value.isdigit())


def _classes(value: str) -> int:
    return any(map(str.islower, value)) + any(map(str.isupper, value)) + any(map(str.isdigit, value))


def random_spans(text: str, taken: list[tuple[int, int, int]], encoding, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """Spans of expensive strings that overlap none of ``taken``; candidates and ``taken`` are walked once, side by side."""
    spans: list[tuple[int, int, int]] = []
    ordered = sorted(taken)
    at, reach = 0, 0  # ``reach`` is the furthest end of the spans that start before the candidate ends
    for m in _CANDIDATE.finditer(text):
        while at < len(ordered) and ordered[at][0] < m.end():
            reach = max(reach, ordered[at][2])
            at += 1
        if reach > m.start():
            continue
        value = m.group()
        if _classes(value) < LEAST_CLASSES or is_known(value):
            continue
        if len(value) / len(encoding.encode_ordinary(value)) < ratio:
            spans.append((m.start(), 3, m.end()))
    return spans


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan_secrets(docs: DataFrame, ranks: str, pattern: str, ratio: float = RATIO) -> DataFrame:
    """doc_id, counts per kind, base_sha256 and spans of every row.

    Spans are ``kind:start:end`` in code points, end exclusive, sorted by start and then by kind in
    the order assign, access, hex, random; ``base_sha256`` covers the first three kinds. NULL and
    empty texts have none. ``ranks`` is the path of a vocabulary and ``pattern`` its splitting rule.
    Rows are neither joined nor shuffled: rows with the same id, or none, each get their result.
    Other columns are ignored.
    """

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding = _encoding(ranks, pattern)
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            hashes, all_spans = [], []
            for value in batch:
                text = value.as_py() or ""
                base = pattern_spans(text)
                extra = random_spans(text, base, encoding, ratio)
                for kind in range(4):
                    counts[kind].append(sum(s[1] == kind for s in (*base, *extra)))
                hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
                all_spans.append(joined(base + extra))
            columns = [*(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(all_spans, pa.string())]
            yield pa.StructArray.from_arrays(columns, names)

    names = ["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
    scan.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    kind = "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return docs.select("doc_id", F.arrow_udf(scan, kind)("text").alias("s")).select("doc_id", "s.*")
