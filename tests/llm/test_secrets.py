import hashlib
import re

import public_tokenizers
import pytest

from tandem.llm.secrets import joined, pattern_spans, random_spans, scan_secrets

from .helpers import docs, odd_rows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def plain(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return spans + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]


TEXTS = [
    "token: token: abcdefg", "API_KEY = 'abc.def-1'", "PassWord==abcde", "apikey:x", 'é secret" : "0123456789abcdef0123456789abcdef"',
    "AKIA" + "B" * 16, "AKIA" + "B" * 15, "xAKIAAKIA" + "C" * 15 + " AKIA", "f" * 24, "f" * 23, "\U0001f600 passwd=hunter22 token=",
    "tOKEN=abcdef" * 3, "api-key=abcdefgh", "toKen=abcdef", "paſſword=abcdefgh",
]


def test_patterns():
    for text in TEXTS:
        assert sorted(pattern_spans(text)) == sorted(plain(text)), text


def scan(spark, texts):
    rows = [(i, t, *[None] * 6) for i, t in enumerate(texts)]
    found = scan_secrets(docs(spark, rows), RANKS, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    return [r.spans for r in found]


def test_random_strings_are_expensive(spark):
    key = "q7Zx9LmK2vRt8WbY4nJd1Hc6Gf3P"
    got = scan(spark, [
        f"use {key} here", "the internationalisation of characterisation", "my_long_variable_name_for_testing", "getHttpResponseHeaderValue",
        "0123456789ABCDEF0123456789ABCDEF", "123e4567-e89b-12d3-a456-426614174000", "path/to/some/file/of/interest", "=" * 60, f"token={key}",
        "Wörter und " + key + ", " + key,
    ])
    assert got == [f"random:4:{4 + len(key)}", "", "", "", "", "", "", "", f"assign:0:{6 + len(key)}", f"random:11:{11 + len(key)},random:{13 + len(key)}:{13 + 2 * len(key)}"]


def test_odd_rows(spark):
    rows = odd_rows(TEXTS + [None, "", "x " * 50_000 + "secret=abcdef"])
    got = scan_secrets(docs(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    want = sorted((repr(r[0]), hashlib.sha256(joined(plain(r[1] or "")).encode()).hexdigest(), [sum(k == kind for _, k, _ in plain(r[1] or "")) for kind in range(3)]) for r in rows)
    assert sorted((repr(r.doc_id), r.base_sha256, [r.n_assign, r.n_access, r.n_hex]) for r in got) == want
    assert scan_secrets(docs(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize("spans,text", [([], ""), ([(5, 2, 9), (1, 0, 3), (5, 0, 9)], "assign:1:3,assign:5:9,hex:5:9")])
def test_joined(spans, text):
    assert joined(spans) == text


def test_spans_are_walked_once():
    """Every candidate stands beside the spans already taken, which are looked at once however many there are."""

    class Looked(tuple):
        reads = 0

        def __getitem__(self, at):
            Looked.reads += 1
            return tuple.__getitem__(self, at)

    class Costly:
        def encode_ordinary(self, value):
            return list(value)

    key = "q7Zx9LmK2vRt8WbY4nJd1Hc6Gf3P"
    n = 2_000
    text = f"token=abcdef {key} " * n
    taken = [Looked(span) for span in pattern_spans(text)]
    found = random_spans(text, taken, Costly())
    assert len(taken) == n and [text[a:b] for a, _, b in found] == [key] * n
    assert Looked.reads <= 4 * n


@pytest.mark.parametrize("taken", [[(0, 0, 100)], [(0, 0, 3), (2, 1, 60), (10, 2, 20)], [(5, 0, 6)], [(3, 2, 4), (3, 0, 9)], [(33, 1, 40)], [(0, 0, 5)], []])
def test_overlaps(taken):
    class Costly:
        def encode_ordinary(self, value):
            return list(value)

    key = "q7Zx9LmK2vRt8WbY4nJd1Hc6Gf3P"
    text = f"say: {key} and {key}."
    places = [m.span() for m in re.finditer(key, text)]
    want = [(a, 3, b) for a, b in places if not any(s < b and a < e for s, _, e in taken)]
    assert random_spans(text, taken, Costly()) == want
