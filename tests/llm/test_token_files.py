import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tandem.llm.encoding import BlankFreeCounter, SpacedEncoder
from tandem.llm.token_counts import byte_groups, count_tokens, safe_parts
from tandem.llm.token_files import pack_blocks, read_segment, read_token_files, segment_image, unpack_blocks, write_token_files

from .helpers import docs, odd_rows

SPACED = public_tokenizers.path("byte_bpe_50k.json")
BLANK_FREE = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [
    " ", "  ", "\n", "\t", "\r\n", " \n", "\x1c", "\x85", " ", "　", "́", "a", "bc", "The", "É", "İ", "ß", "'s", "don't", "1", "23",
    ".", ",", "_", "-", "<|endoftext|>", "<|startoftext|>", "<|", "日本", "🙂", "ΑΣ",
]


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(SPACED), Tokenizer.from_file(BLANK_FREE)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=25).map("".join))
def test_pieces_give_what_the_library_gives(libraries, text):
    spaced, blank_free = libraries
    assert SpacedEncoder(SPACED).ids(text).tolist() == spaced.encode(text, add_special_tokens=False).ids
    assert BlankFreeCounter(BLANK_FREE).count([text, "", text]) == [len(blank_free.encode(t, add_special_tokens=False).ids) for t in (text, "", text)]


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3_000])
@pytest.mark.parametrize("top", [1, 2, 300, 50_257, 2**32 - 1])
@pytest.mark.parametrize("percentile", [0, 50, 90, 100])
def test_blocks_round_trip(n, top, percentile):
    ids = np.random.default_rng(n).integers(0, top, n).astype("<u4")
    ids[::50] = top - 1
    packed = pack_blocks(ids, percentile)
    assert (unpack_blocks(*packed, n) == ids).all()
    if percentile == 100:
        assert not packed[2].any()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(128, dtype="<u4") % 16
    ids[5] = 4_000_000_000
    _, widths, exceptions, starts, _ = pack_blocks(ids)
    assert (widths[0], exceptions[0], starts[-1]) == (4, 1, 4 * 16 + 5)


def test_segment_keeps_missing_ids_and_empty_documents():
    encoded = [np.array(v, "<u4") for v in ([3, 2, 1], [], [7])]
    ids, at, values = read_segment(segment_image([None, 4, 4], encoded))
    assert (ids, at.tolist(), values.tolist()) == ([None, 4, 4], [0, 3, 3, 4], [3, 2, 1, 7])


@pytest.mark.parametrize("segment_ids", [5, 1 << 20])
def test_files_of_odd_rows(spark, tmp_path, libraries, segment_ids):
    rows = odd_rows()
    write_token_files(docs(spark, rows).repartition(3), str(tmp_path), SPACED, segment_ids=segment_ids, partitions=3)
    got = [tuple(r) for r in read_token_files(spark, str(tmp_path)).collect()]
    start, want = 0, []
    for doc_id, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = libraries[0].encode(text or "", add_special_tokens=False).ids + [0]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_empty_table(spark, tmp_path):
    write_token_files(docs(spark, []), str(tmp_path), SPACED)
    assert read_token_files(spark, str(tmp_path)).collect() == []
    assert count_tokens(docs(spark, []), BLANK_FREE, 5).collect() == []


def test_counts_of_odd_rows(spark, libraries):
    rows = odd_rows()
    got = count_tokens(docs(spark, rows), BLANK_FREE, 5, part_chars=64).collect()
    want = [(r[0], len((r[1] or "").encode()), len(libraries[1].encode(r[1] or "", add_special_tokens=False))) for r in rows]
    assert sorted(map(repr, got)) == sorted(repr(g) for g in got)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.over_limit == (r.n_tokens > 5) for r in got)


def test_parts_are_cut_at_blanks_only():
    text = "ab cd\nef " * 10 + "x" * 50 + " y"
    parts = list(safe_parts(text, 8))
    assert "".join(parts) == text
    assert all(p[0] in " \n" for p in parts[1:])
    assert any("x" * 50 in p for p in parts)


def test_groups_hold_about_equal_bytes():
    sizes = [90, 1, 1, 50, 40, 30, 5]
    groups = byte_groups(sizes, 110)
    assert sorted(i for g in groups for i in g) == list(range(7))
    assert max(sum(sizes[i] for i in g) for g in groups) <= 120


def test_rows_of_one_id_and_of_none_are_dealt_to_many_tasks(spark, tmp_path):
    """A third of the rows has one id, a third none, and half of each is one text: no task gets much more than others."""
    rows = [(i if i % 3 == 0 else 7 if i % 3 == 1 else None, "the same text" if i % 2 else f"{i} of many") for i in range(1_200)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    write_token_files(table, str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"), partitions=12)
    counts = [r.n for r in read_token_files(spark, str(tmp_path / "t"), with_ids=False).groupBy("doc_id").count().selectExpr("count AS n").collect()]
    assert sum(counts) == 1_200
    parts = [r["n"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy("part").sum("n_ids").withColumnRenamed("sum(n_ids)", "n").collect()]
    assert len(parts) == 12 and max(parts) < 3 * sum(parts) / 12


def test_old_pieces_come_back():
    from tandem.llm import encoding

    encoded = []
    pieces = encoding._Pieces(lambda piece: encoded.append(piece) or piece.upper())
    for i in range(encoding.CACHE_PIECES + 1):
        pieces[str(i)]
    pieces.trim()
    assert not len(pieces) and pieces["5"] == "5" and encoded.count("5") == 1
    assert pieces["x" * 41] == "X" * 41 and "x" * 41 not in pieces


def test_new_words_are_encoded_as_one_batch():
    counter = BlankFreeCounter(BLANK_FREE)
    library, batches = counter.tokenizer, []

    class Watched:
        def encode_batch(self, words, add_special_tokens):
            batches.append(sorted(words))
            return library.encode_batch(words, add_special_tokens=add_special_tokens)

    counter.tokenizer = Watched()
    counter.known.clear()
    counter.known.old = {}
    long = "unrepeatable" * 10
    first = counter.count([f"one two {long}", "two three"])
    assert batches == [sorted(["one", "two", long, "three"])]
    assert counter.count([f"one two {long}", "two three"]) == first
    assert batches[1:] == [[long]]  # too long to be kept
    counter.known.old, _ = dict(counter.known), counter.known.clear()
    assert counter.count(["two three"]) == first[1:] and batches[2:] == [[]]


def test_texts_of_a_group_are_cut_and_encoded_together(libraries, monkeypatch):
    """New plain words go to the library as one string without splitting, what else is new as another; what is known does not."""
    from tandem.llm import encoding

    library, texts = libraries[0], ["The of zqa, don't 12\nzqb of. " + "x" * 50, None, "", "été of zqa a  b", "of <|endoftext|> zqa", "zqb,"]
    monkeypatch.setattr(encoding, "worker_store", lambda owner, store={}: store)
    encoder = SpacedEncoder(SPACED)
    assert encoder.unsplit is not encoder.tokenizer
    given_to = {"unsplit": [], "tokenizer": []}

    class Watched:
        def __init__(self, name):
            self.name, self.inner = name, getattr(encoder, name)

        def encode_batch_fast(self, texts, add_special_tokens):
            given_to[self.name] += texts
            return self.inner.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

        def encode(self, text, add_special_tokens):
            return self.inner.encode(text, add_special_tokens=add_special_tokens)

    encoder.unsplit, encoder.tokenizer = Watched("unsplit"), Watched("tokenizer")
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [i.tolist() for i in encoder.ids_of(pa.array(texts))] == want
    once = [piece for given in given_to.values() for text in given for piece in re.findall(r"[ \n][^ \n]+", text)]
    assert len(once) == len(set(once)) and {" of", "\nof", "\nzqb", " 12"} <= set(once) and not {" of.", "\nzqb,"} & set(once)
    assert len(given_to["unsplit"]) == 2 and len(given_to["tokenizer"]) == 1  # the long word is one by itself
    given_to["unsplit"].clear(), given_to["tokenizer"].clear()
    assert [i.tolist() for i in encoder.ids_of(pa.array(texts, pa.large_string()))] == want
    assert given_to == {"unsplit": [" " + "x" * 50], "tokenizer": []}
    assert max(map(len, encoder.store["pool"].slots)) <= encoding.CACHED_CHARS
    blank = ["new\n\nwords", " new words", "new words\n"]  # not cut at single blanks, so nothing is learned from them
    assert [i.tolist() for i in encoder.ids_of(pa.array(blank))] == [library.encode(t, add_special_tokens=False).ids for t in blank]
    assert given_to["unsplit"] == [" " + "x" * 50] and "words" not in encoder.store["pool"].slots


def test_pieces_of_the_old_generation_come_back(libraries, monkeypatch):
    from tandem.llm import encoding

    monkeypatch.setattr(encoding, "POOL_PIECES", 3)
    monkeypatch.setattr(encoding, "GROUP_BYTES", 16)
    texts = [f"word{chr(97 + i % 7)}, of w{'abc'[i % 3]}\nof É{'x' * (i % 5)}." + " y" * (i % 4) for i in range(60)]
    assert [i.tolist() for i in SpacedEncoder(SPACED).ids_of(pa.array(texts))] == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_split_where_tokens_join_them_to_blanks(libraries):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from tandem.llm import encoding

    vocabulary = libraries[0].get_vocab()
    assert encoding._unsplit(libraries[0], vocabulary) is not libraries[0]
    for token in ("a\u0120b", "\u010aa", "a\u010a"):
        assert encoding._unsplit(libraries[0], {**vocabulary, token: 50_257}) is libraries[0]
    other = Tokenizer(models.BPE(ignore_merges=True))
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    assert encoding._unsplit(other, {}) is other


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=12).map("".join), min_size=1, max_size=8))
def test_groups_give_what_the_library_gives(libraries, texts):
    assert [i.tolist() for i in SpacedEncoder(SPACED).ids_of(pa.array(texts, pa.string()))] == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]
