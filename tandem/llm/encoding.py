"""Token ids of whole texts, by the tokenizers library, with repeated pieces encoded once.

The library spends nearly all its time on its general machinery of normalising, splitting and
aligning. Texts repeat their words, so texts are cut where the tokenizer's own splitting rule cannot
join what is on either side, every distinct piece is encoded by the library once per worker, and the
results are put together. Arrow cuts the texts of a group and finds its distinct pieces, those that
are new to the worker go to the library together, and the ids of all texts are gathered from theirs.
Texts in which such cuts could matter go through the library whole.
A cache is bounded, and only saves time: when its young generation is full, it becomes the old one,
from which pieces that occur again come back; those that do not are forgotten.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import repeat
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tandem.llm.common import within, worker_store

CACHE_PIECES = 250_000
# Pieces of texts that are cut in groups, in each of two generations.
POOL_PIECES = 400_000
# Longer pieces are hardly ever repeated and are not kept.
CACHED_CHARS = 40
# Texts that are cut at once, and new pieces that the library gets as one string.
GROUP_BYTES = 1 << 20
JOINED_WORDS = 100
JOINED_PIECES = 2_000

# A word of these letters is one split by the rules of both vocabularies, and a mark after it is another.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_ENDS = ".,;:!?"
_PLAIN = re.compile(f"\n?[{_LETTERS}]+")
_EMPTY_PIECE = r"[ \n][ \n]|^[ \n]|[ \n]$"
_BEFORE_SPACE = re.compile(r"(?= \S)")


# How byte-level vocabularies write the space and the line break.
_BLANKS = ("\u0120", "\u010a")


class _Pieces(dict):
    """Encoded pieces by text; a missing one is taken from the old generation or encoded."""

    def __init__(self, encode: Callable[[str], Any]) -> None:
        self.encode = encode
        self.old: dict[str, Any] = {}

    def __missing__(self, piece: str) -> Any:
        if piece in self.old:
            value = self.old[piece]
        else:
            value = self.encode(piece)
            if len(piece) > CACHED_CHARS:
                return value
        self[piece] = value
        return value

    def trim(self) -> None:
        if len(self) > CACHE_PIECES:
            self.old = dict(self)
            self.clear()


def _specials(tokenizer) -> re.Pattern[str]:
    return re.compile("|".join(re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()) or r"(?!)")


def _library(path: str):
    store = worker_store("encoding")
    if path not in store:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        store[path] = Tokenizer.from_file(path)
    return store[path]


def _unsplit(tokenizer, vocabulary: dict[str, int]):
    """The tokenizer's model without its splitting, for plain words that each follow a blank; itself where that could matter.

    It can't if no token joins such a word to the blank after it or to a line break, as then no merge does.
    """
    from tokenizers import Tokenizer, models, pre_tokenizers

    model, bytes_only = tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    if tokenizer.normalizer is not None or not isinstance(model, models.BPE) or model.ignore_merges or model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix:
        return tokenizer
    letters = "".join(set(bytes_only.pre_tokenize_str("".join(re.findall(f"[{_LETTERS}]", "".join(map(chr, range(256))))))[0][0]))
    space, line_break = _BLANKS
    joins = re.compile(f"[{letters}][{space}{line_break}]|{line_break}[{letters}]")
    if any(joins.search(token) and not token.strip(letters + space + line_break) for token in vocabulary):
        return tokenizer
    unsplit = Tokenizer(model)
    unsplit.pre_tokenizer = bytes_only
    return unsplit


class _Pool:
    """Ids of pieces: where those of each begin in one array, and how many they are; -1 where a piece can't be cut out.

    The first pieces have no names. Pieces too long to be kept are the last, until they are forgotten.
    """

    def __init__(self, nameless: list[np.ndarray]) -> None:
        self.slots: dict[str, int] = {}
        self.starts = self.sizes = np.empty(0, np.int64)
        self.ids = np.empty(0, "<u4")
        self.put([], np.array([len(e) for e in nameless]), np.concatenate(nameless))

    def put(self, pieces: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.slots.update(zip(pieces, range(len(self.sizes), len(self.sizes) + len(pieces))))
        counts = np.maximum(sizes, 0)
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(counts) - counts))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, ids))

    def find(self, pieces: np.ndarray) -> np.ndarray:
        return np.fromiter(map(self.slots.get, pieces, repeat(-1)), np.int64, len(pieces))

    def get(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the pieces in these slots, and their ids one after the other."""
        sizes = self.sizes[slots]
        return sizes, self.ids[within(self.starts[slots], np.maximum(sizes, 0))]

    def forget(self) -> None:
        """Drop the long pieces."""
        kept = len(self.sizes)
        while self.slots and len(next(reversed(self.slots))) > CACHED_CHARS:
            kept = self.slots.popitem()[1]
        if kept < len(self.sizes):
            self.ids = self.ids[: self.starts[kept]].copy()
            self.starts, self.sizes = self.starts[:kept].copy(), self.sizes[:kept].copy()


class SpacedEncoder:
    """Ids for a byte-level vocabulary whose tokens keep the space before a word.

    A cut before a space followed by a visible character is always between two of the rule's
    splits, and so are the cuts around a line break between visible characters. Where white space
    stands together, only the first kind of cut is made.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _library(path)
        self.special = _specials(self.tokenizer)
        self.store = worker_store("encoding").setdefault(("pools", path), {})
        if not self.store:
            vocabulary = self.tokenizer.get_vocab()
            begins = np.zeros(max(vocabulary.values()) + 1, bool)
            begins[[i for token, i in vocabulary.items() if token.startswith(_BLANKS)]] = True
            ends = [self._whole(mark) for mark in (*_ENDS, "")]
            self.store.update(pool=_Pool(ends), old=_Pool(ends), ends=ends, loose=_Pieces(None), begins=begins)
            self.store.update(unsplit=_unsplit(self.tokenizer, vocabulary), line_break=len(self._whole("\n")))
        self.loose, self.begins, self.unsplit, self.line_break = (self.store[k] for k in ("loose", "begins", "unsplit", "line_break"))
        self.loose.encode = lambda piece: self._whole(piece).tobytes()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _joined(self, tokenizer, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of pieces as they are after a space or their line break: each begins where such a token is."""
        text = (" " + " ".join(pieces)).replace(" \n", "\n")
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) == len(pieces):
            return np.diff(starts, append=len(ids)), ids
        each = [self._whole(p if p[0] == "\n" else " " + p) for p in pieces]  # together they hold a special string
        return np.array([len(e) for e in each]), np.concatenate(each)

    def _learn(self, pool: _Pool, pieces: np.ndarray) -> None:
        """Put new pieces into the pool, without ids where white space at an edge could belong to what is next to it."""
        if not len(pieces):
            return
        old = self.store["old"]
        slots = old.find(pieces)
        again = slots >= 0
        uncut, words, other = [], [], []
        for piece in pieces[~again].tolist():
            if _PLAIN.fullmatch(piece):
                words.append(piece)
            else:
                body = piece.removeprefix("\n")
                (other if body and body == body.strip() else uncut).append(piece)
        learned = [old.get(slots[again]), (np.full(len(uncut), -1), pool.ids[:0])]
        for tokenizer, some, most in ((self.unsplit, words, JOINED_WORDS), (self.tokenizer, other, JOINED_PIECES)):
            learned += [self._joined(tokenizer, some[a : a + most]) for a in range(0, len(some), most)]
        pool.put([*pieces[again], *uncut, *words, *other], *map(np.concatenate, zip(*learned)))

    def _slots(self, pool: _Pool, pieces: pa.Array) -> np.ndarray:
        """Where the pool has these pieces; new ones are learned first."""
        names = pieces.to_numpy(zero_copy_only=False)
        slots = pool.find(names)
        unknown = np.flatnonzero(slots < 0)
        long = pc.utf8_length(pieces).to_numpy()[unknown] > CACHED_CHARS
        self._learn(pool, names[unknown[~long]])
        self._learn(pool, names[unknown[long]])
        slots[unknown] = pool.find(names[unknown])
        return slots

    def _group(self, texts: pa.Array) -> Iterator[np.ndarray]:
        # Texts with an empty piece are not worth cutting.
        cuttable = pc.if_else(pc.match_substring_regex(texts, _EMPTY_PIECE), pa.scalar("", texts.type), texts)
        # A piece is what follows a space, or a line break with what follows that. Every text is begun by a line break of ours.
        lines = pc.replace_substring(cuttable, "\n", " \n")
        cut = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("", texts.type), lines, pa.scalar("\n", texts.type)), " ")
        pieces = cut.flatten().dictionary_encode()
        index, pieces = pieces.indices.to_numpy(), pieces.dictionary
        # A mark after a letter is a split of its own.
        ended = pc.match_substring_regex(pieces, f"[{_LETTERS}][{_ENDS}]$")
        marks = pc.index_in(pc.if_else(ended, pc.utf8_slice_codeunits(pieces, -1), pa.scalar("", pieces.type)), pa.array([*_ENDS, ""], pieces.type))
        stems = pc.if_else(ended, pc.utf8_slice_codeunits(pieces, 0, -1), pieces).dictionary_encode()
        if len(self.store["pool"].slots) > POOL_PIECES:
            self.store.update(old=self.store["pool"], pool=_Pool(self.store["ends"]))
        pool = self.store["pool"]
        slots = self._slots(pool, stems.dictionary)[stems.indices.to_numpy()]
        known, ids = pool.get(np.stack((slots, marks.to_numpy()), axis=1).reshape(-1))
        pool.forget()
        unsure = (known < 0)[::2][index]
        known = np.maximum(known, 0).reshape(-1, 2).sum(axis=1)
        sizes = known[index]
        ids = ids[within((np.cumsum(known) - known)[index], sizes)]
        counts = pc.list_value_length(cut).to_numpy()
        firsts = np.cumsum(counts, dtype=np.int64) - counts
        ends = np.cumsum(np.add.reduceat(sizes, firsts))
        unsure = np.logical_or.reduceat(unsure, firsts)
        special = pc.match_substring(texts, "<").to_numpy(zero_copy_only=False)
        for row, (begin, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            if special[row] and self.special.search(texts[row].as_py()):
                yield self._whole(texts[row].as_py())
            elif unsure[row]:
                yield self._loose(texts[row].as_py())
            else:
                yield ids[begin + self.line_break : end]

    def _loose(self, text: str) -> np.ndarray:
        self.loose.trim()
        return np.frombuffer(b"".join(map(self.loose.__getitem__, _BEFORE_SPACE.split(text))) if text else b"", "<u4")

    def ids_of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text as little-endian unsigned 32-bit integers; none for NULL."""
        texts = pc.fill_null(texts, "")
        group = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // GROUP_BYTES
        bounds = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        for a, b in zip(bounds, bounds[1:]):
            if b > a:
                yield from self._group(texts.slice(a, b - a))

    def ids(self, text: str | None) -> np.ndarray:
        return next(self.ids_of(pa.array([text], pa.string())))


class BlankFreeCounter:
    """Token counts for a vocabulary that drops white space, so that any blank is a safe boundary."""

    def __init__(self, path: str) -> None:
        self.tokenizer = _library(path)
        self.known = worker_store("encoding").setdefault(("counts", path), _Pieces(None))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of every text; the words that are new here go to the library as one batch, of which only lengths are kept."""
        self.known.trim()
        words = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        new = []
        for word in set().union(*words).difference(self.known):
            if word in self.known.old:
                self.known[word] = self.known.old[word]
            else:
                new.append(word)
        for word, encoding in zip(new, self.tokenizer.encode_batch(new, add_special_tokens=False)):
            self.known[word] = len(encoding)
        counts = [sum(map(self.known.__getitem__, w)) for w in words]
        for word in new:
            if len(word) > CACHED_CHARS:
                del self.known[word]
        return counts
