"""Encoding of whole texts piece by piece with a public tokenizer.

Both kinds of tokenizer cut a text at certain places whatever stands around them, so the pieces between these places can be
encoded by the library once and looked up afterwards. Texts for which that is not certain go to the library whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemeter.llm.words import ragged

# Pieces a worker remembers; beyond that it starts anew. Memory only, not results, depends on it.
MEMO = 1_200_000

#: a letter before marks: words and marks are encoded apart
LETTER_MARK = r"([a-z])([.,!?;:#*$%&]+)"

#: white space before a space: there the cut of a byte-level tokenizer depends on more than the piece
UNSURE = r"[\s\x0b\x1c-\x1f\x85\pZ] "


@lru_cache(maxsize=2)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


class Pieces:
    """Ids by piece, as the library gives them."""

    def __init__(self, path: str):
        self.encode = library(path).encode_batch
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = np.zeros(0, dtype=np.int64)
        self.counts = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def learn(self, new: list[str]) -> None:
        self._keep(new, *self.encoded(new))

    def _keep(self, new: list[str], counts: np.ndarray, ids: np.ndarray) -> None:
        base = len(self.known)
        self.known.update(zip(new, range(base, base + len(new))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])

    def encoded(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and all ids."""
        found = [e.ids for e in self.encode(new, add_special_tokens=False)]
        return np.array([len(f) for f in found], dtype=np.int64), np.array([i for f in found for i in f], dtype=np.uint32)

    def places(self, pieces: list[str]) -> np.ndarray:
        """Numbers of the pieces in the memo, after encoding the new ones."""
        if len(self.known) > MEMO:
            self.clear()
        if new := [p for p in dict.fromkeys(pieces) if p not in self.known]:
            for start in range(0, len(new), 20_000):
                self.learn(new[start : start + 20_000])
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))


class Words(Pieces):
    """Pieces for tokenizers that mark word ends: plain words are encoded many at once, in one text.

    A word of letters a-z is one unit for such a tokenizer, and its last id, and no other, ends a word.
    """

    def __init__(self, path: str):
        super().__init__(path)
        suffix = library(path).model.end_of_word_suffix
        vocabulary = library(path).get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def learn(self, new: list[str]) -> None:
        plain, other = [], []
        for word in new:
            (plain if word.isascii() and word.isalpha() else other).append(word)
        if plain:
            super().learn(plain)
        if other:
            counts, ids = Pieces.encoded(self, other)
            self._keep(other, counts, ids)

    def encoded(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.encode([" ".join(new)], add_special_tokens=False)[0].ids, dtype=np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(new):
            return super().encoded(new)
        return np.diff(last, prepend=-1), ids


@lru_cache(maxsize=4)
def memo(path: str, kind: str) -> Pieces:
    return Words(path) if kind == "words" else Pieces(path)


def _offsets(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    return np.asarray(lists.offsets) - lists.offsets[0].as_py(), lists.flatten()


def count_tokens(texts: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text with a byte-level tokenizer, which cuts before each space that follows no white space."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    unsure = np.asarray(pc.match_substring_regex(texts, UNSURE))
    total = np.zeros(len(texts), dtype=np.int64)
    if unsure.any():
        odd = texts.filter(pa.array(unsure)).to_pylist()
        total[unsure] = [len(e.ids) for e in library(path).encode_batch(odd, add_special_tokens=False)]
    sure = np.flatnonzero(~unsure)
    at, parts = _offsets(pc.split_pattern(texts.take(pa.array(sure)), " "))
    if len(sure):
        first, rest = memo(path, "first"), memo(path, "rest")
        coded = parts.dictionary_encode()
        codes, words = np.asarray(coded.indices), coded.dictionary.to_pylist()
        heads = np.zeros(len(codes), dtype=bool)
        heads[at[:-1]] = True
        found = rest.places([" " + w for w in words])
        counts = rest.counts[found][codes]
        starts = parts.take(pa.array(at[:-1])).to_pylist()
        found = first.places(starts)
        counts[heads] = first.counts[found]
        total[sure] = np.add.reduceat(counts, at[:-1])
    return total


def encode_words(texts: pa.Array, path: str) -> tuple[list[np.ndarray], np.ndarray]:
    """Ids of each text with a tokenizer that lower-cases, drops white space and so cuts there, and that cuts between a
    letter and a punctuation mark as well. Texts in which a special token may stand go to the library whole."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    special = np.asarray(pc.match_substring(texts, "<|"))
    made: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(texts)
    if special.any():
        odd = np.flatnonzero(special)
        for i, e in zip(odd, library(path).encode_batch(texts.take(pa.array(odd)).to_pylist(), add_special_tokens=False)):
            made[i] = np.array(e.ids, dtype=np.uint32)
    plain = np.flatnonzero(~special)
    if len(plain):
        lowered = pc.ascii_lower(texts.take(pa.array(plain)))
        at, parts = _offsets(pc.ascii_split_whitespace(pc.replace_substring_regex(lowered, LETTER_MARK, r"\1 \2")))
        coded = parts.dictionary_encode()
        held = memo(path, "words")
        place = held.places(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        counts = held.counts[place]
        ids = held.ids[ragged(held.starts[place], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[at]
        for i, a, b in zip(plain, ends[:-1], ends[1:]):
            made[i] = ids[a:b]
    return made, np.array([len(x) for x in made], dtype=np.int64)
