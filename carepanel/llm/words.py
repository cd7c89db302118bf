"""Texts as runs of word numbers: each distinct word is tokenised once per worker, whole texts are put together by index.

A byte-pair tokenizer that cuts at white space treats every white-space-free word on its own, so a text's ids are
the ids of its words in order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np

from carepanel.llm.shared import hold_table

#: What Python takes for white space beyond the property White_Space.
NOT_WHITE = re.compile("[\x1c-\x1f]")
SPLIT = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: The pattern of word-piece pre-tokenizers for lower-case words of printable ASCII and Latin-1 letters.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+")
PLAIN = re.compile(r"[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
#: Words that tell whether a tokenizer file cuts plain words as ``PIECES`` does.
CUT_PROBE = "It's we'll x9!? 12-a Stra\xdfe \xc9T\xc9"
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
#: Bytes as the byte-level rule writes them: visible ones as they are, the others from 256 on.
_BYTE_CHARS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
PIECE_CHARS = 1 << 20
MOST_WORDS = 250_000


def byte_level(piece: str) -> str:
    return piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_CHARS)


def split_words(text: str) -> list[str]:
    return [w for w in SPLIT.split(text) if w] if NOT_WHITE.search(text) else text.split()


def pieces_of(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that end at white space."""
    at = 0
    while len(text) - at > size:
        found = SPLIT.search(text, at + size)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


class _Numbers(dict):
    """Word -> its number; new words get the next number and are remembered."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class WordTokens:
    """Ids of texts through a table of the words met so far (cleared when it holds ``most_words``)."""

    def __init__(self, tokenize: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most_words: int = MOST_WORDS):
        self.tokenize, self.most_words = tokenize, most_words
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.used = 0

    def _learn(self) -> None:
        ids, lengths = self.tokenize(self.numbers.fresh)
        self.numbers.fresh = []
        if self.used + len(ids) > len(self.flat):
            self.flat = np.r_[self.flat[: self.used], np.zeros(max(len(ids), self.used, 1 << 16), np.int32)]
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.ends = np.r_[self.ends, self.ends[-1] + np.cumsum(lengths)]

    def _ids(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some word lists, flat, and how many each list has."""
        return self.ids(chain.from_iterable(words), np.fromiter(map(len, words), np.int64, len(words)))

    def ids(self, words: Iterable[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for lists that lie one after the other, with their sizes."""
        if len(self.numbers) > self.most_words:
            self._clear()
        number = np.fromiter(map(self.numbers.__getitem__, words), np.int64, int(sizes.sum()))
        if self.numbers.fresh:
            self._learn()
        start = self.ends[number]
        length = self.ends[number + 1] - start
        done = np.r_[0, np.cumsum(length)]
        where = np.arange(done[-1]) + np.repeat(start - done[:-1], length)
        per_list = np.diff(done[np.r_[0, np.cumsum(sizes)]])
        return self.flat[where], per_list

    def texts(self, texts: Iterator[str]) -> Iterator[tuple[np.ndarray, bool]]:
        """Per text its ids in one or more parts; the flag tells whether the text ends with the part."""
        hold_table(f"words {id(self)}", self._clear)
        group: list[list[str]] = []
        held = 0
        for text in texts:
            if len(text) > PIECE_CHARS:
                yield from self._flush(group)
                group, held = [], 0
                for piece in pieces_of(text):
                    yield self._ids([split_words(piece)])[0], False
                yield np.zeros(0, np.int32), True
                continue
            group.append(split_words(text))
            held += len(text)
            if held > PIECE_CHARS:
                yield from self._flush(group)
                group, held = [], 0
        yield from self._flush(group)

    def _flush(self, group: list[list[str]]) -> Iterator[tuple[np.ndarray, bool]]:
        if group:
            ids, sizes = self._ids(group)
            for part in np.split(ids, np.cumsum(sizes)[:-1]):
                yield part, True
