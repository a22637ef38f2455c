"""Counts over whole texts that quality rules and classifiers are made of."""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa

from placewise.llm.texts import Words, mixed, raw, run_hashes, whole_runs

# Words of a window for repeats inside a text.
REPEAT_WINDOW = 8
_ALL = np.arange(256)
_SYMBOL = np.isin(_ALL, list(b"#*$%&|<>"))
_STOP = np.isin(_ALL, list(b".,;:!?"))
_DIGIT = (_ALL >= 0x30) & (_ALL <= 0x39)
_CAPITAL = (_ALL >= 0x41) & (_ALL <= 0x5A)
_ASCII_LETTER = _CAPITAL | ((_ALL >= 0x61) & (_ALL <= 0x7A))
_HIGH = _ALL >= 0x80
_FIRST = (_ALL & 0xC0) != 0x80


class Measured:
    """Counts of each text of a slice, worked out when asked for."""

    def __init__(self, texts: pa.Array):
        self.texts = texts
        self.data, self.offsets = raw(texts)

    @cached_property
    def words(self) -> Words:
        return Words(self.texts)

    @cached_property
    def hashes(self) -> np.ndarray:
        return self.words.hashes(1)

    def bytes_in(self, table: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(table[self.data]))[self.offsets])

    def words_with(self, marked: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(marked))[self.words.first])

    def n_words(self) -> np.ndarray:
        return self.words.counts

    def n_chars(self) -> np.ndarray:
        return self.bytes_in(_FIRST)

    def word_chars(self) -> np.ndarray:
        """Code points in words: white space of ASCII is all that lies between them."""
        spaces = (_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D))
        return self.bytes_in(_FIRST & ~spaces)

    def n_symbols(self) -> np.ndarray:
        return self.bytes_in(_SYMBOL)

    def n_stops(self) -> np.ndarray:
        return self.bytes_in(_STOP)

    def n_digits(self) -> np.ndarray:
        return self.bytes_in(_DIGIT)

    def n_capitals(self) -> np.ndarray:
        return self.bytes_in(_CAPITAL)

    def n_letters(self) -> np.ndarray:
        """ASCII letters and all characters outside ASCII."""
        return self.bytes_in(_ASCII_LETTER | (_HIGH & _FIRST))

    @cached_property
    def _lines(self) -> list[tuple[int, int]]:
        lines = ([x for x in t.split(b"\n") if x and not x.isspace()] for t in self.texts.to_pylist())
        return [(len(x), len(x) - len(set(x))) for x in lines]

    def n_lines(self) -> np.ndarray:
        """Lines with a word."""
        return np.array([n for n, _ in self._lines], np.int64)

    def n_dup_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line."""
        return np.array([n for _, n in self._lines], np.int64)

    def n_same_words(self) -> np.ndarray:
        """Words that equal the word before them."""
        own = self.hashes[0]
        same = np.zeros(len(own), bool)
        same[1:] = own[1:] == own[:-1]
        same[self.words.first[:-1][self.words.counts > 0]] = False
        return self.words_with(same)

    def n_distinct_words(self) -> np.ndarray:
        owners = self.words.owners()
        order = np.lexsort((self.hashes[0], owners))
        own, of = self.hashes[0][order], owners[order]
        new = np.append(True, (own[1:] != own[:-1]) | (of[1:] != of[:-1]))[:len(own)]
        return np.bincount(of[new], minlength=len(self.texts))

    def n_repeat_words(self) -> np.ndarray:
        """Words inside a window of REPEAT_WINDOW words that the text has twice or more."""
        starts = whole_runs(self.words, REPEAT_WINDOW)
        keys = mixed(run_hashes(self.hashes, REPEAT_WINDOW)[starts] + mixed(self.words.owners()[starts].astype(np.uint64)))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        repeated = order[np.append(False, same) | np.append(same, False)] if len(keys) else order
        covered = np.zeros(len(self.words.starts) + 1, np.int32)
        np.add.at(covered, starts[repeated], 1)
        np.add.at(covered, starts[repeated] + REPEAT_WINDOW, -1)
        return self.words_with(np.cumsum(covered[:-1]) > 0)

    def longest_word(self) -> np.ndarray:
        lengths = np.append(self.words.lengths(), 0)
        result = np.maximum.reduceat(lengths, np.minimum(self.words.first[:-1], len(lengths) - 1))
        return np.where(self.words.counts > 0, result, 0)
