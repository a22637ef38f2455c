"""Token counts of every prefix of a text, by dynamic programming over its bytes.

Byte-level BPE has one encoding for each prefix, and that of a prefix is the encoding of
a shorter one and a last token which goes with the token before it: the two, put together
and encoded, come apart as they are. So the last token of each prefix follows from those
of shorter prefixes, and its count is one more than that of the prefix before the token.

The counts of a text are stored as differences, a 16-bit number for each character. They
answer what a prefix costs and where a budget ends without encoding anything again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.llm import segments
from placewise.llm.segments import SLICE_BYTES
from placewise.llm.texts import arrow_map, id_and_text, slices

# The white space of Unicode, by which the tokenizer splits.
WHITE = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                  "\u2028\u2029\u202f\u205f\u3000")

# Pairs of tokens that one Python worker remembers.
MEMORY = 300_000


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary names each byte.

    Printable bytes of Latin-1 name themselves, the others follow from 256 on.
    """
    named = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    letters = {chr(b): b for b in named}
    for place, b in enumerate(sorted(set(range(256)) - set(named))):
        letters[chr(256 + place)] = b
    return letters


class PrefixCounter:
    """Counts for all prefixes that end between characters; special strings count as one token."""

    def __init__(self, path: str):
        self.tokenizer = segments.load(path)
        letters = byte_letters()
        self.letter = {b: c for c, b in letters.items()}
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.tokens = {bytes(letters[c] for c in name) for name, i in self.tokenizer.get_vocab(False).items() if i not in added}
        self.longest = max(map(len, self.tokens))
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.cache = segments.PieceCache(lambda new: [self.differences(s.decode()) for s in new], "h")

    @staticmethod
    def of(path: str) -> PrefixCounter:
        """One for each worker process, so that its memory serves all its tasks."""
        if ("counts", path) not in segments._caches:
            segments._caches["counts", path] = PrefixCounter(path)
        return segments._caches["counts", path]

    def _goes_with(self, before: bytes, token: bytes) -> bool:
        key = before, token
        if key not in self.pairs:
            if len(self.pairs) > MEMORY:
                self.pairs.clear()
            found = self.tokenizer.model.tokenize("".join(self.letter[b] for b in before + token))
            self.pairs[key] = len(found) == 2 - (not before) and len(found[-1].value) == len(token)
        return self.pairs[key]

    def word(self, word: str) -> list[int]:
        """Token counts of the prefixes of one word, by characters."""
        data = word.encode()
        last, counts = [b""], [0]
        for end in range(1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                token = data[start:end]
                if token in self.tokens and self._goes_with(last[start], token):
                    last.append(token)
                    counts.append(counts[start] + 1)
                    break
        at = [place for place in range(1, len(data) + 1) if place == len(data) or data[place] & 0xC0 != 0x80]
        return [counts[place] for place in at]

    def counts(self, text: str) -> list[int]:
        """Token counts of the prefixes of a text without special strings.

        All words but the last of a prefix are words of the text too, save where a prefix
        ends in white space, which is then one word, or inside ``'ll``, ``'ve`` or ``'re``.
        """
        result, done, words = [], 0, [w for _, w in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        space = None
        for start, end in words:
            word = text[start:end]
            own = self.word(word)
            total = done + own[-1]
            if word in ("'ll", "'ve", "'re"):
                own = [1, 2, own[2]]
            if space is not None and word[0] in WHITE:
                before, begin = space
                own = [before + self.word(text[begin:start + 1])[-1] - done, *own[1:]]
            result += [done + n for n in own]
            space = (done, start) if WHITE.issuperset(word) else None
            done = total
        return result

    def differences(self, text: str) -> list[int]:
        counts = self.counts(text)
        return [here - before for here, before in zip(counts, [0, *counts], strict=False)]

    def with_special(self, text: str) -> np.ndarray:
        """Differences for a text that holds special strings; each is text until it is whole."""
        runs, base = [], 0
        while True:
            found = min(((text.find(s), s) for s in self.special if s in text), default=None)
            if not found:
                rest = np.array(self.counts(text), np.int64) + base
                return np.diff(np.concatenate([*runs, rest]), prepend=0)
            place, name = found
            begun = np.array(self.counts(text[:place] + name[:-1]), np.int64) + base
            base = (int(begun[place - 1]) if place else base) + 1
            runs += [begun, [base]]
            text = text[place + len(name):]

    def all_differences(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The differences of all texts in a row, and where each text's start (one more: the end)."""
        odd = segments.special_rows(texts, [s.encode() for s in self.special])
        if odd:
            plain = pa.array([b"" if i in odd else t for i, t in enumerate(texts.to_pylist())], pa.binary())
            values, bounds = self.all_differences(plain)
            parts = [values[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
            for i in odd:
                parts[i] = self.with_special(texts[i].as_py().decode()).astype(np.int16)
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        coded, distinct, first = segments.pieces(texts)
        values, lengths = self.cache.values(coded, distinct)
        return values, np.append(0, np.cumsum(lengths))[first]


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary for each ``values[bounds[i]:bounds[i + 1]]``."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((np.asarray(bounds) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, prefixes`` of each row of ``docs``.

    ``prefixes`` holds, as 16-bit little-endian integers, by how much the token count of
    each prefix differs from that of the prefix a character shorter. Rows are kept as they
    are: repeated ids and texts give repeated rows, a null id stays null, a null or empty
    text has 0 tokens and no prefixes. Other columns are not read.
    """
    def run(batches):
        counter = PrefixCounter.of(tokenizer)
        for batch, texts in slices(batches, SLICE_BYTES):
            values, bounds = counter.all_differences(texts)
            sums = np.append(0, np.cumsum(values, dtype=np.int64))[bounds]
            yield {"doc_id": batch.column("doc_id"), "n_bytes": pc.binary_length(texts),
                   "n_tokens": np.diff(sums), "prefixes": binaries(values.astype("<i2"), bounds)}

    return arrow_map(id_and_text(docs), run, "doc_id long, n_bytes long, n_tokens long, prefixes binary")


def tokens_at(prefixes: Column, length: Column) -> Column:
    """Tokens of the prefix of ``length`` characters, at most those of the whole text."""
    @F.pandas_udf("long")
    def count(stored: pd.Series, wanted: pd.Series) -> pd.Series:
        return pd.Series([None if s is None or pd.isna(n) else int(np.frombuffer(s, "<i2")[:max(0, int(n))].sum(dtype=np.int64))
                          for s, n in zip(stored, wanted, strict=True)], dtype="Int64")

    return count(prefixes, length)


def length_within(prefixes: Column, budget: Column) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens."""
    @F.pandas_udf("long")
    def longest(stored: pd.Series, most: pd.Series) -> pd.Series:
        def one(s, n):
            fits = np.flatnonzero(np.cumsum(np.frombuffer(s, "<i2"), dtype=np.int64) <= n)
            return int(fits[-1]) + 1 if len(fits) else 0
        return pd.Series([None if s is None or pd.isna(n) else one(s, n) for s, n in zip(stored, most, strict=True)], dtype="Int64")

    return longest(prefixes, budget)


def truncated(docs: DataFrame, counts: DataFrame, budget: int) -> DataFrame:
    """``doc_id, text``: each text cut to its longest prefix of at most ``budget`` tokens."""
    return (docs.select("doc_id", "text").join(counts.select("doc_id", "prefixes"), "doc_id")
            .select("doc_id", F.substring("text", F.lit(1), length_within("prefixes", F.lit(budget)).cast("int")).alias("text")))
