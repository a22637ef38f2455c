"""Byte-level BPE of whole texts: each distinct piece between safe cuts is encoded once.

The tokenizer first splits a text into words, spaces and signs and merges bytes only
inside these. A text can be cut between a character that is no white space and white
space, and between a letter or digit and an ASCII sign, without changing a token. So
texts are cut there, and the tokenizers library encodes each distinct piece. The cache of
pieces is bounded; pieces beyond it are encoded again.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

from placewise.llm.texts import raw

# Pieces that one Python worker keeps, and the longest that it keeps.
CACHE_PIECES = 600_000
CACHE_BYTES = 64
# Bytes of text that are encoded at once.
SLICE_BYTES = 4 << 20

_ALL = np.arange(256)
_SPACE = (_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D))
_ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x41) & (_ALL <= 0x5A)) | ((_ALL >= 0x61) & (_ALL <= 0x7A))
_SIGN = (_ALL < 0x80) & ~_SPACE & ~_ALNUM
# White space outside ASCII, in UTF-8.
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The first byte of each piece of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    if not len(data):
        return np.zeros(0, np.int64)
    before, here = data[:-1], data[1:]
    solid = ~_SPACE[before]
    if _WIDE_SPACE.search(data.tobytes()):
        solid &= before < 0x80
    cut = np.empty(len(data), bool)
    cut[0] = True
    # after the Latin-1 letters as well: C3 80 to C3 BF but for the signs C3 97 and C3 B7
    letter = _ALNUM[before]
    letter[1:] |= (data[:-2] == 0xC3) & (before[1:] != 0x97) & (before[1:] != 0xB7)
    cut[1:] = (solid & _SPACE[here]) | (letter & _SIGN[here])
    starts = offsets[:-1]
    cut[starts[starts < len(data)]] = True
    return np.flatnonzero(cut)


def pieces(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Each piece's number, the distinct pieces, and each text's first piece (one more: the end)."""
    data, offsets = raw(texts)
    starts = cuts(data, offsets)
    bounds = np.append(starts, len(data)).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.searchsorted(starts, offsets)


def load(path: str):
    """The tokenizer in ``path``, without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[s:s + n]`` of each pair of ``starts`` and ``lengths``, in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class PieceCache:
    """Values of pieces, each a run of small integers, worked out by ``make(list of bytes)``."""

    def __init__(self, make, typecode: str, limit: int = CACHE_PIECES):
        self.make, self.limit, self.typecode = make, limit, typecode
        self.at: dict[bytes, int] = {}
        self.flat, self.starts, self.lengths = array(typecode), array("q"), array("q")

    def values(self, coded: np.ndarray, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The values of all pieces in a row, and how many each piece has."""
        names = distinct.to_pylist()
        at = np.fromiter(map(self.at.get, names, [-1] * len(names)), np.int64, len(names))
        missing = np.flatnonzero(at < 0)
        kept = len(self.at)
        if len(missing):
            new = self.make([names[i] for i in missing.tolist()])
            at[missing] = np.arange(len(self.starts), len(self.starts) + len(missing))
            for i, run in zip(missing.tolist(), new, strict=True):
                if kept == len(self.at) < self.limit and len(names[i]) <= CACHE_BYTES:
                    kept += 1
                    self.at[names[i]] = len(self.starts)
                self.starts.append(len(self.flat))
                self.lengths.append(len(run))
                self.flat.extend(run)
        flat = np.frombuffer(self.flat, self.typecode).copy() if len(self.flat) else np.zeros(0, self.typecode)
        starts = np.frombuffer(self.starts, np.int64)[at] if len(self.starts) else at
        lengths = np.frombuffer(self.lengths, np.int64)[at] if len(self.lengths) else at
        result = gathered(flat, starts[coded], lengths[coded]), lengths[coded]
        del flat, starts, lengths
        self._forget()
        return result

    def _forget(self) -> None:
        """Starts anew once pieces that were not kept take more room than those that were."""
        if len(self.starts) > 2 * self.limit:
            self.at.clear()
            self.flat, self.starts, self.lengths = array(self.typecode), array("q"), array("q")


_caches: dict[tuple, object] = {}


class Encoder:
    """Token ids of texts, as the tokenizers library gives them without special tokens added."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = PieceCache(self._encode, "I" if self.tokenizer.get_vocab_size() > 65536 else "H")

    def _encode(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    @staticmethod
    def of(path: str) -> Encoder:
        """One for each worker process, so that its cache serves all its tasks."""
        if ("ids", path) not in _caches:
            _caches["ids", path] = Encoder(path)
        return _caches["ids", path]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids start (one more: the end)."""
        odd = special_rows(texts, self.special)
        if odd:
            plain = pa.array([b"" if i in odd else t for i, t in enumerate(texts.to_pylist())], pa.binary())
            ids, bounds = self.encode(plain)
            parts = [ids[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
            for i, run in zip(sorted(odd), self._encode([texts[i].as_py() for i in sorted(odd)]), strict=True):
                parts[i] = np.array(run, ids.dtype)
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        coded, distinct, first = pieces(texts)
        ids, lengths = self.cache.values(coded, distinct)
        return ids, np.append(0, np.cumsum(lengths))[first]


def special_rows(texts: pa.Array, special: list[bytes]) -> set[int]:
    """The texts that hold the string of a special token."""
    data = raw(texts)[0].tobytes()
    if not any(s in data for s in special):
        return set()
    return {i for i, t in enumerate(texts.to_pylist()) if any(s in t for s in special)}
