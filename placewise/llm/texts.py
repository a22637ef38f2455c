"""Texts inside Arrow tasks: bounded slices, words as codes, hashes of word runs.

Words are found on the bytes of a whole slice at once, and every distinct word of a
slice is hashed once. Nothing here depends on how Spark cut the rows into tasks.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text that are handled at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

_ALL = np.arange(256, dtype=np.uint8)
# Words are runs of bytes outside these: [^\x20\x09-\x0D]+
SPACES = (_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D))
# Words are runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing
_LETTERS = (_ALL >= 0x61) & (_ALL <= 0x7A)
_CAPITALS = (_ALL >= 0x41) & (_ALL <= 0x5A)
SIGNS = ~(((_ALL >= 0x30) & (_ALL <= 0x39)) | _LETTERS | _CAPITALS | (_ALL >= 0x80))
SAME = _ALL.copy()
LOWER = np.where(_CAPITALS, _ALL + 32, _ALL).astype(np.uint8)


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that the operators read; a null text is an empty one."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows with about ``limit`` bytes of the column ``text``, and these texts as bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)
            start = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts (one more: the end)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, (offsets - offsets[0]).astype(np.int64)


class Words:
    """The words of a slice of texts.

    The words of text ``i`` are number ``first[i]`` to ``first[i + 1]``, the end not included.
    """

    def __init__(self, texts: pa.Array, between: np.ndarray = SPACES, mapped: np.ndarray = SAME):
        data, offsets = raw(texts)
        inside = ~between[data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        #: the place of each word's first byte
        self.starts = np.flatnonzero(inside & ~before)
        kept = np.cumsum(inside, dtype=np.int32)
        ends = np.empty(len(self.starts) + 1, np.int32)
        ends[:-1] = kept[self.starts] - 1
        ends[-1] = kept[-1] if len(kept) else 0
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self._ends, self._data = ends, mapped[data[inside]]

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word in order, and the distinct words by number."""
        words = pa.Array.from_buffers(pa.binary(), len(self.starts), [
            None, pa.py_buffer(self._ends), pa.py_buffer(self._data)]).dictionary_encode()
        return words.indices.to_numpy(), words.dictionary

    def lengths(self) -> np.ndarray:
        """Bytes of each word."""
        return np.diff(self._ends)

    def between(self, begin: int, end: int) -> list[str]:
        """The words from one number to another, the end not included."""
        return [self._data[self._ends[i]:self._ends[i + 1]].tobytes().decode() for i in range(begin, end)]

    def bytes_between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bytes of the words from one number to another, for many such runs."""
        return (self._ends[end] - self._ends[begin]).astype(np.int64)

    def hashes(self, lanes: int = 2) -> np.ndarray:
        """One or two 64-bit hashes of each word: sums of its bytes by random factors for each place."""
        count = len(self.starts)
        result = np.zeros((lanes, count), np.uint64)
        if not count:
            return result
        begins = self._ends[:-1]
        lengths = np.diff(self._ends)
        place = np.arange(len(self._data), dtype=np.int32) - np.repeat(begins, lengths)
        long = np.flatnonzero(lengths > _PLACES)
        for lane in range(lanes):
            sums = np.add.reduceat((self._data + np.uint64(1)) * _BYTE_FACTORS[lane][place & (_PLACES - 1)], begins)
            result[lane] = mixed(sums + lengths.astype(np.uint64))
        for word in long.tolist():
            own = self._data[begins[word]:begins[word] + lengths[word]].tobytes()
            result[:, word] = np.frombuffer(xxhash.xxh3_128_digest(own), "<u8")[:lanes]
        return result

    def joined(self, kept: np.ndarray) -> pa.Array:
        """Each text as its words of ``kept``, with one space between them."""
        lengths = np.diff(self._ends)[kept].astype(np.int64)
        begins = self._ends[:-1][kept].astype(np.int64)
        places = np.cumsum(lengths + 1) - lengths - 1
        out = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
        inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(places, lengths) + inner] = self._data[np.repeat(begins, lengths) + inner]
        counts = np.diff(np.append(0, np.cumsum(kept))[self.first])
        ends = np.append(0, np.cumsum(lengths + 1))[np.append(0, np.cumsum(counts))]
        bare = np.ones(len(out), bool)
        bare[ends[1:][counts > 0] - 1] = False
        ends = ends - np.append(0, np.cumsum(counts > 0))
        return pa.Array.from_buffers(pa.string(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out[bare])])

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


# Odd factors for each place of a word in a window, and of a byte in a word; fixed, so that all tasks agree.
_PLACES = 256
_MULTIPLIERS, _BYTE_FACTORS = np.random.default_rng(20130513).integers(
    0, 1 << 63, (2, 2, _PLACES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads what differs over all 64 bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def run_hashes(hashes: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """A hash of each run of ``length`` words; runs across two texts are for the caller to drop."""
    own = hashes[lane]
    count = max(0, len(own) - length + 1)
    total = np.full(count, length, np.uint64)
    for place in range(length):
        total += own[place:place + count] * _MULTIPLIERS[lane, place]
    return mixed(total)


def whole_runs(words: Words, length: int) -> np.ndarray:
    """The starts of the runs of ``length`` words that lie in one text."""
    count = max(0, len(words.starts) - length + 1)
    ends = np.repeat(words.first[1:], words.counts)
    return np.flatnonzero(np.arange(count) + length <= ends[:count])


def give_back() -> None:
    """Returns what the task freed to the system: workers are used again, by operators that need it for something else."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library is another one
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a schema in words; to be made on the driver."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function(batches)`` yields dictionaries of columns; they become the rows of ``schema``."""
    columns = arrow_schema(schema)

    def run(batches):
        try:
            yield from made(batches)
        finally:
            give_back()

    def made(batches):
        for row in function(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[f.name], type=f.type, from_pandas=False) if not isinstance(row[f.name], (pa.Array, pa.ChunkedArray)) else row[f.name].cast(f.type)
                 for f in columns], schema=columns)

    return df.mapInArrow(run, schema)
