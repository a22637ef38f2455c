"""Runs of integers as compressed binaries, dealt to blocks by their leading bits.

Rows of single integers cost far more in a shuffle than their bits. A task gathers what it
has for a block of the hash space, sorts it and sends one binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.llm.texts import arrow_map, mixed

# Blocks of the hash space: a power of two. Each has 1 / BLOCKS of all hashes, whatever their number.
BLOCKS = 512
BLOCK_BITS = BLOCKS.bit_length() - 1


def squeezed(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def unsqueezed(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)


def pack(values: np.ndarray) -> bytes:
    """The integers in as few bytes each as the largest needs, first bytes first, compressed."""
    values = np.ascontiguousarray(values).astype("<u8", copy=False)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return width.to_bytes(1, "little") + len(values).to_bytes(8, "little") + squeezed(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    width, count = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(unsqueezed(data[9:], width * count), np.uint8)
    values = np.zeros((count, 8), np.uint8)
    values[:, :width] = planes.reshape(width, count).T
    return values.reshape(-1).view("<u8")


def pack_sorted(values: np.ndarray) -> bytes:
    """The same for ascending integers, by their differences."""
    return pack(np.diff(values, prepend=np.zeros(1, values.dtype)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def block_bounds(hashes: np.ndarray, bits: int = 64) -> np.ndarray:
    """Where each block begins in ascending ``hashes`` of so many bits (one more: the end)."""
    firsts = np.arange(BLOCKS, dtype=np.uint64) << np.uint64(bits - BLOCK_BITS)
    return np.append(np.searchsorted(hashes, firsts), len(hashes))


def finer_bounds(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The blocks, of a power of two in all, that ascending 64-bit hashes lie in, and where each begins (one more: the end)."""
    of = hashes >> np.uint64(65 - blocks.bit_length())
    begins = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    return of[begins].astype(np.int32), np.append(begins, len(of))


def by_block(df: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Rows of a block to one task, a few blocks for each, in the order of ``block``."""
    parts = min(blocks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartitionById(parts, F.floor(F.col("block").cast("long") * parts / blocks).cast("int")).sortWithinPartitions("block")


def blocks(batches):
    """``(block, rows)`` for rows in the order of ``block``; rows are dictionaries, one at a time."""
    current, rows = None, []
    for batch in batches:
        numbers = batch.column("block").to_pylist()
        for place, number in enumerate(numbers):
            if number != current:
                if rows:
                    yield current, rows
                current, rows = number, []
            rows.append({name: batch.column(name)[place].as_py() for name in batch.schema.names if name != "block"})
    if rows:
        yield current, rows


def shared(spark, values: np.ndarray):
    """Broadcasts an array, compressed: one that is mostly zeros costs little."""
    return spark.sparkContext.broadcast((values.dtype.str, len(values), squeezed(values.tobytes())))


_opened: dict[int, np.ndarray] = {}


def opened(broadcast) -> np.ndarray:
    """The array of :func:`shared`, opened once in a worker that gets it again."""
    kind, count, data = broadcast.value
    key = hash((kind, count, data))
    if key not in _opened:
        _opened.clear()
        _opened[key] = np.frombuffer(unsqueezed(data, count * np.dtype(kind).itemsize), kind)
    return _opened[key]


def _block_bytes(bits: int) -> int:
    return 1 << (bits - 3 - BLOCK_BITS)


def places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two bits of each 64-bit key in a filter of 2 to the power of ``bits``."""
    keys = mixed(np.asarray(keys).view(np.uint64))
    return [keys >> np.uint64(64 - bits), (keys & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - min(bits, 32))]


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether both bits of each key are set."""
    bits = len(filter_).bit_length() + 2
    found = np.ones(len(keys), bool)
    for place in places(keys, bits):
        found &= (filter_[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return found


def key_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A filter that all of ``key`` (long) pass. Its size is fixed; the more keys, the more others pass as well."""
    def partial(batches):
        own, any_ = np.zeros(1 << (bits - 3), np.uint8), False
        for batch in batches:
            for place in places(batch.column("key").drop_null().to_numpy(), bits):
                np.bitwise_or.at(own, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
                any_ |= len(place) > 0
        if any_:
            stretches = own.reshape(BLOCKS, -1)
            full = np.flatnonzero(stretches.any(1))
            yield {"block": full.astype(np.int32), "bits": [squeezed(x.tobytes()) for x in stretches[full]]}

    def merged(batches):
        current, total = None, None
        for batch in batches:
            for block, found in zip(batch.column("block").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                if block != current:
                    if current is not None:
                        yield {"block": [current], "bits": [total.tobytes()]}
                    current, total = block, np.zeros(_block_bytes(bits), np.uint8)
                total |= np.frombuffer(unsqueezed(found, _block_bytes(bits)), np.uint8)
        if current is not None:
            yield {"block": [current], "bits": [total.tobytes()]}

    rows = arrow_map(by_block(arrow_map(keys.select("key"), partial, "block int, bits binary")), merged, "block int, bits binary")
    filter_ = np.zeros((BLOCKS, _block_bytes(bits)), np.uint8)
    for row in rows.toLocalIterator():
        filter_[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return filter_.reshape(-1)
