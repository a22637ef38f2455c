"""Removes passages that an earlier document has, with a count-min sketch before the exact count.

1. Each task puts its windows into a count-min sketch of one wide row, kept sparse: the
   cells that it touched. Merged block by block, the sketch tells for each cell if two
   documents touched it. It overestimates, so a window that two documents have always
   counts as repeated. The repeated cells are folded into a filter of fixed size.
2. Only windows that pass the filter are grouped exactly, by 128 bits of hash, each with
   the smallest document that it starts in. A task sends one row for each window: it knows
   itself that its other documents have the window from a smaller one.
3. The windows to remove go back to the documents that hold them.

The sizes of sketch and filter do not depend on the data. Over many more windows than
cells the filter lets more windows pass; the result is the same. The blocks of the exact
step grow in number with the words: beyond BLOCK_WINDOWS in each they are cut once more, in
a shuffle of their own, as a task could not send to so many at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.llm import packed
from placewise.llm.texts import Words, arrow_map, mixed, run_hashes, slices, whole_runs

# Words of a window.
WINDOW = 13
# Cells of the sketch and bits of the filter, as powers of two. The filter (32 MB) is what is broadcast.
CELL_BITS = 32
FILTER_BITS = 28
# Windows that a task holds before it sends what it has.
HELD_WINDOWS = 1_000_000
# Windows of a block that is grouped exactly, at most on average: a block is held by one task.
BLOCK_WINDOWS = 1 << 21
# Words in a group of documents that is rewritten together, about.
GROUP_WORDS = 1_000_000


def _places(cells: np.ndarray) -> list[np.ndarray]:
    """The two bits of each cell in the filter. Cells of a block have their bits in one stretch."""
    own = FILTER_BITS - packed.BLOCK_BITS
    stretch = (cells >> np.uint64(CELL_BITS - packed.BLOCK_BITS)) << np.uint64(own)
    spread = mixed(cells)
    low = np.uint64((1 << own) - 1)
    return [stretch | (spread & low), stretch | ((spread >> np.uint64(32)) & low)]


def _windows(batches, lanes: int):
    """For each slice: the rows, the words, the starts of the windows, and their hashes."""
    for batch, texts in slices(batches):
        words = Words(texts)
        hashes = words.hashes(lanes)
        starts = whole_runs(words, WINDOW)
        yield batch, words, starts, [run_hashes(hashes, WINDOW, lane)[starts] for lane in range(lanes)]


def _cells(batches):
    """Sparse sketches: cells in ascending order, and a bit that says if two documents touched them."""
    held, number, documents = [], 0, 0

    def sent():
        keys = np.sort(np.concatenate(held))
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
        cells = keys >> np.uint64(32)
        first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        twice = (np.diff(np.append(first, len(cells))) > 1).astype(np.uint64)
        cells = cells[first]
        bounds = packed.block_bounds(cells, CELL_BITS)
        full = np.flatnonzero(np.diff(bounds))
        rows = []
        for block in full.tolist():
            a, b = bounds[block], bounds[block + 1]
            own = cells[a:b] - (np.uint64(block) << np.uint64(CELL_BITS - packed.BLOCK_BITS))
            rows.append(packed.pack_sorted((own << np.uint64(1)) | twice[a:b]))
        return {"block": full.astype(np.int32), "cells": rows, "words": [0] * len(full)}

    total = 0
    for batch, words, starts, (hashes,) in _windows(batches, 1):
        owners = words.owners()[starts].astype(np.uint64) + np.uint64(documents)
        held.append(((hashes >> np.uint64(64 - CELL_BITS)) << np.uint64(32)) | owners)
        documents += batch.num_rows
        number += len(starts)
        total += len(words.starts)
        if number > HELD_WINDOWS:
            yield sent()
            held, number, documents = [], 0, 0
    if number:
        yield sent()
    yield {"block": np.zeros(1, np.int32), "cells": [packed.pack(np.zeros(0, np.uint64))], "words": [total]}


def _merged(batches):
    """The filter's stretch of each block, and the words of all texts."""
    own = 1 << (CELL_BITS - packed.BLOCK_BITS)
    width = 1 << (FILTER_BITS - packed.BLOCK_BITS)
    current, counts, words = None, None, 0

    def stretch():
        cells = np.flatnonzero(counts > 1).astype(np.uint64) + np.uint64(current * own)
        bits = np.zeros(width, bool)
        for place in _places(cells):
            bits[place - np.uint64(current * width)] = True
        return {"block": [current], "bits": [np.packbits(bits, bitorder="little").tobytes()], "words": [words]}

    for batch in batches:
        for block, cells, n in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "words")), strict=True):
            if block != current:
                if current is not None:
                    yield stretch()
                current, counts, words = block, np.zeros(own, np.uint8), 0
            values = packed.unpack_sorted(cells)
            at = (values >> np.uint64(1)).astype(np.int64)
            counts[at] = np.minimum(counts[at] + 1 + (values & np.uint64(1)).astype(np.uint8), 2)
            words += n
    if current is not None:
        yield stretch()


def repeated_filter(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The filter of the windows that two documents may have, and the number of all words."""
    sketches = arrow_map(docs.select("doc_id", "text"), _cells, "block int, cells binary, words long")
    merged = arrow_map(packed.by_block(sketches), _merged, "block int, bits binary, words long")
    bits, words = np.zeros((packed.BLOCKS, 1 << (FILTER_BITS - packed.BLOCK_BITS - 3)), np.uint8), 0
    for row in merged.toLocalIterator():
        bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
        words += row["words"]
    return bits.reshape(-1), words


def _passing(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The windows whose two bits are set."""
    found = np.arange(len(hashes))
    cells = hashes >> np.uint64(64 - CELL_BITS)
    for place in _places(cells):
        at = place[found]
        found = found[(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0]
    return found


def _signed(ids: np.ndarray) -> np.ndarray:
    """Ids in an unsigned order, for packing; and back."""
    return ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def _smaller_first(first: np.ndarray, second: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by window and document, and for each place the one where its window begins."""
    order = np.lexsort((docs, second, first))
    a, b = first[order], second[order]
    begins = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    return order, np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))


def _dealt(groups: np.ndarray, blocks: int) -> np.ndarray:
    """A block for the marks of each group, which pass through: all blocks have some."""
    return (mixed(groups.astype(np.int64).view(np.uint64)) >> np.uint64(65 - blocks.bit_length())).astype(np.int32)


def _marks(groups: np.ndarray, docs: np.ndarray, hashes: np.ndarray, blocks: int):
    """Rows for the windows to remove: by group of documents, then document and hash."""
    if not len(docs):
        return
    order = np.lexsort((hashes, docs, groups))
    groups, docs, hashes = groups[order], docs[order], hashes[order]
    bounds = np.append(np.flatnonzero(np.append(True, groups[1:] != groups[:-1])), len(groups))
    yield {"kind": np.zeros(len(bounds) - 1, np.int32), "block": _dealt(groups[bounds[:-1]], blocks), "group": groups[bounds[:-1]],
           "first": [packed.pack(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
           "second": [None] * (len(bounds) - 1), "groups": [None] * (len(bounds) - 1),
           "docs": [packed.pack_sorted(docs[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]}


_SENT = "kind int, block int, group long, first binary, second binary, docs binary, groups binary"


def _sent(held: list[tuple[np.ndarray, ...]], blocks: int):
    """Of the windows held, those that a smaller document has as marks, the others in a row for each block."""
    first, second, docs, groups = (np.concatenate(x) for x in zip(*held, strict=True))
    order, begin = _smaller_first(first, second, docs)
    first, second, docs, groups = first[order], second[order], docs[order], groups[order].astype(np.int64)
    own = begin == np.arange(len(order))
    removed = docs > docs[begin]
    yield from _marks(groups[removed], docs[removed], first[removed], blocks)
    first, second, docs, groups = first[own], second[own], docs[own], groups[own]
    of, bounds = packed.finer_bounds(first, blocks)
    cut = lambda x, pack=packed.pack: [pack(x[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    yield {"kind": np.ones(len(of), np.int32), "block": of, "group": np.zeros(len(of), np.int64), "first": cut(first, packed.pack_sorted),
           "second": cut(second), "docs": cut(docs), "groups": cut(groups.astype(np.uint64))}


def _windows_of(columns: dict, at: int) -> tuple[np.ndarray, ...]:
    """The windows of a row: both hashes, documents, groups."""
    return packed.unpack_sorted(columns["first"][at]), *(packed.unpack(columns[c][at]) for c in ("second", "docs", "groups"))


def _divided(blocks: int):
    """Blocks cut into finer ones, ``blocks`` in all; no block is held whole."""
    def run(batches):
        held, number = [], 0
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            for at, kind in enumerate(columns["kind"]):
                if kind == 0:
                    group = np.array([columns["group"][at]], np.int64)
                    yield {name: [columns[name][at]] for name in columns} | {"block": _dealt(group, blocks)}
                    continue
                held.append(_windows_of(columns, at))
                number += len(held[-1][0])
                if number > HELD_WINDOWS:
                    yield from _sent(held, blocks)
                    held, number = [], 0
        if number:
            yield from _sent(held, blocks)
    return run


def _candidates(bits):
    def run(batches):
        filter_, held, number = packed.opened(bits), [], 0

        for batch, words, starts, (first, second) in _windows(batches, 2):
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            docs, groups = _signed(ids.fill_null(0).to_numpy()), batch.column("group").to_numpy()
            owners = words.owners()[starts]
            found = _passing(filter_, first)
            found = found[known[owners[found]]]
            owners, hashes = owners[found], first[found]
            # a window counts once for a document
            order = np.lexsort((hashes, owners))
            once = order[np.append(True, (np.diff(owners[order]) != 0) | (np.diff(hashes[order]) != 0))] if len(order) else order
            owners = owners[once]
            held.append((hashes[once], second[found][once] & np.uint64(0xFFFFFFFFFFFF), docs[owners], groups[owners]))
            number += len(once)
            if number > HELD_WINDOWS:
                yield from _sent(held, packed.BLOCKS)
                held, number = [], 0
        if number:
            yield from _sent(held, packed.BLOCKS)
    return run


def exact_blocks(words: int) -> int:
    """Blocks of the exact step: a power of two, packed.BLOCKS at least."""
    return max(packed.BLOCKS, 1 << max(0, -(-words // BLOCK_WINDOWS) - 1).bit_length())


def _grouped(batches):
    def ready(current, parts):
        first, second, docs, groups = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, begin = _smaller_first(first, second, docs)
        docs, hashes, groups = docs[order], first[order], groups[order].astype(np.int64)
        removed = docs > docs[begin]
        for row in _marks(groups[removed], docs[removed], hashes[removed], packed.BLOCKS):
            yield {name: row[name] for name in ("group", "first", "docs")}

    current, parts = None, []
    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        for at, (kind, block) in enumerate(zip(columns["kind"], columns["block"], strict=True)):
            if kind == 0:
                yield {name: [columns[name][at]] for name in ("group", "first", "docs")}
                continue
            if block != current and parts:
                yield from ready(current, parts)
                parts = []
            current = block
            parts.append(_windows_of(columns, at))
    if parts:
        yield from ready(current, parts)


def _rewritten(batches):
    """Rows by group, marks before documents: the texts without the windows marked."""
    current, marks = None, {}

    def kept(batch):
        for rows, texts in slices([batch]):
            words = Words(texts)
            starts = whole_runs(words, WINDOW)
            hashes = run_hashes(words.hashes(1), WINDOW)[starts]
            owners = words.owners()[starts]
            bounds = np.searchsorted(owners, np.arange(rows.num_rows + 1))
            gone = np.zeros(len(words.starts) + 1, np.int32)
            for row, doc in enumerate(rows.column("doc_id").to_pylist()):
                if doc is not None and doc in marks:
                    a, b = bounds[row], bounds[row + 1]
                    hit = starts[a:b][np.isin(hashes[a:b], marks[doc])]
                    np.add.at(gone, hit, 1)
                    np.add.at(gone, hit + WINDOW, -1)
            removed = np.cumsum(gone[:-1]) > 0
            n_removed = np.diff(np.append(0, np.cumsum(removed))[words.first])
            yield {"doc_id": rows.column("doc_id"), "rest": rows.column("rest"), "n_words": words.counts, "n_removed": n_removed,
                   "text": pc.if_else(pa.array(n_removed > 0), words.joined(~removed), rows.column("text"))}

    for batch in batches:
        groups = batch.column("group").to_numpy()
        kinds = batch.column("kind").to_numpy()
        edges = np.flatnonzero((np.diff(groups) != 0) | (np.diff(kinds) != 0)) + 1
        for a, b in zip(np.append(0, edges).tolist(), np.append(edges, len(groups)).tolist(), strict=True):
            part = batch.slice(a, b - a)
            if groups[a] != current:
                current, marks = groups[a], {}
            if kinds[a] == 0:
                docs = np.concatenate([packed.unpack_sorted(x) for x in part.column("docs").to_pylist()])
                hashes = np.concatenate([packed.unpack(x) for x in part.column("first").to_pylist()])
                order = np.argsort(docs, kind="stable")
                docs, hashes = (docs[order] ^ np.uint64(1 << 63)).view(np.int64), hashes[order]
                at = np.append(np.flatnonzero(np.append(True, docs[1:] != docs[:-1])), len(docs))
                for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    more = hashes[x:y]
                    doc = int(docs[x])
                    marks[doc] = np.concatenate([marks[doc], more]) if doc in marks else more
            else:
                yield from kept(part)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_words, n_removed, rest`` of each row of ``docs``.

    A window is 13 words of one text. Words that a window covers are removed if a document
    with a smaller id has that window too, whether or not it loses it itself. ``text`` has
    the words that stay, joined by single spaces, if any word is removed, and else stays as
    it is (a null text is empty); ``rest`` has the other columns as a struct.
    A null text has no words. A row without an id loses nothing and takes nothing from
    others. Rows with equal ids take nothing from each other; each is rewritten by itself.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", rest.alias("rest"))
    bits, words = repeated_filter(rows)
    groups = words // GROUP_WORDS + 1
    group = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(groups)).alias("group")
    sent = arrow_map(rows.select("doc_id", "text", group), _candidates(packed.shared(spark, bits)), _SENT)
    blocks = exact_blocks(words)
    if blocks > packed.BLOCKS:
        sent = arrow_map(packed.by_block(sent), _divided(blocks), _SENT)
    marks = arrow_map(packed.by_block(sent, blocks), _grouped, "group long, first binary, docs binary")
    sides = (marks.withColumn("kind", F.lit(0))
             .unionByName(rows.select("*", group, F.lit(1).alias("kind")), allowMissingColumns=True)
             .repartition(F.col("group")).sortWithinPartitions("group", "kind"))
    kind = next(f.dataType.simpleString() for f in rows.schema if f.name == "rest")
    return arrow_map(sides, _rewritten, f"doc_id long, text string, n_words long, n_removed long, rest {kind}")
