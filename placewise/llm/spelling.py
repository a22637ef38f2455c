"""Spelling variants: words one edit apart, and the form that each word is a variant of.

Words are searched by their letters first. A letter-count vector is kept in unary: a bit
for each count of a letter that is reached, so that the L1 distance of two vectors is the
number of bits they differ in, and a box of vectors is the bits that all of them have and
those that any has. An edit changes at most two bits (a replaced letter) or one (a letter
more or less), as counts beyond the last bit and letters that share one only come closer.

K-d trees divide the vectors by one bit after the other. The top of the tree of each word
length, fitted on a bounded sample of words, deals all words into cells; a word is sent to
the cells of its own length within two bits and to those of the next length within one. In
a cell a tree with exact boxes is searched in the same way, and what it gives is
compared letter by letter. A task returns one row for each word, not one for each pair.

Null texts have no words; a null id leaves all words as they are. A word of any length
has a place: beyond ``SAMPLED_LENGTH`` a length is one cell, and cells are cut into parts of ``CELL_WORDS`` by
hash, every part against every other. Empty tables give empty results; columns besides ``doc_id`` and
``text`` are not looked at, and repeated rows count again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.llm.texts import arrow_map, arrow_schema, raw
from placewise.session import work_folder

LEAST_LENGTH, LEAST_COUNT = 5, 3
# A form is so many times as frequent as its variant at least.
MORE = 2
# The words that the tops of the trees are fitted on, the longest of them, and the fewest of them in a cell.
SAMPLE_WORDS, SAMPLED_LENGTH, LEAST_SAMPLED = 1 << 16, 64, 64
CELL_WORDS = 1 << 14
LEAF_WORDS = 32
# Pairs of words that are compared at once, and the bytes of their letters.
_PAIRS, _PAIR_BYTES = 1 << 18, 8 << 20
# Near pairs that are held at once.
_GATHERED = 1 << 20

# The bits of a letter (a Latin-1 byte): three counts for a to z, one shared bit for others.
COUNTS = 3
_FIRST = np.where((np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A), COUNTS * (np.arange(256) - 0x61), COUNTS * 26 + np.arange(256) % 50)
_LEVELS = np.where((np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A), COUNTS, 1)
BITS = 128


def words(docs: DataFrame, one_in: int = 97) -> DataFrame:
    """``code, n``: the words of all texts in Latin-1 and how often each occurs.

    One in so many pairs of document and run of letters, by hash, loses a letter.
    """
    text = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(rf"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    hashed = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run"))
    place = (F.col("hash") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    found = runs.withColumn("hash", hashed).select(F.when(F.col("hash") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))
    found = found.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)
    return found.select(F.encode("word", "ISO-8859-1").alias("code"), "n")


def signatures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The unary letter counts of each word ``data[offsets[i]:offsets[i + 1]]``, as two rows of 64 bits."""
    count = len(offsets) - 1
    owner = np.repeat(np.arange(count), np.diff(offsets))
    letters, counts = np.unique(owner * 256 + data, return_counts=True)
    owner, letters = letters >> 8, letters & 255
    found = np.zeros((2, count), np.uint64)
    for level in range(COUNTS):
        reached = (counts > level) & (_LEVELS[letters] > level)
        bit = _FIRST[letters[reached]] + level
        for lane in range(2):
            here = bit >> 6 == lane
            np.bitwise_or.at(found[lane], owner[reached][here], np.uint64(1) << (bit[here] & 63).astype(np.uint64))
    return found


def _bits_of(found: np.ndarray) -> np.ndarray:
    """How many vectors have each of the bits."""
    return np.array([int(((lane >> np.uint64(bit)) & np.uint64(1)).sum()) for lane in found for bit in range(64)])


class Tree:
    """A k-d tree of unary vectors; a node is its box, and two nodes below it or a leaf's number."""

    def __init__(self, vectors: np.ndarray, leaf: int, exact: bool):
        self.leaves: list[np.ndarray] = []
        self.exact = exact
        whole = (np.zeros(2, np.uint64), np.full(2, np.uint64(0xFFFFFFFFFFFFFFFF)))
        self.root = self._node(vectors, np.arange(vectors.shape[1]), leaf, *whole)

    def _node(self, vectors, members, leaf, low, high):
        own = vectors[:, members]
        if self.exact and len(members):
            low, high = np.bitwise_and.reduce(own, axis=1), np.bitwise_or.reduce(own, axis=1)
        if len(members) > leaf:
            having = _bits_of(own)
            bit = int(np.argmin(np.abs(2 * having - len(members))))
            if 0 < having[bit] < len(members):
                has = (own[bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1) > 0
                one = np.uint64(1) << np.uint64(bit & 63)
                without, with_ = high.copy(), low.copy()
                without[bit >> 6] &= ~one
                with_[bit >> 6] |= one
                return (low, high, self._node(vectors, members[~has], leaf, low, without), self._node(vectors, members[has], leaf, with_, high))
        self.leaves.append(members)
        return (low, high, len(self.leaves) - 1)

    def within(self, asked: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(leaf, which of asked)`` where the box of the leaf is within ``radius`` of the vectors asked for."""
        stack = [(self.root, np.arange(asked.shape[1]))]
        while stack:
            (low, high, *below), which = stack.pop()
            own = asked[:, which]
            outside = np.bitwise_count(low[:, None] & ~own) + np.bitwise_count(own & ~high[:, None])
            which = which[outside.sum(0) <= radius]
            if not len(which):
                continue
            if len(below) == 1:
                yield below[0], which
            else:
                stack.extend((node, which) for node in below)


def tops(found: DataFrame) -> dict[int, Tree]:
    """The top of the tree of each length, fitted on about ``SAMPLE_WORDS`` words chosen by hash."""
    total = found.count()
    chosen = F.pmod(F.xxhash64("code"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_WORDS / max(1, total)))
    sample = found.where(chosen & (F.length("code") <= SAMPLED_LENGTH)).select("code").limit(2 * SAMPLE_WORDS).toArrow().column("code").combine_chunks()
    data, offsets = raw(sample)
    lengths, trees = np.diff(offsets), {}
    leaf = max(LEAST_SAMPLED, int(CELL_WORDS * min(1.0, SAMPLE_WORDS / max(1, total))))
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        flat = data[(offsets[own][:, None] + np.arange(length)).ravel()]
        trees[length] = Tree(signatures(flat, np.arange(len(own) + 1) * length), leaf, exact=False)
    return trees


def _cells(codes: pa.Array, trees: dict[int, Tree], reach: dict[int, int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(length, cell, which words)``: the cells of the trees of a length ``more`` letters longer, within ``reach[more]`` bits."""
    data, offsets = raw(codes)
    vectors, lengths = signatures(data, offsets), np.diff(offsets)
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        for more, radius in reach.items():
            if length + more not in trees:
                yield length + more, 0, own
                continue
            for cell, which in trees[length + more].within(vectors[:, own], radius):
                yield length + more, cell, own[which]


def _sent(found: DataFrame, trees: dict[int, Tree], reach: dict[int, int]) -> DataFrame:
    """``length, cell, code, n``: each word in the cells that it reaches."""
    def run(batches):
        for batch in batches:
            codes = batch.column("code")
            for length, cell, which in _cells(codes, trees, reach) if batch.num_rows else ():
                at = pa.array(which)
                yield {"length": np.full(len(which), length, np.int32), "cell": np.full(len(which), cell, np.int32),
                       "code": codes.take(at), "n": batch.column("n").take(at)}

    return arrow_map(found, run, "length int, cell int, code binary, n long")


class _Words:
    """Words of one length in the order of their letters."""

    def __init__(self, rows: pa.Table, length: int):
        codes = rows.column("code").combine_chunks()
        letters = raw(codes)[0].reshape(len(codes), length)
        order = np.argsort(np.ascontiguousarray(letters).view(f"V{length}").ravel(), kind="stable") if len(codes) else np.zeros(0, int)
        self.letters, self.codes = letters[order], codes.take(pa.array(order))
        self.n = rows.column("n").to_numpy()[order]
        self.vectors = signatures(self.letters.ravel(), np.arange(len(codes) + 1) * length)


def _one_edit(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether words are one edit apart, row by row: one letter replaced, or one letter more in ``longer``."""
    if shorter.shape[1] == longer.shape[1]:
        return (shorter != longer).sum(1) == 1
    size = shorter.shape[1]
    here, shifted = shorter == longer[:, :-1], shorter == longer[:, 1:]
    before = np.where(here.all(1), size, np.argmin(here, 1))
    after = np.where(shifted.all(1), size, np.argmin(shifted[:, ::-1], 1))
    return before + after >= size


def _pairs(asked: _Words, items: _Words, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs one edit apart, as places in both."""
    tree = Tree(items.vectors, LEAF_WORDS, exact=True)
    step = max(1, min(_PAIRS // LEAF_WORDS, _PAIR_BYTES // (LEAF_WORDS * items.letters.shape[1])))
    for leaf, reached in tree.within(asked.vectors, radius):
        members = tree.leaves[leaf]
        for some in (members[i:i + LEAF_WORDS] for i in range(0, len(members), LEAF_WORDS)):  # a leaf of equal vectors may be long
            for start in range(0, len(reached), step):
                which = reached[start:start + step]
                apart = sum(np.bitwise_count(asked.vectors[lane][which][:, None] ^ items.vectors[lane][some][None, :]).astype(np.int16) for lane in range(2))
                left, right = np.nonzero(apart <= radius)
                left, right = which[left], some[right]
                same = _one_edit(asked.letters[left], items.letters[right])
                yield left[same], right[same]


_NEAR = "code binary, n long, n_near long, best_n long, best binary"


def _near(of: _Words, others: _Words, left: np.ndarray, right: np.ndarray) -> dict[str, pa.Array]:
    """For each word that has any: how many, and the one with the largest n, then the smallest letters."""
    order = np.lexsort((right, -others.n[right], left))
    left, right = left[order], right[order]
    at, first, counts = np.unique(left, return_index=True, return_counts=True)
    best = right[first]
    return {"code": of.codes.take(pa.array(at)), "n": pa.array(of.n[at]), "n_near": pa.array(counts.astype(np.int64)),
            "best_n": pa.array(others.n[best]), "best": others.codes.take(pa.array(best))}


def _searched(length: int, asking: pa.Table, items: pa.Table, schema: pa.Schema) -> pa.Table:
    """The near words of a cell: those of its words' own length, and of words one letter shorter both ways."""
    found = []
    if items.num_rows and asking.num_rows:
        own, sizes = _Words(items, length), pc.binary_length(asking.column("code")).to_numpy()
        for size, radius in ((length, 2), (length - 1, 1)):
            if not (sizes == size).any():
                continue
            asked = _Words(asking.filter(pa.array(sizes == size)), size)
            for left, right in _gathered(_pairs(asked, own, radius)):
                found.append(pa.table(_near(asked, own, left, right)).cast(schema))
                if size < length:
                    found.append(pa.table(_near(own, asked, right, left)).cast(schema))
    return pa.concat_tables(found) if found else schema.empty_table()


def _gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs in fewer arrays, of some ``_GATHERED`` pairs each."""
    held, count = [], 0
    for pair in pairs:
        held.append(pair)
        count += len(pair[0])
        if count >= _GATHERED:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, count = [], 0
    if count:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def near_words(found: DataFrame) -> DataFrame:
    """``code, n, n_near, best_n, best``: the number of near words and the most frequent one. ``found``: a written table."""
    spark = found.sparkSession
    folder = work_folder(spark, "spelling")
    trees = tops(found)
    items = _sent(found, trees, {0: 0})
    items.write.parquet(f"{folder}/cells")
    items = spark.read.schema(items.schema).parquet(f"{folder}/cells")
    # Cells that are larger than planned: at most one for each CELL_WORDS words and each cell of the trees.
    large = {(r["length"], r["cell"]): -(-r["count"] // CELL_WORDS)
             for r in items.groupBy("length", "cell").count().where(F.col("count") > CELL_WORDS).collect()}
    parts = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for key, n in large.items() for x in (f"{key[0]}:{key[1]}", n))),
                                    F.concat_ws(":", "length", "cell")), F.lit(1)) if large else F.lit(1)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        df = df.withColumn("parts", parts).withColumn(own, F.pmod(F.xxhash64("code"), F.col("parts")).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)) if large else F.lit(0)).drop("parts")

    keys, schema = ("length", "cell", "a", "b"), arrow_schema(_NEAR)

    def searched(key, asked: pa.Table, own: pa.Table) -> pa.Table:
        return _searched(key[0].as_py(), asked, own, schema)

    asking = dealt(_sent(found, trees, {0: 2, 1: 1}), "a", "b")
    near = asking.groupBy(*keys).cogroup(dealt(items, "b", "a").groupBy(*keys)).applyInArrow(searched, _NEAR)
    none = found.select("code", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("binary").alias("best"))
    best = F.min(F.when(F.col("best_n").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    return near.unionByName(none).groupBy("code").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("top")) \
        .select("code", "n", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """``code, root`` of words that have a form, by following twice as far in each round."""
    spark = forms.sparkSession
    schema = "code binary, root binary, more boolean"
    forms.select("code", F.col("form").alias("root"), F.lit(True).alias("more")).write.parquet(f"{folder}/0")
    number, current = 0, spark.read.schema(schema).parquet(f"{folder}/0")
    while current.where("more").limit(1).count():
        number += 1
        onward = current.select(F.col("code").alias("root"), F.col("root").alias("further"))
        current.join(onward, "root", "left").select("code", F.coalesce("further", "root").alias("root"),
                                                    F.col("further").isNotNull().alias("more")).write.parquet(f"{folder}/{number}")
        current = spark.read.schema(schema).parquet(f"{folder}/{number}")
    return current.select("code", "root")


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the texts.

    ``form``: the most frequent near word, the first in the order of letters among equals, if it is
    at least ``MORE`` times as frequent; ``root``: the last form of forms. Forms grow in frequency, so
    there is a last one.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "variants")
    found = words(docs)
    found.write.parquet(f"{folder}/words")
    found = spark.read.schema(found.schema).parquet(f"{folder}/words")
    near = near_words(found)
    related = F.coalesce(F.col("best_n") >= MORE * F.col("n"), F.lit(False))
    near = near.select("code", "n", "n_near", F.when(related, F.col("best")).alias("form"), F.when(related, F.col("best_n")).alias("form_n"))
    near.write.parquet(f"{folder}/near")
    near = spark.read.schema(near.schema).parquet(f"{folder}/near")
    roots = _roots(near.where("form IS NOT NULL"), f"{folder}/roots")
    text = lambda c: F.decode(c, "ISO-8859-1")
    return near.join(roots, "code", "left").select(
        text(F.col("code")).alias("word"), text(F.col("form")).alias("form"), text(F.coalesce("root", "code")).alias("root"), "n", "n_near", "form_n")
