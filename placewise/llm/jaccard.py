"""Joins documents whose sets of word n-grams are alike, as a blocked sparse matrix product.

The matrix has a row for each document and a column for each n-gram. Only columns that a
link needs are multiplied first: with the n-grams of a document ordered from rare to
frequent, two documents that link share ``m`` among the first ``n - ceil(0.8 n) + m`` of
each (``n`` n-grams, ``m`` = 0.2 n). Columns of few documents give pairs, whose counts are
added up; a pair below ``m``, even if all its shared frequent columns were added, is
dropped. Documents that have ``m`` frequent columns themselves are tied along these, each
to the smallest that has the column, which is one edge and not a pair for each other one.

The components of what is left are the blocks, cut further by size bands and to a bounded
number of rows. Inside a block the product of the full rows accumulates the overlaps, and
pairs below the bound that their sizes give are dropped. Documents with the same set are
one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.llm import packed
from placewise.llm.components import components
from placewise.llm.texts import LOWER, Words, arrow_map, mixed, run_hashes, slices, whole_runs
from placewise.session import work_folder

# Words of a shingle, and the least similarity of a link in percent.
SHINGLE = 5
PERCENT = 80
# Counters (a power of two) that order shingles by frequency. Any order gives the same
# links; more counters keep more of the frequent shingles out of the way.
COUNTER_BITS = 22
# Columns and rows that a task holds before it sends what it has.
HELD = 1_000_000
# Bits (a power of two) of the filter of documents that are compared, which is broadcast: 8 MB.
WANTED_BITS = 26
# Documents up to which a column gives pairs; beyond, documents are tied along it.
PAIR_DOCUMENTS = 4
# Documents of a block.
BLOCK_ROWS = 512
# Columns that are multiplied at once, as a dense stripe.
STRIPE = 4096


def least_overlap(first, second):
    """Shingles that two sets of these sizes must share: the smallest o with 100 o >= PERCENT * (first + second - o)."""
    return -(-PERCENT * (first + second) // (100 + PERCENT))


def shared_in_prefix(size):
    """Shingles that sets of this size share with each set they link to, both within their prefixes."""
    return max(1, size * (100 - PERCENT) // 100)


def prefix_length(size):
    """A set of this size shares at least ceil(size * PERCENT / 100) shingles with each set that it links to."""
    return min(size, size - -(-size * PERCENT // 100) + shared_in_prefix(size))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts in a row, ascending in each, and where each text's start (one more: the end)."""
    words = Words(texts, mapped=LOWER)
    hashes = words.hashes(1)
    starts = whole_runs(words, SHINGLE)
    values = run_hashes(hashes, SHINGLE)[starts]
    bounds = np.searchsorted(words.owners()[starts], np.arange(len(texts) + 1))
    parts = []
    for row, count in enumerate(words.counts.tolist()):
        if count >= SHINGLE:
            own = np.sort(values[bounds[row]:bounds[row + 1]])
            parts.append(own[np.append(True, own[1:] != own[:-1])])
        elif count:
            parts.append(run_hashes(hashes[:, words.first[row]:words.first[row + 1]], count))
        else:
            parts.append(values[:0])
    return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))[bounds])


def set_keys(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that sets have in common only if they are the same."""
    return _sums(mixed(values ^ np.uint64(0x9E3779B97F4A7C15)), bounds).view(np.int64), _sums(mixed(values + np.uint64(0x632BE59BD9B4E019)), bounds).view(np.int64)


def _surveyed(batches):
    """A row for each document with size and key of its set; and counts of shingles by counter."""
    counts, number = np.zeros(1 << COUNTER_BITS, np.uint32), 0
    none = np.zeros(packed.BLOCKS, np.int64)

    def sent():
        return {"doc_id": none, "size": none, "first": none, "second": none, "block": np.arange(packed.BLOCKS, dtype=np.int32),
                "counts": [packed.pack(x) for x in counts.reshape(packed.BLOCKS, -1)]}

    for batch, texts in slices(batches):
        values, bounds = shingle_sets(texts)
        counts += np.bincount((values >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(counts)).astype(np.uint32)
        number += len(values)
        first, second = set_keys(values, bounds)
        yield {"doc_id": batch.column("doc_id"), "size": np.diff(bounds), "first": first, "second": second,
               "block": pa.nulls(len(first), pa.int32()), "counts": pa.nulls(len(first), pa.binary())}
        if number > 24 * HELD:
            yield sent()
            counts[:], number = 0, 0
    if number:
        yield sent()


def _added(batches):
    current, total = None, None
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            if block != current:
                if current is not None:
                    yield {"block": [current], "counts": [packed.pack(total)]}
                current, total = block, np.zeros(1 << (COUNTER_BITS - packed.BLOCK_BITS), np.uint64)
            total = total + packed.unpack(counts)
    if current is not None:
        yield {"block": [current], "counts": [packed.pack(total)]}


def frequencies(survey: DataFrame) -> np.ndarray:
    """The counters over all documents; their number is fixed."""
    total = np.zeros((packed.BLOCKS, 1 << (COUNTER_BITS - packed.BLOCK_BITS)), np.uint64)
    rows = packed.by_block(survey.where("block IS NOT NULL").select("block", "counts"))
    for row in arrow_map(rows, _added, "block int, counts binary").toLocalIterator():
        total[row["block"]] = packed.unpack(row["counts"])
    return np.minimum(total.reshape(-1), np.iinfo(np.uint32).max).astype(np.uint32)


def _groups(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ascending columns: where the group of each place begins, and how many places it has."""
    begins = np.append(True, columns[1:] != columns[:-1])[:len(columns)]
    first = np.flatnonzero(begins)
    counts = np.diff(np.append(first, len(columns)))
    return np.repeat(first, counts), np.repeat(counts, counts)


_SENT = "block int, columns binary, docs binary, marks binary, frequent boolean"


def _prefixes(counters):
    """Postings of the prefixes by block. A column that is frequent in the task alone is sent apart, and named among the marks of its block."""
    def run(batches):
        frequency = packed.opened(counters)
        held, number = [], 0

        def sent():
            columns, docs, first, second = (np.concatenate(x) for x in zip(*held, strict=True))
            # of the documents with one set the first stands for all
            order = np.lexsort((docs, second, first))
            a, b = first[order], second[order]
            begins = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            smallest = np.empty_like(docs)
            smallest[order] = docs[order][np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))]
            own = smallest == docs
            columns, docs = columns[own], docs[own]
            order = np.lexsort((docs, columns))
            columns, docs = columns[order], docs[order]
            begin, counts = _groups(columns)
            frequent = counts > PAIR_DOCUMENTS
            marked = columns[frequent & (begin == np.arange(len(columns)))]
            for apart, kept, marks in ((True, frequent, marked[:0]), (False, ~frequent, marked)):
                own_columns, own_docs = columns[kept], docs[kept]
                bounds, ends = packed.block_bounds(own_columns), packed.block_bounds(marks)
                full = np.flatnonzero(np.diff(bounds) + np.diff(ends)).tolist()
                yield {"block": np.array(full, np.int32), "columns": [packed.pack_sorted(own_columns[bounds[x]:bounds[x + 1]]) for x in full],
                       "docs": [packed.pack(own_docs[bounds[x]:bounds[x + 1]]) for x in full],
                       "marks": [packed.pack_sorted(marks[ends[x]:ends[x + 1]]) for x in full], "frequent": [apart] * len(full)}

        for batch, texts in slices(batches):
            values, bounds = shingle_sets(texts)
            first, second = set_keys(values, bounds)
            ids = batch.column("doc_id")
            known, docs = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            rank = frequency[values >> np.uint64(64 - COUNTER_BITS)]
            for row in range(len(docs)):
                own = values[bounds[row]:bounds[row + 1]]
                if known[row] and len(own):
                    needed = prefix_length(len(own))
                    order = np.argsort(rank[bounds[row]:bounds[row + 1]], kind="stable")[:needed]
                    held.append((own[order], np.full(needed, docs[row]).view(np.uint64) ^ np.uint64(1 << 63),
                                 np.full(needed, first[row]), np.full(needed, second[row])))
                    number += needed
            if number > HELD:
                yield from sent()
                held, number = [], 0
        if number:
            yield from sent()
    return run


def _signed(values: np.ndarray) -> np.ndarray:
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def _summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of equal keys as one row with the sum of their counts."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    begins = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))[:len(order)]
    return [k[begins] for k in keys], np.add.reduceat(counts[order], np.flatnonzero(begins)) if len(order) else counts


_FOUND = "kind string, a int, columns binary, docs binary, counts binary"


def _multiplied_columns(batches):
    """``pair`` rows: pairs of documents of a block ``a`` and how many of their rare columns they share, packed;
    ``frequent`` rows: other columns with their documents, packed; ``heavy`` rows: documents of a block ``a`` and how many
    such columns they have, packed. Their number depends on tasks and blocks, not on documents."""
    pairs: list[tuple] = []
    often: list[tuple] = []

    def packed_rows(kind, keys, counts):
        place = mixed(keys[0])
        order = np.argsort(place, kind="stable")
        bounds = packed.block_bounds(place[order])
        full = np.flatnonzero(np.diff(bounds)).tolist()
        cut = lambda x: [packed.pack(x[order][bounds[i]:bounds[i + 1]]) for i in full]
        return {"kind": [kind] * len(full), "a": full, "columns": cut(keys[1]) if len(keys) > 1 else [None] * len(full),
                "docs": cut(keys[0]), "counts": cut(counts.astype(np.uint64))}

    def sent():
        if pairs:
            keys, n = _summed([np.concatenate(x) for x in zip(*pairs, strict=True)], np.ones(sum(len(p[0]) for p in pairs), np.int64))
            yield packed_rows("pair", keys, n)
        if often:
            columns, docs = (np.concatenate(x) for x in zip(*often, strict=True))
            order = np.lexsort((docs, columns))
            yield {"kind": ["frequent"], "a": [0], "columns": [packed.pack_sorted(columns[order])], "docs": [packed.pack(docs[order])], "counts": [None]}
            yield packed_rows("heavy", *_summed([docs], np.ones(len(docs), np.int64)))
        pairs.clear(), often.clear()

    def full():
        return sum(len(x[0]) for x in (*pairs, *often)) > HELD

    def ready(parts):
        columns, docs, marks = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(columns):
            return
        order = np.lexsort((docs, columns))
        columns, docs = columns[order], docs[order]
        _, counts = _groups(columns)
        many = (counts > PAIR_DOCUMENTS) | np.isin(columns, marks)
        if many.any():
            often.append((columns[many], docs[many]))
        columns, docs = columns[~many], docs[~many]
        for step in range(1, PAIR_DOCUMENTS):
            same = np.flatnonzero((columns[step:] == columns[:-step]) & (docs[step:] != docs[:-step]))
            if len(same):
                pairs.append((docs[same + step], docs[same]))

    current, parts = None, []
    for batch in batches:
        for block, columns, docs, marks, apart in zip(*(batch.column(c).to_pylist() for c in ("block", "columns", "docs", "marks", "frequent")), strict=True):
            if apart:
                often.append((packed.unpack_sorted(columns), packed.unpack(docs)))
            elif block != current and parts:
                ready(parts)
                parts = []
            if full():
                yield from sent()
            if apart:
                continue
            current = block
            parts.append((packed.unpack_sorted(columns), packed.unpack(docs), packed.unpack_sorted(marks)))
    if parts:
        ready(parts)
    yield from sent()


def _added_pairs(batches):
    """``a, b, n`` once for each pair: the sums over all blocks of columns."""
    for _, rows in packed.blocks(batches):
        a, b, n = (np.concatenate([packed.unpack(x[c]) for x in rows]) for c in ("docs", "columns", "counts"))
        (a, b), n = _summed([a, b], n.astype(np.int64))
        yield {"a": _signed(a), "b": _signed(b), "n": n}


def _added_heavy(batches):
    """``a, n`` once for each document with frequent columns."""
    for _, rows in packed.blocks(batches):
        docs, n = (np.concatenate([packed.unpack(x[c]) for x in rows]) for c in ("docs", "counts"))
        (docs,), n = _summed([docs], n.astype(np.int64))
        yield {"a": _signed(docs), "n": n}


def _ties(popular):
    """Ties of popular documents along frequent columns: to the first in the row, and that one for the column as a whole."""
    def run(batches):
        wanted = packed.opened(popular)
        for batch in batches:
            for columns, docs in zip(batch.column("columns").to_pylist(), batch.column("docs").to_pylist(), strict=True):
                columns, docs = packed.unpack_sorted(columns), packed.unpack(docs)
                chosen = packed.passes(wanted, _signed(docs))
                columns, docs = columns[chosen], docs[chosen]
                begin, _ = _groups(columns)
                first = begin == np.arange(len(docs))
                (a, b), _ = _summed([docs[~first], docs[begin][~first]], np.ones(int((~first).sum()), np.int64))
                keys = np.append(np.zeros(len(a), np.int64), columns[first].view(np.int64))
                yield {"whole": np.append(np.zeros(len(a), bool), np.ones(int(first.sum()), bool)), "key": keys,
                       "a": _signed(np.append(a, docs[first])), "b": _signed(np.append(b, docs[first]))}
    return run


def candidates(rows: DataFrame, known: DataFrame, counters, folder: str) -> DataFrame:
    """``a, b``: edges along which all links between different sets can be reached; not every edge is a link."""
    spark = rows.sparkSession
    sent = arrow_map(rows, _prefixes(counters), _SENT)
    arrow_map(packed.by_block(sent), _multiplied_columns, _FOUND).write.parquet(f"{folder}/columns")
    found = spark.read.schema(_FOUND).parquet(f"{folder}/columns")
    size = F.min("size")
    needed = lambda n: F.greatest(F.lit(1), F.floor(n * (100 - PERCENT) / 100))
    heavy = found.where("kind = 'heavy'").select(F.col("a").alias("block"), "docs", "counts")
    heavy = arrow_map(packed.by_block(heavy), _added_heavy, "a long, n long").withColumnRenamed("n", "heavy")
    of = (known.groupBy("doc_id").agg(size.alias("size")).join(heavy.withColumnRenamed("a", "doc_id"), "doc_id", "left")
          .select("doc_id", "size", needed(F.col("size")).alias("needed"), F.coalesce("heavy", F.lit(0)).alias("heavy")))
    pairs = found.where("kind = 'pair'").select(F.col("a").alias("block"), "columns", "docs", "counts")
    pairs = arrow_map(packed.by_block(pairs), _added_pairs, "a long, b long, n long")
    for end in ("a", "b"):
        pairs = pairs.join(of.toDF(end, f"size_{end}", f"needed_{end}", f"heavy_{end}"), end)
    pairs = pairs.where(F.col("n") + F.least("heavy_a", "heavy_b") >= F.least("needed_a", "needed_b")).select("a", "b")
    # a partner may be smaller by PERCENT and so need fewer shared columns
    popular = packed.key_filter(of.where(F.col("heavy") >= needed(F.floor(F.col("size") * PERCENT / 100))).select(F.col("doc_id").alias("key")), WANTED_BITS)
    ties = arrow_map(found.where("kind = 'frequent'").select("columns", "docs"), _ties(packed.shared(spark, popular)), "whole boolean, key long, a long, b long")
    ties.write.parquet(f"{folder}/ties")
    ties = spark.read.schema("whole boolean, key long, a long, b long").parquet(f"{folder}/ties")
    whole = ties.where("whole").select("key", "a")
    along = whole.join(whole.groupBy("key").agg(F.min("a").alias("b")), "key").where("a != b").select("a", "b")
    return pairs.unionByName(ties.where("NOT whole").select("a", "b")).unionByName(along)


def _sets(wanted):
    """The sets of the documents that pass the filter."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            chosen = packed.passes(packed.opened(wanted), ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
            for rows, texts in slices([batch.filter(pa.array(chosen))]):
                values, bounds = shingle_sets(texts)
                yield {"doc_id": rows.column("doc_id"), "size": np.diff(bounds),
                       "shingles": [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]}
    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of each pair of sets: the product of the rows with their transpose, stripe by stripe."""
    values, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))
    order = np.argsort(values)
    values, rows = values[order], rows[order]
    begins = np.append(True, values[1:] != values[:-1])
    column = np.cumsum(begins) - 1
    shared = np.bincount(column)[column] > 1
    column, rows = column[shared], rows[shared]
    column = np.cumsum(np.append(0, column[1:] != column[:-1])) if len(column) else column
    total = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, STRIPE):
        a, b = np.searchsorted(column, [start, start + STRIPE])
        stripe = np.zeros((len(sets), int(column[b - 1]) - start + 1), np.float32)
        stripe[rows[a:b], column[a:b] - start] = 1
        total += stripe @ stripe.T
    return total.astype(np.int64)


def linked(sets: list[np.ndarray], docs: np.ndarray) -> np.ndarray:
    """For each set the smallest document that links reach among these."""
    sizes = np.array(list(map(len, sets)))
    links = overlaps(sets) >= least_overlap(sizes[:, None], sizes[None, :])
    np.fill_diagonal(links, True)
    labels = docs.copy()
    while True:
        better = np.where(links, labels[None, :], np.iinfo(np.int64).max).min(1)
        if (better == labels).all():
            return labels
        labels = better


def _multiplied(key, table):
    docs = table.column("doc_id").to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    labels = linked(sets, docs)
    far = labels != docs
    return pa.table({"a": pa.array(docs[far], pa.int64()), "b": pa.array(labels[far], pa.int64())})


def _block_pairs(nodes: DataFrame) -> DataFrame:
    """``doc_id, size, component, pair`` for each pair of blocks that a row ``doc_id, size, component`` belongs to.

    A component of up to BLOCK_ROWS documents is one block. A larger one is cut by size,
    into bands of ratio 100 / PERCENT, and each band by hash; links join blocks of a band
    or of neighbouring ones only.
    """
    nodes = nodes.withColumn("band", F.floor(F.log(F.col("size")) / F.log(F.lit(100 / PERCENT)) + 1e-9))
    counts = nodes.groupBy("component", "band").agg(F.count("*").alias("n"))
    maps = counts.groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("band", "n"))).alias("bands"))
    nodes = nodes.join(maps, "component")
    whole = F.aggregate(F.map_values("bands"), F.lit(0).cast("long"), lambda x, y: x + y) <= BLOCK_ROWS
    parts = lambda b: F.ceil(F.coalesce(F.try_element_at("bands", b), F.lit(0)) / BLOCK_ROWS).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), parts(F.col("band"))).cast("int")
    name = lambda b1, p1, b2, p2: F.concat_ws(":", b1, p1, b2, p2)
    numbers = lambda b: F.when(parts(b) > 0, F.sequence(F.lit(0), parts(b) - 1)).otherwise(F.array().cast("array<int>"))
    below, above = F.col("band") - 1, F.col("band") + 1
    pairs = F.concat(
        F.transform(numbers(F.col("band")), lambda p: name(F.col("band"), F.least(own, p), F.col("band"), F.greatest(own, p))),
        F.transform(numbers(above), lambda p: name(F.col("band"), own, above, p)),
        F.transform(numbers(below), lambda p: name(below, p, F.col("band"), own)))
    return nodes.select("doc_id", "size", "component", F.explode(F.when(whole, F.array(F.lit(""))).otherwise(pairs)).alias("pair"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of ``docs``.

    Two documents link if 100 times the shingles they share is at least PERCENT times the
    shingles of both; the component is the smallest id that links reach. A text with fewer
    words than a shingle is one shingle; one without words has none and links with none.
    Rows with equal ids are one document as to links. A row without an id links with none,
    and its component is null. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    folder = work_folder(spark, "jaccard")
    survey = "doc_id long, size long, first long, second long, block int, counts binary"
    arrow_map(rows, _surveyed, survey).write.parquet(f"{folder}/survey")
    survey = spark.read.schema(survey).parquet(f"{folder}/survey")
    counters = packed.shared(spark, frequencies(survey))
    docs_of = survey.where("block IS NULL").select("doc_id", "size", "first", "second")
    known = docs_of.where("doc_id IS NOT NULL AND size > 0")
    classes = known.groupBy("first", "second").agg(F.min("doc_id").alias("least"))
    same = known.join(classes, ["first", "second"]).select("doc_id", "least")
    same.distinct().write.parquet(f"{folder}/same")
    same = spark.read.schema("doc_id long, least long").parquet(f"{folder}/same")
    ties = candidates(rows, known, counters, folder).distinct()
    for end in ("a", "b"):
        ties = ties.join(same.select(F.col("doc_id").alias(end), F.col("least").alias(f"{end}_least")), end)
    blocks = components(ties.select(F.col("a_least").alias("a"), F.col("b_least").alias("b")))
    blocks.write.parquet(f"{folder}/blocks")
    blocks = spark.read.schema("node long, component long").parquet(f"{folder}/blocks")
    wanted = packed.key_filter(blocks.select(F.col("node").alias("key")), WANTED_BITS)
    sets = arrow_map(rows, _sets(packed.shared(spark, wanted)), "doc_id long, size long, shingles binary")
    nodes = known.select("doc_id", "size").distinct().join(blocks.withColumnRenamed("node", "doc_id"), "doc_id")
    links = (sets.join(_block_pairs(nodes), ["doc_id", "size"]).select("component", "pair", "doc_id", "shingles")
             .groupBy("component", "pair").applyInArrow(_multiplied, "a long, b long"))
    found = components(links.unionByName(same.toDF("a", "b")))
    return (docs_of.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component; rows without an id stay."""
    lost = near_duplicates(docs).where("component_id != doc_id").select("doc_id")
    return docs.join(lost, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
