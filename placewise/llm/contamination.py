"""Finds benchmark passages in documents, as a prefix-filtered set join.

A window of an item, 10 words, is a set of shingles of 3 words with their places. To be in
a document it must be there with all of them, so one necessary shingle is enough to find
it: the rarest, by counts over all documents. Documents are searched for these only, a
match must leave room for the whole window on both sides, and the words are compared last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewise.llm.texts import LOWER, SIGNS, Words, arrow_map, run_hashes, slices, whole_runs
from placewise.session import work_folder

# Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 3
# Bits (a power of two) of the filter of needed shingles, which is broadcast: 2 MB, however many items there are.
FILTER_BITS = 24
# Bytes of windows up to which Spark is told to broadcast the needed shingles; beyond, it joins by shuffles.
BROADCAST_BYTES = 16 << 20
# Bytes of words, about, that a task turns into rows of hits at once.
HIT_BYTES = 1 << 20


def words_of(text: Column | str) -> Column:
    """The words of a text: lower-cased runs of ASCII letters, digits and all that is not ASCII."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def item_windows(items: DataFrame) -> DataFrame:
    """``item_id, window``: each item's runs of WINDOW words; a shorter item is one run. Items without words have none."""
    words = items.select("item_id", words_of("text").alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - WINDOW + 1))
    return words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, WINDOW))).alias("window")).distinct()


def _keys(batches):
    """The shingles of each window by place: hashes of SHINGLE words, or of all words of a shorter window."""
    for batch, texts in slices(batches):
        words = Words(texts)
        hashes = words.hashes(1)
        keys = []
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            keys.append(run_hashes(hashes[:, a:b], min(SHINGLE, b - a)).view(np.int64).tolist())
        yield {"window": texts.cast(pa.string()), "keys": keys}


def _bits(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint64) >> np.uint64(64 - FILTER_BITS)


def _found(words: Words, hashes: np.ndarray, length: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts and hashes of the runs of ``length`` words that pass the filter."""
    starts = whole_runs(words, length)
    keys = run_hashes(hashes, length)[starts]
    place = _bits(keys)
    passing = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return starts[passing], keys[passing].view(np.int64)


def _counted(filters):
    """How often each shingle that passes occurs."""
    def run(batches):
        for batch, texts in slices(batches):
            words = Words(texts, SIGNS, LOWER)
            hashes = words.hashes(1)
            keys = np.concatenate([_found(words, hashes, n, bits)[1] for n, bits in filters.value.items()])
            distinct, counts = np.unique(keys, return_counts=True)
            yield {"key": distinct, "n": counts}
    return run


def _searched(filters):
    """A row without a key for each document, and one for each needed shingle found: its place and the words around."""
    def run(batches):
        for batch, texts in slices(batches):
            words = Words(texts, SIGNS, LOWER)
            hashes = words.hashes(1)
            owners = words.owners()
            none = [None] * batch.num_rows
            yield {"row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_words": words.counts,
                   "key": none, "place": none, "begin": none, "around": none}
            for length, bits in filters.value.items():
                starts, keys = _found(words, hashes, length, bits)
                first, last = words.first[owners[starts]], words.first[owners[starts] + 1]
                begin, end = np.maximum(first, starts - WINDOW + 1), np.minimum(last, starts + WINDOW)
                ends = np.cumsum(words.bytes_between(begin, end) + WINDOW)
                a = 0
                while a < len(starts):
                    b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + HIT_BYTES, "right")))
                    own = pa.array(owners[starts[a:b]])
                    yield {"row": batch.column("row").take(own), "doc_id": batch.column("doc_id").take(own), "n_words": words.counts[own.to_numpy()],
                           "key": keys[a:b], "place": (starts - first)[a:b], "begin": (begin - first)[a:b],
                           "around": [words.between(x, y) for x, y in zip(begin[a:b].tolist(), end[a:b].tolist(), strict=True)]}
                    a = b
    return run


def _filters(keys: DataFrame) -> dict[int, np.ndarray]:
    """A filter of fixed size for each length of shingle, from ``length, key``."""
    places = keys.select("length", F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("bit")).distinct()
    filters: dict[int, np.ndarray] = {}
    for row in places.toLocalIterator():
        bits = filters.setdefault(row["length"], np.zeros(1 << (FILTER_BITS - 3), np.uint8))
        bits[row["bit"] >> 3] |= 1 << (row["bit"] & 7)
    return filters or {SHINGLE: np.zeros(1 << (FILTER_BITS - 3), np.uint8)}


def needed_shingles(docs: DataFrame, items: DataFrame, folder: str) -> DataFrame:
    """``item_id, window, length, key, place``: of each window the shingle that is rarest in ``docs``, and where it stands."""
    spark = docs.sparkSession
    windows = item_windows(items)
    keyed = arrow_map(windows.select(F.array_join("window", " ").alias("text")).distinct(), _keys, "window string, keys array<long>")
    places = keyed.select("window", F.size(F.split("window", " ")).alias("words"), F.posexplode("keys").alias("place", "key"))
    places = places.withColumn("length", F.least("words", F.lit(SHINGLE)))
    places.write.parquet(f"{folder}/places")
    places = spark.read.parquet(f"{folder}/places")
    filters = spark.sparkContext.broadcast(_filters(places))
    counts = arrow_map(docs.select("text"), _counted(filters), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "key", "length")).alias("best")
    rarest = places.join(counts, "key", "left").groupBy("window").agg(best).select("window", "best.*").drop("n")
    return windows.select("item_id", F.array_join("window", " ").alias("window")).join(rarest, "window")


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``row, doc_id, n_words, n_hit, items`` of each row of ``docs``: its words, those inside a window of an item, and these items.

    ``row`` is ``xxhash64(doc_id, text)``, a null text being empty. ``items`` has ``item_id, text``; ids are given as sorted strings. A text that is null or
    without words has none and is not hit, an item without words hits nothing, and items
    with one text are all given. Rows with equal ids are searched each by itself. Other
    columns are not read. A text of any length is one of many rows of hits: a task holds
    its words and HIT_BYTES of hits.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "contamination")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    needed_shingles(rows, items, folder).write.parquet(f"{folder}/needed")
    needed = spark.read.schema("window string, item_id string, place int, key long, length int").parquet(f"{folder}/needed")
    filters = spark.sparkContext.broadcast(_filters(needed.select("length", "key")))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    kind = "row long, doc_id long, n_words long, key long, place int, begin int, around array<string>"
    arrow_map(rows, _searched(filters), kind).write.parquet(f"{folder}/found")
    # a row is told by its hash and its id
    found = spark.read.schema(kind).parquet(f"{folder}/found").withColumn("id", F.coalesce("doc_id", F.lit(0)))

    windows = needed.select("key", F.col("place").alias("offset"), F.split("window", " ").alias("window"), "window", "item_id").toDF(
        "key", "offset", "words", "window", "item_id")
    distinct = windows.select("key", "offset", "words", "window").distinct()
    size = needed.agg(F.sum(2 * F.length(F.encode("window", "utf-8")) + F.coalesce(F.length("item_id"), F.lit(0)) + 100)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        windows, distinct = F.broadcast(windows.select("window", "item_id")), F.broadcast(distinct)
    matches = found.where("key IS NOT NULL").drop("doc_id").join(distinct, "key")
    start, length = F.col("place") - F.col("offset"), F.size("words")
    matches = (matches.where((start >= F.col("begin")) & (start + length <= F.col("n_words")))
               .where(F.slice("around", start - F.col("begin") + 1, length) == F.col("words"))
               .select("row", "id", start.alias("start"), (start + length).alias("end"), "window").distinct())
    before = F.max("end").over(Window.partitionBy("row", "id").orderBy("start", "end", "window").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))))
    hits = matches.withColumn("fresh", fresh).groupBy("row", "id").agg(F.sum("fresh").alias("n_hit"))
    of = (matches.select("row", "id", "window").distinct().join(windows, "window").groupBy("row", "id")
          .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    return (found.where("key IS NULL").select("row", "id", "doc_id", "n_words").join(hits.join(of, ["row", "id"]), ["row", "id"], "left")
            .select("row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a word that a window of an item covers."""
    hit = contaminated(docs, items).where("n_hit > 0").select(F.col("row").alias("hit_row"), F.col("doc_id").alias("hit_doc")).distinct()
    own = F.xxhash64(docs["doc_id"], F.coalesce(docs["text"], F.lit("")))
    return docs.join(hit, docs["doc_id"].eqNullSafe(F.col("hit_doc")) & (own == F.col("hit_row")), "left_anti")
