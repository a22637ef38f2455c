"""Packs documents into sequences of equal length, next to documents that share their words.

Documents are dealt to shards by their most telling token, the one with the highest tf-idf
over all documents, and a shard that would grow too large in tokens or rows is split by a hash of id,
rest and place in the written table, so that equal rows are dealt out too. Each shard has
an inverted index over token ids. A seed, the first document not used, asks it with its
most telling tokens; BM25 ranks the unused documents, and the best fill the window one by
one. The last one is cut where the window ends, and its rest is the next seed. So only the
last sequence of a shard is padded.

Whole windows of long documents are sequences of their own; only what is left over, less
than a window, is held in a shard.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.llm.segments import SLICE_BYTES, Encoder
from placewise.llm.texts import arrow_map, id_and_text, slices
from placewise.llm.token_counts import binaries
from placewise.session import work_folder

# Tokens of a sequence, and of the rests in a shard, about.
WINDOW = 2048
SHARD_TOKENS = 1 << 20
# What a rest counts for beside its tokens, so that a shard of empty texts has an end as well.
ROW_TOKENS = 16
# BM25: saturation of term counts and weight of the length; tokens of the seed that ask.
K1, B = 1.2, 0.75
QUERY_TOKENS = 32
# Sequences of one shard have ids from shard * SHARD_SEQUENCES on.
SHARD_SEQUENCES = 1 << 32


def crc(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def idf(frequency: np.ndarray, documents: int) -> np.ndarray:
    return np.log(1 + (documents - frequency + 0.5) / (frequency + 0.5))


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id, ids``: 16- or 32-bit ids of each text and the end."""
    def run(batches):
        encoder = Encoder.of(tokenizer)
        for batch, texts in slices(batches, SLICE_BYTES):
            ids, starts = encoder.encode(texts)
            ids = np.insert(ids, starts[1:], end_id)
            yield {"doc_id": batch.column("doc_id"), "ids": binaries(ids, starts + np.arange(len(starts)))}

    return arrow_map(id_and_text(docs), run, "doc_id long, ids binary")


def _frequencies(kind: str, size: int):
    def run(batches):
        counts, documents = np.zeros(size, np.int64), 0
        for batch in batches:
            for ids in batch.column("ids").to_pylist():
                counts[np.frombuffer(ids, kind)] += 1  # once for each token, however often a document has it
            documents += batch.num_rows
        token = np.flatnonzero(counts)
        yield {"token": np.append(token, -1), "n": np.append(counts[token], documents)}
    return run


def _measured(kind: str, weights):
    """For each document the checksums of its whole windows, its rest, the rest's most telling token, and its place in the task."""
    def run(batches):
        weight, number = weights.value, 0
        for batch in batches:
            ids_of, starts = [np.frombuffer(x, kind) for x in batch.column("ids").to_pylist()], batch.column("doc_id")
            windows, rests, signs = [], [], []
            for ids in ids_of:
                whole = len(ids) // WINDOW * WINDOW
                windows.append([crc(ids[i:i + WINDOW]) for i in range(0, whole, WINDOW)])
                rests.append(ids[whole:].tobytes())
                token, n = np.unique(ids[whole:], return_counts=True)
                signs.append(int(token[np.argmax(n * weight[token])]) if len(token) else 0)
            yield {"doc_id": starts, "tokens": list(map(len, ids_of)), "windows": windows, "rest": rests, "sign": signs,
                   "size": [len(ids) % WINDOW for ids in ids_of], "place": np.arange(number, number + batch.num_rows)}
            number += batch.num_rows
    return run


class Index:
    """Postings of the documents of one shard, by token."""

    def __init__(self, docs: list[np.ndarray], weight: np.ndarray):
        self.weight, self.size = weight, len(docs)
        lengths = np.array([len(d) for d in docs])
        terms = [np.unique(d, return_counts=True) for d in docs]
        tokens = np.concatenate([t for t, _ in terms])
        owners = np.repeat(np.arange(len(docs)), [len(t) for t, _ in terms])
        counts = np.concatenate([n for _, n in terms])
        norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean()))
        order = np.argsort(tokens, kind="stable")
        self.owners = owners[order]
        gain = counts * (K1 + 1) / (counts + norm[owners])
        self.gain = gain[order]
        self.tokens, self.starts = np.unique(tokens[order], return_index=True)
        self.starts = np.append(self.starts, len(order))

    def ranked(self, query: np.ndarray, used: np.ndarray) -> np.ndarray:
        """The unused documents that share a token with the query, best first."""
        terms = np.unique(query)
        terms = terms[np.argsort(-self.weight[terms], kind="stable")[:QUERY_TOKENS]]
        scores = np.zeros(self.size)
        for at in np.searchsorted(self.tokens, terms):
            a, b = self.starts[at], self.starts[at + 1]
            scores[self.owners[a:b]] += self.weight[self.tokens[at]] * self.gain[a:b]
        scores[used] = 0
        found = np.flatnonzero(scores)
        return found[np.argsort(-scores[found], kind="stable")]


def filled(docs: list[np.ndarray], weight: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """``document, start, length, sequence, offset`` of the pieces of a shard's documents."""
    index = Index(docs, weight)
    used, start = np.zeros(len(docs), bool), np.zeros(len(docs), np.int64)
    lengths = np.array([len(d) for d in docs])
    used[lengths == 0] = True
    pieces, sequence, seed, next_unused = [], 0, None, 0
    while True:
        while next_unused < len(docs) and used[next_unused]:
            next_unused += 1
        if next_unused == len(docs):
            return pieces
        seed = next_unused if seed is None or used[seed] else seed
        room, place, follow = WINDOW, seed, None
        while place is not None:
            take = int(min(room, lengths[place] - start[place]))
            pieces.append((place, int(start[place]), take, sequence, WINDOW - room))
            start[place] += take
            used[place] = start[place] == lengths[place]
            room -= take
            if not room:
                break
            if follow is None:
                # the query comes first, then the others in their order
                used_now = used.copy()
                follow = iter(np.append(index.ranked(docs[seed], used_now), -1).tolist())
            place = next((i for i in follow if i < 0 or not used[i]), None)
            if place == -1:
                unused = np.flatnonzero(~used)
                follow = iter(unused[1:].tolist())
                place = int(unused[0]) if len(unused) else None
        seed = place
        sequence += 1


def _packed(kind: str, weights):
    def run(key, table):
        import pyarrow as pa

        shard = key[0].as_py()
        order = np.lexsort((table.column("tokens").to_numpy(), table.column("doc_id").fill_null(-1).to_numpy()))
        table = table.take(pa.array(order))
        docs, tokens = table.column("doc_id").to_pylist(), table.column("tokens").to_pylist()
        rests = [np.frombuffer(x, kind) for x in table.column("rest").to_pylist()]
        rows = []
        number = 0
        for doc, n, windows in zip(docs, tokens, table.column("windows").to_pylist(), strict=True):
            for i, check in enumerate(windows):
                rows.append((doc, i * WINDOW, WINDOW, check, n, number, 0))
                number += 1
        for place, start, length, sequence, offset in filled(rests, weights.value):
            begin = tokens[place] - len(rests[place]) + start
            rows.append((docs[place], begin, length, crc(rests[place][start:start + length]), tokens[place], number + sequence, offset))
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        columns = dict(zip(names, zip(*rows, strict=True), strict=True))
        columns["sequence_id"] = [shard * SHARD_SEQUENCES + n for n in columns["sequence_id"]]
        return pa.table({name: pa.array(columns[name], pa.int64()) for name in names})
    return run


def shards(tokens: dict[int, int]) -> dict[int, tuple[int, int]]:
    """For each telling token its first shard and over how many its documents are dealt; small ones share a shard."""
    result, shard, room = {}, -1, 0
    for sign in sorted(tokens):
        if tokens[sign] > SHARD_TOKENS:
            parts = -(-tokens[sign] // SHARD_TOKENS)
            result[sign] = (shard + 1, parts)
            shard, room = shard + parts, 0
        else:
            if tokens[sign] > room:
                shard, room = shard + 1, SHARD_TOKENS
            result[sign] = (shard, 1)
            room -= tokens[sign]
    return result


def packed(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of each piece of ``docs``.

    Every id of every row is in one piece; a null or empty text is its end alone. Rows that
    repeat an id or have none are packed like others. Other columns are not read. What is
    broadcast and sent to the driver has an entry for each token of the vocabulary.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "packing")
    encoder = Encoder.of(tokenizer)
    size = encoder.tokenizer.get_vocab_size()
    kind = "<u2" if encoder.cache.typecode == "H" else "<u4"
    encoded(docs, tokenizer, end_id).write.parquet(f"{folder}/ids")
    ids = spark.read.schema("doc_id long, ids binary").parquet(f"{folder}/ids")
    counts = {r["token"]: r["n"] for r in arrow_map(ids.select("ids"), _frequencies(kind, size), "token int, n long")
              .groupBy("token").agg(F.sum("n").alias("n")).collect()}
    documents = counts.pop(-1, 0)
    frequency = np.zeros(size, np.int64)
    frequency[list(counts)] = list(counts.values())
    weights = spark.sparkContext.broadcast(idf(frequency, documents))
    measured = "doc_id long, tokens long, windows array<long>, rest binary, sign int, size long, place long"
    arrow_map(ids, _measured(kind, weights), measured).write.parquet(f"{folder}/measured")
    rows = spark.read.schema(measured).parquet(f"{folder}/measured")
    signs = {r["sign"]: r["n"] for r in rows.groupBy("sign").agg(F.sum(F.col("size") + ROW_TOKENS).alias("n")).collect()}
    places = shards(signs)
    table = spark.createDataFrame([(s, first, parts) for s, (first, parts) in places.items()], "sign int, first long, parts long")
    dealt = rows.join(F.broadcast(table), "sign").withColumn(
        "shard", F.col("first") + F.pmod(F.xxhash64("doc_id", "rest", "place"), F.col("parts")))
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.select("shard", "doc_id", "tokens", "windows", "rest").groupBy("shard").applyInArrow(_packed(kind, weights), kinds)
