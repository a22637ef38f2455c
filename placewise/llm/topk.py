"""The nearest vectors of every query by exact inner product, one component at a time.

Candidates are dealt into blocks of fixed size, queries into groups. In a task a block is
an inverted index: for each component the candidates that have it and their weights. A
group of queries goes through its components one after the other; the weights of a query
times the posted weights are added to its dense row of scores. Each row keeps its best by
partial selection, and a window over the kept ones merges the blocks.

Vectors that are null, or hold a null or a component that is not finite, take no part, neither as
query nor as candidate; an empty vector has the score 0 with all. A shorter vector has no postings for
the components it lacks. Scaled components and scores beyond a long count as the nearest
long. Rows may repeat and ids be null: every row is a candidate of its own, and a query leaves out only its own
row; ties go to the smaller id, null ids last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewise.llm.texts import arrow_schema
from placewise.session import work_folder

SCALE = 1024
BLOCK_ROWS, GROUP_ROWS = 2048, 1024
# Queries whose rows of scores are held at once.
_ROWS = 64
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def weights(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null for a vector that takes no part."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


class Postings:
    """The candidates of a block by component."""

    def __init__(self, rows: pa.ChunkedArray):
        vectors = rows.combine_chunks()
        self.count = len(vectors)
        offsets = vectors.offsets.to_numpy().astype(np.int64)
        values = vectors.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
        lengths = np.diff(offsets)
        place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        owner = np.repeat(np.arange(self.count), lengths)
        held = values != 0
        order = np.argsort(place[held], kind="stable")
        self.owners, self.weights, terms = owner[held][order], values[held][order], place[held][order]
        self.terms, firsts = np.unique(terms, return_index=True)
        self.bounds = np.append(firsts, len(terms))
        self.most = max(abs(int(values.min())), abs(int(values.max()))) if len(values) else 0

    def of(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.bounds[number], self.bounds[number + 1])
        return self.owners[own], self.weights[own]


def _scores(queries: Postings, items: Postings) -> np.ndarray:
    """The dense scores of all queries: exact, in Python's integers where a long might not do."""
    common, at, there = np.intersect1d(queries.terms, items.terms, return_indices=True)
    wide = queries.most * items.most * max(1, len(common)) > _MOST
    kind = object if wide else np.int64
    scores = np.zeros((queries.count, items.count), kind)
    for mine, theirs in zip(at.tolist(), there.tolist(), strict=True):
        rows, own = queries.of(mine)
        posted, weight = items.of(theirs)
        added = own.astype(kind)[:, None] * weight.astype(kind)[None, :]
        if len(rows) == queries.count and len(posted) == items.count:
            scores += added
        else:
            scores[np.ix_(rows, posted)] += added
    return np.clip(scores, _LEAST, _MOST).astype(np.int64) if wide else scores


def _best(queries: pa.Table, items: pa.Table, k: int) -> dict[str, np.ndarray]:
    """The ``k`` best candidates of the block for each query."""
    if not queries.num_rows or not items.num_rows:
        return {name.split()[0]: [] for name in _FOUND.split(", ")}
    rows = items.column("row").to_numpy()
    missing = items.column("vec_id").is_null().to_numpy()
    ids = items.column("vec_id").fill_null(0).to_numpy()
    order = np.lexsort((rows, ids, missing))
    items, rows = items.take(pa.array(order)), rows[order]  # now a smaller place wins a tie
    postings = Postings(items.column("weights"))
    asked, found, kept = [], [], []
    own_rows = queries.column("row").to_numpy()
    for start in range(0, queries.num_rows, _ROWS):
        part = queries.slice(start, _ROWS)
        scores = _scores(Postings(part.column("weights")), postings)
        own = own_rows[start:start + _ROWS]
        wanted = min(k + 1, len(rows))  # the query's own row may be among them
        least = np.partition(scores, len(rows) - wanted, axis=1)[:, len(rows) - wanted]
        for number in range(len(own)):
            at = np.flatnonzero((scores[number] >= least[number]) & (rows != own[number]))
            at = at[np.argsort(~scores[number, at], kind="stable")][:k]  # ~x falls as x rises, and never overflows
            asked.append(np.full(len(at), start + number))
            found.append(at)
            kept.append(scores[number, at])
    asked, found = np.concatenate(asked), np.concatenate(found)
    return {"query_row": own_rows[asked], "query_id": queries.column("vec_id").take(pa.array(asked)), "row": rows[found],
            "vec_id": items.column("vec_id").take(pa.array(found)), "score": np.concatenate(kept)}


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of all other rows for each row that ``is_query`` holds for.

    ``vectors``: ``vec_id`` (long) and ``embedding`` (array of numbers).
    """
    spark = vectors.sparkSession
    folder = work_folder(spark, "topk")
    taken = vectors.select("vec_id", weights(F.col("embedding"), scale).alias("weights"), F.coalesce(is_query, F.lit(False)).alias("asks"),
                           F.monotonically_increasing_id().alias("row")).where("weights IS NOT NULL")
    taken.write.parquet(f"{folder}/taken")
    taken = spark.read.schema(taken.schema).parquet(f"{folder}/taken")
    n_items, n_queries = taken.agg(F.count("*"), F.count_if("asks")).first()
    blocks, groups = max(1, -(-n_items // BLOCK_ROWS)), max(1, -(-n_queries // GROUP_ROWS))
    # A cell is a block against a group. A block is sent to each group and a group to each block.
    dealt = lambda parts: F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    items = taken.select("row", "vec_id", "weights", dealt(blocks).alias("block"), every(groups).alias("group"))
    queries = taken.where("asks").select("row", "vec_id", "weights", dealt(groups).alias("group"), every(blocks).alias("block"))
    schema = arrow_schema(_FOUND)

    def best(asking: pa.Table, asked: pa.Table) -> pa.Table:
        return pa.table(_best(asking, asked, k), schema=schema)

    found = queries.groupBy("block", "group").cogroup(items.groupBy("block", "group")).applyInArrow(best, _FOUND)
    by_query = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
