"""A Merkle manifest of a table, and octopus multiproofs of its rows.

Every row is a leaf. The leaves of a group (``source``) in the order of their key are the
bottom of a tree whose runs of 16 nodes become one; the tops of the groups are the bottom
of one more tree. Leaves are proved in runs of consecutive ones, whatever group they are
of: a run asks once for the smallest set of nodes it can't work out itself, works out all
nodes that its leaves share, and expands each leaf's own proof from these.

Nulls: a null field counts as ``-``; a null group is a group, the first one; null keys come
first in their group. Rows with equal keys are leaves one after the other, in the order of their
digests; rows that are equal throughout can be told apart by nothing, so their order among each other
changes no row of the result. Empty tables give empty results. Texts of any length are hashed where they are
read and go no further; columns that are not fields are not looked at. A group of any size, or a key of any
number of rows, is cut into runs like all else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.llm.texts import arrow_map, arrow_schema
from placewise.session import work_folder

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Leaves that are proved together.
RUN_LEAVES = 4096
# The tree over the tops of the groups.
TOP = -1

_NODE = "tree long, level int, place long, digest string, size long"
_PROOF = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, n_siblings int")


def leaf_digest(values: Iterable[Column]) -> Column:
    """The digest of a row: each value with its number of bytes before it."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: run, tree, place, size, doc_id, leaf, held. ``nodes``: tree, level, place, digest, size (of that level)."""
    leaves: DataFrame
    nodes: DataFrame
    n_groups: int

    def root(self) -> str | None:
        """The digest of the whole table; None of an empty one."""
        top = self.nodes.where((F.col("tree") == TOP) & (F.col("size") == 1)).select("digest").first()
        return top and top[0]


def _numbered(df: DataFrame, folder: str, *order: Column) -> DataFrame:
    """The rows with ``at``, their number in this order from 0, as a written table.

    The driver learns one count for each task that wrote.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder).withColumn("task", F.shiftright("at", 33))
    counts = placed.groupBy("task").count().orderBy("task").collect()
    before = np.cumsum([0, *(r["count"] for r in counts)]).tolist()
    offsets = spark.createDataFrame([(r["task"], n) for r, n in zip(counts, before, strict=False)], "task long, before long")
    inner = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "task").withColumn("at", F.col("before") + inner).drop("task", "before")


def manifest(docs: DataFrame, claimed: dict[str, Column] | None = None, key: str = "doc_id", group: str = "source",
             fields: Iterable[str] = FIELDS) -> Manifest:
    """The trees of ``docs``. ``claimed``: what a holder of the rows has for some fields, as columns of ``docs``;
    the manifest is of the rows themselves, and ``held`` is the digest of what the holder has.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "merkle")
    held = [(claimed or {}).get(name, F.col(name)) for name in fields]
    rows = docs.select(F.col(key).alias("doc_id"), F.col(group).alias("source"),
                       leaf_digest(map(F.col, fields)).alias("leaf"), leaf_digest(held).alias("held"),
                       F.monotonically_increasing_id().alias("salt"))
    # The texts are read once; only digests are sorted. The salt deals out rows that are equal.
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    rows = _numbered(rows, f"{folder}/leaves", F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("salt"))
    rows = rows.drop("salt").withColumn("run", F.floor(F.col("at") / RUN_LEAVES).cast("long"))
    runs = rows.groupBy("run", "source").agg(F.min("at").alias("first"), F.count("*").alias("own"))
    groups = _numbered(runs.groupBy("source").agg(F.min("first").alias("first"), F.sum("own").alias("size")),
                       f"{folder}/groups", F.col("source").asc_nulls_first()).withColumnRenamed("at", "tree")
    named = runs.select("run", "source").alias("r").join(groups.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source"))) \
        .select("run", F.col("r.source").alias("of"), "tree", "first", "size")
    leaves = rows.withColumnRenamed("run", "in_run").join(named, (F.col("in_run") == F.col("run")) & F.col("source").eqNullSafe(F.col("of"))) \
        .select("run", "tree", (F.col("at") - F.col("first")).alias("place"), "size", "doc_id", "leaf", "held")
    leaves.write.parquet(f"{folder}/placed")
    leaves = spark.read.schema(leaves.schema).parquet(f"{folder}/placed")

    bottom = leaves.select("tree", F.lit(0).alias("level"), "place", F.col("leaf").alias("digest"), "size")
    nodes = _grown(bottom, f"{folder}/nodes")
    count = groups.count()
    tops = nodes.where("size = 1").select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"),
                                          "digest", F.lit(count).cast("long").alias("size"))
    tops.write.parquet(f"{folder}/tops")
    above = _grown(spark.read.schema(_NODE).parquet(f"{folder}/tops"), f"{folder}/above")
    return Manifest(leaves, nodes.unionByName(above), count)


def _grown(bottom: DataFrame, folder: str) -> DataFrame:
    """The nodes of all levels: those of ``bottom``, then one table for each level above."""
    spark, nodes, current = bottom.sparkSession, bottom, bottom
    most = bottom.agg(F.max("size")).first()[0] or 0
    level = 0
    while most > 1:
        level, most = level + 1, -(-most // ARITY)
        own = F.array_sort(F.collect_list(F.struct("place", "digest")))
        above = F.floor(F.col("place") / ARITY).cast("long")
        current.where("size > 1").groupBy("tree", above.alias("above")).agg(own.alias("own"), F.first("size").alias("below")).select(
            "tree", F.lit(level).alias("level"), F.col("above").alias("place"), F.sha2(F.array_join("own.digest", ""), 256).alias("digest"),
            F.ceil(F.col("below") / ARITY).cast("long").alias("size")).write.parquet(f"{folder}/{level}")
        current = spark.read.schema(_NODE).parquet(f"{folder}/{level}")
        nodes = nodes.unionByName(current)
    return nodes


def missing(places: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(level, places)`` of the nodes that the leaves in ``places`` (ascending) need and can't work out.

    The smallest such set: what lies in a run with a known node and is not known. ``size``: leaves of the tree.
    """
    level, known = 0, np.unique(places)
    while size > 1:
        parents = np.unique(known // ARITY)
        needed = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        needed = np.setdiff1d(needed[needed < size], known, assume_unique=True)
        if len(needed):
            yield level, needed
        level, size, known = level + 1, -(-size // ARITY), parents


def _requests(batches):
    for batch in batches:
        for row in batch.to_pylist():
            for level, places in missing(np.arange(row["begin"], row["end"]), row["size"]):
                yield {"run": [row["run"]] * len(places), "tree": [row["tree"]] * len(places), "level": [level] * len(places), "place": places}


def _digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class _Tree:
    """The part of a tree that a run of leaves knows: by level, digests by place."""

    def __init__(self, size: int, leaves: dict[int, str], fetched: dict[int, dict[int, str]]):
        self.sizes, self.levels = [size], [leaves | fetched.get(0, {})]
        known = sorted(leaves)
        while self.sizes[-1] > 1:
            known = sorted({place // ARITY for place in known})
            self.sizes.append(-(-self.sizes[-1] // ARITY))
            own = {place: _digest(self.run(len(self.levels) - 1, place)) for place in known}
            self.levels.append(own | fetched.get(len(self.levels), {}))
        self.top = self.levels[-1][0]
        self._above: dict[tuple[int, int], tuple[str, int]] = {}
        self._folds: dict[tuple[int, int, str], str] = {}

    def run(self, level: int, parent: int) -> list[str]:
        digests = self.levels[level]
        return [digests[place] for place in range(parent * ARITY, min(self.sizes[level], (parent + 1) * ARITY))]

    def siblings(self, level: int, place: int, end: tuple[str, int]) -> tuple[str, int]:
        """The siblings on the way from a node to the top in a row, then ``end``, and their number."""
        if self.sizes[level] == 1:
            return end
        parent = place // ARITY
        if (level, parent) not in self._above:
            self._above[level, parent] = self.siblings(level + 1, parent, end)
        own = self.run(level, parent)
        del own[place % ARITY]
        rest, count = self._above[level, parent]
        return "".join(own) + rest, len(own) + count

    def fold(self, place: int, digest: str) -> str:
        """The top as it would be with ``digest`` in place of a leaf."""
        for level in range(len(self.sizes) - 1):
            parent = place // ARITY
            key = (level, place, digest)
            if key not in self._folds:
                run = self.run(level, parent)
                run[place % ARITY] = digest
                self._folds[key] = _digest(run)
            place, digest = parent, self._folds[key]
        return digest


def _expanded(leaves: pa.Table, nodes: pa.Table, n_groups: int) -> dict[str, list]:
    """The proofs of a run of leaves from the nodes that it fetched."""
    fetched: dict[int, dict[int, dict[int, str]]] = {}
    for tree, level, place, digest in zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "place", "digest")), strict=True):
        fetched.setdefault(tree, {}).setdefault(level, {})[place] = digest
    own = list(zip(*(leaves.column(c).to_pylist() for c in ("tree", "place", "size", "doc_id", "leaf", "held")), strict=True))
    bottoms: dict[int, tuple[int, dict[int, str]]] = {}
    for tree, place, size, _, leaf, _ in own:
        bottoms.setdefault(tree, (size, {}))[1][place] = leaf
    trees = {tree: _Tree(size, digests, fetched.get(tree, {})) for tree, (size, digests) in bottoms.items()}
    top = _Tree(n_groups, {tree: t.top for tree, t in trees.items()}, fetched.get(TOP, {}))
    ends = {tree: top.siblings(0, tree, ("", 0)) for tree in trees}
    out: dict[str, list] = {name.split()[0]: [] for name in _PROOF.split(", ")}
    for tree, place, _, doc_id, leaf, held in own:
        proof, count = trees[tree].siblings(0, place, ends[tree])
        folded = top.fold(tree, trees[tree].fold(place, held))
        for name, value in zip(out, (doc_id, leaf, trees[tree].top, top.top, _digest([proof]), folded, folded == top.top, count), strict=True):
            out[name].append(value)
    return out


def proofs(made: Manifest) -> DataFrame:
    """A row for each leaf: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, n_siblings``.

    ``proof_sha256`` is the digest of the siblings on the way to the root, ``folded_root`` the root that
    ``held`` and these siblings give; ``verified`` says that it is the root.
    """
    spans = made.leaves.groupBy("run", "tree", "size").agg(F.min("place").alias("begin"), (F.max("place") + 1).alias("end"))
    over = spans.groupBy("run").agg(F.min("tree").alias("begin"), (F.max("tree") + 1).alias("end")) \
        .select("run", F.lit(TOP).cast("long").alias("tree"), F.lit(made.n_groups).cast("long").alias("size"), "begin", "end")
    wanted = arrow_map(spans.unionByName(over), _requests, "run long, tree long, level int, place long")
    fetched = wanted.join(made.nodes.drop("size"), ["tree", "level", "place"])
    schema, n_groups = arrow_schema(_PROOF), made.n_groups

    def expand(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        return pa.table(_expanded(leaves, nodes, n_groups), schema=schema)

    return made.leaves.groupBy("run").cogroup(fetched.groupBy("run")).applyInArrow(expand, _PROOF)
