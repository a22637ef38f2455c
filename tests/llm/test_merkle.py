"""Merkle manifest against a plain tree, and multiproofs against single proofs."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from placewise.llm import merkle, queries
from tests.llm.conftest import expected, passages, rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, place):
    """Each level's siblings, and the node's place among them."""
    found = []
    for level in levels[:-1]:
        run = place // 16 * 16
        found.append((level[run:place] + level[place + 1:run + 16], place - run))
        place //= 16
    return found


def plain(docs):
    """What op11 returns, one row after the other."""
    order = sorted({d[1] for d in docs}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((d for d in docs if d[1] == s), key=lambda d: (d[0] is not None, d[0] or 0, leaf(d))) for s in order]
    trees = [tree([leaf(d) for d in g]) for g in groups]
    top = tree([t[-1][0] for t in trees])
    found = []
    for number, group in enumerate(groups):
        for place, doc in enumerate(group):
            steps = way(trees[number], place) + way(top, number)
            held = doc
            if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 5 == 0 and doc[4] is not None:
                held = (*doc[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in doc[4]))
            folded = leaf(held)
            for siblings, at in steps:
                folded = digest([*siblings[:at], folded, *siblings[at:]])
            found.append((doc[0], leaf(doc), trees[number][-1][0], top[-1][0], digest(s for step in steps for s in step[0]), folded,
                          folded == top[-1][0], sum(len(s) for s, _ in steps)))
    return found


def docs_of(spark, docs):
    return spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, source string, lang string, n_chars long, text string, leaf string, place int").repartition(3)


def odd_docs():
    rng, texts = random.Random(4), passages(6, 40)
    docs = [(i, rng.choice(["hot", "hot", "b", None, "é", "Z"]), rng.choice(["en", None]), rng.choice([None, 7]), rng.choice([*texts, "", None, "ABC " * i]))
            for i in rng.sample(range(-20, 900), 700)]
    docs += [(5, "hot", "en", 1, "Same ROW")] * 40 + [(None, None, None, None, None)] * 20 + [(6, "hot", "en", n, "same id") for n in range(30)]
    docs += [(10_000 + i, f"small{i}", "en", 1, "A lone leaf") for i in range(40)] + [(20_000, "long", "en", 1, "Very LONG " * 300_000)]
    return docs


@pytest.mark.parametrize("run", [7, 16, 4096])
def test_proofs_are_those_of_a_plain_tree(spark, monkeypatch, run):
    monkeypatch.setattr(merkle, "RUN_LEAVES", run)
    docs = odd_docs() if run != 7 else odd_docs()[::4]
    monkeypatch.setattr(queries, "table", lambda *_: docs_of(spark, docs))
    assert rows(queries.op11_merkle_manifest(spark, "")) == expected(plain(docs))


@pytest.mark.parametrize("docs", [[(1, "a", None, None, "A")], [(1, "a", "en", 1, "A"), (2, "b", "en", 1, "B")],
                                  [(i, "a", "en", 1, "T") for i in range(17)]])
def test_small_trees(spark, monkeypatch, docs):
    monkeypatch.setattr(queries, "table", lambda *_: docs_of(spark, docs))
    assert rows(queries.op11_merkle_manifest(spark, "")) == expected(plain(docs))


def test_an_empty_table_has_no_rows_and_no_root(spark):
    made = merkle.manifest(docs_of(spark, [(1, "a", None, None, "A")]).limit(0))
    assert rows(merkle.proofs(made)) == [] and made.root() is None


def test_the_root_is_the_same_however_rows_are_dealt(spark):
    docs = docs_of(spark, odd_docs()[:200])
    assert merkle.manifest(docs).root() == merkle.manifest(docs.repartition(7, F.rand(3))).root() == plain(odd_docs()[:200])[0][3]


def test_only_what_was_claimed_is_held_against_the_root(spark):
    docs = docs_of(spark, [(i, "a", "en", i, "t") for i in range(40)])
    found = merkle.proofs(merkle.manifest(docs, {"n_chars": F.when(F.col("doc_id") == 7, 0).otherwise(F.col("n_chars"))}))
    assert {r["doc_id"] for r in found.where("NOT verified").collect()} == {7}


def test_missing_nodes_are_the_fewest(spark):
    """All nodes a run of leaves needs but those it can work out, each once."""
    rng = random.Random(1)
    for size in (1, 2, 16, 17, 300, 5000):
        chosen = sorted(rng.sample(range(size), min(size, rng.choice([1, 3, 40]))))
        levels = tree([str(i) for i in range(size)])
        needed, known = set(), [set()]
        for place in chosen:
            at = place
            for level in range(len(levels) - 1):
                known[level].add(at)
                known.append(set())
                needed |= {(level, s) for s in range(at // 16 * 16, min(len(levels[level]), at // 16 * 16 + 16))}
                at //= 16
        needed -= {(level, at) for level, own in enumerate(known) for at in own}
        found = [(level, at) for level, places in merkle.missing(np.array(chosen), size) for at in places.tolist()]
        assert len(found) == len(set(found)) and set(found) == needed


def test_a_run_fetches_few_nodes_once(spark):
    made = merkle.manifest(docs_of(spark, [(i, "a", "en", 1, "t") for i in range(9000)]))
    spans = made.leaves.groupBy("run", "tree", "size").agg(F.min("place").alias("begin"), (F.max("place") + 1).alias("end")).collect()
    asked = {s["run"]: sum(len(p) for _, p in merkle.missing(np.arange(s["begin"], s["end"]), s["size"])) for s in spans}
    assert len(asked) == 3 and max(asked.values()) <= 30
