"""A quality classifier of few readable rules over counts of the text.

Trees of a small forest are grown on labelled documents. Every path from a root to a node
is a rule: a conjunction of comparisons. A logistic model with a lasso penalty weighs the
rules and drops most of them. What is left is a Spark column expression, so that scoring
runs no model code at all.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.llm.measures import Measured
from placewise.llm.texts import arrow_map, slices
from placewise.session import work_folder

# Labelled documents that are learnt from, at most: those with the smallest hash of the id.
TRAIN_ROWS = 20_000
TREES, DEPTH = 20, 3
# Weight of the lasso penalty.
PENALTY = 0.002
ROUNDS = 40
SEED = 7
MEASURES = ("n_words", "n_chars", "word_chars", "n_symbols", "n_stops", "n_digits", "n_capitals", "n_letters", "n_lines",
            "n_dup_lines", "n_same_words", "n_distinct_words", "n_repeat_words", "longest_word")


def statistics() -> dict[str, Column]:
    """Statistics of a text by name, as expressions over its counts."""
    part = lambda n, of: F.coalesce(F.try_divide(F.col(n), F.col(of)), F.lit(0.0))
    return {
        "words": F.log1p(F.col("n_words").cast("double")), "word_length": part("word_chars", "n_words"),
        "symbols": part("n_symbols", "n_words"), "stops": part("n_stops", "n_words"), "digits": part("n_digits", "word_chars"),
        "capitals": part("n_capitals", "word_chars"), "letters": part("n_letters", "word_chars"), "line_words": part("n_words", "n_lines"),
        "same_lines": part("n_dup_lines", "n_lines"), "same_words": part("n_same_words", "n_words"),
        "distinct": part("n_distinct_words", "n_words"), "repeats": part("n_repeat_words", "n_words"),
        "longest": F.log1p(F.col("longest_word").cast("double")),
    }


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    limit: float

    def column(self) -> Column:
        return F.col(self.statistic) > self.limit if self.above else F.col(self.statistic) <= self.limit


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Ensemble:
    """``base + sum of the weights of the rules that hold`` is the log-odds of quality."""

    base: float
    rules: tuple[tuple[Rule, float], ...] = ()
    #: documents that it was learnt from
    learnt_from: int = 0

    def score(self) -> Column:
        """Over the columns of :func:`statistics`."""
        odds = F.lit(self.base)
        for rule, weight in self.rules:
            odds = odds + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


def holds(rule: Rule) -> Column:
    found = rule[0].column()
    for condition in rule[1:]:
        found = found & condition.column()
    return found


def measured(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but ``text`` with the counts of ``text``; names must not clash."""
    schema = [f for f in rows.schema if f.name != "text"]

    def run(batches):
        for batch, texts in slices(batches):
            own = Measured(texts)
            yield {f.name: batch.column(f.name) for f in schema} | {m: getattr(own, m)() for m in MEASURES}

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + [f"{m} long" for m in MEASURES]
    return arrow_map(rows, run, ", ".join(columns))


def paths(tree: str, names: list[str]) -> set[Rule]:
    """The rules of a tree as Spark prints it: one for each node below the root."""
    rules, stack = set(), []
    for line in tree.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.Ee+]+)\)", line)
        if found:
            depth = len(found[1])
            stack = [(d, c) for d, c in stack if d < depth] + [(depth, Condition(names[int(found[2])], found[3] == ">", float(found[4])))]
            rules.add(tuple(sorted({c for _, c in stack}, key=lambda c: (c.statistic, c.above, c.limit))))
    return rules


def learnt(labelled: DataFrame) -> Ensemble:
    """The ensemble for rows of statistics with ``label`` (0 or 1). Without both labels it is their smoothed part."""
    names = list(statistics())
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    good, all_ = counts.get(1, 0), counts.get(1, 0) + counts.get(0, 0)
    if good in (0, all_):
        return Ensemble(math.log((good + 1) / (all_ - good + 1)), (), all_)
    labelled = labelled.withColumn("label", F.col("label").cast("double"))
    forest = RandomForestClassifier(featuresCol="all", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                    featureSubsetStrategy="onethird", minInstancesPerNode=5)
    model = forest.fit(VectorAssembler(inputCols=names, outputCol="all").transform(labelled))
    rules = sorted({rule for tree in model.trees for rule in paths(tree.toDebugString, names)}, key=str)
    if not rules:
        return Ensemble(math.log((good + 1) / (all_ - good + 1)), (), all_)
    held = labelled.select("label", F.array(*(holds(r).cast("double") for r in rules)).alias("held"))
    from pyspark.ml.functions import array_to_vector

    lasso = LogisticRegression(featuresCol="held", labelCol="label", elasticNetParam=1.0, regParam=PENALTY, maxIter=ROUNDS, standardization=False)
    fitted = lasso.fit(held.select("label", array_to_vector("held").alias("held")))
    weights = fitted.coefficients.toArray()
    return Ensemble(float(fitted.intercept), tuple((rules[i], float(weights[i])) for i in np.flatnonzero(weights)), all_)


def trained(docs: DataFrame, labels: DataFrame, held_out: Column | None = None) -> tuple[Ensemble, DataFrame]:
    """The ensemble for ``docs``, and ``doc_id`` with the counts of all documents, which are yet to be worked out.

    ``labels`` has ``doc_id, quality``. Labels of ids that ``held_out`` holds for are not
    used, nor null ones; an id with several labels counts with the smallest. Ids and other
    columns of ``docs`` choose what is learnt from and are no inputs of the score. Labelled
    documents are chosen before they are measured, others only when they are scored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = labels.where("quality IN (0, 1)")
    if held_out is not None:
        known = known.where(~F.coalesce(held_out, F.lit(False)))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"))
    # twice as many as are needed by hash, of which the first are taken: few rows for the one task that sorts them
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    part = min(1.0, 2 * TRAIN_ROWS / max(1, known.count()))
    few = known.where(place < int(part * (1 << 40)))
    if few.count() <= 4 * TRAIN_ROWS:  # 16 bytes each
        few = F.broadcast(few)
    chosen = measured(texts.join(few, "doc_id")).orderBy(place, "doc_id", *MEASURES).limit(TRAIN_ROWS)
    sample = work_folder(docs.sparkSession, "labelled")
    chosen.select("label", *(c.alias(n) for n, c in statistics().items())).write.parquet(sample)
    return learnt(docs.sparkSession.read.parquet(sample)), measured(texts)


def scored(counts: DataFrame, ensemble: Ensemble) -> DataFrame:
    """``counts`` with ``score``: the likelihood of quality, between 0 and 1. Empty texts get one as well."""
    inner = [f"`{c}`" for c in counts.columns]
    return counts.select(*inner, *(c.alias(n) for n, c in statistics().items())).select(*inner, ensemble.score().alias("score"))


def good(docs: DataFrame, labels: DataFrame, least: float, held_out: Column | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``least`` or more. Repeated rows are scored each.

    Where labels are of one kind, or no rule has a weight, the base decides alone and for all
    rows. Without any labelled document nothing can be said against a row, and all stay.
    """
    ensemble, _ = trained(docs, labels, held_out)
    if not ensemble.learnt_from:
        return docs
    rows = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    return scored(measured(rows), ensemble).where(F.col("score") >= least).select("row.*")
