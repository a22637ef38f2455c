"""Quality rules as a cascade: the rule that rejects most for its cost comes first.

Each rule asks for measures of the text. On a sample every rule and every measure runs and
is timed; the order then follows greedily: next is the rule that rejects the largest part
of what the rules before it let pass, for the seconds that it and the measures which are
still missing take. Over all documents a rule only sees those that passed the ones before.
The order changes the work, never which documents pass: that is all rules together.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.llm.measures import Measured
from placewise.llm.texts import arrow_map, id_and_text, slices

# Documents that costs and rejections are estimated on, at most, their longest text, and the part of rows they are drawn from.
SAMPLE_ROWS = 1000
SAMPLE_CHARS = 100_000
SAMPLE_PART = 0.1


@dataclass(frozen=True)
class Rule:
    """Rejects texts: ``rejects`` gets the arrays of the measures by name."""

    name: str
    measures: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


# Base rules: too short, or repeating itself.
BASE = (
    Rule("few_words", ("n_words",), lambda n_words: n_words < 20),
    Rule("repeats", ("n_words", "n_repeat_words"), lambda n_words, n_repeat_words: 100 * n_repeat_words > 30 * n_words),
)
# Further rules, with limits that plain prose stays far from.
FURTHER = (
    Rule("symbols", ("n_words", "n_symbols"), lambda n_words, n_symbols: 10 * n_symbols > 3 * n_words),
    Rule("same_lines", ("n_lines", "n_dup_lines"), lambda n_lines, n_dup_lines: 2 * n_dup_lines > n_lines),
    Rule("word_length", ("n_words", "word_chars"), lambda n_words, word_chars: (word_chars < 2 * n_words) | (word_chars > 15 * n_words)),
    Rule("same_words", ("n_words", "n_same_words"), lambda n_words, n_same_words: 100 * n_same_words > 20 * n_words),
    Rule("letters", ("word_chars", "n_letters"), lambda word_chars, n_letters: 100 * n_letters < 60 * word_chars),
)
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _sampled(rules: Sequence[Rule]):
    names = sorted({m for r in rules for m in r.measures})

    def run(batches):
        for batch, texts in slices(batches):
            measured, values, seconds = Measured(texts), {}, []
            measured.words, measured.hashes  # noqa: B018  what several measures share counts for none of them
            for name in names:
                began = time.perf_counter()
                values[name] = getattr(measured, name)()
                seconds.append(time.perf_counter() - began)
            rejected = []
            for rule in rules:
                began = time.perf_counter()
                rejected.append(rule.rejects(*(values[m] for m in rule.measures)))
                seconds.append(time.perf_counter() - began)
            per_row = [x / batch.num_rows for x in seconds]
            yield {"seconds": [per_row] * batch.num_rows, "rejected": np.stack(rejected, 1).tolist()}
    return names, run


def ordered(docs: DataFrame, rules: Sequence[Rule], known: Sequence[str] = ()) -> list[Rule]:
    """The rules by rejection per cost on a sample; ``known`` measures cost nothing.

    The sample is taken from as few partitions as hold enough rows.
    """
    names, run = _sampled(rules)
    sample = id_and_text(docs).where(F.length("text") <= SAMPLE_CHARS).sample(SAMPLE_PART, seed=1).take(SAMPLE_ROWS)
    if not sample:
        return list(rules)
    batch = pa.RecordBatch.from_pydict({"doc_id": [r["doc_id"] for r in sample], "text": [r["text"] for r in sample]})
    found = list(run([batch]))
    rows = [x for part in found for x in part["rejected"]]
    seconds = np.array([x for part in found for x in part["seconds"]]).mean(0)
    cost = dict(zip(names, seconds[:len(names)].tolist(), strict=True))
    own = dict(zip([r.name for r in rules], seconds[len(names):].tolist(), strict=True))
    rejected = np.array(rows, bool)
    alive, done, left, order = np.ones(len(rows), bool), set(known), list(range(len(rules))), []
    while left:
        def worth(i: int) -> float:
            price = own[rules[i].name] + sum(cost[m] for m in set(rules[i].measures) - done)
            return (rejected[alive, i].mean() if alive.any() else 0.0) / max(price, 1e-12)
        best = max(left, key=worth)
        left.remove(best)
        order.append(rules[best])
        done |= set(rules[best].measures)
        alive &= ~rejected[:, best]
    return order


def judged(docs: DataFrame, base: Sequence[Rule] = BASE, further: Sequence[Rule] = FURTHER,
           reported: Sequence[str] = REPORTED) -> DataFrame:
    """``doc_id``, the ``reported`` measures, ``base_failed`` and ``kept`` of each row of ``docs``.

    ``base_failed`` if a base rule rejects the text, ``kept`` if no rule does. Reported
    measures are worked out for every text, others only for texts that reach their rule. A
    null text is an empty one; rows and ids may repeat or ids be null, each row is judged
    by itself; other columns are not read.
    """
    order = ordered(docs, [*base, *further], reported)
    names = {r.name for r in base}

    def run(batches):
        for batch, texts in slices(batches):
            measured = Measured(texts)
            values = {m: getattr(measured, m)() for m in reported}
            failed = np.zeros(batch.num_rows, bool)
            for rule in base:
                failed |= rule.rejects(*(values[m] if m in values else getattr(measured, m)() for m in rule.measures))
            alive = np.flatnonzero(~failed)
            here, held = None, {}
            for rule in order:
                if rule.name in names or not len(alive):
                    continue
                if not set(rule.measures) <= set(values):
                    if here is None:
                        here, held = Measured(pa.concat_arrays([texts.take(pa.array(alive))])), {}
                    for m in set(rule.measures) - set(values) - set(held):
                        held[m] = getattr(here, m)()
                passed = ~rule.rejects(*(values[m][alive] if m in values else held[m] for m in rule.measures))
                if not passed.all():
                    alive, here, held = alive[passed], None, {}
            kept = np.zeros(batch.num_rows, bool)
            kept[alive] = True
            yield {"doc_id": batch.column("doc_id"), **values, "base_failed": failed, "kept": kept}

    columns = ", ".join(f"{m} long" for m in reported)
    return arrow_map(id_and_text(docs), run, f"doc_id long, {columns}, base_failed boolean, kept boolean")
