"""Rules, deduplication, decontamination and language model against plain Python."""

import math

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

from placewise.llm import cascade, components, contamination, jaccard, lattice, packed, queries, rule_ensemble, substring, texts
from tests.llm import brute
from tests.llm.conftest import TRAPS, expected, in_process, passages, rows

COUNTS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


# ---- quality rules ----

def test_rules_count_as_plain_python_does(traps):
    assert rows(cascade.judged(traps), *COUNTS) == expected(brute.op1(TRAPS))


def test_the_order_of_rules_changes_no_verdict(traps, monkeypatch):
    first = rows(cascade.judged(traps))
    monkeypatch.setattr(cascade, "ordered", lambda docs, rules, known=(): list(rules)[::-1])
    assert rows(cascade.judged(traps)) == first
    assert {r[-1] for r in first} == {True, False}


def test_the_rule_that_rejects_most_for_its_cost_comes_first(spark):
    prose = lambda sign: " ".join(f"word{n}{sign}" for n in range(30))
    docs = spark.createDataFrame([(i, prose("###" if i % 2 else "")) for i in range(200)], "doc_id long, text string")
    order = [r.name for r in cascade.ordered(docs, [*cascade.BASE, *cascade.FURTHER], cascade.REPORTED)]
    assert len(order) == len(cascade.BASE) + len(cascade.FURTHER)
    assert order[0] == "symbols"


def test_rules_on_empty_and_null_tables(none, all_null):
    assert rows(cascade.judged(none)) == []
    assert rows(cascade.judged(all_null)) == [(None, 0, 0, 0, 0, 0, True, False)] * 3


# ---- rule ensemble ----

@pytest.fixture(scope="module")
def graded(spark):
    texts = passages(5, 120)
    docs = [(i, t if i % 3 else " ".join(f"{w}%%%" for w in t.split())) for i, t in enumerate(texts)]
    return (spark.createDataFrame(docs, "doc_id long, text string").withColumn("symbols", F.lit("clash")),
            spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 120)] + [(5, None), (None, 1), (9999, 1)], "doc_id long, quality int"))


def test_the_ensemble_finds_what_labels_mark(graded):
    docs, labels = graded
    ensemble, counts = rule_ensemble.trained(docs, labels, F.col("doc_id") % 4 == 2)
    assert 0 < len(ensemble.rules) < 60
    scores = {r["doc_id"]: r["score"] for r in rule_ensemble.scored(counts, ensemble).collect()}
    held = [i for i in scores if i % 4 == 2]
    assert all((scores[i] >= 0.7) == (i % 3 > 0) for i in held) and all(0 < s < 1 for s in scores.values())
    kept = rule_ensemble.good(docs, labels, 0.7)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in scores if i % 3}


def test_the_ensemble_is_learnt_without_the_held_out_labels(graded):
    docs, labels = graded
    wrong = labels.withColumn("quality", F.when(F.col("doc_id") % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    held_out = F.col("doc_id") % 4 == 2
    assert rule_ensemble.trained(docs, labels, held_out)[0] == rule_ensemble.trained(docs, wrong, held_out)[0]


def test_paths_become_rules():
    tree = "If (feature 0 <= 0.5)\n If (feature 1 > 2.0)\n  Predict: 0.0\n Else (feature 1 <= 2.0)\n  Predict: 1.0\nElse (feature 0 > 0.5)\n Predict: 1.0"
    found = rule_ensemble.paths(tree, ["a", "b"])
    condition = rule_ensemble.Condition
    assert found == {(condition("a", False, 0.5),), (condition("a", True, 0.5),), (condition("a", False, 0.5), condition("b", True, 2.0)),
                     (condition("a", False, 0.5), condition("b", False, 2.0))}


def test_without_labels_or_documents_there_is_a_score(graded, none, traps):
    docs, labels = graded
    for known in (labels.limit(0), labels.where("quality = 1")):
        ensemble, counts = rule_ensemble.trained(traps, known)
        assert not ensemble.rules and all(0 < r["score"] < 1 for r in rule_ensemble.scored(counts, ensemble).collect())
    ensemble, counts = rule_ensemble.trained(none, labels)
    assert rows(rule_ensemble.scored(counts, ensemble)) == []


def test_the_base_decides_where_no_rule_does(graded, monkeypatch):
    docs, labels = graded
    share = lambda known: rule_ensemble.good(docs, known, 0.7).count() / docs.count()
    assert share(labels.limit(0)) == 1 and share(labels.where("quality = 1")) == 1 and share(labels.where("quality = 0")) == 0
    monkeypatch.setattr(rule_ensemble, "PENALTY", 1e9)
    ensemble, counts = rule_ensemble.trained(docs, labels)
    assert not ensemble.rules and ensemble.learnt_from == 120
    scores = {r["score"] for r in rule_ensemble.scored(counts, ensemble).collect()}
    assert len(scores) == 1 and min(scores) == pytest.approx(2 / 3, abs=1e-3) and share(labels) == 0


def test_compiled_rules_score_as_plain_python(graded, traps):
    docs, labels = graded
    ensemble, _ = rule_ensemble.trained(docs, labels)
    counts = rule_ensemble.measured(traps.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    names = list(rule_ensemble.statistics())
    found = rule_ensemble.scored(counts, ensemble).select("score", *(c.alias(n) for n, c in rule_ensemble.statistics().items())).collect()
    assert len(found) == len(TRAPS) and len({r["score"] for r in found}) > 1
    for r in found:
        own = {n: r[n] for n in names}
        odds = ensemble.base + sum(w for rule, w in ensemble.rules if all((own[c.statistic] > c.limit) == c.above for c in rule))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-12)


# ---- substring deduplication ----

def _digest(docs):
    found = substring.without_repeats(docs).collect()
    return expected((r["doc_id"], r["n_words"], r["n_removed"], brute.sha(" ".join(brute.words(r["text"])))) for r in found)


def test_passages_go_as_in_plain_python(traps):
    assert _digest(traps) == expected(brute.op4(TRAPS))


def test_a_full_filter_and_small_tasks_change_nothing(traps, monkeypatch):
    monkeypatch.setattr(substring, "arrow_map", in_process)
    monkeypatch.setattr(substring, "HELD_WINDOWS", 500)
    monkeypatch.setattr(substring, "GROUP_WORDS", 700)
    monkeypatch.setattr(substring, "CELL_BITS", 12)
    monkeypatch.setattr(substring, "FILTER_BITS", 13)
    assert _digest(traps) == expected(brute.op4(TRAPS))


def test_blocks_grow_with_the_words(traps, monkeypatch):
    assert [substring.exact_blocks(n) for n in (0, 1, 512 << 21, (512 << 21) + 1, 3 << 40)] == [512, 512, 512, 1024, 1 << 21]
    sent = []

    def here(df, function, schema):
        if schema.startswith("kind"):
            found = in_process(df, function, schema)
            sent.append([r["block"] for r in found.collect()])
            return found
        return in_process(df, function, schema)

    monkeypatch.setattr(substring, "arrow_map", here)
    monkeypatch.setattr(substring, "BLOCK_WINDOWS", 1)
    monkeypatch.setattr(substring, "HELD_WINDOWS", 300)
    assert _digest(traps) == expected(brute.op4(TRAPS))
    words = sum(len(brute.words(t)) for _, t in TRAPS)
    assert len(sent) == 2 and max(sent[0]) < packed.BLOCKS < max(sent[1]) < substring.exact_blocks(words) < 2 * words


def test_marks_are_dealt_to_all_blocks():
    blocks = substring._dealt(np.arange(5000), packed.BLOCKS)
    assert 0 <= blocks.min() and blocks.max() < packed.BLOCKS and len(np.unique(blocks)) > 500


def test_passages_of_texts_beyond_a_slice(spark):
    rng = np.random.default_rng(4)
    text = lambda n: " ".join(map(str, rng.integers(0, 3_000, n)))
    shared, far = text(40), text(600_000)
    docs = [(5, f"{far} {shared}"), (1, f"{shared} own"), (3, far[:1_000_000]), (9, f"{text(20)} {shared}\n{far[-900:]}"), (2, "")]
    assert len(docs[0][1]) > texts.SLICE_BYTES
    assert _digest(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)) == expected(brute.op4(docs))


def test_a_text_that_loses_nothing_stays_and_other_columns_do(spark):
    docs = spark.createDataFrame([(1, "two  spaces\nand a line", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["text"], r["rest"]["source"]) for r in substring.without_repeats(docs).orderBy("doc_id").collect()] == [("two  spaces\nand a line", "s"), (None, None)]


def test_passages_of_empty_and_null_tables(none, all_null):
    assert rows(substring.without_repeats(none)) == []
    assert rows(substring.without_repeats(all_null), "doc_id", "n_words", "n_removed") == [(None, 0, 0)] * 3


def test_packed_integers_come_back():
    rng = np.random.default_rng(1)
    for values in (np.zeros(0, np.uint64), np.array([0, 1 << 63, (1 << 64) - 1], np.uint64), rng.integers(0, 1 << 40, 999, dtype=np.uint64)):
        assert (packed.unpack(packed.pack(values)) == values).all()
        values = np.sort(values)
        assert (packed.unpack_sorted(packed.pack_sorted(values)) == values).all()


# ---- decontamination ----

ITEMS = [(1, passages()[0]), (2, "a b c"), (3, None), (4, "!!! ..."), (11, passages(9, 30)[4] + " " + passages(9, 30)[5]), (12, "ONE"), (13, "one"), (None, "four words are here"),
         (2, "a second text of item two")]


def test_items_are_found_as_in_plain_python(spark, traps):
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id long, text string, words string")
    known = [x for x in ITEMS if x[0] is not None]
    found = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), brute.sha(",".join(r["items"])), r["n_hit"] > 0)
             for r in contamination.contaminated(traps, items.where("item_id IS NOT NULL")).collect()]
    assert expected(found) == expected(brute.op5(TRAPS, known))
    assert contamination.contaminated(traps, items).count() == len(TRAPS)
    kept = contamination.clean(traps, items.where("item_id IS NOT NULL"))
    assert kept.columns == traps.columns
    assert kept.count() == sum(not r[-1] for r in brute.op5(TRAPS, known))


def test_without_a_broadcast_the_same_items_are_found(spark, traps, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    first = rows(contamination.contaminated(traps, items))
    monkeypatch.setattr(contamination, "BROADCAST_BYTES", -1)
    assert rows(contamination.contaminated(traps, items)) == first


def test_hits_come_in_bounded_rows(spark, traps, monkeypatch):
    items = spark.createDataFrame([x for x in ITEMS if x[0] is not None], "item_id long, text string")
    first, sizes = rows(contamination.contaminated(traps, items)), []

    def here(df, function, schema):
        def run(batches):
            for found in function(batches):
                around = found.get("around") or [None]
                sizes.extend([len(around)] if around[0] is not None else [])
                yield found
        return in_process(df, run, schema)

    monkeypatch.setattr(contamination, "arrow_map", here)
    monkeypatch.setattr(contamination, "HIT_BYTES", 300)
    assert rows(contamination.contaminated(traps, items)) == first
    assert len(sizes) > 5 and max(sizes) < 30


def test_a_text_that_hits_everywhere_beyond_a_slice(spark):
    docs = [(1, "One, two three\n" * 90_000), (2, "two three"), (3, None), (None, "x one two three " * 20)]
    items = [(7, "one two three " * 5), (8, "three x one")]
    assert len(docs[0][1]) > texts.SLICE_BYTES // 2
    docs += [(4, docs[0][1] + "x " + docs[0][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    found = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), brute.sha(",".join(r["items"])), r["n_hit"] > 0)
             for r in contamination.contaminated(table, spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert expected(found) == expected(brute.op5(docs, items))


def test_items_of_empty_tables(spark, traps, none, all_null):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(contamination.contaminated(none, items)) == []
    assert contamination.contaminated(traps, items.limit(0)).where("n_hit > 0").count() == 0
    assert rows(contamination.contaminated(all_null, items), "doc_id", "n_words", "n_hit", "items") == [(None, 0, 0, [])] * 3


# ---- Jaccard join ----

def test_components_are_those_of_plain_python(traps):
    assert rows(jaccard.near_duplicates(traps)) == expected(brute.op7(TRAPS))


def test_small_blocks_and_tasks_change_nothing(traps, monkeypatch):
    for name, value in (("HELD", 100), ("BLOCK_ROWS", 2), ("PAIR_DOCUMENTS", 2), ("arrow_map", in_process)):
        monkeypatch.setattr(jaccard, name, value)
    assert rows(jaccard.near_duplicates(traps)) == expected(brute.op7(TRAPS))


@pytest.mark.parametrize("small", [False, True])
def test_every_long_is_an_id(spark, monkeypatch, small):
    if small:
        for name, value in (("HELD", 100), ("BLOCK_ROWS", 2), ("PAIR_DOCUMENTS", 2), ("arrow_map", in_process)):
            monkeypatch.setattr(jaccard, name, value)
    ids = [2**63 - 1, 2**63 - 2, -(2**63), -1, 0, 1]
    words = passages(9, 30)[4].split(" ") * 4
    docs = [(doc, " ".join([*words[:100], f"own{place}"])) for place, doc in enumerate(ids)]
    docs += [(2**63 - 3 - i, passages(11, 20)[i]) for i in range(20)]
    assert rows(jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == expected(brute.op7(docs))


def test_overlaps_in_stripes(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 90, n).astype(np.uint64)) for n in (0, 1, 30, 60, 60, 80)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    for stripe in (1, 7, 4096):
        monkeypatch.setattr(jaccard, "STRIPE", stripe)
        found = jaccard.overlaps(sets)
        assert all(found[i][j] == want[i][j] for i in range(6) for j in range(6) if i != j)


def test_random_sets_near_the_limit(spark):
    """Texts of a few shared words, so that many pairs lie just above or below the limit."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(120):
        words = list(base[:int(rng.integers(12, 60))])
        for place in rng.integers(0, len(words), int(rng.integers(0, 3))):
            words[place] = f"x{rng.integers(0, 4)}"
        docs.append((i, " ".join(words)))
    assert rows(jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == expected(brute.op7(docs))


def test_one_of_each_group_stays(traps):
    kept = jaccard.one_of_each(traps)
    want = [r for r, (doc, _, least) in zip(TRAPS, brute.op7(TRAPS), strict=True) if doc is None or doc == least]
    assert kept.columns == traps.columns and rows(kept, "doc_id", "text") == expected(want)


def test_components_of_empty_and_null_tables(none, all_null):
    assert rows(jaccard.near_duplicates(none)) == []
    assert rows(jaccard.near_duplicates(all_null)) == [(None, 0, None)] * 3


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 100), (5, 5), (None, 3), (70, None)]
    found = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 1 for i in range(1, 61)} | {90: 90, 100: 90}


def test_the_least_overlap_is_exact():
    for a in range(1, 60):
        for b in range(1, 60):
            want = next(o for o in range(200) if 100 * o >= 80 * (a + b - o))
            assert jaccard.least_overlap(a, b) == want
            if want <= min(a, b):
                m = min(jaccard.shared_in_prefix(a), jaccard.shared_in_prefix(b))
                assert all(n - want + m <= jaccard.prefix_length(n) or jaccard.prefix_length(n) == n for n in (a, b))


# ---- lattice scores ----

PIECES = {"▁": -1.0, "▁a": -2.0, "a": -1.5, "b": -1.7, "ab": -2.2, "▁ab": -3.0, "ba": -2.5}


def _all_paths(data, log):
    return sum(math.exp(log[data[:n]]) * _all_paths(data[n:], log) for n in range(1, len(data) + 1) if data[:n] in log) if data else 1.0


def _pieces():
    log = {k.encode(): v for k, v in PIECES.items()} | {bytes([b]): -6.0 for b in range(256) if bytes([b]) not in (b"a", b"b")}
    return lattice.Pieces(log, math.log(0.1), max(map(len, log)))


def test_scores_sum_over_all_segmentations(monkeypatch):
    pieces = _pieces()
    words = [b"ab", b"a", b"abba", b"zz", "é".encode(), b"ababab"]
    want = [math.log10(_all_paths("▁".encode() + w, pieces.log)) for w in words]
    assert np.allclose(pieces.words(words), want)
    carried = pieces.carried(words, np.arange(1.0, 7.0))
    monkeypatch.setattr(lattice, "LONG_WORD", 0)
    assert np.allclose(pieces.words(words), want)
    long = pieces.carried(words, np.arange(1.0, 7.0))
    assert carried.keys() == long.keys() and all(math.isclose(carried[k], long[k]) for k in long)


def test_fitting_makes_the_training_words_likelier(spark, monkeypatch):
    monkeypatch.setattr(lattice, "SMOOTHING", 1e-6)
    counts = lattice.counted(spark.createDataFrame([("ab ab ba abba", True), ("ab", True)], "text string, learn boolean"))
    assert rows(counts.where("n > 1").selectExpr("cast(word AS string)", "n")) == [("", 2), ("ab", 3)]
    start, first = _pieces(), None
    total = lambda p: sum(3 * p.words([b"ab"])) + sum(p.words([b"ba", b"abba"])) + 2 * p.ending()
    for n in range(1, 4):
        now = total(lattice.fitted(counts, start, n))
        assert first is None or now > first
        first = now
    fitted = lattice.fitted(counts, start, 1)
    assert math.isclose(sum(map(math.exp, fitted.log.values())) + math.exp(fitted.end), 1)


def test_scores_of_traps(traps, monkeypatch):
    found = lattice.scored(traps, ~queries.held_out_words(), tokenizer_path("piece_bpe_32k.model"))
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
    want = expected((r[0], *r[2:]) for r in brute.op8(TRAPS))
    assert rows(found, *columns) == want
    scores = rows(found, "doc_id", "score")
    for name, value in (("HEAD_WORDS", 5), ("HELD_WORDS", 20), ("arrow_map", in_process)):
        monkeypatch.setattr(lattice, name, value)
    found = lattice.scored(traps, ~queries.held_out_words(), tokenizer_path("piece_bpe_32k.model"))
    assert rows(found, *columns) == want and rows(found, "doc_id", "score") == scores


def test_every_text_is_the_sum_of_its_words_and_an_end(traps, monkeypatch):
    """Head and joined words alike, by the model that was fitted."""
    fitted = []
    keep = lattice.fitted
    monkeypatch.setattr(lattice, "fitted", lambda *a: fitted.append(keep(*a)) or fitted[-1])
    monkeypatch.setattr(lattice, "HEAD_WORDS", 7)
    found = lattice.scored(traps, ~queries.held_out_words(), tokenizer_path("piece_bpe_32k.model"))
    pieces, texts = fitted[0], [(doc, [w.encode() for w in brute.words(brute.lower(text))]) for doc, text in TRAPS]
    once = {w: pieces.forward(lattice.SPACE + w)[-1] / math.log(10) for _, own in texts for w in own}
    want = expected((doc, len(own) + 1, sum(once[w] for w in own) + pieces.ending()) for doc, own in texts)
    for got, one in zip(rows(found, "doc_id", "n_tokens", "score"), want, strict=True):
        assert got[:2] == one[:2] and got[2] == pytest.approx(one[2], rel=1e-7)


def test_scores_of_empty_and_null_tables(none, all_null):
    path = tokenizer_path("piece_bpe_32k.model")
    assert rows(lattice.scored(none, F.lit(True), path)) == []
    assert {r[:4] for r in rows(lattice.scored(all_null, F.lit(None).cast("boolean"), path))} == {(None, 1, 0, 0)}
