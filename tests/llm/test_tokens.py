"""Token counts, record files and packing against the tokenizers library; tool calls; the pipeline."""

import json
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

import corpus_pipeline
from placewise.llm import packing, queries, records, segments, token_counts, tool_calls
from placewise.session import work_folder
from tests.llm import brute
from tests.llm.conftest import TRAPS, expected, rows

BPE = tokenizer_path("byte_bpe_50k.json")
SIGNS = ["a", "b", "the", " ", "  ", "\n", ".", ",", "'s", "'re", "'l", "'", "é", "é.", "…", " ", "\xa0", "日本", "1", "23", "_", "<|endoftext|>", "<|endof",
         "\x00", "\x1c", "᠎", "🙂", "!!", "ing", " the", "\t", "́", "×", "\x85"]


@pytest.fixture(scope="module")
def library():
    return segments.load(BPE)


def _ids(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def _odd(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(SIGNS, k=rng.randint(0, 14))) for _ in range(count)]


def test_pieces_give_the_tokens_of_the_whole_text(library, monkeypatch):
    texts = _odd(3000) + [t or "" for _, t in TRAPS]
    encoder = segments.Encoder(BPE)
    encoder.cache.limit = 300
    for start in range(0, len(texts), 500):
        own = texts[start:start + 500]
        ids, bounds = encoder.encode(pa.array([t.encode() for t in own], pa.binary()))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == _ids(library, own)


def test_prefixes_have_the_counts_of_the_library(library):
    counter = token_counts.PrefixCounter(BPE)
    for text in _odd(400, 2) + ["don't we'll 'll they've"]:
        found, _ = counter.all_differences(pa.array([text.encode()], pa.binary()))
        assert np.cumsum(found).tolist() == list(map(len, _ids(library, [text[:k] for k in range(1, len(text) + 1)])))


def test_counts_and_budgets(traps, library):
    counts = token_counts.prefix_counts(traps, BPE)
    want = expected((doc, len((t or "").encode()), len(i)) for (doc, t), i in zip(TRAPS, _ids(library, [t for _, t in TRAPS]), strict=True))
    assert rows(counts, "doc_id", "n_bytes", "n_tokens") == want
    one = counts.where("doc_id = 212")
    text = next(t for doc, t in TRAPS if doc == 212)
    cut = one.select(token_counts.length_within("prefixes", F.lit(50)).alias("n"), token_counts.tokens_at("prefixes", F.lit(30)).alias("m")).first()
    assert len(_ids(library, [text[:cut["n"]]])[0]) <= 50
    assert all(len(i) > 50 for i in _ids(library, [text[:k] for k in range(cut["n"] + 1, cut["n"] + 60)]))
    assert cut["m"] == len(_ids(library, [text[:30]])[0])
    assert token_counts.truncated(traps.where("doc_id = 212"), one, 50).first()["text"] == text[:cut["n"]]


def test_counts_of_empty_and_null_tables(none, all_null):
    assert rows(token_counts.prefix_counts(none, BPE)) == []
    assert rows(token_counts.prefix_counts(all_null, BPE), "doc_id", "n_bytes", "n_tokens") == [(None, 0, 0)] * 3


# ---- records ----

def _crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_records_come_back_in_the_order_of_ids(spark, traps, library):
    out = work_folder(spark, "records")
    records.write_records(traps, out, BPE)
    found = records.digests(records.read_records(spark, out)).orderBy("start").collect()
    ids = [(doc, [*i, 0]) for (doc, _), i in zip(TRAPS, _ids(library, [t for _, t in TRAPS]), strict=True)]
    docs = [r["doc_id"] for r in found]
    assert docs == sorted(docs, key=lambda d: (d is not None, d))
    assert [r["start"] for r in found] == np.append(0, np.cumsum([r["n_tokens"] for r in found])[:-1]).tolist()
    assert expected((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == expected((d, len(i), _crc(i)) for d, i in ids)
    shuffled = [records.digests(records.read_records(spark, out, seed)).collect() for seed in (1, 1, 2)]
    assert shuffled[0] == shuffled[1] != shuffled[2]
    assert expected(map(tuple, shuffled[2])) == expected(map(tuple, found))


def test_a_damaged_record_is_not_read():
    whole = records.framed(b"first") + records.framed(b"second")
    def read(data):
        at = [0]

        def take(n):
            at[0] += n
            return data[at[0] - n:at[0]]
        return list(records.unframed(take, "file"))
    assert read(whole) == [b"first", b"second"] and read(b"") == []
    for place in (0, 9, 13, len(whole) - 1):
        with pytest.raises(ValueError):
            read(whole[:place] + bytes([whole[place] ^ 1]) + whole[place + 1:])
    with pytest.raises(ValueError):
        read(whole[:-3])


EXTREMES = [*range(50), *range(2**63 - 50, 2**63), *range(-(2**63), -(2**63) + 50), 1 << 62, -(1 << 62), None, None]


def _library_records(docs, library):
    """``doc_id, start, n_tokens`` by ascending id, nulls first; rows of one id are alike here."""
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    sizes = [len(i) + 1 for i in _ids(library, [t for _, t in docs])]
    return [(doc, int(start), size) for (doc, _), start, size in zip(docs, np.append(0, np.cumsum(sizes)[:-1]), sizes, strict=True)]


def _read_back(spark, out):
    return [tuple(r[:3]) for r in records.digests(records.read_records(spark, out)).orderBy("start").collect()]


@pytest.mark.parametrize("least", [1, 20])
def test_records_of_extreme_ids_are_in_order(spark, library, monkeypatch, least):
    monkeypatch.setattr(records, "FILE_BYTES", least * 64)
    docs = [(doc, f"text of {doc}") for doc in EXTREMES]
    out = work_folder(spark, "records")
    records.write_records(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), out, BPE)
    assert _read_back(spark, out) == _library_records(docs, library)
    assert len(records.index_of(out)["files"]) >= min(8, 150 // least)


@pytest.mark.parametrize("doc", [None, 7, 2**63 - 1])
def test_the_rows_of_a_hot_id_lie_in_many_files(spark, library, monkeypatch, doc):
    monkeypatch.setattr(records, "FILE_BYTES", 700)
    docs = [(doc, "the same text")] * 200 + [(i, "the same text") for i in range(-20, 20)]
    out = work_folder(spark, "records")
    records.write_records(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), out, BPE)
    assert _read_back(spark, out) == _library_records(docs, library)
    assert max(f["records"] for f in records.index_of(out)["files"]) < 60


def test_equal_rows_are_dealt_out_alike_in_any_order():
    ids, texts, bounds = pa.array([5, 5, 5, 9, None, 5, 5, None]), pa.array([b"a", b"b", b"a", b"c", b"d", b"a", b"b", b"d"]), np.array([5, 5, 9])
    first = records.places(ids, texts, 1, bounds, records.Counter())
    order = pa.array([7, 3, 6, 5, 0, 4, 2, 1])
    again = records.places(ids.take(order), texts.take(order), 1, bounds, records.Counter())
    files = lambda found, i, t: sorted(zip(i.to_pylist(), t.to_pylist(), found.tolist(), strict=True), key=repr)
    assert files(first, ids, texts) == files(again, ids.take(order), texts.take(order))


def test_a_second_write_follows_the_first_and_an_overwrite_replaces_both(spark, library):
    out = work_folder(spark, "records")
    make = lambda *ids: spark.createDataFrame([(i, f"number {i}") for i in ids], "doc_id long, text string")
    records.write_records(make(1, 2), out, BPE)
    records.write_records(make(3, 0), out, BPE)
    found = _read_back(spark, out)
    assert [r[0] for r in found] == [1, 2, 0, 3]
    assert [r[1] for r in found] == np.append(0, np.cumsum([r[2] for r in found])[:-1]).tolist()
    old = {f["name"] for f in records.index_of(out)["files"]}
    with pytest.raises(Exception, match="holds ids of 2 bytes, not of 4"):
        spark.createDataFrame([(9, b"abcd")], "doc_id long, ids binary").write.format(records.FORMAT).option("width", 4).mode("append").save(out)
    spark.createDataFrame([(9, b"ab")], "doc_id long, ids binary").write.format(records.FORMAT).option("width", 2).mode("overwrite").save(out)
    assert _read_back(spark, out) == [(9, 0, 1)]
    assert not old & {f["name"] for f in records.index_of(out)["files"]}


def test_stores_that_records_cannot_use_are_refused_before_the_job(none):
    for path in ("dbfs:/records", "ftp://host/records"):
        with pytest.raises(ValueError, match="can't be kept there"):
            records.write_records(none, path, BPE)


def test_texts_beyond_a_slice_are_encoded_whole(spark, library):
    docs = [(1, "some words of a long text, " * 100_000), (2, "x" * 3_000_000), (3, "short"), (4, "line\n" * 500_000)]
    out = work_folder(spark, "records")
    records.write_records(spark.createDataFrame(docs, "doc_id long, text string"), out, BPE)
    assert _read_back(spark, out) == _library_records(docs, library)


def test_records_of_empty_and_null_tables(spark, none, all_null):
    for docs, n in ((none, 0), (all_null, 3)):
        out = work_folder(spark, "records")
        records.write_records(docs, out, BPE)
        assert [r[1:3] for r in rows(records.digests(records.read_records(spark, out)))] == [(i, 1) for i in range(n)]


# ---- packing ----

def _check_packing(found, docs, library, end=1):
    pieces = defaultdict(list)
    for r in found:
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    want = defaultdict(int)
    for (doc, text), ids in zip(docs, _ids(library, [t for _, t in docs]), strict=True):
        ids = [*ids, end]
        for start, length, crc in pieces[doc, len(ids)]:
            want[doc, len(ids), start] += crc == _crc(ids[start:start + length])
    assert all(want.values())
    total = sum(len(i) + 1 for i in _ids(library, [t for _, t in docs]))
    assert sum(r["length"] for r in found) == total and all(r["length"] > 0 for r in found)
    for own in pieces.values():
        starts = sorted(own)
        if len({s for s, _, _ in own}) == len(own):
            assert [s for s, _, _ in starts] == np.append(0, np.cumsum([n for _, n, _ in starts])[:-1]).tolist()
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.append(0, np.cumsum([n for _, n in own])[:-1]).tolist() and sum(n for _, n in own) <= packing.WINDOW
    return [sum(n for _, n in own) for own in sequences.values()]


def test_every_token_is_packed_once(traps, library):
    full = _check_packing(packing.packed(traps, BPE).collect(), TRAPS, library)
    assert sum(n < packing.WINDOW for n in full) <= 1


def test_shards_and_windows(monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 700)
    monkeypatch.setattr(packing, "WINDOW", 64)
    shards = packing.shards({5: 100, 7: 650, 9: 10, 11: 2000, 12: 600, 13: 200})
    assert shards == {5: (0, 1), 7: (1, 1), 9: (1, 1), 11: (2, 3), 12: (5, 1), 13: (6, 1)}
    docs = [np.array([1, 2, 3] * 10), np.array([9] * 40), np.array([1, 2, 4] * 12), np.zeros(0, int)]
    pieces = packing.filled(docs, np.ones(20))
    # the neighbour that shares tokens comes before the one that shares none
    assert pieces[:2] == [(0, 0, 30, 0, 0), (2, 0, 34, 0, 30)] and pieces[2][:2] == (2, 34)
    assert sum(p[2] for p in pieces) == 106


def test_shards_of_empty_texts_and_of_equal_rows_have_an_end(spark, library, monkeypatch):
    """Empty texts, whole windows without a rest, and rows that are equal in all, without an id too."""
    monkeypatch.setattr(packing, "SHARD_TOKENS", 4_000)
    whole = next(t for n in range(1500, 2100) if len(library.encode(t := "word " * n, add_special_tokens=False).ids) % packing.WINDOW == packing.WINDOW - 1)
    docs = [(None, "")] * 900 + [(i, None) for i in range(300)] + [(7, "equal rows")] * 800 + [(1000 + i, whole) for i in range(700)]
    found = packing.packed(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), BPE).collect()
    _check_packing(found, docs, library)
    shards = Counter((r["sequence_id"] // packing.SHARD_SEQUENCES) for r in found)
    assert min(shards) >= 0 and max(shards.values()) < 500


def test_a_document_counts_once_for_each_of_its_tokens():
    docs = [np.array(d, "<u2").tobytes() for d in ([1, 1, 2], [2, 3, 3, 3], [], [5])]
    batches = [pa.record_batch({"ids": pa.array(docs[a:b], pa.binary())}) for a, b in ((0, 2), (2, 4))]
    (found,) = packing._frequencies("<u2", 6)(batches)
    assert dict(zip(found["token"].tolist(), found["n"].tolist(), strict=True)) == {1: 1, 2: 2, 3: 1, 5: 1, -1: 4}


def test_the_index_ranks_as_bm25():
    docs = [np.array(d) for d in ([1, 1, 2], [2, 3, 3, 3], [1, 4], [5])]
    weight = packing.idf(np.array([0, 2, 2, 1, 1, 1]), 4)
    index, mean = packing.Index(docs, weight), np.mean([3, 4, 2, 1])

    def score(query, doc):
        return sum(weight[t] * (n := (doc == t).sum()) * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(doc) / mean)) for t in set(query.tolist()))

    for query in docs:
        want = sorted((i for i in range(4) if score(query, docs[i]) > 0), key=lambda i: -score(query, docs[i]))
        assert index.ranked(query, np.zeros(4, bool)).tolist() == want
    assert index.ranked(docs[0], np.array([True, False, True, True])).tolist() == [1]


def test_packing_of_empty_and_null_tables(none, all_null):
    assert rows(packing.packed(none, BPE)) == []
    assert [r[:3] for r in rows(packing.packed(all_null, BPE))] == [(None, 0, 1)] * 3


# ---- tool calls ----

CALLS = [(1, "a", None, "add", '{"y": 2, "x": 1}'), (1, "b", "a", "add", '{"x": 1.5, "y": "no"}'), (1, "c", "b", "add", '{"x": 1'), (2, "d", "gone", "none", "{}"),
         (2, "e", "f", "add", None), (2, "f", "e", "add", "[1]"), (2, "g", "f", "add", '{"x": true, "y": 1}'), (2, None, "a", "add", "{}"), (1, "a", None, "add", '{"y": 3, "x": 1}'),
         (3, "h", None, "add", '{"x": NaN}'), (3, "i", None, "add", '{"x": 1, "y": 2, "z": 3}')]


def test_calls_meet_their_results_in_an_order_that_can_run(spark):
    calls = spark.createDataFrame([(*c, "clash") for c in CALLS], "conversation long, call_id string, after string, tool string, arguments string, depth string")
    results = spark.createDataFrame([("a", "3"), ("a", "2\né\""), ("zz", "lost"), (None, "lost"), ("b", None)], "call_id string, content string")
    schemas = spark.createDataFrame([("add", "x", "number", True), ("add", "y", "integer", True)], "tool string, name string, type string, required boolean")
    found = {r["call_id"]: r for r in tool_calls.linked(calls, results, schemas).collect()}
    assert {k: r["depth"] for k, r in found.items()} == {"a": 0, "b": 1, "c": 2, "d": 0, "e": None, "f": None, "g": None, "h": 0, "i": 0}
    assert {k: r["fault"] for k, r in found.items()} == {
        "a": None, "b": "argument y is no integer", "c": "arguments are no JSON", "d": "unknown tool", "e": "arguments are no object", "f": "arguments are no object",
        "g": "argument x is no number", "h": "arguments are no JSON", "i": "unknown argument z"}
    assert found["a"]["json"] == '{"arguments":{"x":1,"y":2},"call_id":"a","result":"2\\né\\"","tool":"add"}'
    assert found["a"]["n_results"] == 2 and found["b"]["n_results"] == 1 and found["c"]["n_results"] == 0
    order = [r["call_id"] for r in tool_calls.ordered(tool_calls.linked(calls, results, schemas)).collect()]
    assert order == ["a", "b", "c", "d", "e", "f", "g", "h", "i"]
    assert tool_calls.linked(calls.limit(0), results, schemas).count() == 0
    assert tool_calls.linked(calls, results.limit(0), schemas.limit(0)).where("fault = 'unknown tool'").count() == 7


DEEP = "[" * 100_000
ODD = {
    "half": ('{"x":"\\ud800"}', "arguments are no Unicode text"), "half name": ('{"\\udc00":1}', "arguments are no Unicode text"),
    "pair": ('{"x":1,"y":"\\ud83d\\ude00"}', None), "deep": (DEEP, "arguments are nested too deeply"),
    "closed": (f'{{"x":{DEEP}{"]" * 100_000}}}', "arguments are nested too deeply"), "quoted": (json.dumps({"x": 1, "y": DEEP}), None),
    "cut quote": ('{"x":1,"y":"' + DEEP, "arguments are no JSON"), "huge": ('{"x":1e999}', "arguments are no JSON"), "many digits": ('{"x":' + "9" * 9999 + "}", "arguments are no JSON"),
    "whole": ('{"x":1.0,"y":"a"}', None), "part": ('{"x":1.5,"y":"a"}', "argument x is no integer"), "either": ('{"x":2,"y":null}', None),
    "neither": ('{"x":2,"y":3}', "argument y is no null or string"), "missing": ('{"x":2}', "missing argument y"), "empty": ("", "arguments are no JSON"),
    "twice": ('{"x":"no","x":3,"y":"a"}', None)}


def test_no_arguments_and_no_schema_stop_the_job(spark):
    calls = [(1, name, None, "tool", text) for name, (text, _) in ODD.items()]
    calls += [(1, f"of {tool}", None, tool, "{}") for tool in ("nameless", "odd", "untyped", None)]
    calls = spark.createDataFrame(calls, "conversation long, call_id string, after string, tool string, arguments string")
    schemas = spark.createDataFrame([("tool", "x", "integer", True), ("tool", "y", "string", True), ("tool", "y", "null", None), ("nameless", None, "string", False),
                                     ("odd", "x", "money", False), ("untyped", "x", None, None), (None, "x", "string", True)],
                                    "tool string, name string, type string, required boolean")
    results = spark.createDataFrame([], "call_id string, content string")
    found = {r["call_id"]: r for r in tool_calls.linked(calls, results, schemas).collect()}
    assert {k: r["fault"] for k, r in found.items()} == {k: f for k, (_, f) in ODD.items()} | {
        "of nameless": "schema has an argument without a name", "of odd": "schema has no known type for x",
        "of untyped": "schema has no known type for x", "of None": "unknown tool"}
    assert found["whole"]["json"] == '{"arguments":{"x":1,"y":"a"},"call_id":"whole","result":null,"tool":"tool"}'
    assert json.loads(found["half"]["json"])["arguments"] is None and json.loads(found["quoted"]["json"])["arguments"]["y"] == DEEP


def test_equal_values_have_one_canonical_text():
    for same in (("1", "1.0", "1e0", "10e-1"), ("0", "-0.0", "0e5"), ('{"a":1,"b":[2.0]}', '{ "b":[2], "a":1.0 }'), ('"\\u0061"', '"a"')):
        assert len({tool_calls.canonical(json.loads(t)) for t in same}) == 1
    assert tool_calls.canonical(json.loads("9007199254740993")) == "9007199254740993"
    assert tool_calls.canonical(True) == "true" != tool_calls.canonical(1)


def test_a_long_chain_of_calls(spark):
    calls = spark.createDataFrame([(f"{i}", f"{i - 1}") for i in range(40)], "call_id string, after string")
    assert dict(tool_calls.depths(calls).collect()) == {f"{i}": i for i in range(40)}


# ---- pipeline ----

def _brute_pipeline(docs, good, items):
    docs = [d for d in docs if d[0] in good]
    docs = [d for d, (doc, _, least) in zip(docs, brute.op7(docs), strict=True) if doc == least]
    first = {}
    for doc, text in docs:
        own = brute.words(text)
        for i in range(len(own) - 12):
            first[tuple(own[i:i + 13])] = min(first.get(tuple(own[i:i + 13]), doc), doc)
    left = []
    for doc, text in docs:
        own = brute.words(text)
        gone = brute.covered([i for i in range(len(own) - 12) if first[tuple(own[i:i + 13])] < doc], 13)
        if gone and len(gone) == len(own):
            continue
        left.append((doc, " ".join(w for i, w in enumerate(own) if i not in gone) if gone else text))
    return [d for d, r in zip(left, brute.op5(left, items), strict=True) if not r[-1]]


def test_the_pipeline_keeps_what_plain_python_keeps(spark, library, tmp_path):
    docs = [(doc, text, "en", "s", len(text or "")) for doc, text in dict(t for t in TRAPS if t[0] is not None).items()]
    labels = [(doc, int("%%%" not in (text or "")), 0) for doc, text, *_ in docs]
    items = [(1, docs[4][1][:120]), (2, docs[9][1])]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    read = queries.table(spark, str(tmp_path), "documents")
    good = {r["doc_id"] for r in corpus_pipeline.quality(spark, read, str(tmp_path)).collect()}
    assert 207 in {d[0] for d in docs}
    kept = _brute_pipeline([d[:2] for d in docs], good, items)
    full = _check_packing(corpus_pipeline.run(spark, str(tmp_path)).collect(), kept, library)
    assert len(full) > 0
    stage = read
    for _, function in corpus_pipeline.STAGES[:-1]:
        stage = function(spark, stage, str(tmp_path))
        assert stage.columns == read.columns and [f.dataType for f in stage.schema] == [f.dataType for f in read.schema]
    assert rows(stage, "doc_id", "text") == expected(kept)
    assert stage.where("n_chars != length(text)").count() == 0


@pytest.mark.parametrize("stage", [corpus_pipeline.quality, corpus_pipeline.near_duplicates, corpus_pipeline.repeated_passages, corpus_pipeline.decontaminated, corpus_pipeline.packed])
def test_stages_take_empty_tables_and_odd_rows(spark, stage, traps, none, tmp_path):
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "some text of an item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert stage(spark, none, str(tmp_path)).count() == 0
    assert stage(spark, traps, str(tmp_path)).count() > 0
