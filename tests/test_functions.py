import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import as_dict
from placewise.functions import fields
from placewise.functions.handles import LAST_HANDLE, all_handles, last_handle
from placewise.functions.keywords import POSITIVE_WORDS, has_keyword, keyword_pattern, rare_letter_pattern
from placewise.functions.times import hour_of_day


def by_id(posts, column):
    return as_dict(posts.select("data.id", column.alias("v")), "id", "v")


def test_has_place_takes_an_empty_list_for_a_place(traps):
    placed = {i for i, v in by_id(traps, fields.has_place()).items() if v}
    assert placed == {"1", "4", "5", "7", "11"}
    names = by_id(traps, fields.place_name())
    assert names["4"] is None and names["3"] is None and names["1"] == "Rivertown"


def test_profile_location_default_and_strict(traps):
    assert {i for i, v in by_id(traps, fields.has_profile_location()).items() if v} == {"1", "2", "7", "11"}
    strict = by_id(traps, fields.has_profile_location(strict=True))
    assert {i for i, v in strict.items() if v} == {"1", "7", "11"} and None not in strict.values()


def test_hours(spark, traps):
    utc, east = by_id(traps, hour_of_day()), by_id(traps, hour_of_day(tz="America/New_York"))
    assert utc["5"] is None and utc["11"] == 23 and east["11"] == 18 and utc["1"] == 10
    half = by_id(traps, hour_of_day(tz="Asia/Kolkata"))
    assert half["11"] == 4


def test_hour_does_not_depend_on_the_session_unless_asked(spark):
    stamps = ["2024-11-03T05:30:00Z", "2024-11-03T06:30:00.123456Z", "2024-07-01T23:59:59Z", "1969-12-31T23:00:00Z", None, "xx"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string")
    want = [5, 6, 23, 23, None, None]
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r[0] for r in df.select(hour_of_day("s")).collect()] == want
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [r[0] for r in df.select(hour_of_day("s", tz=None)).collect()] == [1, 1, 19, 18, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hour_of_typed_time_stamps(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-15 23:10:00' AS n, timestamp'2024-01-15 23:10:00' AS t")
    assert df.select(hour_of_day("n"), hour_of_day("t"), hour_of_day("t", "America/New_York")).first() == (23, 23, 18)


def test_handles(traps):
    last = by_id(traps, last_handle())
    assert last["1"] == "@ann" and last["7"] == "@bob" and last["12"] == "@ann"
    assert [last[i] for i in ("6", "8", "2")] == [None] * 3
    assert by_id(traps, all_handles())["6"] == ["@ann", "@bob"]


def test_last_handle_is_the_fixed_pattern(spark):
    rng = random.Random(7)
    signs = ["@", "@", "a", "b_", "é", " ", " ", "\t", "\x0b", "\n", "\r", "\u2028", "\x85", "."]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(20_000)]
    texts += ["".join(rng.choices(signs[:8] + ["\n"], k=rng.randint(0, 40))) for _ in range(5_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_extract("t", LAST_HANDLE, 1)
    differ = df.filter(F.coalesce(last_handle("t"), F.lit("")) != plain)
    assert differ.count() == 0 and df.filter(plain != "").count() > 300


def test_last_handle_of_a_long_list_of_handles(spark):
    text = "@ann " * 100_000 + "\n" + "tail"
    df = spark.createDataFrame([(text,), (text + "\nmore",), ("@ann " * 100_000 + "@bob\n",)], "t string")
    start = time.time()
    assert [r[0] for r in df.select(last_handle("t")).collect()] == ["@ann", None, "@bob"]
    assert time.time() - start < 20


def test_the_word_list():
    assert len(POSITIVE_WORDS) == len(set(POSITIVE_WORDS)) == 126


def test_keyword_defaults_and_options(spark, traps):
    hit = by_id(traps, has_keyword())
    assert {i for i, v in hit.items() if v} == {"1", "5", "10"}
    assert by_id(traps, has_keyword(ignore_case=True))["9"] is True
    whole = by_id(traps, has_keyword(whole_word=True))
    assert whole["10"] is False and whole["1"] is True
    df = spark.createDataFrame([("a champion", ), ("champions",), ("x.y",), ("xzy",), ("so ❤!",), (None,)], "t string")
    def flags(column):
        return [r[0] for r in df.select(column).collect()]

    assert flags(has_keyword("t", ["champ", "champion"], whole_word=True)) == [True, False, False, False, False, None]
    assert flags(has_keyword("t", ["x.y", "❤"])) == [False, False, True, False, True, None]
    for bad in ([], [""]):
        with pytest.raises(ValueError):
            keyword_pattern(bad)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab.c[", min_size=1, max_size=4), min_size=1, max_size=6), st.text("ab.c[", max_size=12))
def test_pattern_means_any_word_is_contained(words, text):
    assert bool(re.search(keyword_pattern(words), text)) == any(w in text for w in words)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text("abevz.[", min_size=1, max_size=5), min_size=1, max_size=7), st.text("abevz.[", max_size=14))
def test_words_are_found_at_their_rarest_letter(words, text):
    pattern, plain = rare_letter_pattern(words)
    assert (pattern is not None and bool(re.search(pattern, text)) or any(w in text for w in plain)) == any(w in text for w in words)


def test_every_word_of_the_list_is_found_by_itself_and_none_without_a_letter(spark):
    words = [w for w in POSITIVE_WORDS if w.isascii()]
    texts = [f"{a}{w}{b}" for w in words for a, b in (("", ""), ("xy", "zz"), (". ", "!"))]
    texts += [w[:i] + "~" + w[i + 1:] for w in words for i in range(len(w))] + [w[::-1] for w in words]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.p for r in df.select("t", has_keyword("t").alias("p")).collect()} == {t: any(w in t for w in POSITIVE_WORDS) for t in texts}


def test_case_is_folded_as_the_pattern_does(spark):
    texts = ["FUN", "Fun", "fuN", "ea\u017fy", "fair", "fa\u0130r", "FA\u0131R", "luc\u212Ay", "LUCKY", "❤", "straSSe", "ca\ufb01ne", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    folded, plain = has_keyword("t", ignore_case=True), F.col("t").rlike(keyword_pattern(POSITIVE_WORDS, ignore_case=True))
    assert df.where(~folded.eqNullSafe(plain)).count() == 0 and df.where(folded).count() == 10


def test_a_search_is_spread_over_as_many_tasks_as_run(spark):
    from placewise.checks.reports import tables
    from placewise.plans.hours import positive_counts
    posts = tables.posts(spark, "/root/testdata/sf0.001", "text")
    tasks = posts.select(F.spark_partition_id().alias("p"), "data.text").groupBy("p").count().collect()
    assert len(tasks) == spark.sparkContext.defaultParallelism
    assert positive_counts(posts).agg(F.count("*")).first()[0] > 1


def test_keyword_flag_against_contains(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()]
    got = [r[0] for r in docs.select(has_keyword("text")).collect()]
    assert got == [any(w in t for w in POSITIVE_WORDS) for t in texts]
    every = F.exists(F.array(*map(F.lit, POSITIVE_WORDS)), lambda w: F.contains("text", w))
    assert docs.filter(has_keyword("text") != every).count() == 0


def test_only_texts_with_the_rare_signs_are_translated(spark):
    from placewise.functions.keywords import _folded
    assert "translate" in str(_folded(F.col("t"))) and "CASE WHEN" in str(_folded(F.col("t")))
    texts = ["PLAIN text", "eaſy ıt İS", "İ", "ſſ", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(_folded(F.col("t"))).collect()] == ["plain text", "easy it is", "i", "ss", "", None]


def test_the_search_in_batches_flags_as_the_pattern_does(spark, traps):
    from placewise.functions.keywords import has_keyword_in_batches
    from placewise.plans import hours
    texts = ["a champion", "champions", "x.y", "xzy", "so ❤!", "fun😍", "😂", "FUN", "eaſy", "faİr", "FAıR",
             "LUCKY", "funeral", "honest", "a[b", "", None] + [w[::-1] for w in POSITIVE_WORDS]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for words in (POSITIVE_WORDS, ["x.y", "❤", "[", "a\\b"]):
        for options in ({}, {"ignore_case": True}, {"whole_word": True}):
            flags = [tuple(r) for r in df.select(has_keyword_in_batches("t", words, **options), has_keyword("t", words, **options)).collect()]
            assert [mine for mine, _ in flags] == [theirs for _, theirs in flags]
    counts = hours.positive_counts(traps, search=has_keyword_in_batches)
    assert "RLIKE" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, counts.collect())) == sorted(map(repr, hours.positive_counts(traps).collect()))
