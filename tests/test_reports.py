import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import as_dict, post
from placewise import names
from placewise.operators import joining
from placewise.operators.counting import share_of_total
from placewise.operators.enriching import count_by_gender, enrich_gender
from placewise.operators.joining import spread_join
from placewise.plans import devices, feeds, genders, handles, hours, locations
from placewise.sources.schemas import POST


def test_feeds(traps):
    rows = {(r[names.PLACE], r[names.TEXT]) for r in feeds.place_text(traps).collect()}
    assert (None, "plain") in rows and ("Rivertown", "good day @ann hi") in rows and len(rows) == 5
    geo = feeds.geo_feed(traps)
    assert geo.columns == ["author_id", names.CREATED, names.PLACE] and geo.count() == 5
    assert feeds.text_feed(traps).count() == 12
    author = feeds.author_feed(traps)
    assert author.columns == [names.LOCATION, "Text", "Name", "author_id"] and author.count() == 12


def test_device_share(traps):
    got = as_dict(devices.device_share(traps), "source", names.BY_DEVICE, names.RATIO)
    assert got == {"web": (4, 0.8), "phone": (1, 0.2)}


def test_shares_sum_to_one(spark):
    counts = spark.range(1, 50).withColumnRenamed("id", "n")
    assert share_of_total(counts, "n").agg(F.sum("ratio")).first()[0] == pytest.approx(1.0)
    assert share_of_total(counts.limit(0), "n").count() == 0


def test_array_groups_stay_apart(traps):
    got = {tuple(r[0]) if r[0] is not None else None: r[1] for r in locations.by_location(traps).collect()}
    assert got == {None: 8, (None,): 1, ("Rivertown",): 1, ("Hillford",): 1, ("Sea",): 1}
    each = as_dict(locations.by_location(traps, each_user=True), names.LOCATION, names.BY_LOCATION)
    assert each == {None: 9, "Rivertown": 1, "Hillford": 1, "Sea": 1}
    assert locations.by_location(traps).first()[1] == 8


def test_hours(traps):
    every = as_dict(hours.hourly_counts(traps), names.HOUR, names.WITHOUT_ADDRESS, names.WITH_ADDRESS)
    assert every == {10: (7, 3), 23: (0, 1), None: (0, 1)}
    assert sum(a + b for a, b in every.values()) == traps.count()
    want = [(10, 7, 3)]
    assert [tuple(r) for r in hours.hourly_geo(traps).collect()] == want
    assert [tuple(r) for r in hours.hourly_geo_join(traps).collect()] == want
    assert [tuple(r) for r in hours.top_hours(traps).collect()] == want


def test_positive_hours(traps):
    every = as_dict(hours.positive_counts(traps), names.HOUR, names.WITH_ADDRESS, names.POSITIVE_WITH, names.POSITIVE_WITHOUT)
    assert every == {10: (3, 1, 1), 23: (1, 0, 0), None: (1, 1, 0)}
    assert [tuple(r) for r in hours.positive_hourly(traps).collect()] == [(10, 3, 1, 1)]
    whole = as_dict(hours.positive_counts(traps, ignore_case=True, whole_word=True), names.HOUR, names.POSITIVE_WITH, names.POSITIVE_WITHOUT)
    assert whole == {10: (1, 1), 23: (0, 0), None: (1, 0)}


def test_the_text_is_searched_once_per_post(spark, traps):
    plan = hours.positive_hourly(traps)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1


def test_a_null_text_is_not_positive(spark):
    rows = [(("1", None, "a", "2024-01-01T00:00:00Z", "web"), ([("P", "p")], None)),
            (("2", "good", "a", "2024-01-01T00:00:00Z", "web"), ([("P", "p")], None))]
    got = hours.positive_counts(spark.createDataFrame(rows, POST)).first()
    assert tuple(got) == (0, 2, 1, 0)


def test_top_hours_cuts_at_n(spark):
    posts = spark.range(24 * 3).select(
        F.struct(F.col("id").cast("string").alias("id"), F.lit("t").alias("text"), F.lit("a").alias("author_id"),
                 F.format_string("2024-01-01T%02d:00:00Z", F.col("id") % 24).alias("created_at"),
                 F.lit("s").alias("source")).alias("data"),
        F.struct(F.when(F.col("id") < 48, F.array(F.struct(F.lit("P").alias("full_name"), F.lit("p").alias("id"))))
                 .alias("places")).alias("includes"))
    top = hours.top_hours(posts).collect()
    assert [r[0] for r in top] == list(range(20)) and hours.hourly_geo(posts).count() == 24


def test_handle_counts(traps):
    assert as_dict(handles.top_handles(traps), "value", "count") == {"@ann": 2, "@bob": 1}
    assert as_dict(handles.top_handles(traps, every=True), "value", "count") == {"@ann": 5, "@bob": 2}
    assert handles.top_handles(traps).first().value == "@ann"


# ---- gender ----

@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame(
        [("nell", "female", 98), ("nell", "male", 60), ("omar", "male", 90), (None, "male", 99), ("idle", None, 1)],
        "username string, gender string, probability long")


def test_enrichment_keeps_one_row_per_placed_post(traps, lookup):
    got = as_dict(enrich_gender(traps, lookup), "id", "username", "gender")
    assert got == {"1": ("nell", "female"), "4": (None, "null"), "5": (None, "null"),
                   "7": ("omar", "male"), "11": ("unknown", "null")}


def test_gender_counts_agree_with_enriched_rows(traps, lookup):
    rows = as_dict(genders.record_share(enrich_gender(traps, lookup)), "gender", names.BY_GENDER, names.RATIO)
    assert rows == as_dict(genders.gender_share(traps, lookup), "gender", names.BY_GENDER, names.RATIO)
    assert rows == {"female": (1, 0.2), "male": (1, 0.2), "null": (3, 0.6)}
    assert sum(r[1] for r in count_by_gender(traps, lookup).collect()) == 5


# ---- place against profile ----

def test_many_to_many_join(spark):
    posts = [post(str(i), f"t{i}", "a", places=["P"]) for i in range(2)]
    posts += [post(str(i), f"t{i}", "a", users=[("u", "L")]) for i in range(2, 5)]
    posts += [post("9", "t9", None, places=["P"], users=[("u", "L")])]
    df = from_dicts(spark, posts)
    joined = locations.place_vs_profile(df, df)
    assert joined.columns == [names.ID, names.CREATED, names.POST_LOCATION, names.POST_TEXT, names.USER_LOCATION]
    assert joined.count() == 6
    assert locations.place_vs_profile(df, df, spread=False).count() == 6
    assert as_dict(locations.place_vs_profile_counts(df, df), "place", "location", "n") == {"P": ("L", 6)}


def test_joined_lists_are_json_before_the_join(spark):
    posts = [post(str(i), f"t{i}", "a", places=["P"]) for i in range(2)]
    posts += [post(str(i), f"t{i}", "a", users=[("u", "L"), ("v", None)]) for i in range(2, 5)]
    df = from_dicts(spark, posts)
    lists = (names.POST_LOCATION, names.USER_LOCATION)
    plain = locations.place_vs_profile(df, df, spread=False)
    texts = locations.place_vs_profile(df, df, spread=False, as_json=True)
    assert sorted(texts.collect()) == sorted(plain.withColumns({c: F.to_json(c) for c in lists}).collect())
    plan = texts._jdf.queryExecution().analyzed().toString()
    assert plan.rindex("to_json") > plan.index("Join")  # only below the join, once per post


def from_dicts(spark, posts):
    rows = [((p["data"]["id"], p["data"]["text"], p["data"]["author_id"], p["data"]["created_at"], p["data"]["source"]),
             None if "includes" not in p else
             ([(x["full_name"], x["id"]) for x in p["includes"]["places"]] if "places" in p["includes"] else None,
              [(x["id"], x["name"], x["username"], x.get("location")) for x in p["includes"]["users"]]
              if "users" in p["includes"] else None)) for p in posts]
    return spark.createDataFrame(rows, POST)


@pytest.mark.parametrize("cell_pairs", [1, 5, 30, 1_000_000])
def test_spread_join_is_the_plain_join(spark, cell_pairs):
    rng = random.Random(cell_pairs)
    # One key holds a third of each side, one is heavy on the left only, some are null.
    keys = ["hot"] * 30 + ["left"] * 20 + ["right"] + [None] * 3 + [f"k{i % 9}" for i in range(36)]
    left = [(k, f"l{i}") for i, k in enumerate(keys)]
    right = [(k, f"r{i}") for i, k in enumerate(["hot"] * 25 + ["right"] * 20 + ["left"] + [None] * 3 + ["k1", "k2", "k2"])]
    rng.shuffle(left), rng.shuffle(right)
    l, r = spark.createDataFrame(left, "k string, a string"), spark.createDataFrame(right, "k string, b string")
    got = Counter(map(tuple, spread_join(l, r, "k", F.col("a"), F.col("b"), cell_pairs).collect()))
    want = Counter((k, a, b) for (k, a), (k2, b) in itertools.product(left, right) if k is not None and k == k2)
    assert got == want


@pytest.mark.parametrize("counters, broadcast", [(1, 100), (7, 100), (1 << 26, 0)])
def test_any_sketch_gives_the_rows_of_the_plain_join(spark, monkeypatch, counters, broadcast):
    """Keys that share counters, and more heavy counters than are broadcast."""
    monkeypatch.setattr(joining, "BROADCAST_COUNTERS", broadcast)
    rng = random.Random(counters)
    l, r = (spark.createDataFrame([(rng.choice(["hot", "hot", "k1", "k2", "k3", None]), i) for i in range(60)], f"k string, {c} long") for c in "ab")
    got = spread_join(l, r, "k", F.col("a"), F.col("b"), 20, partitions=8, counters=counters)
    want = l.join(r, "k")
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect()) and got.count() > 300
    assert spread_join(l.limit(0), r, "k", F.col("a"), F.col("b"), 20).count() == 0


def test_the_sketch_never_shows_too_little(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("k"))
    for counters in (1, 50, 1 << 20):
        shown = {r["_counter"]: r["n"] for r in joining.key_sketch(df, "k", "n", counters).collect()}
        own = df.groupBy("k", joining._counter("k", counters).alias("c")).count().collect()
        assert len(shown) <= counters and sum(shown.values()) == 5000 and all(shown[r["c"]] >= r["count"] for r in own)


def test_spread_join_cuts_heavy_keys_into_cells(spark):
    l = spark.range(300).selectExpr("if(id < 100, 'hot', 'k' || id) AS k", "id AS a")
    r = spark.range(300).selectExpr("if(id < 100, 'hot', 'k' || id) AS k", "id AS b")
    joined = spread_join(l, r, "k", F.col("a"), F.col("b"), cell_pairs=100)
    assert joined.count() == 100 * 100 + 200
    assert sum(1 for x in joined.groupBy("k").count().collect() if x["count"] == 10_000) == 1


def test_the_pairs_of_one_key_are_made_by_many_tasks(spark):
    """9,000 rows of one key on both sides: 81 million pairs, whatever the size of the table."""
    l, r = (spark.range(9000).select(F.lit("hot").alias("k"), F.col("id").alias(c)) for c in "ab")
    joined = spread_join(l, r, "k", F.col("a"), F.col("b"), partitions=64)
    pairs = [x["count"] for x in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(pairs) == 81_000_000 and len(pairs) > 40 and max(pairs) < 8_000_000


def test_location_match_and_region_share(spark):
    posts = from_dicts(spark, [
        post("1", author="a", places=["Rivertown"], users=[("u", "rivertown")]),
        post("2", author="a", places=["North Rivertown"], users=[("u", "Rivertown")]),
        post("3", author="a", places=["Hillford"], users=[("u", None)]),
        post("4", author="b", users=[("v", "Sea")]),
        post("5", author="b", places=[], users=[("v", "Sea")]),
    ])
    got = as_dict(locations.location_match(posts, posts), "author_id", "pairs", "equal", "holding", "rate")
    assert got == {"a": (6, 2, 4, 4 / 6)}
    regions = spark.createDataFrame([("Rivertown", "x"), ("rivertown", "x"), ("Sea", "y")], "location string, attribute string")
    share = as_dict(locations.share_by_region(posts, regions), "attribute", "placed", "posts", "share")
    assert share == {"x": (2, 2, 1.0), "y": (1, 2, 0.5), None: (1, 1, 1.0)}


REGIONS = [("Austin", "south"), ("TX", "south"), ("New York", "east"), ("York", "north"), ("São Paulo", "latin"), ("Port", "b"), ("Port", "a"), (" - ", "none"), (None, "none")]


def test_regions_of_free_text(spark):
    regions = spark.createDataFrame(REGIONS, "location string, attribute string")
    texts = {"Austin, TX": ("austin", "south"), "living in NEW   york!": ("new york", "east"), "york/new": ("york", "north"), "Yorkshire": None, "Aust": None,
             "são paulo": ("são paulo", "latin"), "port": ("port", "a"), "": None, " ,, ": None, "tx york": ("york", "north"), "TX, NY": ("tx", "south"),
             "port york": ("port", "a"), "x " * 5000 + "Austin": ("austin", "south")}
    got = locations.regions_of(spark.createDataFrame([(t,) for t in texts], "location string"), regions)
    assert {r["location"]: (r["named"], r["attribute"]) for r in got.collect()} == {t: v for t, v in texts.items() if v}
    assert locations.regions_of(spark.createDataFrame([("a",)], "location string"), regions.limit(0)).count() == 0


def test_posts_per_named_region(spark):
    regions = spark.createDataFrame(REGIONS, "location string, attribute string")
    posts = from_dicts(spark, [post("1", places=["P"], users=[("u", "Austin, TX")]), post("2", users=[("u", "austin")]), post("3", users=[("u", "nowhere")]),
                               post("4", places=["P"]), post("5", users=[("u", None)])])
    got = as_dict(locations.share_by_named_region(posts, regions), "attribute", "placed", "posts")
    assert got == {"south": (1, 2), None: (1, 3)}


@pytest.mark.parametrize("one, other, agree", [
    ("Rivertown", "RIVER-TOWN", True), ("Rivertown", "Hillford", False), ("Rivertown", "Rivertwn", True), ("Rivertown", "Rivrtwn", True), ("Rivertown", "Rvrtwn", False),
    ("North Rivertown", "north  rivertown!", True), ("Xivertown", "Rivertown", False), ("East Lakeside", "Eost Lakeside", True), ("Sea", "Sex", False),
    ("", "", True), ("", "Sea", False), (None, "Sea", None)])
def test_names_agree_but_for_a_few_letters(spark, one, other, agree):
    from placewise.functions.places import names_agree
    df = spark.createDataFrame([(one, other)], "a string, b string")
    assert df.select(names_agree("a", "b"), names_agree("b", "a")).first() == (agree, agree)


def test_location_agreement(spark):
    posts = from_dicts(spark, [post("1", author="a", places=["Rivertown"], users=[("u", "Rivertwn")]), post("2", author="a", places=["Hillford"], users=[("u", "rivertown")]),
                               post("3", author="b", places=["Sea"], users=[("v", None)])])
    got = as_dict(locations.location_agreement(posts, posts), "author_id", "pairs", "equal", "holding", "near", "rate")
    assert got == {"a": (4, 1, 1, 2, 0.5)}


def test_a_null_key_is_not_the_total(spark):
    from placewise.operators.counting import count_with_total, with_shares
    df = spark.createDataFrame([(k,) for k in ("a", "a", None)], "k string")
    assert as_dict(with_shares(count_with_total(df, "k", "n"), "n"), "k", "n", "ratio") == {"a": (2, 2 / 3), None: (1, 1 / 3)}
    assert with_shares(count_with_total(df.limit(0), "k", "n"), "n").count() == 0
