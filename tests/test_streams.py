import shutil

import pytest
from pyspark.sql import functions as F

from conftest import TRAPS, write_lines
from placewise import names
from placewise.plans import devices, feeds, genders, handles, hours, locations
from placewise.sources.posts import read_gender_records, read_posts, stream_gender_records, stream_posts
from placewise.streaming import reports as live
from placewise.streaming import sinks
from placewise.streaming.sinks import append_files, latest, replace_table, to_console

PARTS = (TRAPS[:4], TRAPS[4:8], TRAPS[8:])


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(number):
        path = write_lines(tmp_path / f"part{number}", PARTS[number])
        shutil.copy(f"{path}/part-0.json", folder / f"file-{number}.json")
    land.path = str(folder)
    return land


def rows(df):
    return sorted(map(repr, df.collect()))


COUNTS = {
    "device": devices.count_by_device,
    "hours": hours.hourly_counts,
    "positive": hours.positive_counts,
    "location": locations.by_location,
    "handles": handles.top_handles,
}


@pytest.mark.parametrize("name", COUNTS)
def test_live_count_ends_like_the_batch_and_goes_on_after_a_restart(spark, landing, tmp_path, name):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        counts = COUNTS[name](stream_posts(spark, landing.path, max_files=1))
        query = replace_table(counts, out, checkpoint)
        query.awaitTermination(180)
        assert query.exception() is None
        return counts.schema, len([p for p in query.recentProgress if p["numInputRows"]])

    landing(0), landing(1)
    schema, batches = run()
    assert batches == 2
    assert rows(latest(spark, out, schema)) == rows(COUNTS[name](read_posts(spark, landing.path)))
    landing(2)
    schema, batches = run()
    assert batches == 1
    got = latest(spark, out, schema)
    assert rows(got) == rows(COUNTS[name](read_posts(spark, landing.path))) and got.count() > 0


def test_feeds_are_appended_once(spark, landing, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for number in range(3):
        landing(number)
        feed = feeds.place_text(stream_posts(spark, landing.path, "data.text", "includes.places"))
        append_files(feed, out, checkpoint).awaitTermination(120)
    assert rows(spark.read.parquet(out)) == rows(feeds.place_text(read_posts(spark, landing.path)))


def test_live_shares(spark, landing, tmp_path):
    for number in range(3):
        landing(number)
    posts = stream_posts(spark, landing.path, max_files=1)
    live.live_device_share(posts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(180)
    want = devices.device_share(read_posts(spark, landing.path))
    assert rows(live.latest_shares(spark, str(tmp_path / "out"), "source", names.BY_DEVICE)) == rows(want)


def test_a_batch_of_a_live_share_is_written_once(spark, landing, tmp_path):
    landing(0)
    live.live_device_share(stream_posts(spark, landing.path), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(180)
    assert {p.parent.relative_to(tmp_path / "out").as_posix() for p in (tmp_path / "out").rglob("*.parquet")} == {"turn=0/table", "log/part=0"}


def test_genders_are_landed_file_by_file_and_counted(spark, landing, tmp_path):
    lookup = spark.createDataFrame([("nell", "female", 98), ("omar", "male", 90)],
                                   "username string, gender string, probability long")
    gender = str(tmp_path / "gender")
    for number in range(3):
        landing(number)
        posts = stream_posts(spark, landing.path, max_files=1)
        live.land_genders(posts, lookup, gender, str(tmp_path / "cp1")).awaitTermination(120)
    records = read_gender_records(spark, gender)
    want = genders.record_share(records)
    assert rows(want) == rows(genders.gender_share(read_posts(spark, landing.path), lookup))
    live.live_record_share(stream_gender_records(spark, gender, max_files=1), str(tmp_path / "out"),
                           str(tmp_path / "cp2")).awaitTermination(180)
    assert rows(live.latest_shares(spark, str(tmp_path / "out"), "gender", names.BY_GENDER)) == rows(want)


def test_windowed_count_gives_closed_windows_only(spark, landing, tmp_path):
    for number in range(3):
        landing(number)
    counts = live.windowed_count(stream_posts(spark, landing.path), F.col("data.source"), "1 hour", "1 hour", "n")
    append_files(counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(180)
    got = spark.read.parquet(str(tmp_path / "out")).select(F.hour("window.start"), "source", "n").collect()
    assert sorted(map(tuple, got)) == [(10, "phone", 1), (10, "web", 9)]  # 23 h is still open


def test_the_log_stays_short_and_names_the_last_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "LOG_LENGTH", 3)
    out = tmp_path / "out"
    for turn in (0, 1):
        spark.range(1).select(F.lit(turn).alias("turn")).write.parquet(f"{out}/turn={turn}/table")
    for number in range(11):
        sinks._log(spark, str(out), number)
        if number % 4 == 0:
            sinks._log(spark, str(out), number)  # run again
        assert latest(spark, str(out), "turn int").first()[0] == number % 2
    assert len(list((out / "log").glob("*/*.parquet"))) <= 2 * 4 + 2


def test_state_partitions_leave_the_session_alone(spark, landing, tmp_path):
    landing(0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = replace_table(devices.count_by_device(stream_posts(spark, landing.path)), str(tmp_path / "out"),
                          str(tmp_path / "cp"), state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    query.awaitTermination(120)
    assert len([p for p in (tmp_path / "cp" / "state" / "0").iterdir() if p.name.isdigit()]) == 3


def test_console_takes_feeds(spark, landing):
    landing(0)
    query = to_console(feeds.text_feed(stream_posts(spark, landing.path)), "append", available_now=True)
    query.awaitTermination(120)
    assert query.exception() is None and query.lastProgress["numInputRows"] == len(PARTS[0])


def test_console(spark, landing, capfd):
    landing(0)
    posts = stream_posts(spark, landing.path)
    query = to_console(devices.count_by_device(posts), "complete", available_now=True)
    query.awaitTermination(120)
    assert query.exception() is None and "Console" in query.lastProgress["sink"]["description"]


# ---- fresh lookups ----

def test_a_name_added_between_two_batches_is_found_without_a_restart(spark, landing, tmp_path):
    names, out = tmp_path / "names", str(tmp_path / "out")
    schema, asked = "username string, gender string, probability long", []

    def lookup(session):
        """Before the second batch a producer lands omar."""
        known = [("nell", "female", 98)] if not asked else [("omar", "male", 90)]
        asked.append(session.createDataFrame(known, schema).write.mode("append").json(str(names)))
        return session.read.schema(schema).json(str(names))

    for number in range(3):
        landing(number)
    query = live.land_fresh_genders(stream_posts(spark, landing.path, max_files=1), lookup, out, str(tmp_path / "cp"))
    query.awaitTermination(180)
    assert query.exception() is None and len(asked) == 3
    got = {r["id"]: (r["gender"], r["batch"]) for r in sinks.landed_batches(spark, out, "id string, gender string").collect()}
    assert got == {"1": ("female", 0), "4": ("null", 0), "5": ("null", 1), "7": ("male", 1), "11": ("null", 2)}


def test_a_batch_that_runs_twice_lands_once(spark, tmp_path):
    out, made = str(tmp_path / "out"), []
    batch = spark.range(5)

    def make(df, number):
        made.append(number)
        return df.withColumn("n", F.lit(len(made)))

    assert sinks.last_batch(spark, out) == -1
    for number in (0, 0, 1):
        sinks.land_batch(batch, number, out, make)
    assert made == [0, 1] and sinks.landed_batches(spark, out, "id long, n long").count() == 10
    # a batch that wrote and did not get into the log is not read, and is replaced
    make(batch, 2).write.json(f"{out}/rows/batch=2")
    assert sinks.landed_batches(spark, out, "id long, n long").count() == 10
    sinks.land_batch(batch, 2, out, make)
    landed = sinks.landed_batches(spark, out, "id long, n long")
    assert landed.count() == 15 and {r["n"] for r in landed.where("batch = 2").collect()} == {4}


# ---- bounded rankings ----

STAMPED = "data struct<id: string, created_at: string, source: string>"


def stamped(spark, values, days=2):
    rows = [((str(i), f"2024-01-{15 + i % days:02d}T10:00:00Z", v),) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, STAMPED).repartition(4)


def test_tops_of_windows_are_exact_while_all_values_have_a_place(spark):
    posts = stamped(spark, [v for i in range(40) for v in [f"v{i:02d}"] * (2 * (i // 2) + 2)] + [None] * 500)
    tops = live.windowed_top(posts, F.col("data.source"), "1 hour", "1 day", k=5, items=100)
    exact = live.top_of_windows(live.windowed_count(posts, F.col("data.source").alias("value"), "1 hour", "1 day"), k=5)
    columns = ["window", "rank", "value", "count"]
    assert sorted(tops.select(columns).collect()) == sorted(exact.select(columns).collect()) and tops.count() == 10
    assert {r["posts"] for r in tops.collect()} == {420}


def test_an_estimate_is_never_too_low_nor_beyond_the_error(spark):
    import random
    rng = random.Random(3)
    values = [f"v{int(rng.paretovariate(0.9))}" for _ in range(30_000)]
    posts = stamped(spark, values, days=1)
    exact = {v: values.count(v) for v in set(values)}
    least = sorted(exact.values())[-20]
    for items in (30, 100, 400):
        tops = live.windowed_top(posts, F.col("data.source"), "1 hour", "1 day", k=20, items=items).collect()
        assert all(0 <= r["count"] - exact[r["value"]] <= r["error"] for r in tops)
        assert [r["rank"] for r in sorted(tops, key=lambda r: (-r["count"], r["value"]))] == list(range(1, len(tops) + 1))
        if items >= 100:
            assert sum(exact[r["value"]] >= least for r in tops) >= 18


def test_the_state_of_a_ranking_is_a_row_for_each_window(spark, landing, tmp_path):
    for number in range(3):
        landing(number)
    tops = live.windowed_top(stream_posts(spark, landing.path, max_files=1), F.col("data.id"), "1 hour", "1 hour", k=20, items=100)
    query = append_files(tops, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(180)
    state = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert query.exception() is None and state <= 2 and len(got) == 10 and {r["posts"] for r in got} == {10}


@pytest.mark.parametrize("k, items", [(0, 10), (11, 10), (5, 2_000_000)])
def test_limits_of_a_ranking(spark, k, items):
    with pytest.raises(ValueError):
        live.windowed_top(stamped(spark, ["a"]), F.col("data.source"), "1 hour", "1 day", k=k, items=items)


# ---- torn lines ----

def test_torn_lines_are_counted_in_each_batch(spark, tmp_path):
    from placewise.sources.posts import lines_by_batch
    (tmp_path / "landing").mkdir()
    for number, torn in ((0, True), (1, False), (2, True)):
        path = write_lines(tmp_path / f"part{number}", PARTS[number], torn=torn)
        shutil.copy(f"{path}/part-0.json", tmp_path / "landing" / f"file-{number}.json")
    feed = feeds.text_feed(stream_posts(spark, str(tmp_path / "landing"), "data.text", max_files=1, observed="seen"))
    query = append_files(feed, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert lines_by_batch(query, "seen") == [(0, 5, 1), (1, 4, 0), (2, 5, 1)]
    assert lines_by_batch(query, "other") == [] and spark.read.parquet(str(tmp_path / "out")).count() == 12
