"""Every report over the test tables, by name: ``(spark, sf_dir) -> DataFrame``.

Arrays come out as JSON text and texts that a join would multiply as digests, so that
plain SQL can check them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placewise import names
from placewise.checks.oracle import ADDED_WORDS
from placewise.functions import fields
from placewise.functions.handles import last_handle
from placewise.functions.keywords import POSITIVE_WORDS, has_keyword_in_batches
from placewise.operators.counting import ranked
from placewise.operators.enriching import enrich_gender
from placewise.plans import devices, feeds, genders, handles, hours, locations
from placewise.session import work_folder
from placewise.sources import tables
from placewise.sources.drift import schema_drift
from placewise.sources.landing import COMPRESSION, land_posts, land_stream
from placewise.sources.posts import LINES, NO_POSTS, lines_by_batch, read_gender_records, read_posts, stream_gender_records, stream_posts
from placewise.streaming import reports as live
from placewise.streaming.sinks import FEW_KEYS, append_files, landed_batches, last_batch, latest, replace_table

LANDED_ANSWER = "id string, username string, name string, gender string, country string, probability long, total_names long"

REPORTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def report(function: Callable[[SparkSession, str], DataFrame]):
    REPORTS[function.__name__] = function
    return function


def as_json(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.to_json(c) for c in columns})


# ---- tables ----

@report
def place_text(spark, sf_dir):
    return feeds.place_text(tables.posts(spark, sf_dir, "text", "place"))


@report
def text_feed(spark, sf_dir):
    return feeds.text_feed(tables.posts(spark, sf_dir, "text"))


@report
def geo_feed(spark, sf_dir):
    return as_json(feeds.geo_feed(tables.posts(spark, sf_dir, "place")), names.PLACE)


@report
def author_feed(spark, sf_dir):
    return as_json(feeds.author_feed(tables.posts(spark, sf_dir, "text", "author")), names.LOCATION, "Name")


@report
def by_location(spark, sf_dir):
    return as_json(locations.by_location(tables.posts(spark, sf_dir, "author")), names.LOCATION)


@report
def by_each_location(spark, sf_dir):
    return locations.by_location(tables.posts(spark, sf_dir, "author"), each_user=True)


@report
def device_share(spark, sf_dir):
    return devices.device_share(tables.posts(spark, sf_dir))


@report
def gender_share(spark, sf_dir):
    return genders.gender_share(tables.posts(spark, sf_dir, "author"), tables.lookup(spark, sf_dir))


@report
def enriched_genders(spark, sf_dir):
    return enrich_gender(tables.posts(spark, sf_dir, "author"), tables.lookup(spark, sf_dir))


@report
def record_share(spark, sf_dir):
    """Lands the gender of each placed post as JSON, then counts the landed rows."""
    out = work_folder(spark, "gender")
    enriched_genders(spark, sf_dir).write.json(out)
    return genders.record_share(read_gender_records(spark, out))


@report
def hourly_geo(spark, sf_dir):
    return hours.hourly_geo(tables.posts(spark, sf_dir))


@report
def hourly_geo_tz(spark, sf_dir):
    return hours.hourly_geo(tables.posts(spark, sf_dir), tz="America/New_York")


@report
def hourly_geo_join(spark, sf_dir):
    return hours.hourly_geo_join(tables.posts(spark, sf_dir))


@report
def top_hours(spark, sf_dir):
    return hours.top_hours(tables.posts(spark, sf_dir))


@report
def positive_hourly(spark, sf_dir):
    return hours.positive_hourly(tables.posts(spark, sf_dir, "text"))


@report
def positive_hourly_words(spark, sf_dir):
    """Whole words only, whatever their case; with words that the texts have, for the list's own are only parts of theirs."""
    words = (*POSITIVE_WORDS, *ADDED_WORDS)
    return hours.positive_hourly(tables.posts(spark, sf_dir, "text"), ignore_case=True, whole_word=True, words=words)


@report
def positive_counts_any_case(spark, sf_dir):
    """Every hour; parts of words, whatever their case."""
    return hours.positive_counts(tables.posts(spark, sf_dir, "text"), ignore_case=True)


@report
def place_vs_profile(spark, sf_dir):
    posts = tables.posts(spark, sf_dir, "author", "place")
    return locations.place_vs_profile_counts(posts, posts)


def _joined_rows(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    placed = tables.posts(spark, sf_dir, "place")
    # Only the digest of a text is kept, so it is taken before the join: a text is copied to every cell of its author.
    profiled = tables.posts(spark, sf_dir, "text", "author")
    profiled = profiled.withColumn("data", F.col("data").withField("text", F.md5("data.text")))
    # Lists become JSON text on each side, once per post, not once per joined row.
    return locations.place_vs_profile(placed, profiled, as_json=True, **limits)


@report
def place_vs_profile_rows(spark, sf_dir):
    """The join row by row, texts and all; a digest stands for each text in the result."""
    return _joined_rows(spark, sf_dir)


@report
def place_vs_profile_spread(spark, sf_dir):
    """The same with cells so small that the busier authors of these tables are spread."""
    return _joined_rows(spark, sf_dir, cell_pairs=100)


@report
def location_match(spark, sf_dir):
    posts = tables.posts(spark, sf_dir, "author", "place")
    return locations.location_match(posts, posts)


@report
def share_by_region(spark, sf_dir):
    return locations.share_by_region(tables.posts(spark, sf_dir, "author"), tables.regions(spark, sf_dir))


def _in_free_text(posts: DataFrame) -> DataFrame:
    """The posts with locations as people write them: in a sentence, in small letters, beside another name, misspelt, or none at all."""
    def written(user: Column) -> Column:
        kind, name = F.col("data.author_id").cast("long") % 6, user["location"]
        return (F.when(kind == 0, F.concat(F.lit("Old Town, "), name)).when(kind == 1, F.concat(F.lower(name), F.lit("(north-west)!")))
                .when(kind == 2, F.concat(F.lit("born in "), name, F.lit(" / now CHINA"))).when(kind == 3, F.lit("somewhere  nice"))
                .when(kind == 4, F.concat(F.substring(name, 1, 4), F.substring(name, 6, 100))).otherwise(name))

    users = F.transform("includes.users", lambda user: user.withField("location", written(user)))
    return posts.withColumn("includes", F.struct("includes.places", users.alias("users")))


@report
def share_by_named_region(spark, sf_dir):
    """The nations, and the regions by their own names."""
    nations = tables.regions(spark, sf_dir)
    regions = nations.unionByName(nations.select(F.col("attribute").alias("location"), "attribute").distinct())
    return locations.share_by_named_region(_in_free_text(tables.posts(spark, sf_dir, "author")), regions)


@report
def location_agreement(spark, sf_dir):
    posts = _in_free_text(tables.posts(spark, sf_dir, "author", "place"))
    return locations.location_agreement(posts, posts)


@report
def top_handles(spark, sf_dir):
    return handles.top_handles(tables.posts(spark, sf_dir, "text"))


@report
def every_handle(spark, sf_dir):
    return handles.top_handles(tables.posts(spark, sf_dir, "text"), every=True)


def _landed(posts: DataFrame) -> DataFrame:
    return posts.select("data.id", "data.author_id", "data.created_at", "data.source", "data.text",
                        fields.place_name().alias("place"), fields.user_field("username").alias("username"),
                        fields.user_field("location").alias("location"))


@report
def landed_posts(spark, sf_dir):
    """Lands the posts as JSON files and reads them back."""
    out = work_folder(spark, "posts")
    land_posts(tables.posts(spark, sf_dir, "text", "author", "place"), out, compression=COMPRESSION)
    return _landed(read_posts(spark, out))


@report
def post_schema_drift(spark, sf_dir):
    """Posts landed without users, with a number for an id and with a field more, against the declared schema."""
    out = work_folder(spark, "drifted")
    posts = tables.posts(spark, sf_dir, "place")
    data = F.struct("data.*", F.lit("en").alias("lang"))
    land_posts(posts.select(data.withField("id", F.col("data.id").cast("long")).alias("data"), "includes"), out)
    return schema_drift(spark, out)


# ---- streams: each handles what is there and returns the table it left ----

def _parts(files: int, lowest: int, highest: int) -> Column:
    """Which of so many parts of the time from the first to the last event a time stamp lies in, from 0."""
    return F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - lowest) * files / (highest - lowest + 1)).cast("int")


def _in_files(spark: SparkSession, sf_dir: str, files: int) -> str:
    """A folder with the events in so many files, one after the other by time."""
    out = work_folder(spark, "events")
    events = tables.table(spark, sf_dir, "events")
    span = events.agg(*(F.unix_micros(f("ts").cast("timestamp")) for f in (F.min, F.max))).first()
    for number in range(files):
        events.filter(_parts(files, *span) == number).coalesce(1).write.mode("append").parquet(f"{out}/events.parquet")
    return out


def _stream(spark: SparkSession, sf_dir: str, *parts: str, files: int = 2) -> DataFrame:
    """The posts as a stream that gets a file in each batch."""
    return tables.posts(spark, sf_dir, *parts, events=tables.stream_events(spark, _in_files(spark, sf_dir, files), max_files=1))


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _appended(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    out = work_folder(spark, name)
    _finish(append_files(df, f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{out}/rows")


def _replaced(spark: SparkSession, name: str, df: DataFrame, rank: tuple[str, ...] = (),
              state_partitions: int | None = FEW_KEYS) -> DataFrame:
    out = work_folder(spark, name)
    _finish(replace_table(df, f"{out}/result", f"{out}/checkpoint", state_partitions=state_partitions))
    counts = latest(spark, f"{out}/result", df.schema)
    return ranked(counts, *rank) if rank else counts


@report
def stream_place_text(spark, sf_dir):
    return _appended(spark, "place_text", feeds.place_text(_stream(spark, sf_dir, "text", "place")))


@report
def stream_text_feed(spark, sf_dir):
    return _appended(spark, "text_feed", feeds.text_feed(_stream(spark, sf_dir, "text")))


@report
def stream_geo_feed(spark, sf_dir):
    feed = feeds.geo_feed(_stream(spark, sf_dir, "place"))
    return as_json(_appended(spark, "geo_feed", feed), names.PLACE)


@report
def stream_device(spark, sf_dir):
    return _replaced(spark, "device", devices.count_by_device(_stream(spark, sf_dir)))


@report
def stream_device_share(spark, sf_dir):
    out = work_folder(spark, "device_share")
    posts = _stream(spark, sf_dir)
    _finish(live.live_device_share(posts, f"{out}/result", f"{out}/checkpoint"))
    return live.latest_shares(spark, f"{out}/result", "source", names.BY_DEVICE)


def _stream_genders(spark: SparkSession, sf_dir: str) -> str:
    out = work_folder(spark, "gender")
    posts = _stream(spark, sf_dir, "author")
    _finish(live.land_genders(posts, tables.lookup(spark, sf_dir), f"{out}/rows", f"{out}/checkpoint"))
    return f"{out}/rows"


@report
def stream_enriched_genders(spark, sf_dir):
    return spark.read.schema(LANDED_ANSWER).json(_stream_genders(spark, sf_dir))


@report
def stream_fresh_genders(spark, sf_dir):
    """A quarter of the names is known when the stream begins, and a quarter more with each of the four batches."""
    out = work_folder(spark, "fresh")
    names_ = tables.lookup(spark, sf_dir).withColumn("quarter", F.pmod(F.regexp_extract("username", "([0-9]+)", 1).cast("long"), F.lit(4)))

    def landed(number: int) -> None:
        names_.filter(F.col("quarter") == number).drop("quarter").write.mode("append").json(f"{out}/names")

    def known(session: SparkSession) -> DataFrame:
        landed(last_batch(session, f"{out}/genders") + 1)  # what a producer does meanwhile
        return session.read.schema(f"{LANDED_ANSWER}").json(f"{out}/names").drop("id")

    posts = _stream(spark, sf_dir, "author", files=4)
    _finish(live.land_fresh_genders(posts, known, f"{out}/genders", f"{out}/checkpoint"))
    numbers = {c: F.col(c).cast("string") for c in ("probability", "total_names")}  # nulls compare as texts
    return landed_batches(spark, f"{out}/genders", LANDED_ANSWER).withColumns(numbers)


def _torn_lines(spark: SparkSession, sf_dir: str, files: int) -> str:
    """Posts landed as JSON lines in so many files; every fiftieth line is cut short."""
    out = work_folder(spark, "torn")
    events = _in_files(spark, sf_dir, files)
    for path in sorted(spark.read.parquet(f"{events}/events.parquet").inputFiles(), key=lambda p: spark.read.parquet(p).agg(F.min("ts")).first()):
        lines = tables.posts(spark, sf_dir, events=spark.read.schema(tables.SCHEMAS["events"]).parquet(path))
        line = F.to_json(F.struct("data", "includes"))
        torn = F.when(F.col("data.id").cast("long") % 50 == 0, F.substring(line, 1, 30)).otherwise(line)
        lines.select(torn.alias("value")).coalesce(1).write.mode("append").text(f"{out}/posts")
    return f"{out}/posts"


@report
def torn_lines_by_batch(spark, sf_dir):
    """Lines and torn lines as the scans counted them: those of each batch of a stream, and of a table (batch -1)."""
    path = _torn_lines(spark, sf_dir, files=3)
    out = work_folder(spark, "whole")
    query = append_files(feeds.text_feed(stream_posts(spark, path, "data.text", max_files=1, observed="lines")), f"{out}/rows", f"{out}/checkpoint")
    _finish(query)
    observed = Observation("lines")
    read_posts(spark, path, "data.text", observed=observed).write.format("noop").mode("overwrite").save()
    found = [*lines_by_batch(query, "lines"), (-1, observed.get[LINES], observed.get[NO_POSTS])]
    return spark.createDataFrame(found, "batch long, lines long, torn long")


@report
def stream_gender(spark, sf_dir):
    """Lands genders beside the post stream and counts them in a stream of their own."""
    records = stream_gender_records(spark, _stream_genders(spark, sf_dir))
    return _replaced(spark, "gender_counts", genders.count_records_by_gender(records))


@report
def stream_gender_share(spark, sf_dir):
    out = work_folder(spark, "gender_share")
    records = stream_gender_records(spark, _stream_genders(spark, sf_dir))
    _finish(live.live_record_share(records, f"{out}/result", f"{out}/checkpoint"))
    return live.latest_shares(spark, f"{out}/result", "gender", names.BY_GENDER)


@report
def stream_by_location(spark, sf_dir):
    counts = locations.count_by_location(_stream(spark, sf_dir, "author"))
    rank = (names.BY_LOCATION, names.LOCATION)
    return as_json(_replaced(spark, "location", counts, rank, None), names.LOCATION)


@report
def stream_sorted_location(spark, sf_dir):
    """The same with the sort inside the stream: ``position`` is where its files have a row, from 1."""
    counts = locations.by_location(_stream(spark, sf_dir, "author"))
    kept = _replaced(spark, "sorted", counts, state_partitions=None)
    written = Window.orderBy("_metadata.file_name", "_metadata.row_index")
    return as_json(kept.withColumn("position", F.row_number().over(written)), names.LOCATION)


@report
def stream_hourly(spark, sf_dir):
    return _replaced(spark, "hourly", hours.hourly_counts(_stream(spark, sf_dir)))


@report
def stream_positive(spark, sf_dir):
    return _replaced(spark, "positive", hours.positive_counts(_stream(spark, sf_dir, "text"), search=has_keyword_in_batches))


@report
def stream_handles(spark, sf_dir):
    counts = handles.count_handles(_stream(spark, sf_dir, "text"))
    return _replaced(spark, "handles", counts, ("count", "value"), None)


@report
def stream_landed_posts(spark, sf_dir):
    out = work_folder(spark, "posts")
    _finish(land_stream(_stream(spark, sf_dir, "text", "author", "place"), f"{out}/posts", f"{out}/checkpoint", compression=COMPRESSION))
    return _landed(read_posts(spark, f"{out}/posts"))


def _windowed(spark: SparkSession, posts: DataFrame, key: Column, name: str) -> DataFrame:
    counts = live.windowed_count(posts, key.alias(name), watermark="1 hour", window="1 day", name="n")
    day = F.floor(F.unix_seconds("window.start") / 86400).cast("int")
    counts = counts.select(F.date_from_unix_date(day).cast("string").alias("day"), name, "n")
    return _appended(spark, "windowed", counts)


@report
def stream_windowed_device(spark, sf_dir):
    """Devices per day with bounded state: the days that are closed behind the watermark."""
    return _windowed(spark, _stream(spark, sf_dir), F.col("data.source"), "source")


@report
def stream_windowed_location(spark, sf_dir):
    return _windowed(spark, _stream(spark, sf_dir, "author"), F.to_json(fields.user_locations()), names.LOCATION)


@report
def stream_windowed_handles(spark, sf_dir):
    return _windowed(spark, _stream(spark, sf_dir, "text"), last_handle(), "value")


def _top(spark: SparkSession, posts: DataFrame, key: Column, window: str = "1 day", **limits) -> DataFrame:
    tops = _appended(spark, "top", live.windowed_top(posts, key, watermark="1 hour", window=window, **limits))
    day = F.date_from_unix_date(F.floor(F.unix_seconds("window.start") / 86400).cast("int")).cast("string")
    return tops.withColumn("day", day)


@report
def stream_top_locations(spark, sf_dir):
    """The locations of each closed day by a summary with room for all of them."""
    tops = _top(spark, _stream(spark, sf_dir, "author"), fields.user_field("location"), k=100, items=1000)
    return tops.select("day", "rank", F.col("value").alias("location"), F.col("count").alias("n"), "posts", "error")


@report
def stream_top_handles(spark, sf_dir):
    tops = _top(spark, _stream(spark, sf_dir, "text"), last_handle(), k=1000, items=1000)
    return tops.select("day", "rank", "value", F.col("count").alias("n"), "posts", "error")


@report
def stream_top_handles_exact(spark, sf_dir):
    """The exact way: counts of all handles of a closed day, then the best five of each."""
    counts = live.windowed_count(_stream(spark, sf_dir, "text"), last_handle().alias("value"), watermark="1 hour", window="1 day")
    tops = live.top_of_windows(_appended(spark, "handles", counts), k=5)
    day = F.date_from_unix_date(F.floor(F.unix_seconds("window.start") / 86400).cast("int")).cast("string")
    return tops.select(day.alias("day"), "rank", "value", F.col("count").alias("n"))


@report
def stream_top_recall(spark, sf_dir):
    """Twenty words that posts begin with, by a summary that has no room for all: what it finds of the exact twenty.

    Words come with the last digits of the author's id, so that there are thousands of values.
    """
    def word(posts: DataFrame) -> DataFrame:
        often = F.when(F.col("data.id").cast("long") % 3 > 0, F.substring_index("data.text", " ", 1))
        return posts.withColumn("word", F.coalesce(often, F.concat("data.author_id", F.lit("-"), F.col("data.id").cast("long") % 100)))

    tops = _top(spark, word(_stream(spark, sf_dir, "text")), F.col("word"), window="10 days", k=20, items=400)
    days = F.window(F.col("data.created_at").cast("timestamp"), "10 days")
    exact = word(tables.posts(spark, sf_dir, "text")).groupBy(days.alias("window"), F.col("word").alias("value")).agg(F.count("*").alias("n"))
    last = live.top_of_windows(exact, 20, name="n").groupBy("window").agg(F.min("n").alias("least"))
    judged = tops.join(exact, ["window", "value"]).join(last, "window")
    return judged.groupBy("day").agg((F.count_if(F.col("n") >= F.col("least")) >= 18).alias("recall_of_nine_tenths"),
                                     F.bool_and((F.col("count") >= F.col("n")) & (F.col("count") - F.col("n") <= F.col("error"))).alias("within_error"),
                                     F.max("posts").alias("posts"))
