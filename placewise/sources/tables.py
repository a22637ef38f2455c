"""Posts derived from the relational test tables.

Every event becomes one post: its author is the customer, its text a document, its
place a nation for every third value of ``k``. The posts have the declared nested
schema, so that the reports run on them as on landed JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewise.sources.posts import spread
from placewise.sources.schemas import USERS

SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stream_events(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The events as a stream; one file or a folder of them."""
    reader = spark.readStream.schema(SCHEMAS["events"])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{sf_dir}/[e]vents.parquet")


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Username to gender, from the customers."""
    gender = (F.when(F.col("c_nationkey") % 3 == 0, "male")
              .when(F.col("c_nationkey") % 3 == 1, "female").otherwise("null"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("username"), F.col("c_name").alias("name"), gender.alias("gender"), F.col("c_mktsegment").alias("country"),
        (F.col("c_custkey") % 50 + 50).alias("probability"), F.col("c_nationkey").cast("long").alias("total_names"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location to region name."""
    return (table(spark, sf_dir, "nation")
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("location"), F.col("r_name").alias("attribute")))


def posts(spark: SparkSession, sf_dir: str, *parts: str, events: DataFrame | None = None) -> DataFrame:
    """The posts of the test tables; ``events`` may be a stream.

    ``parts`` says what a report needs beyond id, author id, time, source and whether
    there is a place: ``text``, ``author``, ``place`` (its name). Each is
    a left join on a unique key, which keeps every event once; so a report that leaves
    a part out gets the same rows with nulls there, and no join.
    """
    text, author, place = (part in parts for part in ("text", "author", "place"))
    events = table(spark, sf_dir, "events") if events is None else events
    k = F.get_json_object("props", "$.k").cast("int")
    df = events.select("event_id", "ts", "user_id", "event_type", k.alias("k"))

    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    if place:
        there = nation.select(F.col("n_nationkey").alias("place_key"), F.col("n_name").alias("place_name"))
        df = df.join(there, F.col("place_key") == F.col("k") % 25, "left")
    if author:
        home = nation.select(F.col("n_nationkey").alias("home_key"), F.col("n_name").alias("location"))
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
        df = (df.join(customer, F.col("c_custkey") == F.col("user_id"), "left")
              .join(home, F.col("home_key") == F.col("c_nationkey"), "left"))
    if text:  # last: no row with its long text is shuffled again for a join
        df = spread(df)  # one file of narrow rows, and a long text for each of them
        documents = table(spark, sf_dir, "documents")
        count = documents.count()  # a literal keeps the join an equi-join
        df = df.join(documents.select("doc_id", F.col("text").alias("doc_text")), F.col("doc_id") == F.col("event_id") % count, "left")

    user_id = F.col("user_id").cast("string")
    body = F.lit(None).cast("string")
    if text:
        repeated = F.concat(F.lit("RT @user"), (F.col("user_id") % 20).cast("string"), F.lit(" "), "doc_text")
        body = F.when(F.col("event_id") % 4 == 0, repeated).otherwise(F.col("doc_text"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    users = F.lit(None).cast(USERS)
    if author:
        users = F.array(F.struct(user_id.alias("id"), F.col("c_name").alias("name"),
                                 F.col("c_name").alias("username"), F.col("location").alias("location")))
    full_name, place_id = (F.col("place_name"), F.col("place_key")) if place else (F.lit(None), F.lit(None))
    places = F.when(F.col("k") % 3 == 0, F.array(F.struct(
        full_name.cast("string").alias("full_name"), place_id.cast("string").alias("id"))))
    data = F.struct(F.col("event_id").cast("string").alias("id"), body.alias("text"), user_id.alias("author_id"),
                    stamp.alias("created_at"), F.col("event_type").alias("source"))
    includes = F.struct(places.alias("places"), users.alias("users"))
    return df.select(data.alias("data"), includes.alias("includes"))
