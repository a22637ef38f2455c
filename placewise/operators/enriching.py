"""Gender of the author of each placed post, from a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.functions import fields
from placewise.operators.counting import count_by

# Fixed value: the gender of an unknown name, as the name service spells it.
UNKNOWN = "null"
# What the name service answers about a name.
ANSWER = ("name", "gender", "country", "probability", "total_names")


def unique_lookup(lookup: DataFrame) -> DataFrame:
    """One row per username: the surest answer as a whole, ties settled by value. Fields that the lookup lacks are null."""
    there = {c: F.col(c) for c in lookup.columns}
    fields_ = ["probability", "gender", *(f for f in ANSWER if f not in ("probability", "gender"))]
    kinds = {"probability": "long", "total_names": "long"}
    best = F.max(F.struct(*(there.get(f, F.lit(None)).cast(kinds.get(f, "string")).alias(f) for f in fields_)))
    return (lookup.filter(F.col("username").isNotNull())
            .groupBy("username").agg(best.alias("best"))
            .select("username", *(F.col(f"best.{f}").alias(f) for f in ANSWER)))


def placed_users(posts: DataFrame) -> DataFrame:
    """First user's name of each placed post."""
    return (posts.filter(fields.has_place())
            .select(F.col("data.id").alias("id"), fields.user_field("username").alias("username")))


def _with_gender(users: DataFrame, lookup: DataFrame) -> DataFrame:
    gender = F.coalesce(F.col("gender"), F.lit(UNKNOWN))
    # No hint: the lookup grows with the users. Spark broadcasts it while it is small
    # and splits a heavy user's partition when it is not.
    return users.join(unique_lookup(lookup), "username", "left").withColumn("gender", gender)


def enrich_gender(posts: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row per placed post: ``id, username`` and the answer about the name. Works on streams of posts.

    Posts without a user keep their row. They get keys of their own for the join, made of
    the id or else of the whole post, for otherwise all of them would meet in one task.
    """
    placed = posts.filter(fields.has_place())
    own = F.concat(F.lit("\0"), F.coalesce(F.col("data.id"), F.xxhash64("data", "includes").cast("string")))
    name = fields.user_field("username")
    users = placed.select(F.col("data.id").alias("id"), name.alias("named"), F.coalesce(name, own).alias("username"))
    return _with_gender(users, lookup).select("id", F.col("named").alias("username"), *ANSWER)


def count_by_gender(posts: DataFrame, lookup: DataFrame, name: str = "count") -> DataFrame:
    """Placed posts per gender. Posts are counted per user before the lookup."""
    users = count_by(placed_users(posts), "username", name="posts")
    return _with_gender(users, lookup).groupBy("gender").agg(F.sum("posts").alias(name))
