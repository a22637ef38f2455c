"""Row-by-row feeds. All work on tables and on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise import names
from placewise.functions import fields


def place_text(posts: DataFrame) -> DataFrame:
    """Place name and text of each placed post."""
    return (posts.filter(fields.has_place())
            .select(fields.place_name().alias(names.PLACE), F.col("data.text").alias(names.TEXT)))


def geo_feed(posts: DataFrame) -> DataFrame:
    """Author, time and list of places of each placed post."""
    return (posts.filter(fields.has_place())
            .select("data.author_id", F.col("data.created_at").alias(names.CREATED),
                    F.col(fields.PLACES).alias(names.PLACE)))


def text_feed(posts: DataFrame) -> DataFrame:
    """Text of every post."""
    return posts.select("data.text")


def author_feed(posts: DataFrame) -> DataFrame:
    """Profile locations, text, names and author of every post."""
    return posts.select(fields.user_locations().alias(names.LOCATION), F.col("data.text").alias(names.AUTHOR_TEXT),
                        F.col("includes.users.name").alias(names.AUTHOR_NAME), "data.author_id")
