"""Is sharing a place a matter of the time of day, or of the mood of the post?

The counts that are compared come from one pass over the posts: one aggregate with a
conditional count each, instead of one filtered scan each and a join on the hour.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise import names
from placewise.functions import fields
from placewise.functions.keywords import POSITIVE_WORDS, has_keyword
from placewise.functions.times import hour_of_day
from placewise.operators.counting import count_by, ranked, top_k


def _hours(posts: DataFrame, tz: str | None, **columns: Column) -> DataFrame:
    """Hour, place flag and what else is counted, each worked out once per post."""
    return posts.select(hour_of_day(tz=tz).alias(names.HOUR), fields.has_place().alias("placed"),
                        *(column.alias(name) for name, column in columns.items()))


def hourly_counts(posts: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """Posts without and with a place per hour, every hour. Works on streams."""
    return _hours(posts, tz).groupBy(names.HOUR).agg(
        F.count_if(~F.col("placed")).alias(names.WITHOUT_ADDRESS),
        F.count_if("placed").alias(names.WITH_ADDRESS))


def _on_all_sides(hours: DataFrame, *counts: str) -> DataFrame:
    """What an inner join of the single counts keeps: known hours found in all of them.

    One condition for both: a test of the hour alone would be pushed below the aggregate
    and read the time stamp of every post a second time.
    """
    return hours.filter(F.when(F.col(names.HOUR).isNotNull(), F.least(*counts)) > 0)


def hourly_geo(posts: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """Posts without and with a place, for the hours that have both."""
    hours = _on_all_sides(hourly_counts(posts, tz), names.WITHOUT_ADDRESS, names.WITH_ADDRESS)
    return ranked(hours, names.WITH_ADDRESS, names.HOUR)


def hourly_geo_join(posts: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """``hourly_geo`` as the join of two filtered counts; scans the posts twice."""
    hour = hour_of_day(tz=tz).alias(names.HOUR)
    without = count_by(posts.filter(~fields.has_place()), hour, name=names.WITHOUT_ADDRESS)
    placed = count_by(posts.filter(fields.has_place()), hour, name=names.WITH_ADDRESS)
    return ranked(without.join(placed, names.HOUR), names.WITH_ADDRESS, names.HOUR)


def top_hours(posts: DataFrame, tz: str | None = "UTC", n: int = 20) -> DataFrame:
    """The ``n`` hours with most placed posts."""
    hours = _on_all_sides(hourly_counts(posts, tz), names.WITHOUT_ADDRESS, names.WITH_ADDRESS)
    return top_k(hours, names.WITH_ADDRESS, names.HOUR, n=n)


def positive_counts(posts: DataFrame, tz: str | None = "UTC", ignore_case: bool = False, whole_word: bool = False,
                    words: Iterable[str] = POSITIVE_WORDS, search: Callable[..., Column] = has_keyword) -> DataFrame:
    """Placed posts, and positive posts with and without a place, per hour. Works on streams.

    The options are those of ``has_keyword``, which reads the text of each post once. The search
    is the cost of this report: posts that come in a few splits, such as gzip files, are best dealt out first
    (``spread`` of ``placewise.sources.posts``). ``search`` may be ``has_keyword_in_batches``, which gives the same flags faster.
    """
    return (_hours(posts, tz, positive=search(words=words, ignore_case=ignore_case, whole_word=whole_word))
            .groupBy(names.HOUR).agg(
                F.count_if("placed").alias(names.WITH_ADDRESS),
                F.count_if(F.col("placed") & F.col("positive")).alias(names.POSITIVE_WITH),
                F.count_if(~F.col("placed") & F.col("positive")).alias(names.POSITIVE_WITHOUT)))


def positive_hourly(posts: DataFrame, tz: str | None = "UTC", ignore_case: bool = False, whole_word: bool = False,
                    words: Iterable[str] = POSITIVE_WORDS) -> DataFrame:
    """The same for the hours in which all three counts are above zero."""
    hours = _on_all_sides(positive_counts(posts, tz, ignore_case, whole_word, words),
                          names.WITH_ADDRESS, names.POSITIVE_WITH, names.POSITIVE_WITHOUT)
    return ranked(hours, names.POSITIVE_WITH, names.HOUR)
