"""Grouped counts, shares of a total, and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: Column | str, name: str = "count") -> DataFrame:
    """Rows per key, null being a key too. Works on streams.

    Counts are combined before the shuffle, so a key that holds a third of all rows
    costs one row per task.
    """
    return df.groupBy(*keys).agg(F.count("*").alias(name))


# Marks the row of ``count_with_total`` that is no group's.
TOTAL = "is_total"


def count_with_total(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """``count_by`` of one column with the count of all rows in a row of its own, which ``is_total`` marks. Works on streams.

    One aggregate over two grouping sets, so that a running share needs no second look at a batch:
    ``with_shares`` divides when the kept table is read. A null key is a group, not the total.
    """
    counts = df.select(key).groupingSets([[key], []], key)
    return counts.agg(F.count("*").alias(name), (F.grouping_id() > 0).alias(TOTAL))


def with_shares(counts: DataFrame, count: str, name: str = "ratio") -> DataFrame:
    """The groups of a table of ``count_with_total``, with each one's share of the total. Not for streams."""
    total = counts.filter(TOTAL).select(count).scalar()
    return counts.filter(~F.col(TOTAL)).drop(TOTAL).withColumn(name, F.try_divide(F.col(count), total))


def share_of_total(counts: DataFrame, count: str, name: str = "ratio") -> DataFrame:
    """Adds each group's share of the sum of ``count``. Not for streams.

    The total is a scalar subquery over the same aggregate, whose shuffle is reused.
    A window without keys would move all groups into one task.
    """
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(name, F.try_divide(F.col(count), total))


def ranked(counts: DataFrame, count: str, *ties: str) -> DataFrame:
    """Highest count first; ``ties`` settle equal counts."""
    return counts.orderBy(F.desc(count), *ties)


def top_k(counts: DataFrame, count: str, *ties: str, n: int = 20) -> DataFrame:
    """The ``n`` highest counts: each task keeps its own best ``n``, no full sort."""
    return ranked(counts, count, *ties).limit(n)
