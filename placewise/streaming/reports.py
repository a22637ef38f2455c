"""The reports that differ from their batch form when live.

Feeds and counts are the functions of ``placewise.plans`` applied to a stream. Here are
the enrichment beside a stream, ratios of a live count, and counts with bounded state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placewise import names
from placewise.operators.counting import TOTAL, with_shares
from placewise.operators.enriching import enrich_gender
from placewise.plans.devices import count_devices_with_total
from placewise.plans.genders import count_genders_with_total
from placewise.streaming.sinks import FEW_KEYS, append_files, land_batches, latest, replace_table


def land_genders(posts: DataFrame, lookup: DataFrame, out: str, checkpoint: str,
                 available_now: bool = True, every: str | None = None) -> StreamingQuery:
    """Land the gender of each placed post of a stream as JSON lines, one row per post.

    Read ``posts`` with ``max_files=1`` to get the answers for one landed file per batch.
    """
    return append_files(enrich_gender(posts, lookup), out, checkpoint, "json", available_now, every)


def land_fresh_genders(posts: DataFrame, lookup: Callable[[SparkSession], DataFrame], out: str, checkpoint: str,
                       available_now: bool = True, every: str | None = None) -> StreamingQuery:
    """The same with the names that are known when a batch begins; read it with ``landed_batches``.

    ``lookup`` gives the table of names and is called for every batch: names that landed since the last one are found
    without a restart. Rows that have landed stay as they are.
    """
    return land_batches(posts, out, checkpoint, lambda batch, _: enrich_gender(batch, lookup(batch.sparkSession)), "json", available_now, every)


def live_device_share(posts: DataFrame, out: str, checkpoint: str, **run) -> StreamingQuery:
    """``device_share`` kept up to date: counts and their total, each batch written once. Read it with ``latest_shares``."""
    return replace_table(count_devices_with_total(posts), out, checkpoint, FEW_KEYS, **run)


def live_record_share(records: DataFrame, out: str, checkpoint: str, **run) -> StreamingQuery:
    """``record_share`` kept up to date in the same way."""
    return replace_table(count_genders_with_total(records), out, checkpoint, FEW_KEYS, **run)


def latest_shares(spark: SparkSession, out: str, key: str, count: str) -> DataFrame:
    """The counts that the last finished batch left, with each one's share of their total."""
    return with_shares(latest(spark, out, f"{key} string, {count} bigint, {TOTAL} boolean"), count, names.RATIO)


def windowed_count(posts: DataFrame, key: Column, watermark: str, window: str, name: str = "count") -> DataFrame:
    """Posts per ``key`` and time window, with state dropped behind the watermark.

    Posts with an unreadable time belong to no window and are left out. An extension for jobs that run for long over keys without bound, such as locations
    and handles. Closed windows come out in append mode, so ``append_files`` takes them.
    The state has a row for each key of the open windows: ``windowed_top`` bounds that too.
    """
    return _by_window(posts, watermark, window, key).agg(F.count("*").alias(name))


def _by_window(posts: DataFrame, watermark: str, window: str, *keys: Column) -> GroupedData:
    return (posts.withColumn("moment", F.try_to_timestamp("data.created_at"))
            .withWatermark("moment", watermark)
            .groupBy(F.window("moment", window).alias("window"), *keys))


# Values a window keeps by default, and the most that a summary may keep.
ITEMS, MOST_ITEMS = 10_000, 1_000_000


def windowed_top(posts: DataFrame, key: Column, watermark: str, window: str, k: int = 20, items: int = ITEMS,
                 value: str = "value", name: str = "count") -> DataFrame:
    """The ``k`` most frequent values of each time window, from a summary of at most ``items`` values.

    The state of an open window is one summary, however many posts and values there are. Tasks make
    summaries of their own, which are merged, so a frequent value costs a row per task. Columns
    ``window, rank``, the value, its estimated count, ``posts`` (those of the window that have a value) and
    ``error``: an estimate is never too low, and too high by ``error`` at most. A value whose place among the ``k``
    the summary can't vouch for is left out, so there may be fewer: keep some times more ``items`` than ``k``. With no
    more values than ``items`` in a window counts and ranks are exact; equal counts are ranked by value. A null
    is no value. Works on tables and, in append mode, on streams.

    Where an exact ranking is needed: ``windowed_count``, then ``top_of_windows`` over what it appended.
    """
    if not 0 < k <= items <= MOST_ITEMS:
        raise ValueError(f"0 < k <= items <= {MOST_ITEMS}")
    found = posts.withColumn("_value", key.cast("string")).filter(F.col("_value").isNotNull())
    tops = _by_window(found, watermark, window).agg(F.expr(f"approx_top_k(_value, {items}, {items})").alias("_top"), F.count("*").alias("posts"))
    # All that is kept, as the function breaks ties at random.
    ordered = F.slice(F.array_sort(F.transform("_top", lambda x: F.struct((-x["count"]).alias("less"), x["item"].alias("item")))), 1, k)
    # The summary has 4 / 3 as many places as items, up to the next power of two, and errs by 3.5 posts in as many.
    places = 1 << max(3, (items * 4 // 3 - 1).bit_length())
    return (tops.select("window", "posts", F.posexplode(ordered).alias("_place", "_x"))
            .select("window", (F.col("_place") + 1).alias("rank"), F.col("_x.item").alias(value), (-F.col("_x.less")).alias(name), "posts",
                    F.floor(F.col("posts") * 3.5 / places).cast("long").alias("error")))


def top_of_windows(counts: DataFrame, k: int = 20, value: str = "value", name: str = "count") -> DataFrame:
    """The ``k`` most frequent values of each window of ``windowed_count``, exactly, with their ``rank``. Not for streams.

    Tasks drop what can't be among the ``k`` before the shuffle.
    """
    order = Window.partitionBy("window").orderBy(F.desc(name), value)
    return counts.filter(F.col(value).isNotNull()).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
