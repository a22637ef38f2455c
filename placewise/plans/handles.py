"""Which users are addressed most?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.functions.handles import all_handles, last_handle
from placewise.operators.counting import count_by, ranked


def count_handles(posts: DataFrame, every: bool = False) -> DataFrame:
    """Posts per last handle, or occurrences of ``every`` handle. Works on streams."""
    handle = F.explode(all_handles()) if every else last_handle()
    found = posts.select(handle.alias("value")).filter(F.col("value").isNotNull())
    return count_by(found, "value")


def top_handles(posts: DataFrame, every: bool = False) -> DataFrame:
    """The same, most frequent first."""
    return ranked(count_handles(posts, every), "count", "value")
