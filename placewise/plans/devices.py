"""Is sharing a place a matter of the device?"""

from __future__ import annotations

from pyspark.sql import DataFrame

from placewise import names
from placewise.functions import fields
from placewise.operators.counting import count_by, count_with_total, share_of_total


def count_by_device(posts: DataFrame) -> DataFrame:
    """Placed posts per source. Works on streams."""
    return count_by(posts.filter(fields.has_place()), "data.source", name=names.BY_DEVICE)


def count_devices_with_total(posts: DataFrame) -> DataFrame:
    """The same with the total in a row of its own: the live form of ``device_share``."""
    return count_with_total(posts.filter(fields.has_place()).select("data.source"), "source", names.BY_DEVICE)


def device_share(posts: DataFrame) -> DataFrame:
    """Placed posts per source, and the share of all placed posts."""
    return share_of_total(count_by_device(posts), names.BY_DEVICE, names.RATIO)
