"""Is sharing a place a matter of gender?"""

from __future__ import annotations

from pyspark.sql import DataFrame

from placewise import names
from placewise.operators import enriching
from placewise.operators.counting import count_by, count_with_total, share_of_total


def count_records_by_gender(records: DataFrame) -> DataFrame:
    """Rows of a landed gender table per gender. Works on streams."""
    return count_by(records, "gender", name=names.BY_GENDER)


def count_genders_with_total(records: DataFrame) -> DataFrame:
    """The same with the total in a row of its own: the live form of ``record_share``."""
    return count_with_total(records, "gender", names.BY_GENDER)


def record_share(records: DataFrame) -> DataFrame:
    """The same with the share of all rows."""
    return share_of_total(count_records_by_gender(records), names.BY_GENDER, names.RATIO)


def gender_share(posts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Placed posts per gender of their author, straight from the posts."""
    counts = enriching.count_by_gender(posts, lookup, names.BY_GENDER)
    return share_of_total(counts, names.BY_GENDER, names.RATIO)
