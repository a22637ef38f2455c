"""Which report needs which fields of a post, and how it runs over landing directories."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise import names
from placewise.operators.counting import ranked, with_shares
from placewise.operators.enriching import enrich_gender
from placewise.functions import fields
from placewise.functions.handles import last_handle
from placewise.plans import devices, feeds, genders, handles, hours, locations
from placewise.streaming.sinks import FEW_KEYS

PLACES = "includes.places"
LOCATIONS = "includes.users.location"


@dataclass(frozen=True)
class Job:
    """A report and its live form.

    ``live`` gives rows to append, or a running count whose full result is kept. A count
    may then be given shares of the total (``ratio``, which streams cannot work out) or an
    order (``rank``), as it is read: files have none. ``options``
    are those of both forms, ``window`` is what is counted by time windows.
    """

    fields: tuple[str, ...]
    batch: Callable[..., DataFrame]
    live: Callable[..., DataFrame] | None = None
    reads: str = "posts"  # or records: landed answers of a name service
    needs: tuple[str, ...] = ()  # further inputs: profiles, lookup, regions
    zoned: bool = False  # takes a time zone
    appends: str | None = None  # file format of appended rows
    ratio: str | None = None
    rank: tuple[str, ...] = ()
    state_partitions: int | None = None
    options: tuple[str, ...] = ()
    window: Callable[[], Column] | None = None

    def ordered(self, counts: DataFrame) -> DataFrame:
        """The kept table as the report has it."""
        if self.ratio:
            return with_shares(counts, self.ratio, names.RATIO)
        return ranked(counts, *self.rank) if self.rank else counts


def _feed(function: Callable[..., DataFrame], *fields: str) -> Job:
    return Job(fields, function, function, appends="parquet")


JOBS: dict[str, Job] = {
    "place_text": _feed(feeds.place_text, "data.text", PLACES),
    "text_feed": _feed(feeds.text_feed, "data.text"),
    "geo_feed": _feed(feeds.geo_feed, "data.author_id", "data.created_at", PLACES),
    "author_feed": _feed(feeds.author_feed, "data.text", "data.author_id", "includes.users.name", LOCATIONS),
    "device_share": Job(("data.source", PLACES), devices.device_share, devices.count_devices_with_total,
                        ratio=names.BY_DEVICE, state_partitions=FEW_KEYS, window=lambda: F.col("data.source")),
    "enriched_genders": Job((PLACES, "includes.users.username"), enrich_gender, enrich_gender,
                            needs=("lookup",), appends="json"),
    "record_share": Job((), genders.record_share, genders.count_genders_with_total, reads="records",
                        ratio=names.BY_GENDER, state_partitions=FEW_KEYS),
    "gender_share": Job((PLACES, "includes.users.username"), genders.gender_share, needs=("lookup",)),
    "hourly_geo": Job(("data.created_at", PLACES), hours.hourly_geo, hours.hourly_counts, zoned=True,
                      rank=(names.WITH_ADDRESS, names.HOUR), state_partitions=FEW_KEYS),
    "top_hours": Job(("data.created_at", PLACES), hours.top_hours, zoned=True),
    "positive_hourly": Job(("data.text", "data.created_at", PLACES), hours.positive_hourly, hours.positive_counts,
                           zoned=True, rank=(names.POSITIVE_WITH, names.HOUR), state_partitions=FEW_KEYS,
                           options=("ignore_case", "whole_word")),
    "by_location": Job((LOCATIONS,), locations.by_location, locations.count_by_location,
                       rank=(names.BY_LOCATION, names.LOCATION), options=("each_user",),
                       window=lambda: fields.user_locations().alias(names.LOCATION)),
    "top_handles": Job(("data.text",), handles.top_handles, handles.count_handles, rank=("count", "value"), options=("every_handle",),
                       window=lambda: last_handle().alias("value")),
    "place_vs_profile": Job(("data.text", "data.author_id", "data.created_at", PLACES, LOCATIONS),
                            locations.place_vs_profile, needs=("profiles",), options=("strict",)),
    "place_vs_profile_counts": Job(("data.author_id", PLACES, LOCATIONS),
                                   locations.place_vs_profile_counts, needs=("profiles",), options=("strict",)),
    "location_match": Job(("data.author_id", PLACES, LOCATIONS), locations.location_match, needs=("profiles",)),
    "location_agreement": Job(("data.author_id", PLACES, LOCATIONS), locations.location_agreement, needs=("profiles",)),
    "share_by_named_region": Job((PLACES, LOCATIONS), locations.share_by_named_region, needs=("regions",)),
    "share_by_region": Job((PLACES, LOCATIONS), locations.share_by_region, needs=("regions",)),
}
