"""Fields of a post and the null rules that define every count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = "includes.places"
USERS = "includes.users"


def has_place() -> Column:
    """The post carries a list of places, even an empty one."""
    return F.col(PLACES).isNotNull()


def place_name() -> Column:
    """Full name of the first place; null for an empty list."""
    return F.get(F.col(PLACES), F.lit(0))["full_name"]


def user_field(name: str) -> Column:
    """A field of the first user; null without users."""
    return F.get(F.col(USERS), F.lit(0))[name]


def user_locations() -> Column:
    """Profile locations of all users of the post, as an array."""
    return F.col(f"{USERS}.location")


def has_profile_location(strict: bool = False) -> Column:
    """The post carries users; ``strict`` asks for a user who states a location.

    A user without a location gives ``[null]``, which is a list and so passes by default.
    """
    if strict:
        return F.coalesce(F.exists(user_locations(), lambda x: x.isNotNull()), F.lit(False))
    return user_locations().isNotNull()
