"""Where authors say they are, against where their posts are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise import names
from placewise.functions import fields
from placewise.functions.places import name_words, names_agree, word_runs
from placewise.operators.counting import count_by, ranked
from placewise.operators.joining import count_pairs, spread_join


def count_by_location(posts: DataFrame, each_user: bool = False) -> DataFrame:
    """Posts per list of profile locations. Works on streams.

    No users, a user without a location and a user with one are three kinds of key.
    ``each_user`` counts single locations instead, one per user of the post.
    """
    location = F.explode_outer(fields.user_locations()) if each_user else fields.user_locations()
    located = posts.select(location.alias(names.LOCATION))
    return count_by(located, names.LOCATION, name=names.BY_LOCATION)


def by_location(posts: DataFrame, each_user: bool = False) -> DataFrame:
    """The same, most frequent first."""
    return ranked(count_by_location(posts, each_user), names.BY_LOCATION, names.LOCATION)


def place_vs_profile(placed: DataFrame, profiled: DataFrame, strict: bool = False,
                     spread: bool = True, as_json: bool = False, **limits: int) -> DataFrame:
    """Every placed post of an author with every post that shows the author's profile location.

    Columns ``ID, Created, Location_Per_Tweet, Tweet_Content, Location_Per_User``. The
    result holds the product of both sides for each author, so heavy authors are spread
    over many tasks; ``limits`` are those of ``spread_join``. ``as_json`` gives both lists as
    JSON text, written once per post before the join rather than once per row after it.
    """
    def listed(column: Column) -> Column:
        return F.to_json(column) if as_json else column

    t1 = placed.filter(fields.has_place()).select(
        F.col("data.author_id").alias(names.ID), F.col("data.created_at").alias(names.CREATED),
        listed(F.col(fields.PLACES)).alias(names.POST_LOCATION), F.col("data.id").alias("post1"))
    t2 = profiled.filter(fields.has_profile_location(strict)).select(
        F.col("data.author_id").alias(names.ID), F.col("data.text").alias(names.POST_TEXT),
        listed(fields.user_locations()).alias(names.USER_LOCATION), F.col("data.id").alias("post2"))
    if spread:
        joined = spread_join(t1, t2, names.ID, F.col("post1"), F.col("post2"), **limits)
    else:
        joined = t1.join(t2, names.ID, "inner")
    return joined.select(names.ID, names.CREATED, names.POST_LOCATION, names.POST_TEXT, names.USER_LOCATION)


def _author_pairs(placed: DataFrame, profiled: DataFrame, strict: bool) -> DataFrame:
    t1 = placed.filter(fields.has_place()).select(
        F.col("data.author_id").alias("author_id"), fields.place_name().alias("place"))
    t2 = profiled.filter(fields.has_profile_location(strict)).select(
        F.col("data.author_id").alias("author_id"), fields.user_field("location").alias("location"))
    return count_pairs(t1, t2, "author_id")


def place_vs_profile_counts(placed: DataFrame, profiled: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of ``place_vs_profile`` per first place and first location, without making them."""
    return (_author_pairs(placed, profiled, strict)
            .groupBy("place", "location").agg(F.sum("n").alias("n")))


def location_match(placed: DataFrame, profiled: DataFrame) -> DataFrame:
    """How often the place of a post agrees with the profile location, per author.

    Over the rows of ``place_vs_profile`` with both names known: ``pairs``, those where
    the names are equal, those where the place holds the location, and their rate.
    Case does not count.
    """
    place, location = F.lower("place"), F.lower("location")
    pairs = _author_pairs(placed, profiled, True).filter(
        F.col("place").isNotNull() & F.col("location").isNotNull())

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return (pairs.groupBy("author_id")
            .agg(F.sum("n").alias("pairs"), total(place == location).alias("equal"),
                 total(F.contains(place, location)).alias("holding"))
            .withColumn("rate", F.col("holding") / F.col("pairs")))


def location_agreement(placed: DataFrame, profiled: DataFrame) -> DataFrame:
    """``location_match`` with names that differ in a few letters: ``pairs``, ``equal``, ``holding``, ``near`` and the rate of these.

    Places and locations meet through their authors only, each two names once; ``near`` are those that
    ``names_agree`` finds to be one name.
    """
    pairs = _author_pairs(placed, profiled, True).filter(F.col("place").isNotNull() & F.col("location").isNotNull())
    place, location = F.lower("place"), F.lower("location")

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return (pairs.groupBy("author_id")
            .agg(F.sum("n").alias("pairs"), total(place == location).alias("equal"), total(F.contains(place, location)).alias("holding"),
                 total(names_agree("place", "location")).alias("near"))
            .withColumn("rate", F.col("near") / F.col("pairs")))


def regions_of(locations: DataFrame, regions: DataFrame) -> DataFrame:
    """``location, named, attribute``: the region that a location in free text names, if it names one.

    ``locations`` has a column ``location`` of distinct texts, ``regions`` is that of ``share_by_region``. The runs of
    words of a text are compared with the words of the names, so "Austin, TX" is found by "austin" and by "Austin TX" but not
    by "Aust". Of several names the one of most words counts, then of most letters, then the first in
    the text; a name of several attributes has the smallest. The longest name says how long runs are.
    """
    names_ = (regions.select(F.array_join(name_words("location"), " ").alias("run"), "attribute", F.size(name_words("location")).alias("words"))
              .filter("run != ''").groupBy("run").agg(F.min("attribute").alias("attribute"), F.first("words").alias("words")))
    longest = names_.agg(F.max("words")).first()[0] or 1
    runs = locations.select("location", F.explode(word_runs(name_words("location"), longest)).alias("r")).select("location", "r.*")
    found = runs.join(names_, "run").groupBy("location").agg(
        F.min(F.struct((-F.col("size")).alias("size"), (-F.length("run")).alias("length"), "start", "run", "attribute")).alias("best"))
    return found.select("location", F.col("best.run").alias("named"), F.col("best.attribute").alias("attribute"))


def share_by_named_region(posts: DataFrame, regions: DataFrame) -> DataFrame:
    """``share_by_region`` for locations in free text: those that name a region belong to it, see ``regions_of``.

    Posts are counted per location first, and each location is searched once. Posts whose author names no region
    are the group with a null attribute.
    """
    counts = (posts.select(fields.user_field("location").alias("location"), fields.has_place().alias("placed"))
              .groupBy("location")
              .agg(F.count_if("placed").alias("placed"), F.count("*").alias("posts")))
    named = regions_of(counts.select("location").filter(F.col("location").isNotNull()), regions)
    return (counts.join(named, "location", "left")
            .groupBy("attribute").agg(F.sum("placed").alias("placed"), F.sum("posts").alias("posts"))
            .withColumn("share", F.col("placed") / F.col("posts")))


def share_by_region(posts: DataFrame, regions: DataFrame) -> DataFrame:
    """Share of placed posts per attribute of the region the author names.

    ``regions`` has one row ``location, attribute`` per location. Posts are counted per
    location first; only these counts meet the regions. Posts whose author names no
    location, or one without a region, are the group with a null attribute.
    """
    counts = (posts.select(fields.user_field("location").alias("location"), fields.has_place().alias("placed"))
              .groupBy("location")
              .agg(F.count_if("placed").alias("placed"), F.count("*").alias("posts")))
    return (counts.join(regions, "location", "left")
            .groupBy("attribute").agg(F.sum("placed").alias("placed"), F.sum("posts").alias("posts"))
            .withColumn("share", F.col("placed") / F.col("posts")))
