"""Connected components of an edge table that is larger than any one machine.

Rounds of large-star and small-star: every node learns the smallest of its neighbours and
hands it on, until each component is a star around its smallest node. A round is written
to the shared folder, so that a lost executor costs no more than a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.session import work_folder


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    pairs = edges.join(least, "a")
    own = least.select("a", F.col("least").alias("b"))
    return pairs.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for each node of the edges ``a, b`` (long): the smallest node it is linked to.

    Edges may repeat and point either way; an edge of a node to itself and edges with a
    null are left out. An empty table gives an empty one.
    """
    spark = edges.sparkSession
    folder = work_folder(spark, "components")

    def written(df: DataFrame, number: int) -> tuple[DataFrame, tuple]:
        df.write.parquet(f"{folder}/{number}")
        df = spark.read.schema("a long, b long").parquet(f"{folder}/{number}")
        return df, tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, state = written(current, 0)
    number, before = 0, None
    while state != before and state[0]:
        number, before = number + 1, state
        current, state = written(_small_star(_large_star(current)), number)
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
