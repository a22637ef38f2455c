"""Many-to-many joins that withstand heavy keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.session import work_folder

# Counters of the sketch of a side's keys.
COUNTERS = 1 << 26
# Heavy counters that are broadcast, 16 bytes each; more of them are joined as a table.
BROADCAST_COUNTERS = 100_000

_GRID = "_counter long, _rows int, _cols int"


def _counter(key: str, counters: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(counters))


def key_sketch(df: DataFrame, key: str, name: str, counters: int = COUNTERS) -> DataFrame:
    """``_counter`` and how many rows of ``df`` fell on it: one row of a count-min sketch, without the zeros.

    Tasks send what they have counted and sums are merged, so it is never larger than the number of
    ``counters``, whatever the number of keys. What a key's counter shows is its number of rows or more, on
    average by the number of rows divided by ``counters``. Rows with a null key are not counted.
    """
    return df.filter(F.col(key).isNotNull()).groupBy(_counter(key, counters).alias("_counter")).agg(F.count("*").alias(name))


def _heavy(left: DataFrame, right: DataFrame, key: str, cell_pairs: int, counters: int) -> DataFrame:
    """Counters that show more pairs than a cell may have, and the grid of cells they need.

    A grid of ``_rows`` by ``_cols`` has cells of about ``cell_pairs`` pairs, whatever the
    sizes of the two sides and of the tables.
    """
    l, n = F.col("_l").cast("double"), F.col("_n").cast("double")
    counts = (key_sketch(left, key, "_l", counters).join(key_sketch(right, key, "_n", counters), "_counter")
              .filter(l * n > cell_pairs))
    side, all_cells = math.sqrt(cell_pairs), F.ceil(l * n / cell_pairs)

    def parts(own: Column, other: Column) -> Column:
        return F.when(own < side, 1).when(other < side, all_cells).otherwise(F.ceil(own / side)).cast("int")

    return counts.select("_counter", parts(l, n).alias("_rows"), parts(n, l).alias("_cols"))


def _session_partitions(df: DataFrame) -> int:
    """As many partitions as the session wants before adaptive execution shrinks them."""
    conf = df.sparkSession.conf
    return int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))


def spread_join(left: DataFrame, right: DataFrame, key: str, left_row: Column, right_row: Column,
                cell_pairs: int = 1_000_000, partitions: int | None = None, counters: int = COUNTERS) -> DataFrame:
    """Inner equi-join on ``key`` in which no task makes all pairs of a heavy key. Not for streams.

    Each side is read twice. The first time a sketch of its keys is taken: a key is heavy if the
    product of what its counters show on both sides exceeds ``cell_pairs``. The sketch never shows too little, so no heavy key is
    missed; a light key on the counter of a heavy one is spread with it, which costs copies and
    changes no row. This runs a job before the join is returned.

    If nothing is heavy, the join is the plain one. Else the rows of heavy keys are cut into a grid of cells
    and each cell is joined by itself; the result is that of the plain join. A heavy row is sent at
    most the output of its counter divided by the square root of ``cell_pairs`` times.
    ``left_row`` and ``right_row`` tell rows apart; a hash of them picks the cell, so that
    a task that is run again repeats its work exactly. Column order: key, left, right.

    The cells go to a fixed number of ``partitions`` (by default the session's initial
    number): left alone, adaptive execution would judge cells by their small input and
    put many into one task, where their products pile up.
    """
    spark = left.sparkSession
    left = left.filter(F.col(key).isNotNull())
    right = right.filter(F.col(key).isNotNull())
    folder = f"{work_folder(spark, 'heavy')}/counters"
    _heavy(left, right, key, cell_pairs, counters).write.parquet(folder)
    heavy = spark.read.schema(_GRID).parquet(folder)
    number = heavy.count()
    if not number:
        return left.join(right, key)
    heavy = F.broadcast(heavy) if number <= BROADCAST_COUNTERS else heavy

    def cells(df: DataFrame, row: Column, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        cut = F.coalesce(F.col(own), F.lit(1))
        copies = F.coalesce(F.col(other), F.lit(1))
        return (df.withColumn("_row", F.xxhash64(row)).withColumn("_counter", _counter(key, counters)).join(heavy, "_counter", "left")
                .withColumn(names[0], F.pmod(F.col("_row"), cut).cast("int"))
                .withColumn(names[1], F.explode(F.sequence(F.lit(0), copies - 1)))
                .drop("_row", "_rows", "_cols", "_counter"))

    on = [key, "_r", "_c"]
    partitions = partitions or _session_partitions(left)
    return (cells(left, left_row, "_rows", "_cols", ("_r", "_c")).repartition(partitions, *on)
            .join(cells(right, right_row, "_cols", "_rows", ("_c", "_r")).repartition(partitions, *on), on).drop("_r", "_c"))


def count_pairs(left: DataFrame, right: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Pairs per key and distinct values of the many-to-many join, without making the pairs.

    Equal rows are counted on each side first; joined counts multiply. The distinct rows of
    one key on both sides meet in one task.
    """
    l = left.groupBy(*left.columns).agg(F.count("*").alias("_l"))
    r = right.groupBy(*right.columns).agg(F.count("*").alias("_r"))
    return l.join(r, key).withColumn(name, F.col("_l") * F.col("_r")).drop("_l", "_r")
