"""Where live reports go: files, a table that is replaced by every batch, the console.

All sinks are started with a checkpoint and go on where they stopped. With
``available_now`` a query handles what has landed, in batches, and ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


# Counts over a handful of keys, such as hours, devices or genders, need no more state
# partitions than this; each partition writes files in every batch.
FEW_KEYS = 8

# Batches per part of the log of ``replace_table``, of which two are kept.
LOG_LENGTH = 100


@contextmanager
def _state_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """A stream takes over the session's shuffle partitions when it starts."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        if number:
            spark.conf.set(key, number)
        yield
    finally:
        spark.conf.set(key, before)


def _start(writer: DataStreamWriter, checkpoint: str | None, available_now: bool,
           every: str | None) -> StreamingQuery:
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def append_files(df: DataFrame, out: str, checkpoint: str, format: str = "parquet",
                 available_now: bool = True, every: str | None = None) -> StreamingQuery:
    """Add the rows of a stateless stream to a directory, exactly once."""
    writer = df.writeStream.outputMode("append").format(format).option("path", out)
    return _start(writer, checkpoint, available_now, every)


def replace_table(df: DataFrame, out: str, checkpoint: str,
                  state_partitions: int | None = None, available_now: bool = True, every: str | None = None) -> StreamingQuery:
    """Keep the full result of a running aggregate as a table; read it with ``latest``.

    Batches take turns between two folders and a batch counts once its number is in the
    log, so readers always find a finished table and storage stays bounded. A batch that
    is run again writes the same folder again.

    The number of ``state_partitions`` is the session's shuffle partitions by default;
    it is fixed by the first run of a checkpoint.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{out}/turn={number % 2}/table")
        _log(spark, out, number)

    writer = df.writeStream.outputMode("complete").foreachBatch(write)
    with _state_partitions(df.sparkSession, state_partitions):
        return _start(writer, checkpoint, available_now, every)


def _log(spark: SparkSession, out: str, number: int) -> None:
    """Note a finished batch. A part of the log is begun anew when its turn comes again."""
    mode = "append" if number % LOG_LENGTH else "overwrite"
    row = spark.range(0, 1, 1, 1).select(F.lit(number).cast("long").alias("batch"))
    row.write.mode(mode).parquet(f"{out}/log/part={number // LOG_LENGTH % 2}")


def last_batch(spark: SparkSession, out: str) -> int:
    """The number of the last finished batch in the log; -1 before there is any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/log")
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return -1
    number = spark.read.schema("batch long").parquet(f"{out}/log").agg(F.max("batch")).first()[0]
    return -1 if number is None else number


def land_batch(batch: DataFrame, number: int, out: str, make: Callable[[DataFrame, int], DataFrame], format: str = "json") -> None:
    """Land ``make(batch, number)`` in a folder of the batch. What the log has is not landed again, and what
    a batch left that did not get as far is replaced."""
    spark = batch.sparkSession
    if number <= last_batch(spark, out):
        return
    make(batch, number).write.mode("overwrite").format(format).save(f"{out}/rows/batch={number}")
    _log(spark, out, number)


def land_batches(df: DataFrame, out: str, checkpoint: str, make: Callable[[DataFrame, int], DataFrame], format: str = "json",
                 available_now: bool = True, every: str | None = None) -> StreamingQuery:
    """Land what ``make`` makes of each batch of a stream, once; read it with ``landed_batches``.

    ``make`` is called for every batch, so tables it reads are listed and read anew: that is the difference
    to ``append_files``, for which a joined table is listed when the query starts.
    """
    writer = df.writeStream.foreachBatch(lambda batch, number: land_batch(batch, number, out, make, format))
    return _start(writer, checkpoint, available_now, every)


def landed_batches(spark: SparkSession, out: str, schema: T.StructType | str, format: str = "json") -> DataFrame:
    """The rows of all finished batches, with the number of their ``batch``."""
    rows = spark.read.schema(schema).format(format).load(f"{out}/rows/batch=*", basePath=f"{out}/rows")
    return rows.filter(F.col("batch") <= last_batch(spark, out))


def latest(spark: SparkSession, out: str, schema: T.StructType | str) -> DataFrame:
    """The table that the last finished batch of ``replace_table`` left.

    It stays as it is until the batch after next begins.
    """
    number = spark.read.schema("batch long").parquet(f"{out}/log").agg(F.max("batch")).first()[0]
    return spark.read.schema(schema).parquet(f"{out}/turn={number % 2}/table")


def to_console(df: DataFrame, mode: str, checkpoint: str | None = None, truncate: bool = False,
               available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """Print each batch: ``append`` for feeds, ``complete`` for counts."""
    writer = df.writeStream.outputMode(mode).format("console").option("truncate", truncate)
    return _start(writer, checkpoint, available_now, every)
