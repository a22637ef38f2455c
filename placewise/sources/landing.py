"""Landing a feed as files of bounded size.

Readers of a landing directory must only ever see finished files. Spark's commit
protocol gives that: files appear under their final name when the job commits, and a
streaming sink lists them in its log.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

# Fixed value: lines per landed file.
ROWS_PER_FILE = 1000

# For whole texts: Spark reads and writes it without native libraries.
COMPRESSION = "gzip"
# Fixed value: the level of gzip and deflate. The default one takes five times as long for a tenth less.
_LEVEL, _FASTEST = "zlib.compress.level", "BEST_SPEED"


@contextmanager
def _fastest(spark: SparkSession) -> Iterator[None]:
    """A stream's file sink takes the level over from the session when it starts, not from its options."""
    before = spark.conf.get(_LEVEL, None)
    spark.conf.set(_LEVEL, _FASTEST)
    try:
        yield
    finally:
        spark.conf.unset(_LEVEL) if before is None else spark.conf.set(_LEVEL, before)


def land_posts(df: DataFrame, out: str, rows_per_file: int = ROWS_PER_FILE, format: str = "json",
               mode: str = "append", partition_by: tuple[str, ...] = (), compression: str | None = None) -> None:
    """Write posts as files of at most ``rows_per_file`` rows, without a shuffle.

    ``format="text"`` lands a one-column table of raw lines. Use a much larger
    ``rows_per_file`` for big feeds: small files cost every later scan. ``compression``
    is the format's own by default (none for JSON lines and text). Readers tell it by the file
    name; one task reads a whole gzip file, so keep ``rows_per_file`` bounded.
    """
    writer = df.write.format(format).mode(mode).option("maxRecordsPerFile", rows_per_file)
    if compression:
        writer = writer.option("compression", compression).option(_LEVEL, _FASTEST)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(out)


def land_stream(df: DataFrame, out: str, checkpoint: str, rows_per_file: int = ROWS_PER_FILE,
                format: str = "json", partition_by: tuple[str, ...] = (),
                available_now: bool = True, compression: str | None = None) -> StreamingQuery:
    """The same for a stream; exactly once through the sink's log and ``checkpoint``."""
    writer = (df.writeStream.format(format).outputMode("append")
              .option("maxRecordsPerFile", rows_per_file)
              .option("checkpointLocation", checkpoint)
              .option("path", out))
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with _fastest(df.sparkSession) if compression else nullcontext():
        return writer.start()
