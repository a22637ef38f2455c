"""Reading posts and gender records, as tables or as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from placewise.sources.schemas import GENDER_RECORD, post_schema


def _only_posts(df: DataFrame) -> DataFrame:
    # A blank line gives no row; a torn or foreign line gives a row without data.
    return df.filter(F.col("data").isNotNull())


TORN = "_corrupt_record"


def torn_lines(spark: SparkSession, path) -> DataFrame:
    """The lines of a directory of JSON lines that are no posts, as text: torn ones, which ``read_posts`` leaves out.

    Foreign but whole lines are rows with a null.
    """
    schema = T.StructType([*post_schema("data.id"), T.StructField(TORN, T.StringType())])
    return spark.read.schema(schema).json(path).filter(F.col("data").isNull()).select(TORN)


# What the scan of a directory of JSON lines counts when it is asked to.
LINES, NO_POSTS = "lines", "torn"


def _counted(df: DataFrame, observed: Observation | str) -> DataFrame:
    """Counts lines and those that are no posts, as they are read: no second scan."""
    return df.observe(observed, F.count("*").alias(LINES), F.count_if(F.col("data").isNull()).alias(NO_POSTS))


def read_posts(spark: SparkSession, path, *fields: str, format: str = "json", observed: Observation | None = None) -> DataFrame:
    """The posts of one directory (or several) of JSON lines, Parquet or ORC files.

    Lines that are no posts are left out: torn ones, and foreign ones. ``observed`` gets their number, ``torn``, and
    that of all ``lines`` from the scan itself, once a job has read the posts: ``observed.get`` waits for that. A job that
    stops early, such as ``show`` of a feed, has counted what it read. ``torn_lines`` gives the lines themselves.
    """
    df = spark.read.format(format).schema(post_schema(*fields)).load(path)
    return _only_posts(df if observed is None else _counted(df, observed))


def stream_posts(spark: SparkSession, path: str, *fields: str, format: str = "json",
                 max_files: int | None = None, observed: str | None = None) -> DataFrame:
    """The same directory as a stream of newly landed files.

    ``observed`` names the counts of lines that each batch reports; see ``lines_by_batch``.
    """
    reader = spark.readStream.format(format).schema(post_schema(*fields))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.load(path)
    return _only_posts(df if observed is None else _counted(df, observed))


def lines_by_batch(query: StreamingQuery, observed: str) -> list[tuple[int, int, int]]:
    """``(batch, lines, torn)`` of the batches that a query remembers (the last hundred) and that read something."""
    reports = ((p["batchId"], p["observedMetrics"].get(observed)) for p in query.recentProgress if p["numInputRows"])
    return [(number, found[LINES], found[NO_POSTS]) for number, found in reports if found]


def spread(posts: DataFrame, tasks: int | None = None) -> DataFrame:
    """The posts dealt out evenly to ``tasks`` tasks, by default as many as run at once. Works on streams.

    For input in fewer splits than that (a few gzip files, one small table) before a costly expression.
    Select what is needed first: the rows are shuffled.
    """
    return posts.repartition(tasks or posts.sparkSession.sparkContext.defaultParallelism)


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """What the files of a directory hold. Reads all of them: for looking around only."""
    return spark.read.json(path).schema


def read_gender_records(spark: SparkSession, path: str) -> DataFrame:
    """Answers of a name-to-gender service, landed as JSON lines."""
    return spark.read.schema(GENDER_RECORD).json(path)


def stream_gender_records(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(GENDER_RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)
