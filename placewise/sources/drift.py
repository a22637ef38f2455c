"""Do landed files still hold what their schema declares?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from placewise.session import work_folder
from placewise.sources.schemas import POST

# Lines that are looked at.
SAMPLE_LINES = 10_000


def paths(kind: T.DataType, path: str = "") -> dict[str, str]:
    """Every field by its path and the type it has there; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        return {p: t for f in kind for p, t in paths(f.dataType, f"{path}.{f.name}" if path else f.name).items()}
    if isinstance(kind, T.ArrayType):
        return paths(kind.elementType, f"{path}[]")
    return {path: kind.simpleString()}


def sampled_schema(spark: SparkSession, path: str, lines: int = SAMPLE_LINES) -> T.StructType:
    """What the first ``lines`` lines of a directory of JSON lines hold; torn lines hold nothing.

    Only these lines are read and kept, in the work folder, so the cost does not grow with the directory.
    """
    sample = work_folder(spark, "sample")
    spark.read.text(path).limit(lines).write.text(sample)
    found = spark.read.json(sample).schema
    return T.StructType([f for f in found if f.name != "_corrupt_record"])


def schema_drift(spark: SparkSession, path: str, declared: T.StructType = POST, lines: int = SAMPLE_LINES) -> DataFrame:
    """``path, declared, found, drift``: fields that differ between files and schema.

    ``drift`` is ``unknown`` (in the files alone: never read), ``missing`` (declared alone: null in every
    post, or not in the sample) or ``retyped``. A branch that is absent is missing field by field. No rows: no drift.
    """
    want, have = paths(declared), paths(sampled_schema(spark, path, lines))
    rows = [(p, want.get(p), have.get(p), "unknown" if p not in want else "missing" if p not in have else "retyped")
            for p in sorted(want.keys() | have.keys()) if want.get(p) != have.get(p)]
    return spark.createDataFrame(rows, "path string, declared string, found string, drift string")
