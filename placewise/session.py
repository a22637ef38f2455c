"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Settings the reports are tuned for. On a cluster pass them to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Location and handle counts keep one state row per value: off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; keyword settings use ``__`` for the dots."""
    builder = SparkSession.builder.appName("placewise")
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def on_one_machine(path: str) -> bool:
    return path.startswith(("file:", "/")) or ":" not in path


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for tables and stream checkpoints, on storage all executors see.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Where it is unset, the
    warehouse folder serves if the master is local, as in tests, or if the warehouse is no
    folder of one machine; else this raises ValueError. The path is removed when the session ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if on_one_machine(base) and not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share: {base} is a folder of one machine")
    folder = f"{base.rstrip('/')}/placewise/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{folder}/data"
