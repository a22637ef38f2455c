"""Token ids as length-delimited binary records, with an index for shuffled reads.

A data file is a row of records, each of four parts, all little-endian: the length of the
body (8 bytes), the masked CRC-32 of these 8 bytes (4), the body, and the masked CRC-32 of
the body (4). A body says whether the document has an id (1 byte), gives the id (8 bytes)
and its token ids, of 2 bytes each if the vocabulary allows it, else of 4. Beside each data
file lies its index: for each record the byte at which it starts and the number of ids
before it in the file, 8 bytes each. ``index.json`` names the files in order with their
totals.

Files are written by Spark tasks under names of their own, and only ``index.json``, which
is written when all tasks are done, makes them part of the data set: what a lost or
repeated task leaves behind is never read. A further write to the same path puts its files
after those that are there.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from placewise.llm.segments import SLICE_BYTES, Encoder
from placewise.llm.texts import arrow_map, id_and_text, slices
from placewise.llm.token_counts import binaries
from placewise.session import work_folder

FORMAT = "token_records"
# Fixed value: what is added to a turned checksum, as record files commonly do it.
MASK = 0xA282EAD8
HEAD = struct.Struct("<?q")
READ_BYTES = 8 << 20
# Bytes of text that a file holds at most, but for its last row, and what a row counts beside its text.
FILE_BYTES, ROW_BYTES = 64 << 20, 64
# From this many files on, files grow instead: the driver keeps a number for each.
MOST_FILES = 100_000
# Where files can lie; names that mean the same store are read as the second.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def masked(data: bytes) -> int:
    """CRC-32, turned by 15 bits and shifted, so that a checksum of checksums stays sound."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def framed(body: bytes) -> bytes:
    head = struct.pack("<Q", len(body))
    return b"".join((head, struct.pack("<I", masked(head)), body, struct.pack("<I", masked(body))))


def unframed(read, name: str) -> Iterator[bytes]:
    """The bodies that ``read(n)`` gives until it ends. Raises ValueError for a damaged record."""
    while head := read(12):
        if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
            raise ValueError(f"{name}: damaged length of a record")
        size = struct.unpack("<Q", head[:8])[0]
        body, check = read(size), read(4)
        if len(body) < size or len(check) < 4 or struct.unpack("<I", check)[0] != masked(body):
            raise ValueError(f"{name}: damaged record")
        yield body


def store(path: str):
    """The file system of ``path`` and the path in it. Raises ValueError for a store that isn't in SCHEMES."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if "/" in scheme or not colon:
        return fs.FileSystem.from_uri(f"file://{path}")
    if scheme not in SCHEMES:
        raise ValueError(f"{path}: records can't be kept there, only under {', '.join(SCHEMES)}")
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")


def index_of(path: str) -> dict | None:
    """What ``index.json`` says; None where no write has ended."""
    from pyarrow import fs

    system, folder = store(path)
    if system.get_file_info(f"{folder}/index.json").type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(f"{folder}/index.json") as f:
        return json.loads(f.read())


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    records: int
    ids: int


class RecordWriter(DataSourceArrowWriter):
    """Writes rows ``doc_id, ids`` in the order in which a task gets them, after what is there or instead of it."""

    def __init__(self, path: str, width: int, overwrite: bool = False):
        self.path, self.width, self.overwrite = path, width, overwrite
        before = index_of(path)
        if before and not overwrite and before["width"] != width:
            raise ValueError(f"{path}: holds ids of {before['width']} bytes, not of {width}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = store(self.path)
        system.create_dir(folder, recursive=True)
        part = TaskContext.get().partitionId()
        name, index, place, before = f"part-{part:06d}-{uuid.uuid4().hex}", [], 0, 0
        with system.open_output_stream(f"{folder}/{name}.records", buffer_size=1 << 20) as out:
            for batch in iterator:
                for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = ids.as_py()
                    frame = framed(HEAD.pack(doc is not None, doc or 0) + ids)
                    out.write(frame)
                    index += (place, before)
                    place += len(frame)
                    before += len(ids) // self.width
        with system.open_output_stream(f"{folder}/{name}.index") as out:
            out.write(np.array(index, "<u8").tobytes())
        return Written(part, name, len(index) // 2, before)

    def commit(self, messages: list[Written]) -> None:
        before = index_of(self.path)
        files = before["files"] if before and not self.overwrite else []
        start = files[-1]["start"] + files[-1]["ids"] if files else 0
        for m in sorted((m for m in messages if m and m.records), key=lambda m: m.part):
            files.append({"name": m.name, "records": m.records, "ids": m.ids, "start": start})
            start += m.ids
        system, folder = store(self.path)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/index.json") as out:
            out.write(json.dumps({"width": self.width, "files": files}).encode())
        for f in before["files"] if before and self.overwrite else ():
            for kind in ("records", "index"):
                system.delete_file(f"{folder}/{f['name']}.{kind}")

    def abort(self, messages: list[Written]) -> None:
        system, folder = store(self.path)
        for m in messages:
            for kind in ("records", "index") if m else ():
                system.delete_file(f"{folder}/{m.name}.{kind}")


@dataclass
class File(InputPartition):
    name: str
    start: int
    seed: int | None

    def __post_init__(self):
        self.value = self.name


class RecordReader(DataSourceReader):
    """One task for each file. With ``seed`` files and the records in each come in a shuffled order."""

    def __init__(self, path: str, seed: int | None):
        self.path, self.seed, self.index = path, seed, index_of(path)
        if self.index is None:
            raise FileNotFoundError(f"{path}: no index.json")

    def partitions(self) -> list[InputPartition]:
        files = [File(f["name"], f["start"], self.seed) for f in self.index["files"]]
        if self.seed is not None:
            np.random.default_rng(self.seed).shuffle(files)
        return files

    def _bodies(self, file: File) -> Iterator[tuple[int, bytes]]:
        system, folder = store(self.path)
        name = f"{folder}/{file.name}"
        with system.open_input_stream(f"{name}.index") as f:
            index = np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype(np.int64)
        if file.seed is None:
            with system.open_input_stream(f"{name}.records", buffer_size=1 << 20) as f:
                yield from zip(index[:, 1].tolist(), unframed(f.read, name), strict=True)
            return
        order = np.random.default_rng([file.seed, zlib.crc32(file.name.encode())]).permutation(len(index))
        with system.open_input_file(f"{name}.records") as f:
            for at, before in index[order].tolist():
                f.seek(at)
                yield before, next(unframed(f.read, name))

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no files
            return
        rows, size = [], 0
        for before, body in self._bodies(partition):
            there, doc = HEAD.unpack_from(body)
            rows.append((doc if there else None, partition.start + before, body[HEAD.size:]))
            size += len(body)
            if size >= READ_BYTES:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        ids, starts, bodies = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array([self.index["width"]] * len(rows), pa.int32()),
             pa.array(bodies, pa.binary())], names=["doc_id", "start", "width", "ids"])


class TokenRecords(DataSource):
    """``doc_id long, start long, width int, ids binary``; writes ``doc_id long, ids binary``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id long, start long, width int, ids binary"

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(self.options["path"], int(self.options["seed"]) if "seed" in self.options else None)

    def writer(self, schema: StructType, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"], int(self.options["width"]), overwrite)


def cuts(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Where files end: how many cuts lie among rows without an id, and the ids at the others, ascending.

    Bytes are added up by id first, so that a frequent id is one row. The ids are then
    sorted in ranges, and each range gives an id whenever so many bytes have passed, and
    its last one. An id of many bytes comes several times.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "weights")
    size = F.octet_length("text").cast("long") + ROW_BYTES
    docs.groupBy("doc_id").agg(F.sum(size).alias("size")).write.parquet(folder)
    weights = spark.read.schema("doc_id long, size long").parquet(folder)
    total = weights.agg(F.sum("size")).first()[0] or 0
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    step = max(min(FILE_BYTES, total // ranges), total // MOST_FILES, 1)

    def run(batches):
        passed, last = 0, None
        for batch in batches:
            ends = passed + np.cumsum(batch.column("size").to_numpy())
            cut = np.diff(ends // step, prepend=passed // step)
            yield {"doc_id": batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(cut)), cut)))}
            passed, last = int(ends[-1]), batch.column("doc_id")[-1:]
        if last is not None:
            yield {"doc_id": last}

    found = arrow_map(weights.repartitionByRange(ranges, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id")),
                      run, "doc_id long").toArrow().column(0)
    return found.null_count, np.sort(found.drop_null().to_numpy())


def places(ids: pa.Array, texts: pa.Array, nulls: int, bounds: np.ndarray, seen: Counter) -> np.ndarray:
    """The file of each row.

    An id at which files are cut may lie on both sides of a cut. Its rows are dealt out by a
    hash of the text, and equal rows of a task in turn (``seen`` counts them), which gives
    the same files in whatever order the rows come.
    """
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    own = ids.fill_null(0).to_numpy()
    low, high = (np.where(missing, none, nulls + np.searchsorted(bounds, own, side)) for none, side in ((0, "left"), (nulls, "right")))
    for row in np.flatnonzero(high > low).tolist():
        key = (None if missing[row] else int(own[row]), xxhash.xxh3_64_intdigest(texts[row].as_py()))
        low[row] += (key[1] + seen[key]) % int(high[row] - low[row] + 1)
        seen[key] += 1
    return low


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encodes ``docs`` and writes them by ascending ``doc_id``, each closed by ``end_id``.

    A null text is an empty one and gives the end alone. Null ids come first; rows that
    repeat an id are all written, next to each other. Other columns are not read. An empty
    table gives an index without files. A second write to ``path`` is put after the first,
    by itself in order. Where files end follows from ids and lengths alone, so texts are
    encoded once, and only the ids of tokens are shuffled. A text of any length is one
    record; the longest one that Arrow takes has 2 GB.
    """
    store(path)
    spark = docs.sparkSession
    spark.dataSource.register(TokenRecords)
    docs = id_and_text(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    nulls, bounds = cuts(docs)
    width = 2 if Encoder.of(tokenizer).cache.typecode == "H" else 4

    def run(batches):
        encoder, seen = Encoder.of(tokenizer), Counter()
        for batch, texts in slices(batches, SLICE_BYTES):
            ids, starts = encoder.encode(texts)
            ids = np.insert(ids, starts[1:], end_id).astype(f"<u{width}")
            docs_of = batch.column("doc_id")
            yield {"doc_id": docs_of, "part": places(docs_of, texts, nulls, bounds, seen), "ids": binaries(ids, starts + np.arange(len(starts)))}

    coded = arrow_map(docs, run, "doc_id long, part int, ids binary")
    (coded.repartitionById(nulls + len(bounds) + 1, F.col("part")).sortWithinPartitions(F.asc_nulls_first("doc_id"))
     .select("doc_id", "ids").write.format(FORMAT).option("width", width).mode("append").save(path))


def read_records(spark: SparkSession, path: str, seed: int | None = None) -> DataFrame:
    """``doc_id, start, width, ids``: what :func:`write_records` left, checked as it is read.

    ``start`` counts the ids of all documents before. With ``seed`` the order is shuffled
    by file and, by way of the index, inside each file.
    """
    spark.dataSource.register(TokenRecords)
    reader = spark.read.format(FORMAT)
    return (reader if seed is None else reader.option("seed", seed)).load(path)


def digests(records: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of records: checksum of the ids as 32-bit integers."""
    def run(batches):
        for batch in batches:
            width = batch.column("width").to_pylist()
            ids = [np.frombuffer(b, f"<u{w}") for b, w in zip(batch.column("ids").to_pylist(), width, strict=True)]
            yield {"doc_id": batch.column("doc_id"), "start": batch.column("start"), "n_tokens": list(map(len, ids)),
                   "ids_crc32": [zlib.crc32(i.astype("<u4").tobytes()) for i in ids]}

    return arrow_map(records, run, "doc_id long, start long, n_tokens long, ids_crc32 long")
