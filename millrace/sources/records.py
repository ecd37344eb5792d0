"""Fixed-length binary records as a data source whose partitions are byte ranges of the files, cut at record borders.

``spark.read.format("fixed_records").option("path", ...).option("record_length", "19").load()`` gives ``path``, ``record_no``
(from 0 in each file) and ``record``. A file of any size is read by as many tasks as it has ranges, each of which reads
``chunk_bytes`` at a time. A file that ends within a record raises, unless ``short_tail`` says ``drop`` or ``keep``.

Paths are folders or files of any file system that Arrow opens by its URI (local, hdfs, s3, gs); others go by
``fixed_records`` in ``millrace.sources.files``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

RANGE_BYTES, CHUNK_BYTES = 64 << 20, 4 << 20


def store_of(uri: str):
    """File system and path of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@dataclass
class ByteRange(InputPartition):
    uri: str  # of the folder or file that was asked for, which tells the file system
    file: str
    first: int  # record
    records: int
    tail: int  # bytes of a kept short last record


class FixedRecordsReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]
        self.length = int(options["record_length"])
        self.glob = options.get("glob", "*")
        self.tail = options.get("short_tail", "fail")
        self.chunk = max(1, int(options.get("chunk_bytes", CHUNK_BYTES)) // self.length)
        self.range = max(1, int(options.get("range_bytes", RANGE_BYTES)) // self.length)
        if self.length < 1 or self.tail not in ("fail", "drop", "keep"):
            raise ValueError("record_length must be positive, short_tail one of fail, drop and keep")

    def partitions(self) -> list[ByteRange]:
        from pyarrow import fs

        store, root = store_of(self.uri)
        found = store.get_file_info(root)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.uri)
        files = [found] if found.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
        out = []
        for f in sorted((f for f in files if f.type == fs.FileType.File), key=lambda f: f.path):
            hidden = any(p.startswith(("_", ".")) for p in f.path[len(root) :].split("/"))
            if found.type != fs.FileType.File and (hidden or not fnmatch(f.base_name, self.glob)):
                continue
            whole, rest = divmod(f.size, self.length)
            if rest and self.tail == "fail":
                raise ValueError(f"{f.path} has {f.size} bytes, which is no multiple of {self.length}")
            ranges = [ByteRange(self.uri, f.path, at, min(self.range, whole - at), 0) for at in range(0, whole, self.range)]
            if rest and self.tail == "keep":
                ranges.append(ByteRange(self.uri, f.path, whole, 0, rest))
            out += ranges
        return out or [ByteRange(self.uri, "", 0, 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        store, _ = store_of(partition.uri)
        with store.open_input_file(partition.file) as f:
            f.seek(partition.first * self.length)
            at, behind = partition.first, partition.first + partition.records
            while at < behind:
                n = min(self.chunk, behind - at)
                data = f.read(n * self.length)
                if len(data) != n * self.length:
                    raise OSError(f"{partition.file} ended while it was read")
                records = pa.FixedSizeBinaryArray.from_buffers(pa.binary(self.length), n, [None, pa.py_buffer(data)])
                yield self._batch(partition, at, records.cast(pa.binary()))
                at += n
            if partition.tail:
                yield self._batch(partition, at, pa.array([f.read(partition.tail)], pa.binary()))

    def _batch(self, partition: ByteRange, first: int, records: pa.Array) -> pa.RecordBatch:
        numbers = pa.array(range(first, first + len(records)), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([partition.file] * len(records)), numbers, records], names=["path", "record_no", "record"])


class FixedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fixed_records"

    def schema(self) -> str:
        return "path string, record_no long, record binary"

    def reader(self, schema: StructType) -> FixedRecordsReader:
        return FixedRecordsReader(self.options)


def read_records(spark: SparkSession, path: str, length: int, **options) -> DataFrame:
    """The records of a file or folder; ``options`` are glob, short_tail, range_bytes and chunk_bytes."""
    spark.dataSource.register(FixedRecords)
    return spark.read.format("fixed_records").options(record_length=length, **options).load(path)
