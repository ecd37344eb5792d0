"""A streaming sink that commits in two steps: tasks write files, then the driver names them, with the epoch, in one manifest.

A file counts from the moment its epoch's manifest is there, and a manifest is put in place by one rename. An epoch that runs
again, as its query ended between this and the stream's own commit, finds its manifest and takes its new files back; so a
reader sees each epoch once and whole, or not at all. Files of tasks that were lost stay unnamed and are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from millrace.session import scratch_path
from millrace.sources.records import store_of
from millrace.streaming.sinks import finish, trigger

FILES, MANIFESTS = "files", "manifests"


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class EpochWriter(DataSourceStreamArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        store, root = store_of(self.folder)
        store.create_dir(f"{root}/{FILES}")
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            out = out or pq.ParquetWriter(f"{root}/{FILES}/{name}", batch.schema, filesystem=store)
            out.write_batch(batch)
            rows += batch.num_rows
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        from pyarrow import fs

        store, root = store_of(self.folder)
        store.create_dir(f"{root}/{MANIFESTS}")
        place = f"{root}/{MANIFESTS}/{batchId}.json"
        if store.get_file_info(place).type != fs.FileType.NotFound:
            self.abort(messages, batchId)
            return
        own = [m for m in messages if m is not None and m.file]
        draft = f"{root}/{MANIFESTS}/.{batchId}-{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            for m in own or [Written(None, 0)]:
                out.write((json.dumps({"epoch": batchId, "file": m.file, "rows": m.rows}) + "\n").encode())
        store.move(draft, place)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        store, root = store_of(self.folder)
        for m in messages:
            if m is not None and m.file:
                store.delete_file(f"{root}/{FILES}/{m.file}")


class EpochSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "epoch_files"

    def streamWriter(self, schema: StructType, overwrite: bool) -> EpochWriter:
        return EpochWriter(self.options["path"])


def run_epochs(stream: DataFrame, folder: str, checkpoint: str | None = None) -> str:
    """Append a stream's rows to the folder until the input is used up; returns the checkpoint for a restart."""
    spark = stream.sparkSession
    spark.dataSource.register(EpochSink)
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    finish(stream.writeStream.format("epoch_files").option("path", folder).option("checkpointLocation", checkpoint).trigger(**trigger("available_now")).start())
    return checkpoint


def committed(spark: SparkSession, folder: str) -> DataFrame:
    """The manifests' entries: epoch, file and rows."""
    return spark.read.schema("epoch long, file string, rows long").json(f"{folder}/{MANIFESTS}")


def read_epochs(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """The rows of all committed epochs. The list of files passes the driver, as the list of any table's files does."""
    files = [f"{folder}/{FILES}/{r['file']}" for r in committed(spark, folder).where("file IS NOT NULL").select("file").collect()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
