"""Streaming outputs and running a stream to its present end."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.session import scratch_path

MODES = ("append", "complete", "update")


def trigger(kind: str, interval: str | None = None) -> dict:
    """Arguments for ``DataStreamWriter.trigger``. Intervals must have a fixed length: no months or years."""
    if kind in ("once", "available_now"):
        return {"availableNow": True}
    if kind == "one_batch":  # timers of the processing clock always ask for one more batch, so their streams never run out
        return {"once": True}
    if not interval or not re.fullmatch(r"\s*\d+\s*(millisecond|second|minute|hour|day|week)s?\s*", interval):
        raise ValueError(f"not an interval of fixed length: {interval}")
    if kind == "processing_time":
        return {"processingTime": interval}
    if kind == "continuous":
        return {"continuous": interval}
    raise ValueError(f"no trigger {kind}")


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None) -> str:
    """Hand each micro-batch to a function until the input is used up; returns the checkpoint path for a restart."""
    if mode not in MODES:
        raise ValueError(f"no output mode {mode}")
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream-checkpoint")
    q = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger("available_now")).start()
    finish(q)
    return checkpoint


def finish(q: StreamingQuery) -> None:
    """Wait for the end and raise what went wrong, if anything did."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_append(stream: DataFrame, label: str, checkpoint: str | None = None, path: str | None = None, kind: str = "available_now") -> tuple[str, str]:
    """Append finished rows to files with exactly-once commits. Returns (path, checkpoint)."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    q = stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger(kind)).start()
    finish(q)
    return path, checkpoint


def run_complete(stream: DataFrame, label: str) -> DataFrame:
    """The whole result table after the last batch. Each batch goes to its own folder; the highest one counts."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    last = []

    def save(batch: DataFrame, batch_id: int) -> None:
        # overwriting by batch id makes a repeated batch harmless
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        last.append(batch_id)

    run_batches(stream, save, "complete")
    return spark.read.schema(stream.schema).parquet(f"{path}/batch={max(last)}")


def run_updates(stream: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Update mode: changed rows per batch; the result keeps the latest version of each key."""
    from pyspark.sql import functions as F

    spark = stream.sparkSession
    path = scratch_path(spark, label)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")

    run_batches(stream, save, "update")
    rows = spark.read.option("basePath", path).parquet(f"{path}/_batch=*")
    values = [c for c in stream.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}") for c in values])


def run_memory(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Results on the driver: for small result tables and tests only."""
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(**trigger("available_now")).start()
    finish(q)
    return stream.sparkSession.table(name)


class FolderWriter:
    """A ``foreach`` writer: the rows of one (partition, epoch) become one file, rewritten whole when the epoch repeats."""

    def __init__(self, folder: str):
        self.folder = folder

    def open(self, partition_id: int, epoch_id: int) -> bool:
        from pyarrow import fs

        self.store, root = fs.FileSystem.from_uri(self.folder)
        self.store.create_dir(root)
        self.out = self.store.open_output_stream(f"{root}/{epoch_id}-{partition_id}.json")
        return True

    def process(self, row) -> None:
        self.out.write((json.dumps(row.asDict(), default=str) + "\n").encode())

    def close(self, error) -> None:
        self.out.close()


def run_foreach(stream: DataFrame, folder: str) -> None:
    checkpoint = scratch_path(stream.sparkSession, "stream-checkpoint")
    finish(stream.writeStream.foreach(FolderWriter(folder)).option("checkpointLocation", checkpoint).trigger(**trigger("available_now")).start())
