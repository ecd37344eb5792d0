"""Streaming inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, fmt: str = "parquet") -> DataFrame:
    """New files of a folder, oldest first."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def queue(batches: list[DataFrame], label: str = "queue") -> str:
    """Lay prepared batches down as files, one batch after the other; the file source takes older files first."""
    path = scratch_path(batches[0].sparkSession, label)
    for batch in batches:
        batch.write.mode("append").parquet(path)
    return path


def queue_stream(batches: list[DataFrame], label: str = "queue") -> DataFrame:
    """The batches as a stream with about as many triggers as there are batches."""
    spark = batches[0].sparkSession
    path = queue(batches, label)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").count()
    return file_stream(spark, path, batches[0].schema, max(1, -(-files // len(batches))))


def kafka_options(servers: str, subscribe: str | None = None, pattern: str | None = None, assign: str | None = None, starting: str = "latest") -> dict[str, str]:
    """Exactly one way to choose topics: by name, by pattern, or fixed partitions."""
    ways = {"subscribe": subscribe, "subscribePattern": pattern, "assign": assign}
    chosen = {k: v for k, v in ways.items() if v}
    if len(chosen) != 1:
        raise ValueError("give exactly one of subscribe, pattern and assign")
    return {"kafka.bootstrap.servers": servers, "startingOffsets": starting, **chosen}


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """Kafka values as text; needs the Kafka package and a broker."""
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load().select(F.col("value").cast("string").alias("value"))


def words(lines: DataFrame, column: str | Column = "value") -> DataFrame:
    return lines.select(F.explode(F.split(column, r"\s+")).alias("word")).where("word <> ''")
