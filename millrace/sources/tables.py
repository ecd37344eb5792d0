"""Staging tables in the shared folder: plain, bucketed, partitioned."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from millrace.session import scratch_path


def bucketed_table(df: DataFrame, label: str, keys: list[str], buckets: int, sort: list[str] | None = None, rebalance: bool = True) -> DataFrame:
    """Write a table clustered by ``keys``; joins and groups on those keys then need no shuffle.

    The rebalance before the write splits a hot bucket over several tasks and files; without it, rows that lie in ``buckets``
    partitions by the keys become a file each.
    """
    spark = df.sparkSession
    name = f"millrace_{label}_{uuid.uuid4().hex}"
    writer = (df.hint("rebalance", *keys) if rebalance else df).write.format("parquet").bucketBy(buckets, *keys).sortBy(*(sort or keys))
    writer.option("path", scratch_path(spark, label)).saveAsTable(name)
    return spark.table(name)


def staged(df: DataFrame, label: str, fmt: str = "parquet", partition_by: list[str] | None = None, mode: str = "errorifexists",
           path: str | None = None, **options) -> str:
    """Write a frame below the shared folder (or to ``path``) and return the path."""
    path = path or scratch_path(df.sparkSession, label)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def parallelized(spark, rows: list, schema: str, slices: int) -> DataFrame:
    """A local list cut into consecutive slices of nearly equal length, one partition each. For short lists only."""
    if slices < 1:
        raise ValueError("at least one slice is needed")
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), schema)
