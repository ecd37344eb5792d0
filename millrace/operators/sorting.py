"""Order, layout and numbering of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import checkpointed, scratch_path


def top(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    """The first k rows in order; Spark keeps k rows per task and merges them."""
    return df.orderBy(*order).limit(k)


def sort_by_key(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """A total order laid out in ranges: each partition is sorted and lies after the one before it."""
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def filter_by_range(df: DataFrame, key: str, low, high) -> DataFrame:
    """Rows whose key lies in [low, high]; as a plain filter it reaches the scan."""
    return df.where(F.col(key).between(low, high))


def cluster_by(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """DISTRIBUTE BY and SORT BY on the same keys."""
    return (df.repartition(partitions, *keys) if partitions else df.repartition(*keys)).sortWithinPartitions(*keys)


def zip_with_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """A consecutive 0-based index in the given order, without gathering the rows.

    Rows are laid out in sorted ranges and stored once with their place inside the range. The row counts per range (one
    number per partition) then give each range its first index. ``order`` must identify a row.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranged")
    # the low 33 bits of the id count the rows of a partition
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sort_by_key(df, order).select("*", F.spark_partition_id().alias("_range"), place.alias("_place")).write.parquet(path)
    laid = spark.read.parquet(path)
    sizes = sorted((r["_range"], r["n"]) for r in laid.groupBy("_range").agg(F.count("*").alias("n")).collect())
    starts, first = [], 0
    for part, n in sizes:
        starts.append((part, first))
        first += n
    base = spark.createDataFrame(starts, "_range int, _first bigint")
    return laid.join(F.broadcast(base), "_range").withColumn(name, F.col("_first") + F.col("_place")).drop("_range", "_first", "_place")


def persisted(df: DataFrame) -> DataFrame:
    """Keep a frame that several results share; spills to disk."""
    from pyspark import StorageLevel

    return df.persist(StorageLevel.MEMORY_AND_DISK)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    return checkpointed(df)
