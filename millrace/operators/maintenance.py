"""Loading and keeping tables of files."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.session import scratch_path, task_slots
from millrace.sources.tables import staged


def load_partitions(df: DataFrame, path: str, by: list[str], static: dict[str, str] | None = None) -> None:
    """Replace just the partitions that occur in the frame; ``static`` fixes leading partition values.

    Rows are rebalanced by partition: small ones share a task, a large one is split over several.
    """
    for name, value in (static or {}).items():
        df = df.withColumn(name, F.lit(value))
    keys = [*(static or {}), *by]
    df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def multi_insert(df: DataFrame, targets: dict[str, Callable[[DataFrame], DataFrame]]) -> dict[str, str]:
    """One scan, several targets: the source is kept while each target is written. Returns the paths."""
    from millrace.operators.sorting import persisted

    kept = persisted(df)
    try:
        return {name: staged(make(kept), name) for name, make in targets.items()}
    finally:
        kept.unpersist()


def file_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below a path, summed on Spark from the file listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length")
    return files.agg(F.sum("length")).first()[0] or 0


def bucket_count(spark: SparkSession, *paths: str, target_bytes: int = 256 << 20) -> int:
    """Buckets of about ``target_bytes`` for the larger of some tables: one for each task at least, as many as Spark allows at most."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(task_slots(spark), *[math.ceil(file_bytes(spark, p) / target_bytes) for p in paths]))


def compact(spark: SparkSession, path: str, target_bytes: int = 256 << 20, by: list[str] | None = None) -> str:
    """Rewrite many small files as few of about ``target_bytes`` each. Returns the new path.

    A folder partitioned ``by`` columns keeps its folders: small ones take one task and file, large ones are split at the
    size that adaptive execution advises.
    """
    if by:
        return staged(spark.read.parquet(path).hint("rebalance", *by), "compacted", partition_by=by)
    files = max(1, math.ceil(file_bytes(spark, path) / target_bytes))
    return staged(spark.read.parquet(path).coalesce(files), "compacted")


def list_buckets(df: DataFrame, column: str, heavy: list, path: str, name: str = "bucket") -> None:
    """Heavy values get their own directory, all others share one."""
    c = F.col(column).cast("string")
    df.withColumn(name, F.when(F.col(column).isin(heavy), c).otherwise("other")).hint("rebalance", name).write.partitionBy(name).parquet(path)


def export_table(df: DataFrame, folder: str, by: list[str] | None = None) -> None:
    """Data files plus a manifest with the schema and the partition columns."""
    staged(df, "export", partition_by=by, path=f"{folder}/data")
    manifest = json.dumps({"schema": df.schema.jsonValue(), "partitions": by or []})
    df.sparkSession.createDataFrame([(manifest,)], "value string").coalesce(1).write.text(f"{folder}/manifest")


def import_table(spark: SparkSession, folder: str, where: str | None = None) -> DataFrame:
    """Read an exported table back; ``where`` picks partitions."""
    manifest = json.loads(spark.read.text(f"{folder}/manifest").first()["value"])
    schema = T.StructType.fromJson(manifest["schema"])
    df = spark.read.schema(schema).parquet(f"{folder}/data").select(*schema.names)
    return df.where(where) if where else df


def evolve(df: DataFrame, add: dict[str, str] | None = None, rename: dict[str, str] | None = None, widen: dict[str, str] | None = None,
           drop: list[str] | None = None) -> DataFrame:
    """Schema changes: rename, widen, drop, then add (empty) columns."""
    out = df.withColumnsRenamed(rename or {})
    for name, kind in (widen or {}).items():
        out = out.withColumn(name, F.col(name).cast(kind))
    out = out.drop(*(drop or []))
    for name, kind in (add or {}).items():
        out = out.withColumn(name, F.lit(None).cast(kind))
    return out


def managed_table(df: DataFrame, label: str, by: list[str] | None = None) -> str:
    """A catalog table with a unique name, kept in the shared folder."""
    name = f"millrace_{label}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", scratch_path(df.sparkSession, label))
    (writer.partitionBy(*by) if by else writer).saveAsTable(name)
    return name


def scratch_database(spark: SparkSession) -> str:
    """A database of its own whose managed tables lie in the shared folder."""
    path = scratch_path(spark, "database")
    name = "millrace_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def latest_partition(spark: SparkSession, table: str, column: str) -> str | None:
    """The largest value of a partition column, from the partition list alone."""
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    value = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    return parts.agg(F.max(value)).first()[0]


def table_statistics(spark: SparkSession, table: str, columns: list[str]) -> dict[str, str]:
    """ANALYZE the table and its columns, and return the table's statistics line."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").collect()
    return {"statistics": rows[0]["data_type"] if rows else ""}
