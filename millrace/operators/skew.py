"""Finding hot keys and cutting their rows into slices, so that no key has to fit in one task.

A key is hot when it holds more than ``1/tasks`` of the rows and more than ``min_rows``. By counting, there are fewer
than ``tasks`` such keys, so the list of hot keys is always small enough to send to every task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import checkpointed, task_slots

HOT_ROWS = 2_000_000
SLICE_ROWS = 1_000_000
LOOK = object()  # stands for "look for hot keys first"


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the keys of two aliased frames; no keys means every pair of rows."""
    tests = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


def hot_keys(df: DataFrame, keys: list[str], min_rows: int = HOT_ROWS, tasks: int | None = None) -> DataFrame | None:
    """The hot keys with their row counts, or None when there is none. Fewer than ``tasks`` rows."""
    tasks = tasks or max(8, task_slots(df.sparkSession))
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total, largest = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    floor = max(min_rows, (total or 0) // tasks)
    if largest is None or largest <= floor:
        return None
    rows = counts.where(F.col("_rows") > floor).collect()
    return df.sparkSession.createDataFrame(rows, counts.schema)


def known_hot(df: DataFrame, keys: list[str], min_rows: int, hot) -> DataFrame | None:
    """The hot keys as given, or looked up. A chain of operators that keep the rows of each key looks once and passes
    the answer on, so that its earlier steps do not run again for every look.
    """
    return hot_keys(df, keys, min_rows) if hot is LOOK else hot


def with_slices(df: DataFrame, keys: list[str], order: list[str], min_rows: int = HOT_ROWS, slices: int | None = None,
                name: str = "_slice", hot=LOOK) -> tuple[DataFrame, bool]:
    """Add a slice number that grows with ``order``: 0 for ordinary keys, even parts of the order for hot keys.

    Returns the frame and whether any key is hot. The rows of hot keys are laid out by Spark's range partitioner over the
    keys and all order columns, and a partition is a slice: so slices never overlap in that order, whatever the types, and
    only rows that agree in every order column must share one. The layout is written down, as a second run of the
    partitioner's sample could draw other bounds.
    """
    hot = known_hot(df, keys, min_rows, hot)
    if hot is None:
        return df.withColumn(name, F.lit(0).cast("bigint")), False
    n = slices or max(16, 2 * task_slots(df.sparkSession))
    # a slice is one task: their number grows with the hot rows
    n = max(n, -(-hot.agg(F.sum("_rows")).first()[0] // (hot.count() * SLICE_ROWS)))
    if not keys:
        return checkpointed(_laid_out(df, order, n, name)), True
    marks = hot.drop("_rows").withColumn("_hot", F.lit(True))
    marked = df.alias("d").join(F.broadcast(marks).alias("h"), same_keys("d", "h", keys), "left").select("d.*", F.coalesce("h._hot", F.lit(False)).alias("_hot"))
    even = marked.where("not _hot").drop("_hot").withColumn(name, F.lit(0).cast("bigint"))
    return checkpointed(even.unionByName(_laid_out(marked.where("_hot").drop("_hot"), [*keys, *order], n * hot.count(), name))), True


def _laid_out(df: DataFrame, order: list[str], n: int, name: str) -> DataFrame:
    return df.repartitionByRange(n, *[F.col(c) for c in order]).withColumn(name, F.spark_partition_id().cast("bigint"))


def salted_agg(df: DataFrame, keys: list[str], partial: list[Column], final: list[Column], salts: int = 32) -> DataFrame:
    """Group twice: by key and salt, then by key. For aggregates whose first step cannot combine on the map side."""
    spread = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    return spread.groupBy(*keys, "_salt").agg(*partial).groupBy(*keys).agg(*final)


def window(keys: list[str], *order: Column | str):
    return Window.partitionBy(*keys).orderBy(*order)
