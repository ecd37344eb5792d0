"""Attribute-change reporting over product snapshots (product, source, org, day, attributes as JSON)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import scratch_path

ATTRIBUTES = "map<string,string>"


def attribute_keys(df: DataFrame, column: str, name: str = "attribute") -> DataFrame:
    """One row per top-level JSON key; malformed JSON gives none."""
    return df.select("*", F.explode(F.json_object_keys(column)).alias(name))


def attribute_changes(snapshots: DataFrame, keys: list[str], column: str, name: str = "attribute") -> DataFrame:
    """Names of the attributes that differ between the two states of a product.

    Only keys with exactly two distinct states count. The two states are the smallest and the largest text, so a group
    is reduced on the map side and never gathered.
    """
    states = snapshots.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.lit(1).alias("_one"))
    pairs = states.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(column).alias("_a"), F.max(column).alias("_b")).where("_n = 2")
    a, b = F.from_json("_a", ATTRIBUTES), F.from_json("_b", ATTRIBUTES)
    both = pairs.select(*keys, a.alias("_a"), b.alias("_b"))
    names = F.array_union(F.map_keys("_a"), F.map_keys("_b"))
    differing = F.filter(names, lambda k: ~F.try_element_at("_a", k).eqNullSafe(F.try_element_at("_b", k)))
    return both.select(*keys, F.explode(differing).alias(name))


def attribute_counts(changes: DataFrame, by: list[str], name: str = "attribute") -> DataFrame:
    return changes.groupBy(*by, name).agg(F.count("*").alias("attr_count"))


def top_attributes(changes: DataFrame, by: list[str], k: int, name: str = "attribute") -> DataFrame:
    """The k most changed attributes, ties by name."""
    return attribute_counts(changes, by, name).orderBy(F.desc("attr_count"), *by, name).limit(k)


def top_sources(changes: DataFrame, k: int, source: str = "source", name: str = "attribute", ranks: int = 3) -> DataFrame:
    """The k most changed attributes with their most frequent sources, one column pair per rank."""
    per = changes.groupBy(name, source).agg(F.count("*").alias("_n"))
    # one row per attribute and source: a handful per attribute
    w = Window.partitionBy(name).orderBy(F.desc("_n"), source)
    ranked = per.select("*", F.row_number().over(w).alias("_r"))
    wide = ranked.groupBy(name).agg(
        F.sum("_n").alias("attr_count"),
        *[x for i in range(1, ranks + 1) for x in (
            F.max(F.when(F.col("_r") == i, F.col(source))).alias(f"source_name{i}"),
            F.max(F.when(F.col("_r") == i, F.col("_n"))).alias(f"source_count{i}"))])
    return wide.orderBy(F.desc("attr_count"), name).limit(k)


def duplicate_snapshots(snapshots: DataFrame, product: str, day: str) -> DataFrame:
    """Products with more records than days."""
    per_day = snapshots.groupBy(product, day).agg(F.count("*").alias("_n"))
    return per_day.groupBy(product).agg(F.sum("_n").alias("records"), F.count("*").alias("days")).where("records > days")


def reconcile(snapshots: DataFrame, product: str, day: str) -> DataFrame:
    """Record count against products times days."""
    per = snapshots.groupBy(product, day).agg(F.count("*").alias("_n"))
    days = per.groupBy(product).agg(F.sum("_n").alias("_n"))
    return days.agg(F.sum("_n").alias("records"), F.count("*").alias("products")).join(
        F.broadcast(per.agg(F.countDistinct(day).alias("days")))).select(
        "records", "products", "days", (F.col("products") * F.col("days")).alias("expected"), (F.col("records") - F.col("products") * F.col("days")).alias("surplus"))


def new_rows(df: DataFrame, day: str, control: str) -> DataFrame | None:
    """Rows newer than the last reported day in the control table, or None when there is nothing new."""
    spark = df.sparkSession
    last = spark.read.parquet(control).agg(F.max("reported")).first()[0]
    newest = df.agg(F.max(day)).first()[0]
    if newest is None or (last is not None and newest <= last):
        return None
    return df if last is None else df.where(F.col(day) > F.lit(last))


def mark_reported(df: DataFrame, day: str, control: str) -> None:
    df.agg(F.max(day).alias("reported")).write.mode("append").parquet(control)


def empty_control(spark, kind: str) -> str:
    path = scratch_path(spark, "control")
    spark.createDataFrame([], f"reported {kind}").write.parquet(path)
    return path


def payload(columns: dict[str, Column]) -> Column:
    """A JSON object of the given fields, leaving out those the item does not have."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]), {"ignoreNullFields": "true"})
