"""Row and value functions the corpora use that have no direct built-in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def position_of(value: Column | str, *choices) -> Column:
    """1-based position of a value among the choices, 0 if there is none or the value is missing."""
    v = F.col(value) if isinstance(value, str) else value
    out = F.lit(0)
    for i, choice in reversed(list(enumerate(choices, 1))):
        out = F.when(v == choice, i).otherwise(out)
    return F.when(v.isNull(), 0).otherwise(out)


def tagged_union(tag: Column, *values: Column) -> Column:
    """A value of one of several types: the tag says which field is filled."""
    return F.struct(tag.cast("int").alias("tag"), *[F.when(tag == i, v).alias(f"v{i}") for i, v in enumerate(values)])


def in_lines(df: DataFrame, column: str, path: str, name: str = "in_file") -> DataFrame:
    """Flag rows whose value is a line of a text file."""
    from millrace.operators.joins import existence_join

    lines = df.sparkSession.read.text(path).select(F.col("value").alias(column))
    return existence_join(df, lines, [column], name)


def bitmap_array_and(a: Column, b: Column) -> Column:
    """Bitwise and of two word-array bitmaps, the shorter padded with empty words."""
    return F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0)).bitwiseAND(F.coalesce(y, F.lit(0))))


def bitmap_array_or(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0)).bitwiseOR(F.coalesce(y, F.lit(0))))


def bitmap_array_empty(a: Column) -> Column:
    return ~F.exists(a, lambda x: x != 0)


def columns_like(df: DataFrame, pattern: str) -> DataFrame:
    """Select the columns whose whole name matches a regular expression."""
    return df.select(df.colRegex(f"`{pattern}`"))


def apply_macro(df: DataFrame, name: str, params: str, returns: str, body: str, arguments: list[str], alias: str) -> DataFrame:
    """Define a temporary SQL function and add its value as a column."""
    spark = df.sparkSession
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return df.withColumn(alias, F.expr(f"{name}({', '.join(arguments)})"))
