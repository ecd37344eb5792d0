"""Struct columns as Avro bytes, with Spark's Avro package. Without it both functions raise."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, types as T
from pyspark.sql.avro.functions import from_avro, to_avro


def avro_available(spark) -> bool:
    try:
        return spark.range(1).select(to_avro("id")).columns != []
    except AnalysisException:
        return False


_AVRO_TYPES = {"string": "string", "integer": "int", "long": "long", "double": "double", "float": "float", "boolean": "boolean", "binary": "bytes"}


def avro_schema(kind: T.StructType, name: str = "rec") -> dict:
    """The Avro record schema of a struct of plain and nested fields; every field may be missing."""
    def convert(t, path):
        if isinstance(t, T.StructType):
            return avro_schema(t, path)
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": ["null", convert(t.elementType, path)]}
        return _AVRO_TYPES[t.typeName()]

    return {"type": "record", "name": name, "fields": [
        {"name": f.name, "type": ["null", convert(f.dataType, f"{name}_{f.name}")]} for f in kind.fields]}


def _needed(df: DataFrame) -> None:
    if not avro_available(df.sparkSession):
        raise RuntimeError("Avro columns need the spark-avro package on the class path")


def encode_struct(df: DataFrame, column: str, into: str) -> DataFrame:
    _needed(df)
    return df.withColumn(into, to_avro(column, json.dumps(avro_schema(df.schema[column].dataType)))).drop(column)


def decode_struct(df: DataFrame, column: str, into: str, kind: T.StructType) -> DataFrame:
    _needed(df)
    return df.withColumn(into, from_avro(column, json.dumps(avro_schema(kind)))).drop(column)
