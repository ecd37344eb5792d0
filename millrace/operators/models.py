"""Model stages: thin builders around ``pyspark.ml`` with the column plumbing done."""

from __future__ import annotations

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F


#: rows that one task of a fit learns from, about
FIT_ROWS = 1_000_000


def assembled(df: DataFrame, columns: list[str], label: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """(keep..., label, features) from numeric columns."""
    out = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(df)
    picked = [*(keep or []), *([F.col(label).cast("double").alias("label")] if label else []), "features"]
    return out.select(*picked)


def in_parts(train: DataFrame) -> DataFrame:
    """The rows in tasks of about ``FIT_ROWS``: a fit keeps and reads again what a task holds, which as objects is many times its
    part of the files. A frame that has no more than that is left as it is.
    """
    parts = -(-train.count() // FIT_ROWS)
    return train if parts <= 1 else train.repartition(parts)


def fit_score(estimator, train: DataFrame, score: DataFrame | None = None) -> DataFrame:
    """Fit on one frame, predict on another (or the same)."""
    return estimator.fit(in_parts(train)).transform(train if score is None else score)


def tally(predictions: DataFrame, column: str = "prediction") -> DataFrame:
    """Row count per (rounded) prediction: a result whose size does not grow with the table."""
    return predictions.groupBy(F.round(column, 1).alias(column)).agg(F.count("*").alias("n"))


def indexed(df: DataFrame, column: str, name: str) -> DataFrame:
    return StringIndexer(inputCol=column, outputCol=name, handleInvalid="keep").fit(df).transform(df)


def pipeline(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))


def transformed(df: DataFrame, *stages: Transformer) -> DataFrame:
    for stage in stages:
        df = stage.transform(df)
    return df
