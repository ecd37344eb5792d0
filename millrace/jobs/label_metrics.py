"""Per-label precision, recall, F1 and support of multi-label predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def filled(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(""))


def fill_truth(df: DataFrame, trusted: str, predicted: str) -> DataFrame:
    """Missing labels become empty text; the truth is the trusted label (equal to the prediction when they agree)."""
    return df.withColumn(predicted, filled(predicted)).withColumn("truth", filled(trusted))


def labels_of(c: Column) -> Column:
    """The labels a text holds: split on one of the two separators, whole pieces only, without blanks."""
    pieces = F.array_union(F.split(c, ";"), F.split(c, "__"))
    return F.filter(pieces, lambda x: (x != "") & ~F.contains(x, F.lit(";")) & ~F.contains(x, F.lit("__")))


def known_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """All labels named anywhere, splitting on both separators."""
    out = None
    for c in columns:
        part = df.select(F.explode(F.split(c, ";|__")).alias("label")).where("label <> ''").distinct()
        out = part if out is None else out.union(part)
    return out.distinct()


def label_metrics(df: DataFrame, truth: str, predicted: str, digits: int = 3) -> DataFrame:
    """One row per label. A label that one side never has scores zero in all four measures."""
    t, p = labels_of(F.col(truth)), labels_of(F.col(predicted))
    rows = df.select(t.alias("_t"), p.alias("_p")).select("_t", "_p", F.explode(F.array_union("_t", "_p")).alias("label"))
    in_t, in_p = F.array_contains("_t", F.col("label")), F.array_contains("_p", F.col("label"))
    counts = rows.groupBy("label").agg(F.count_if(in_t & in_p).alias("hit"), F.count_if(in_t).alias("actual"), F.count_if(in_p).alias("given"))
    every = known_labels(df, [truth, predicted]).join(counts, "label", "left").na.fill(0)
    both = (F.col("actual") > 0) & (F.col("given") > 0)

    def measure(c: Column, name: str) -> Column:
        return F.when(both, F.round(c, digits)).otherwise(0.0).alias(name)

    hit, actual, given = F.col("hit"), F.col("actual"), F.col("given")
    return every.select("label", measure(hit / given, "precision"), measure(hit / actual, "recall"),
                        measure(2 * hit / (given + actual), "f1"), measure(actual.cast("double"), "support"))
