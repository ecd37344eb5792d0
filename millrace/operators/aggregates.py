"""Aggregation operators beyond ``groupBy().agg()``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.skew import salted_agg


def distinct_rows_by_key(df: DataFrame, keys: list[str], value: str, name: str = "n") -> DataFrame:
    """Value counts per key: the bounded form of a list of all values."""
    return df.groupBy(*keys, value).agg(F.count("*").alias(name))


def bag(df: DataFrame, keys: list[str], value: str, name: str = "items") -> DataFrame:
    """All values of a key as a sorted array of (value, count): repeated values take one entry."""
    return distinct_rows_by_key(df, keys, value).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(value, "n"))).alias(name))


def ngram_counts(df: DataFrame, text: str, n: int, by: list[str] | None = None, lowercase: bool = True) -> DataFrame:
    """Counts of the n-grams of words inside each sentence."""
    by = by or []
    body = F.lower(F.col(text)) if lowercase else F.col(text)
    sentences = df.select(*by, F.explode(F.sentences(body)).alias("words")).where(F.size("words") >= n)
    grams = F.transform(F.sequence(F.lit(0), F.size("words") - n), lambda i: F.array_join(F.slice("words", i + 1, F.lit(n)), " "))
    return sentences.select(*by, F.explode(grams).alias("ngram")).groupBy(*by, "ngram").agg(F.count("*").alias("frequency"))


def top_ngrams(df: DataFrame, text: str, n: int, k: int) -> DataFrame:
    """The k most frequent n-grams, ties by the n-gram's own order."""
    return ngram_counts(df, text, n).orderBy(F.desc("frequency"), "ngram").limit(k)


def context_ngrams(df: DataFrame, text: str, before: list[str], k: int) -> DataFrame:
    """The k most frequent words that follow the given words."""
    grams = ngram_counts(df, text, len(before) + 1)
    parts = F.split("ngram", " ")
    match = F.array_join(F.slice(parts, 1, len(before)), " ") == " ".join(before)
    return grams.where(match).select(F.element_at(parts, -1).alias("word"), "frequency").orderBy(F.desc("frequency"), "word").limit(k)


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Column statistics, one row per column: count, nulls, approximate distinct, min, max, average and longest length.

    One pass over the table whatever the number of columns.
    """
    columns = columns or df.columns
    stats = []
    for i, c in enumerate(columns):
        col = F.col(c)
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        size = F.length(col.cast("string"))
        stats.append(F.struct(
            F.lit(c).alias("column"), F.count(col).alias("filled"), F.count_if(col.isNull()).alias("nulls"),
            F.approx_count_distinct(col).alias("distinct_about"),
            F.min(col).cast("string").alias("smallest"), F.max(col).cast("string").alias("largest"),
            (F.avg(col) if numeric else F.lit(None)).cast("double").alias("mean"),
            F.avg(size).alias("mean_length"), F.max(size).alias("longest"),
        ).alias(f"s{i}"))
    wide = df.agg(*stats)
    return wide.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))


def exact_profile(df: DataFrame, column: str) -> DataFrame:
    """Count, nulls, exact distinct, min and max of one column."""
    c = F.col(column)
    return df.agg(F.count("*").alias("rows"), F.count_if(c.isNull()).alias("nulls"), F.countDistinct(c).alias("distinct_values"),
                  F.min(c).alias("smallest"), F.max(c).alias("largest"))


def estimate(df: DataFrame, fraction: float, seed: int, value: str, by: list[str] | None = None, z: float = 1.96) -> DataFrame:
    """Count, sum and mean with their confidence bounds, from a Bernoulli sample of the rows."""
    by = by or []
    s = df.sample(False, fraction, seed).groupBy(*by).agg(
        F.count("*").alias("k"), F.avg(value).alias("m"), F.coalesce(F.var_samp(value), F.lit(0.0)).alias("v"))
    k, m, v = F.col("k"), F.col("m"), F.col("v")
    rows = k / fraction
    rows_sd = F.sqrt(k * (1 - fraction)) / fraction
    total_sd = F.sqrt((1 - fraction) * k * (v + m * m)) / fraction
    mean_sd = F.sqrt(v / k * (1 - fraction))

    def bounds(name, mid, sd):
        return [mid.alias(name), (mid - z * sd).alias(f"{name}_low"), (mid + z * sd).alias(f"{name}_high")]

    return s.select(*by, *bounds("row_count", rows, rows_sd), *bounds("total", rows * m, total_sd), *bounds("mean", m, mean_sd))


def skewed_distinct(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Distinct count and row count of a key, spread over salts by the value so equal values meet in one task."""
    spread = df.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(64)))
    per = spread.groupBy(*keys, "_salt").agg(F.countDistinct(value).alias("_d"))
    return per.groupBy(*keys).agg(F.sum("_d").alias(name))


def bitmap_by_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key and bucket a bitmap of the value's positions; 32,768 positions per bucket."""
    return df.groupBy(*keys, F.bitmap_bucket_number(value).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))


def bitmap_count(bitmaps: DataFrame, keys: list[str], name: str = "members") -> DataFrame:
    """Number of distinct values held in the bitmaps of a key."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).groupBy(*keys).agg(
        F.sum(F.bitmap_count("bits")).alias(name))


def bitmap_and(left: DataFrame, right: DataFrame, on: list[str], value: str) -> DataFrame:
    """Number of values set in both bitmaps; needs two rows per bucket at most, so a group-and is enough."""
    both = left.select(*on, "bucket", "bits").unionByName(right.select(*on, "bucket", "bits"))
    met = both.groupBy(*on, "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("_n")).where("_n = 2")
    return met.groupBy(*on).agg(F.sum(F.bitmap_count("bits")).alias(value))


def two_stage_sum(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sum and count of a skewed key in two stages."""
    return salted_agg(df, keys, [F.sum(value).alias("_s"), F.count("*").alias("_n")],
                      [F.sum("_s").alias("total"), F.sum("_n").alias("n")])


def pivot_table(df: DataFrame, keys: list[str], on: str | Column, values: list, aggs: list[Column]) -> DataFrame:
    """PIVOT with the wanted values given, so no extra pass looks them up."""
    return df.groupBy(*keys).pivot(on, values).agg(*aggs)
