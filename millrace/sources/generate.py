"""Random columns and generated tables, keyed by the rows of a given frame so that they grow with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TINY = 1e-15


def _u(seed: int, *keys: Column) -> Column:
    """A uniform draw in (0, 1) that depends on the seed and the key only, so a re-run task draws the same."""
    bits = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 52))
    return (bits.cast("double") + 0.5) / float(1 << 52)


def uniform(seed: int, *keys: Column) -> Column:
    return _u(seed, *keys)


def normal(seed: int, *keys: Column) -> Column:
    return F.sqrt(-2 * F.ln(_u(seed, *keys))) * F.cos(2 * F.pi() * _u(seed + 7919, *keys))


def exponential(mean: float, seed: int, *keys: Column) -> Column:
    return -mean * F.ln(_u(seed, *keys))


def log_normal(mean: float, sd: float, seed: int, *keys: Column) -> Column:
    return F.exp(mean + sd * normal(seed, *keys))


def weibull(shape: float, scale: float, seed: int, *keys: Column) -> Column:
    return scale * F.pow(-F.ln(_u(seed, *keys)), 1.0 / shape)


def gamma(shape: int, scale: float, seed: int, *keys: Column) -> Column:
    """Gamma with a whole-number shape: a sum of exponentials."""
    return sum((exponential(scale, seed + 31 * i, *keys) for i in range(1, shape)), exponential(scale, seed, *keys))


def poisson(mean: float, seed: int, *keys: Column) -> Column:
    """Poisson by counting how many steps of its distribution lie below a uniform draw."""
    import math

    steps, p, total = [], math.exp(-mean), 0.0
    k = 0
    while total < 1 - TINY and k < 10 * mean + 50:
        total += p
        steps.append(total)
        k += 1
        p *= mean / k
    u = _u(seed, *keys)
    return F.transform(F.array(u), lambda x: F.size(F.filter(F.array(*[F.lit(s) for s in steps]), lambda s: s < x)))[0]


def random_table(df: DataFrame, key: str, seed: int = 1) -> DataFrame:
    """One row per key with a draw from each distribution."""
    k = F.col(key)
    return df.select(
        key, uniform(seed, k).alias("uniform"), normal(seed + 1, k).alias("normal"), poisson(4.0, seed + 2, k).alias("poisson"),
        exponential(2.0, seed + 3, k).alias("exponential"), gamma(3, 1.5, seed + 4, k).alias("gamma"),
        log_normal(0.0, 0.5, seed + 5, k).alias("log_normal"), weibull(1.5, 2.0, seed + 6, k).alias("weibull"))


def cluster_points(df: DataFrame, key: str, clusters: int, dims: int, spread: float = 1.0, seed: int = 1) -> DataFrame:
    """Points around ``clusters`` random centres: (key, cluster, point)."""
    c = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(clusters))
    axes = [10 * normal(seed + 100 + d, c) + spread * normal(seed + 200 + d, F.col(key)) for d in range(dims)]
    return df.select(key, c.cast("int").alias("cluster"), F.array(*axes).alias("point"))


def factor_ratings(df: DataFrame, row: str, column: str, rank: int = 3, noise: float = 0.1, seed: int = 1) -> DataFrame:
    """Values of a low-rank matrix at the given (row, column) pairs, with noise."""
    value = sum((normal(seed + i, F.lit("r"), F.col(row)) * normal(seed + i, F.lit("c"), F.col(column)) for i in range(rank)), F.lit(0.0))
    return df.select(row, column, (value + noise * normal(seed + 50, F.col(row), F.col(column))).alias("value"))


def labelled_points(df: DataFrame, key: str, dims: int, seed: int = 1) -> DataFrame:
    """Points labelled by the side of a random plane, with some noise: (key, label, features)."""
    x = [normal(seed + d, F.col(key)) for d in range(dims)]
    side = sum((normal(seed + 500, F.lit(d)) * v for d, v in enumerate(x)), F.lit(0.0)) + 0.1 * normal(seed + 900, F.col(key))
    return df.select(key, (side > 0).cast("double").alias("label"), F.array(*x).alias("features"))
