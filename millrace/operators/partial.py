"""Counts, sums and means of a large table with bounds, from as many of its files as the time allows.

Files are read in random order, a group after the other, until the time is up or the bounds are near enough. A file is the
unit that is drawn: what is kept of it is a row per group of the result, with the count and sum. The bounds are Student's, from how the
files that were read differ, and narrow to nothing when all have been read. Files should be of similar make; a table sorted
by what is asked for has wide bounds, and rightly so.
"""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def student_cdf(x: float, freedom: int) -> float:
    """The share of Student's distribution below x >= 0, by Simpson's rule on an angle."""
    top, steps = math.atan(x / math.sqrt(freedom)), 400
    h = top / steps
    inside = sum((1 if k in (0, steps) else 4 if k % 2 else 2) * math.cos(k * h) ** (freedom - 1) for k in range(steps + 1)) * h / 3
    return 0.5 + inside * math.exp(math.lgamma((freedom + 1) / 2) - math.lgamma(freedom / 2)) / math.sqrt(math.pi)


def student_quantile(share: float, freedom: int) -> float:
    """The x >= 0 below which ``share`` >= 0.5 of Student's distribution lies."""
    low, high = 0.0, 1.0
    while student_cdf(high, freedom) < share and high < 1e9:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if student_cdf(mid, freedom) < share else (low, mid)
    return high


@dataclass(frozen=True)
class Estimate:
    value: float
    low: float
    high: float


def _bounded(value: float, variance: float, files: int, read: int, confidence: float) -> Estimate:
    if read == files:
        return Estimate(value, value, value)
    if read < 2:
        return Estimate(value, -math.inf, math.inf)
    off = student_quantile((1 + confidence) / 2, read - 1) * math.sqrt(max(0.0, variance))
    return Estimate(value, value - off, value + off)


def estimates(found: dict[str, dict[tuple, tuple[int, float]]], files: int, confidence: float = 0.95) -> dict[tuple, dict[str, Estimate]]:
    """Count, sum and mean of each group, from the (count, sum) by file and group; ``files`` are all files there are."""
    read = len(found)
    spread = files * files * (1 - read / files) / read if read else 0.0
    out = {}
    for group in sorted({g for rows in found.values() for g in rows}, key=repr):
        n, s = zip(*(rows.get(group, (0, 0.0)) for rows in found.values()))

        def variance(values: list[float]) -> float:
            mean = sum(values) / read
            return spread * sum((v - mean) ** 2 for v in values) / max(1, read - 1)

        count, total = files * sum(n) / read, files * sum(s) / read
        mean = sum(s) / sum(n) if sum(n) else math.nan
        # a mean is a ratio of two totals: its files differ by what is left of the sum beside the count
        ratio = variance([b - mean * a for a, b in zip(n, s)]) / count**2 if count else 0.0
        out[group] = {
            "count": _bounded(count, variance(list(map(float, n))), files, read, confidence),
            "sum": _bounded(total, variance(list(s)), files, read, confidence),
            "mean": _bounded(mean, ratio, files, read, confidence),
        }
    return out


def approximate(spark: SparkSession, files: list[str], read: Callable[[list[str]], DataFrame], value: Column, by: list[str] | None = None, seconds: float = math.inf,
                near: float = 0.0, confidence: float = 0.95, seed: int = 0, group: int = 8, clock: Callable[[], float] = time.monotonic) -> DataFrame:
    """(by..., measure, value, low, high, files_read, files) with measure count, sum and mean of the values that are not null.

    ``read`` makes the table of some of the ``files``. Reading ends after ``seconds``, at the first group of files in any case,
    or when no bound of a sum is further from it than ``near`` times the sum. The driver holds a row per file and group.
    """
    by, order = list(by or []), list(files)
    random.Random(seed).shuffle(order)
    began, found, at = clock(), {}, 0
    while at < len(order):
        part = order[at : at + group]
        rows = read(part).withColumn("_file", F.col("_metadata.file_path")).groupBy("_file", *by).agg(F.count(value).alias("_n"), F.sum(value.cast("double")).alias("_s")).collect()
        found.update({f: {} for f in part})
        seen: dict[str, str] = {}
        for r in rows:  # a file's name as Spark writes it stands for one of those asked for, whichever it is
            if r["_file"] not in seen:
                seen[r["_file"]] = part[len(seen)]
            found[seen[r["_file"]]][tuple(r[b] for b in by)] = (r["_n"], r["_s"] or 0.0)
        at += len(part)
        if clock() - began >= seconds:
            break
        sums = [e["sum"] for e in estimates(found, len(order), confidence).values()]
        if near and sums and all(e.high - e.value <= near * abs(e.value) for e in sums):
            break
    kinds = [(b, read(order[:1]).schema[b].dataType.simpleString()) for b in by] if order else []
    schema = ", ".join([*(f"`{b}` {k}" for b, k in kinds), "measure string", "value double", "low double", "high double", "files_read int", "files int"])
    out = [(*g, m, e.value, e.low, e.high, len(found), len(order)) for g, all_ in estimates(found, len(order), confidence).items() for m, e in all_.items()]
    return spark.createDataFrame(out, schema)
