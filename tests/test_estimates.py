"""Bounds from part of the files, one-pass reservoirs, singular values, and moments over range frames."""

import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import linalg, partial as op, sampling as sp, windows as ow


def test_student_quantiles():
    # tabled values, two-sided 95 and 99 %
    for freedom, share, want in ((1, 0.975, 12.706), (4, 0.975, 2.776), (10, 0.995, 3.169), (30, 0.975, 2.042), (1000, 0.975, 1.962)):
        assert abs(op.student_quantile(share, freedom) - want) < 1e-3


def test_bounds_hold_in_the_stated_share():
    """Without Spark: many tables of files, each asked for a few of them."""
    r, held, asked = random.Random(1), Counter(), 400
    for _ in range(asked):
        files = {str(i): {(g,): (n := r.randint(50, 150), sum(r.gauss(10, 4) for _ in range(n))) for g in "ab"} for i in range(60)}
        part = {k: files[k] for k in r.sample(sorted(files), 15)}
        n, s = (sum(f[("a",)][k] for f in files.values()) for k in range(2))
        for name, e in op.estimates(part, len(files), 0.95)[("a",)].items():
            held[name] += e.low <= {"count": n, "sum": s, "mean": s / n}[name] <= e.high
    assert all(0.91 * asked <= held[m] <= 0.99 * asked for m in ("count", "sum", "mean"))


def test_approximate_reads_until_the_time_is_up(spark, tmp_path):
    rows = spark.range(4000).select((F.col("id") % 3).alias("k"), (F.col("id") % 50).alias("v")).repartition(20)
    rows.write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    read = lambda files: spark.read.schema(table.schema).parquet(*files)
    clock = iter([0, 5, 11, 20])
    part = op.approximate(spark, table.inputFiles(), read, F.col("v"), ["k"], seconds=10, group=4, clock=lambda: next(clock)).collect()
    assert {r["files_read"] for r in part} == {8} and all(r["low"] <= r["value"] <= r["high"] for r in part) and len(part) == 9
    near = op.approximate(spark, table.inputFiles(), read, F.col("v"), near=0.5, group=4).collect()
    assert near[0]["files_read"] < 20
    whole = {r["measure"]: r["value"] for r in op.approximate(spark, table.inputFiles(), read, F.col("v")).collect()}
    assert whole == {"count": 4000, "sum": sum(i % 50 for i in range(4000)), "mean": 24.5}


def test_reservoir_is_even(spark):
    df = spark.range(0, 60, 1, 3).withColumn("_draw", F.lit("own"))
    seen = Counter()
    for seed in range(60):
        found, total = sp.reservoir_and_count(df, 20, seed)
        rows = [tuple(r) for r in found.collect()]
        assert total == 60 and len(set(rows)) == 20 and all(d == "own" for _, d in rows)
        seen.update(i for i, _ in rows)
    chi = sum((seen[i] - 20) ** 2 / 20 for i in range(60))
    # 59 degrees, and drawn without replacement, which takes a third away
    assert chi * 1.5 < 100 and min(seen.values()) > 5
    assert sp.reservoir_and_count(df.limit(0), 5, 1)[1] == 0
    few, total = sp.reservoir_and_count(df.limit(4), 9, 1)
    assert total == 4 and few.count() == 4


def test_reservoir_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        found, total = sp.reservoir_and_count(spark.range(0, 5000, 1, 2), 100, 4)
        ids = [r["id"] for r in found.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert total == 5000 and len(set(ids)) == 100 and 1900 < statistics.mean(ids) < 3100


@pytest.mark.parametrize("width, rows", [(5, 40), (64, 300), (130, 400)])
def test_singular_values(spark, width, rows):
    r = np.random.default_rng(3)
    a = r.standard_normal((rows, width)) * np.geomspace(10, 0.1, width)
    df = spark.createDataFrame([(x.tolist(),) for x in a] + [(None,)], "v array<double>").repartition(4)
    values, right = linalg.svd(df, "v", 5)
    want = np.linalg.svd(a, compute_uv=False)[:5]
    assert np.abs(values - want).max() < 1e-6
    assert np.abs(np.linalg.norm(a @ right, axis=0) - want).max() < 1e-4
    with pytest.raises(ValueError):
        linalg.svd(df.union(spark.createDataFrame([([1.0],)], "v array<double>")), "v", 5)
    assert len(linalg.svd(df.limit(0), "v", 5)[0]) == 0


@pytest.mark.parametrize("min_rows", [20, 10**9])
def test_range_moments(spark, min_rows):
    r = random.Random(9)
    rows = [(i, k, r.randint(0, 30), 1e9 + r.random() if i % 9 else None, r.random() if i % 11 else None) for i, k in enumerate([None] * 60 + [1] * 15 + [2])]
    df = spark.createDataFrame(rows, "id int, k int, at int, x double, y double")
    got = {g["id"]: g for g in ow.range_moments(df, ["k"], "at", 6, 2, F.col("x"), F.col("y"), min_rows=min_rows, slices=4).collect()}
    for i, k, at, _, _ in rows:
        pairs = [(x - 1e9, y) for _, j, b, x, y in rows if j == k and at - 6 <= b <= at + 2 and x is not None and y is not None]
        g = got[i]
        assert g["n"] == len(pairs)
        if len(pairs) < 2:
            continue
        x, y = zip(*pairs)
        assert abs(g["mean"] - 1e9 - statistics.mean(x)) < 1e-6 and abs(g["var_pop"] - statistics.pvariance(x)) < 1e-9
        sd = statistics.pstdev(x)
        assert abs(g["skewness"] - sum((v - statistics.mean(x)) ** 3 for v in x) / len(x) / sd**3) < 1e-5
        assert math.isclose(g["corr"], statistics.correlation(x, y), abs_tol=1e-5)
