"""Singular values of tall tables of vectors, of any width, by a random basis that each pass over the table improves.

A pass sends a basis (width x rank numbers) to the tasks, each of which adds up its rows against it; the sums meet on Spark,
and what reaches the driver is as large as the basis, whatever the number of rows. The basis is at right angles again after each
pass, and the passes end when the values no longer move. A basis as wide as the vectors is exact after one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The driver and each task hold some matrices of this many numbers.
LARGEST_BASIS = 20_000_000


def _summed(vectors: DataFrame, basis: np.ndarray, left: bool) -> np.ndarray:
    """The sum over rows a of a' (a B), or where ``left`` of (a B)' (a B)."""
    rows = basis.shape[1] if left else basis.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, basis.shape[1]))
        for batch in batches:
            if batch.num_rows:
                a = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                along = a @ basis
                total += (along if left else a).T @ along
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "line"])

    parts = vectors.mapInArrow(run, "i int, line array<double>").select("i", F.posexplode("line").alias("j", "x"))
    lines = parts.groupBy("i", "j").agg(F.sum("x").alias("x")).groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "x"))).alias("line"))
    out = np.zeros((rows, basis.shape[1]))
    for r in lines.select("i", "line.x").collect():
        out[r["i"]] = r["x"]
    return out


def svd(df: DataFrame, vector: str, k: int, seed: int = 1, extra: int = 24, passes: int = 60, close: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values of the table of vectors, and the right singular vectors (width x k).

    Null vectors are left out; all others must have the same width and no null or NaN components. Raises when the values
    have not settled to ``close`` of the largest after ``passes``.
    """
    vectors = df.select(F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL")
    facts = vectors.agg(F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high"), F.bool_or(F.exists("v", lambda x: x.isNull() | F.isnan(x))).alias("bad")).first()
    if facts["high"] is None:
        return np.zeros(0), np.zeros((0, 0))
    width = facts["high"]
    if facts["low"] != width or facts["bad"]:
        raise ValueError("vectors differ in width, or have missing components")
    rank = min(width, max(k + extra, 64))
    if width * rank > LARGEST_BASIS:
        raise ValueError(f"a basis of {width} x {rank} numbers is too large")
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, rank)))[0]
    before = None
    for _ in range(passes):
        if rank < width:
            basis = np.linalg.qr(_summed(vectors, basis, False))[0]
        squares, turn = np.linalg.eigh(_summed(vectors, basis, True))
        values = np.sqrt(np.clip(squares[::-1], 0, None))[:k]
        basis = basis @ turn[:, ::-1]
        if rank == width or before is not None and np.abs(values - before).max() <= close * max(values[0], 1e-300):
            return values, basis[:, :k]
        before = values
    raise RuntimeError(f"singular values still move by {np.abs(values - before).max():.2g} after {passes} passes")
