"""The best items of each user by the product of their factors, exact and without meeting every pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.session import checkpointed

#: items of a cell, about, as long as there are no more than ``MOST_CELLS`` of them
CELL = 512
MOST_CELLS = 1 << 14
#: items that a task cuts into cells at once
LAID = 1 << 16
#: users whose best items are looked up among all first
SCOUTS = 512
#: users that meet the bounds of the cells, or a cell, at once
TOGETHER = 512


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _products(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Summed component by component in single precision, as the model's own predictions are."""
    total = np.zeros((len(users), len(items)), np.float32)
    for d in range(users.shape[1]):
        total += np.multiply.outer(users[:, d], items[:, d])
    return total


def _slack(width: int) -> float:
    """How far sums of ``width`` products in single precision may be off, as part of the products' sizes, twice over."""
    return 4 * (width + 2) * 2.0**-24


def _cut(v: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Row numbers in cells of at most ``size`` near rows: halves along the widest side."""
    left = [np.arange(len(v))]
    while left:
        rows = left.pop()
        if len(rows) <= size:
            yield rows
            continue
        own = v[rows]
        with np.errstate(all="ignore"):
            axis = int(np.nan_to_num(own.max(0) - own.min(0)).argmax())
        half = len(rows) // 2
        order = np.argpartition(own[:, axis], half)
        left += [rows[order[:half]], rows[order[half:]]]


def _cells(items: DataFrame) -> DataFrame:
    """The items in cells of like length and direction: (``cell``, ``ids``, ``factors``) and the bounds ``lo``, ``hi``, ``mid``, ``radius``,
    ``long``. The layout is written down, as a second run of the range partitioner's sample could draw other bounds.
    """
    count = items.count()
    size = max(CELL, -(-count // MOST_CELLS))
    laid = max(LAID, size)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, rows = TaskContext.get().partitionId() << 32, [], 0

        def cells(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal made
            ids, v = table.column("id").to_numpy(), _matrix(table.column("features"), len(table))
            with np.errstate(all="ignore"):
                wide = v.astype(np.float64)
                long = np.sqrt((wide * wide).sum(1))
                for at in _cut(wide / np.where(long == 0, 1, long)[:, None], size):
                    own = wide[at]
                    mid = own.mean(0)
                    ends = {n: pa.array([x]) for n, x in (("lo", own.min(0)), ("hi", own.max(0)), ("mid", mid))}
                    far = {"radius": pa.array([np.sqrt(((own - mid) ** 2).sum(1)).max()]), "long": pa.array([long[at].max()])}
                    yield pa.record_batch({"cell": pa.array([made]), "ids": pa.array([ids[at]]), "factors": pa.array([v[at].ravel()])} | ends | far)
                    made += 1

        for batch in batches:
            held, rows = [*held, batch], rows + batch.num_rows
            if rows >= laid:
                yield from cells(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield from cells(pa.Table.from_batches(held))

    length = F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    near = items.select("id", "features").repartitionByRange(max(1, -(-count // laid)), length, "id")
    ends = "lo array<double>, hi array<double>, mid array<double>, radius double, long double"
    return checkpointed(near.mapInArrow(cut, f"cell bigint, ids array<int>, factors array<float>, {ends}"))


def _best(score: np.ndarray, ids: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of at most the ``k`` best of each row that are not below its least one."""
    i, j = np.nonzero(~(score < least[:, None]))
    order = np.lexsort((ids[j], score[i, j], i))[::-1]
    i, j = i[order], j[order]
    rank = np.arange(len(i)) - np.searchsorted(-i, -i)
    return i[rank < k], j[rank < k]


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("user").orderBy(F.desc("rating"), F.desc("item"))
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def _scouted(cells: DataFrame, scouts: np.ndarray, k: int) -> np.ndarray:
    """Factors of the items that are among the ``k`` best of some scout."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, factors in zip(batch.column("ids"), batch.column("factors")):
                ids, v = ids.values.to_numpy(), factors.values.to_numpy().reshape(len(ids), -1)
                score = _products(scouts, v)
                kth = np.partition(score, -k, 1)[:, -k] if len(ids) > k else np.full(len(scouts), -np.inf, np.float32)
                i, j = _best(score, ids, kth, k)
                yield pa.record_batch({"user": pa.array(i.astype(np.int32)), "item": pa.array(ids[j]), "rating": pa.array(score[i, j]),
                                       "factors": pa.ListArray.from_arrays(np.arange(len(j) + 1, dtype=np.int32) * v.shape[1], v[j].ravel())})

    found = cells.select("ids", "factors").mapInArrow(look, "user int, item int, rating float, factors array<float>")
    rows = _top(found, k).dropDuplicates(["item"]).select("factors").collect()
    return np.array([r["factors"] for r in rows], np.float32).reshape(len(rows), -1)


def best_items(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(``user``, ``item``, ``rating``): the ``k`` items of each user with the highest products, of equal ones those with higher ids.

    Both sides are (``id`` int, ``features`` array<float>), ids distinct. Items lie in cells of like length and direction. The best
    items of some users are looked up among all; the kth best of these is a floor for every user, and a user meets only the cells
    whose bounds reach it: box, ball and length. So no pair that counts is left out, a task holds a cell and some users, and the
    bounds are a row per cell. Where bounds tell nothing apart all pairs are a matter of products.
    """
    cells = _cells(items)
    bounds = cells.drop("ids", "factors").toPandas()
    scouts = users.orderBy(F.xxhash64("id"), "id").limit(SCOUTS).select("features").collect()
    if not scouts or bounds.empty:
        return users.sparkSession.createDataFrame([], "user int, item int, rating float")
    known = _scouted(cells, np.array([r["features"] for r in scouts], np.float32), k)
    names, radius, long = (bounds[c].to_numpy() for c in ("cell", "radius", "long"))
    lo, hi, mid = (np.stack(bounds[c].to_list()) for c in ("lo", "hi", "mid"))
    slack = _slack(lo.shape[1])

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                ids, u = batch.column("id").to_numpy(), _matrix(batch.column("features"), batch.num_rows)
                with np.errstate(all="ignore"):
                    floor = np.partition(_products(u, known), -k, 1)[:, -k] if len(known) >= k else np.full(len(u), -np.inf, np.float32)
                    wide = u.astype(np.float64)
                    own = np.sqrt((wide * wide).sum(1))[:, None]
                    most = np.minimum(np.maximum(wide, 0) @ hi.T + np.minimum(wide, 0) @ lo.T, wide @ mid.T + own * radius)
                    met = ~(np.minimum(most, own * long) + slack * own * long < floor[:, None])
                at_cell = np.nonzero(met.any(0))[0]
                asks = [np.nonzero(met[:, c])[0] for c in at_cell]
                yield pa.record_batch({"cell": pa.array(names[at_cell]), "users": pa.array([ids[a] for a in asks], pa.list_(pa.int32())),
                                       "of_users": pa.array([u[a].ravel() for a in asks], pa.list_(pa.float32())),
                                       "floor": pa.array([floor[a] for a in asks], pa.list_(pa.float32()))})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own, u, floor, ids, v = (batch.column(c)[row].values.to_numpy() for c in ("users", "of_users", "floor", "ids", "factors"))
                with np.errstate(all="ignore"):
                    score = _products(u.reshape(len(own), -1), v.reshape(len(ids), -1))
                i, j = _best(score, ids, floor, k)
                if len(i):
                    yield pa.record_batch({"user": pa.array(own[i]), "item": pa.array(ids[j]), "rating": pa.array(score[i, j])})

    asked = users.select("id", "features").mapInArrow(reach, "cell bigint, users array<int>, of_users array<float>, floor array<float>")
    pairs = asked.join(cells.select("cell", "ids", "factors").hint("merge"), "cell").select("users", "of_users", "floor", "ids", "factors")
    return _top(pairs.mapInArrow(meet, "user int, item int, rating float"), k)
