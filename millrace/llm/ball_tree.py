"""Exact top-k inner products by ball trees.

The vectors are dealt into shards by a hash of their id and the queries into blocks; each pair of a shard and a block is one
group, so neither side has to fit in one task. A group builds a ball tree over its shard and answers its queries by branch
and bound: nodes leave a heap in the order of their upper bound ``q·centre + |q|·radius``, and the search of a query ends
at the first bound below its current kth score. A first pass lets every query search one shard; the kth scores found there
are shared with all other searches as their starting bound.

Components are ``floor(1024 * x)``, so scores are whole numbers and ties are exact: the smaller id wins, and nodes whose
bound equals the kth score are still opened.

Defined results
    * vectors that are null or hold a null, NaN or infinite component take no part, nor do rows without an id;
    * an id given to several rows counts once, with its smallest vector;
    * vectors are compared with those of equal length only; an empty table gives no rows;
    * a scaled component or score beyond a 64-bit integer is held at its end.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import checkpointed

SCALE = 1024
LEAF = 128
SHARD_ROWS = 8192
BLOCK_QUERIES = 1024


def scaled(vector: Column) -> Column:
    """Whole-number components, or null for a vector that takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double"))))


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    rows: slice
    children: tuple["Node", "Node"] | None = None


class BallTree:
    """Rows are reordered so that each node holds a slice of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.order = np.arange(len(ids))
        self.points = vectors.astype(np.float64)
        self.root = self._build(0, len(ids))
        self.ids, self.vectors = ids[self.order], vectors[self.order]
        self.points = self.points[self.order]
        #: products of doubles are exact while no partial sum can pass 2**53
        self.most = float(np.abs(self.points).max(initial=0))

    def _build(self, at: int, to: int) -> Node:
        stack: list[tuple[Node, int, int]] = []
        root = self._node(at, to)
        stack.append((root, at, to))
        while stack:
            node, at, to = stack.pop()
            if to - at <= LEAF or node.radius == 0:
                continue
            own = self.order[at:to]
            points = self.points[own]
            one = points[np.argmax(((points - node.centre) ** 2).sum(axis=1))]
            two = points[np.argmax(((points - one) ** 2).sum(axis=1))]
            along = points @ (two - one)
            half = (to - at) // 2
            self.order[at:to] = own[np.argsort(along, kind="stable")]
            node.children = (self._node(at, at + half), self._node(at + half, to))
            stack += [(node.children[0], at, at + half), (node.children[1], at + half, to)]
        return root

    def _node(self, at: int, to: int) -> Node:
        points = self.points[self.order[at:to]]
        centre = points.mean(axis=0)
        return Node(centre, float(np.sqrt(((points - centre) ** 2).sum(axis=1).max(initial=0))), slice(at, to))

    def scores(self, rows: slice, query: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(query.astype(np.float64)).max(initial=0)) * max(1, len(query)) < 2.0**53:
            return (self.points[rows] @ query.astype(np.float64)).astype(np.int64)
        exact = self.vectors[rows].astype(object) @ query.astype(object)
        return np.array([min(max(int(x), -(2**63)), 2**63 - 1) for x in np.atleast_1d(exact)], np.int64)

    def search(self, own: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """(score, id) of the best ``k`` but for ``own``, best first; those below ``floor`` may be left out."""
        q = query.astype(np.float64)
        length = float(np.sqrt((q * q).sum()))

        def bound(node: Node) -> float:
            most = float(node.centre @ q) + node.radius * length
            return most + 1e-9 * (abs(most) + length * (node.radius + 1)) + 1e-6

        best: list[tuple[int, int]] = []  # (score, -id): the smallest is the one to go
        heap = [(-bound(self.root), 0, self.root)]
        number = 1
        while heap:
            most, _, node = heapq.heappop(heap)
            limit = best[0][0] if len(best) == k else None
            limit = floor if limit is None else limit if floor is None else max(limit, floor)
            if limit is not None and -most < limit:
                break
            if node.children:
                for child in node.children:
                    heapq.heappush(heap, (-bound(child), number, child))
                    number += 1
                continue
            found, ids = self.scores(node.rows, query), self.ids[node.rows]
            keep = ids != own
            if limit is not None:
                keep &= found >= limit
            found, ids = found[keep], ids[keep]
            for at in np.lexsort((ids, -found))[:k]:
                entry = (int(found[at]), -int(ids[at]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                else:
                    break
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    lists = table["vector"].combine_chunks()
    return table["vec_id"].to_numpy(), lists.flatten().to_numpy().reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


def _searched(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each group's vectors for each of its queries; both sides carry dims, shard and block."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            tree = BallTree(*_arrays(left))
            for own, query, floor in zip(*_arrays(right), right["floor"].to_pylist(), strict=True):
                out += [(int(own), i, s) for s, i in tree.search(int(own), query, k, floor)]
        columns = np.array(out, np.int64).reshape(-1, 3)
        return pa.table({n: columns[:, c] for c, n in enumerate(("query_id", "vec_id", "score"))})

    keys = ("dims", "shard", "block")
    queries = queries.toDF(*queries.columns)  # both sides stem from one table
    return vectors.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest inner products of every row that ``is_query`` names
    (an expression over ``vec_id``) with all other rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector)).alias("vector"))
    rows = rows.where("vec_id is not null and vector is not null").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = checkpointed(rows.withColumn("dims", F.size("vector")))
    asked = rows.where(is_query)
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_queries))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int"))
    pilot = F.pmod(F.col("block"), F.lit(shards)).cast("int")

    of_block = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    first = _searched(of_block.where(F.col("shard") == pilot), asked.withColumns({"shard": pilot, "floor": F.lit(None).cast("long")}), k)
    first = checkpointed(_best(first, k).drop("rank"))
    kth = first.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("floor")).withColumnRenamed("query_id", "vec_id")

    of_shard = asked.join(kth, "vec_id", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rest = _searched(of_block.where(F.col("shard") != pilot), of_shard.where(F.col("shard") != pilot), k)
    return _best(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def embedding_neighbours(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("vec_id") % 100 == 0)
