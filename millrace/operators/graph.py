"""Graph operators over edges(src, dst, ...) and vertices(id, ...).

Loops run on the driver but only counts come back to it; each round's state is checkpointed in the shared folder. A hub's
messages are combined on the map side before they meet, and no vertex's neighbours are gathered unless their number is
bounded.
"""

from __future__ import annotations

import math
import sys
import warnings

from collections.abc import Callable
from functools import reduce

from pyspark.ml.clustering import KMeans, PowerIterationClustering
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import checkpointed, task_slots
from millrace.sources.tables import bucketed_table

#: out-edges of a list of targets, about
FAN = 1024
#: votes of a task, about, and the parts that a vertex's votes are dealt to
TASK_ROWS = 1_000_000
PARTS = 16
#: edges up to which the library clusters by power iteration; it keeps a copy of the graph of each round in memory
LIBRARY_EDGES = 1_000_000


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()


def reverse(edges: DataFrame) -> DataFrame:
    swap = {"src": "dst", "dst": "src"}
    return edges.select(*[F.col(swap.get(c, c)).alias(c) for c in edges.columns])


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").union(edges.select("dst", "src"))


def simple_edges(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, without self loops, src < dst."""
    return edges.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def triplets(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with the attributes of both ends, as ``src_x`` and ``dst_x``."""
    def side(end):
        return vertices.select(F.col("id").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in vertices.columns if c != "id"])

    return edges.join(side("src"), "src").join(side("dst"), "dst")


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(edges.select("dst", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"), F.count("*").alias("degree"))


def aggregate_messages(vertices: DataFrame, edges: DataFrame, merge: list[Column], to_dst: Column | None = None, to_src: Column | None = None) -> DataFrame:
    """Send a value along each triplet and merge what arrives at a vertex; ``merge`` aggregates the column ``msg``."""
    t = triplets(vertices, edges)
    sent = []
    if to_dst is not None:
        sent.append(t.select(F.col("dst").alias("id"), to_dst.alias("msg")))
    if to_src is not None:
        sent.append(t.select(F.col("src").alias("id"), to_src.alias("msg")))
    return reduce(DataFrame.union, sent).where("msg IS NOT NULL").groupBy("id").agg(*merge)


def pregel(vertices: DataFrame, edges: DataFrame, message: Column, merge: Callable[[str], Column], update: Column, changed: Column,
           max_iterations: int = 100) -> DataFrame:
    """Vertices with a column ``state``; each round the vertices whose state changed send ``message`` along their out-edges.

    ``message`` may use ``state`` and the edge's columns; ``merge("msg")`` combines arrivals; ``update`` gives the new state
    from ``state`` and ``msg``, and ``changed`` says whether it counts. Ends when no vertex changes; an error if that takes
    more than ``max_iterations`` rounds.
    """
    current = checkpointed(vertices.withColumn("_live", F.col("state").isNotNull()))
    for _ in range(max_iterations):
        live = current.where("_live").select(F.col("id").alias("src"), "state")
        # merged, as a broadcast of each round's vertices would pass the driver
        sent = edges.join(live.hint("merge"), "src").select(F.col("dst").alias("id"), message.alias("msg")).where("msg IS NOT NULL")
        arrived = sent.groupBy("id").agg(merge("msg").alias("msg"))
        joined = current.drop("_live").join(arrived.hint("merge"), "id", "left")
        hit = F.col("msg").isNotNull() & F.coalesce(changed, F.lit(False))
        nxt = joined.select(*[F.when(hit, update).otherwise(F.col("state")).alias("state") if c == "state" else F.col(c) for c in vertices.columns],
                            hit.alias("_live"))
        current = checkpointed(nxt)
        if current.where("_live").isEmpty():
            return current.drop("_live")
    raise RuntimeError(f"vertices still change after {max_iterations} rounds")


def shortest_distance(edges: DataFrame, source, weight: str, max_iterations: int = 1000) -> DataFrame:
    """Smallest summed weight from one vertex to each vertex; null when it cannot be reached."""
    start = vertices_of(edges).withColumn("state", F.when(F.col("id") == source, F.lit(0.0)))
    out = pregel(start, edges, F.col("state") + F.col(weight), F.min, F.col("msg"), F.col("state").isNull() | (F.col("msg") < F.col("state")), max_iterations)
    return out.withColumnRenamed("state", "distance")


def hops_to_landmarks(edges: DataFrame, landmarks: list, max_iterations: int = 1000) -> DataFrame:
    """Hop count from each vertex to each landmark along the edges: (id, landmark, hops). Unreachable pairs have no row."""
    spark = edges.sparkSession
    kind = edges.schema["src"].dataType.simpleString()
    back = edges.select("src", "dst").distinct()
    known = checkpointed(spark.createDataFrame([(m, m, 0) for m in landmarks], f"id {kind}, landmark {kind}, hops int").join(vertices_of(edges), "id", "left_semi"))
    frontier = known
    for step in range(1, max_iterations + 1):
        reached = back.join(frontier.select(F.col("id").alias("dst"), "landmark"), "dst").select(F.col("src").alias("id"), "landmark").distinct()
        fresh = checkpointed(reached.join(known, ["id", "landmark"], "left_anti").withColumn("hops", F.lit(step)))
        if fresh.isEmpty():
            return known
        known = checkpointed(known.union(fresh))
        frontier = fresh
    raise RuntimeError(f"landmarks are still being reached after {max_iterations} steps")


def connected_components(edges: DataFrame, vertices: DataFrame | None = None, max_rounds: int = 50) -> DataFrame:
    """Each vertex with the lowest vertex id of its component, by alternating large and small stars.

    The number of rounds grows with the logarithm of the longest path, not with its length.
    """
    ids = vertices_of(edges) if vertices is None else vertices.select("id").distinct()
    pairs = checkpointed(simple_edges(edges).select(F.col("dst").alias("u"), F.col("src").alias("v")))
    seen = None
    for _ in range(max_rounds):
        # large star: link every larger neighbour to the smallest id around the vertex
        around = pairs.union(pairs.select("v", "u"))
        low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: link the vertex and its smaller neighbours to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("p"))
        pairs = checkpointed(small.select(F.col("p.v").alias("u"), F.col("p.m").alias("v")).where("u <> v").distinct())
        mark = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    lowest = pairs.groupBy("u").agg(F.min("v").alias("component"))
    return ids.join(lowest, ids["id"] == lowest["u"], "left").select("id", F.coalesce("component", "id").alias("component"))


def _fans(edges: DataFrame) -> DataFrame:
    """The edges as (``src``, ``fan``): lists of up to about ``FAN`` targets of a vertex, and its ``d`` out-edges, so that a round's
    join moves and sorts a row per list; the lists of a hub are many.
    """
    out = edges.groupBy("src").agg(F.count("*").alias("d"))
    dealt = edges.join(out, "src").withColumn("_part", F.pmod(F.xxhash64("dst"), F.ceil(F.col("d") / FAN)))
    return checkpointed(dealt.groupBy("src", "d", "_part").agg(F.collect_list(F.struct("dst")).alias("fan")).drop("_part"))  # a list would lose a missing target


def _in_tasks(rows: DataFrame, count: int, *keys: str) -> DataFrame:
    """The rows by their keys, in tasks of about ``TASK_ROWS``, however few the session's reduce tasks are."""
    return rows.repartition(max(task_slots(rows.sparkSession), -(-count // TASK_ROWS)), *keys)


def label_propagation(edges: DataFrame, steps: int) -> DataFrame:
    """Exactly ``steps`` rounds; each vertex takes the most frequent label around it, the lowest one among equals."""
    edges = checkpointed(edges.select("src", "dst"))
    around = _fans(both_ways(edges))
    count = around.agg(F.sum(F.size("fan"))).first()[0] or 0
    labels = vertices_of(edges).withColumn("label", F.col("id"))
    for _ in range(steps):
        sent = around.join(labels.select(F.col("id").alias("src"), "label"), "src").select(F.explode("fan.dst").alias("id"), "label")
        # a hub's votes are dealt by label as well; each part sends its best one on
        sent = _in_tasks(sent.withColumn("_part", F.pmod(F.xxhash64("label"), F.lit(PARTS))), count, "id", "_part")
        votes = sent.groupBy("id", "_part", "label").agg(F.count("*").alias("n"))
        part = votes.groupBy("id", "_part").agg(F.max(F.struct(F.col("n"), (-F.col("label")).alias("neg"))).alias("b"))
        best = _in_tasks(part.select("id", "b"), count, "id").groupBy("id").agg(F.max("b").alias("b"))
        labels = checkpointed(best.select("id", (-F.col("b.neg")).alias("label")))
    return labels


def triangle_count(edges: DataFrame) -> DataFrame:
    """Triangles through each vertex. Edges point from the lower to the higher degree, so a vertex keeps at most
    sqrt(2 * edges) out-neighbours; each edge then intersects two such lists and only real triangles are emitted.
    """
    e = checkpointed(simple_edges(edges))
    deg = both_ways(e).groupBy("src").agg(F.count("*").alias("d"))
    ranked = e.join(deg, "src").withColumnRenamed("d", "ds").join(deg.select(F.col("src").alias("dst"), F.col("d").alias("dd")), "dst")
    up = (F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd")) & (F.col("src") < F.col("dst")))
    oriented = checkpointed(ranked.select(F.when(up, F.col("src")).otherwise(F.col("dst")).alias("src"), F.when(up, F.col("dst")).otherwise(F.col("src")).alias("dst")))
    out = oriented.groupBy("src").agg(F.collect_list("dst").alias("out"))
    met = oriented.join(out, "src").join(out.select(F.col("src").alias("dst"), F.col("out").alias("out2")), "dst")
    third = met.select("src", "dst", F.explode(F.array_intersect("out", "out2")).alias("w"))
    corners = third.select(F.explode(F.array("src", "dst", "w")).alias("id")).groupBy("id").agg(F.count("*").alias("triangles"))
    return vertices_of(edges).join(corners, "id", "left").na.fill(0, ["triangles"])


def page_rank(edges: DataFrame, iterations: int | None = 10, tolerance: float | None = None, reset: float = 0.15, max_iterations: int = 200) -> DataFrame:
    """rank = reset + (1 - reset) * sum of rank / out-degree over in-links, from 1.0, a fixed number of times or until no
    rank moves by more than ``tolerance``.
    """
    links = checkpointed(edges.select("src", "dst"))
    fans = _fans(links)
    ranks = checkpointed(vertices_of(links).withColumn("rank", F.lit(1.0)))
    for _ in range(max_iterations if iterations is None else iterations):
        sent = fans.join(ranks.withColumnRenamed("id", "src"), "src").select(F.explode("fan.dst").alias("id"), (F.col("rank") * (1.0 / F.col("d"))).alias("g"))
        given = sent.groupBy("id").agg(F.sum("g").alias("g"))
        nxt = checkpointed(ranks.withColumnRenamed("rank", "old").join(given, "id", "left").select(
            "id", "old", (reset + (1 - reset) * F.coalesce("g", F.lit(0.0))).alias("rank")))
        moved = tolerance is not None and nxt.agg(F.max(F.abs(F.col("rank") - F.col("old")))).first()[0] <= tolerance
        ranks = nxt.drop("old")
        if moved:
            return ranks
    if iterations is None:
        raise RuntimeError(f"ranks still move by more than {tolerance} after {max_iterations} rounds")
    return ranks


def power_iteration_clusters(edges: DataFrame, k: int, max_iterations: int = 20, start: str = "random", library_edges: int | None = None) -> DataFrame:
    """``id`` and ``cluster`` of each vertex of an undirected graph of edges (``src``, ``dst``, ``w``), by power iteration clustering.

    Up to ``library_edges`` pairs of vertices (``LIBRARY_EDGES``) this is the library's own; beyond, the same steps run over tables:
    the weights of a vertex are divided by their sum, the matrix is applied to a ``start`` ("random" or "degree") until the
    steps' difference settles, but ``max_iterations`` times at most, and the values are clustered by k-means. Repeated edges add up, loops
    are left out, a missing id or a weight that is missing, negative or not finite is an error, as in the library. The random
    start is normally distributed as the library's, but drawn by vertex id: the library's own depends on how many
    tasks there are, and so do its clusters. The start of k-means depends on the layout in both.
    """
    if start not in ("random", "degree"):
        raise ValueError(f"no start {start}")
    given = edges.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint"), F.col("w").cast("double"))
    wrong = F.col("src").isNull() | F.col("dst").isNull() | F.col("w").isNull() | F.isnan("w") | (F.col("w") < 0) | (F.col("w") == math.inf)
    links = checkpointed(given.groupBy("src", "dst").agg(F.sum("w").alias("w"), F.count_if(wrong).alias("wrong")))
    if links.count() <= (LIBRARY_EDGES if library_edges is None else library_edges):
        return PowerIterationClustering(k=k, maxIter=max_iterations, initMode=start, srcCol="src", dstCol="dst", weightCol="w").assignClusters(edges)
    count, bad = links.agg(F.count_if(F.col("src") != F.col("dst")), F.sum("wrong")).first()
    if bad:
        raise ValueError(f"{bad} edges with a missing id or a weight that is missing, negative or not finite")
    links = links.where("src <> dst").drop("wrong")
    links = links.union(links.select("dst", "src", "w"))
    ends = checkpointed(links.groupBy("src").agg(F.sum("w").alias("total"), F.ceil(F.count("*") / FAN).alias("lists")))
    fans = _weighted_fans(links, ends, 2 * count)
    x = F.col("total") if start == "degree" else _normal("src")
    state = checkpointed(ends.select(F.col("src").alias("id"), "total", "lists", x.alias("x")))
    vertices, norm = state.agg(F.count("*"), F.sum(F.abs("x"))).first()
    tolerance = max(1e-5 / max(vertices, 1), 1e-8)
    x = F.col("x") / (norm or math.nan)
    moved = settled = sys.float_info.max
    for _ in range(max_iterations):
        if not settled > tolerance:
            break
        # a vertex's value goes to each of its lists; these stay where they are
        told = state.select(F.col("id").alias("src"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lists") - 1)).alias("_part"), x.alias("x"))
        sent = fans.join(told.hint("shuffle_hash"), ["src", "_part"]).select("x", F.inline(F.arrays_zip("dst", "w")).alias("id", "w"))
        merged = sent.groupBy("id").agg(F.sum(F.col("x") * F.col("w")).alias("y"))
        old = state.select("id", "total", "lists", x.alias("old"))
        state = checkpointed(old.join(merged, "id").select("id", "total", "lists", "old", (F.col("y") / F.greatest("total", F.lit(sys.float_info.epsilon))).alias("x")))
        norm = state.agg(F.sum(F.abs("x"))).first()[0] or math.nan
        x = F.col("x") / norm
        was, (moved, across, square) = moved, state.agg(F.sum(F.abs(F.col("old") - x)), F.sum(F.col("old") * x), F.sum(F.col("old") * F.col("old"))).first()
        settled = abs(moved - was)
        if settled < tolerance and abs(norm - abs(across / square)) > tolerance:
            warnings.warn("the power iteration may not have converged", stacklevel=2)
    points = state.select("id", array_to_vector(F.array(x)).alias("features"))
    model = KMeans(k=k, seed=0, maxIter=20, initSteps=2, tol=1e-4, solver="row").fit(points)
    return model.transform(points).select("id", F.col("prediction").alias("cluster"))


def _weighted_fans(links: DataFrame, ends: DataFrame, count: int) -> DataFrame:
    """The edges as (``src``, ``_part``, ``dst``, ``w``): lists of up to about ``FAN`` targets and weights, in buckets of about ``TASK_ROWS``
    edges, so that a round moves no list. Only vertices with several lists are looked up to deal their edges.
    """
    wide = checkpointed(ends.where("lists > 1").select("src", "lists"))
    dealt = links.join(wide, "src", "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("dst"), F.col("lists")), F.lit(0).cast("bigint")))
    buckets = max(task_slots(links.sparkSession), -(-count // TASK_ROWS))
    lists = dealt.repartition(buckets, "src", "_part").groupBy("src", "_part").agg(F.collect_list(F.struct("dst", "w")).alias("fan"))
    return bucketed_table(lists.select("src", "_part", "fan.dst", "fan.w"), "fans", ["src", "_part"], buckets, rebalance=False)


def _normal(key: str) -> Column:
    """A normally distributed number by a key alone."""
    even = [(F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) + 1) * 2.0**-53 for seed in (1, 2)]
    return F.sqrt(-2 * F.log(even[0])) * F.cos(2 * math.pi * even[1])


def transitive_closure(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """All reachable pairs. Each round joins the new paths with all known ones, so path lengths double."""
    known = checkpointed(edges.select("src", "dst").distinct())
    fresh = known
    for _ in range(max_rounds):
        left = fresh.select("src", F.col("dst").alias("mid")).join(known.select(F.col("src").alias("mid"), "dst"), "mid").select("src", "dst")
        right = known.select("src", F.col("dst").alias("mid")).join(fresh.select(F.col("src").alias("mid"), "dst"), "mid").select("src", "dst")
        fresh = checkpointed(left.union(right).distinct().join(known, ["src", "dst"], "left_anti"))
        if fresh.isEmpty():
            return known
        known = checkpointed(known.union(fresh))
    raise RuntimeError(f"the closure did not settle in {max_rounds} rounds")


def levels(parents: DataFrame, child: str, parent: str, max_levels: int = 10_000) -> DataFrame:
    """Depth of each node of a forest given as child and parent; a row whose parent is null or no node is a root at 1.

    Raises when nodes are left that no root leads to, as those on a cycle.
    """
    links = parents.select(F.col(child).alias("id"), F.col(parent).alias("up"))
    nodes = links.select(F.col("id").alias("up"))
    frontier = checkpointed(links.join(nodes, "up", "left_anti").select("id", F.lit(1).alias("level")))
    found = frontier
    for depth in range(2, max_levels + 1):
        frontier = checkpointed(links.join(frontier.select(F.col("id").alias("up")), "up", "left_semi").select("id", F.lit(depth).alias("level")))
        if frontier.isEmpty():
            left = links.where("id IS NOT NULL").join(found.select("id"), "id", "left_anti").limit(1).collect()
            if left:
                raise RuntimeError(f"no root leads to {left[0]['id']}: it is on a cycle or below one")
            return found
        found = checkpointed(found.union(frontier))
    raise RuntimeError(f"the forest is deeper than {max_levels} levels")


def edge_partition(edges: DataFrame, strategy: str, parts: int, name: str = "part") -> DataFrame:
    """A partition number per edge: ``1d`` by source, ``2d`` by a grid of source and target, ``random`` by the directed
    pair, ``canonical`` by the undirected pair. Follow with ``repartition(parts, name)``.
    """
    src, dst = F.col("src"), F.col("dst")
    if strategy == "1d":
        p = F.pmod(F.xxhash64(src), F.lit(parts))
    elif strategy == "2d":
        # one end picks the row of a grid, the other the column, so a vertex meets one row or one column of parts
        rows = math.isqrt(parts)
        columns = parts // rows
        p = F.pmod(F.xxhash64(src), F.lit(rows)) * columns + F.pmod(F.xxhash64(dst), F.lit(columns))
    elif strategy == "random":
        p = F.pmod(F.xxhash64(src, dst), F.lit(parts))
    elif strategy == "canonical":
        p = F.pmod(F.xxhash64(F.least(src, dst), F.greatest(src, dst)), F.lit(parts))
    else:
        raise ValueError(f"no partition strategy {strategy}")
    return edges.withColumn(name, p.cast("int"))
