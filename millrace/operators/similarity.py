"""Exact similarity joins of sets and of vectors: blocks of both sides meet a pair at a time, and few of their rows are measured."""

from __future__ import annotations

import math
import random

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.ml.feature import MinHashLSHModel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from millrace.operators.joins import broadcast_join, is_small
from millrace.session import checkpointed

#: where sets have at most so many different items together, each item has a bit of its own
COMMON = 512
#: 64 bits each that the items of a set are hashed to: at least and at most so many, and more than twice 1 / FULL bits an item
LEAST_WORDS, MOST_WORDS, FULL = 4, 256, 1.5
#: sets of a block, about: two blocks meet in a task
BLOCK = 8192
#: a block's rows and columns that are compared at once
TILE = (64, 2048)
#: pairs of sets that leave a task at once, about
SENT = 1 << 17
#: pairs whose items are counted in a group, about
GROUP = 4096
#: ids that are sent to every task, at most
IDS = 1_000_000
#: vectors of a box, about: two boxes meet in a task
BOX = 4096
#: pairs of vectors that a task measures at once
PAIRS = 1 << 20


def distinct_sets(df: DataFrame, id_col: str, items: Column) -> tuple[DataFrame, DataFrame]:
    """Sets and members: (``id``, ``items`` sorted, ``n`` of items) for each different set that is not empty, under its
    smallest id, and (``id``, ``member``) for every row with a set.

    So equal sets are one from here on, and a group of copies costs one row each. The sets are written down once, and digests travel
    in their place: only sets of ids that stand for no set, or come several times, are dealt out.
    """
    # sort_array compares by code that is made for the type
    sets = df.select(F.col(id_col).alias("member"), F.sort_array(F.array_distinct(F.filter(items, lambda x: x.isNotNull()))).alias("items"))
    # equal sets meet by a digest, so that the arrays themselves are not the key of the shuffle's order
    # what is empty goes when it is written: before, the sets would be made twice, for the test and for the result
    keyed = checkpointed(sets.withColumn("key", F.sha2(F.to_json("items"), 256))).where("size(items) > 0")
    named = checkpointed(keyed.groupBy("key").agg(F.min("member").alias("id")))
    members = checkpointed(keyed.select("key", "member").join(named, "key").select("id", "member"))
    seen = members.groupBy("member").agg(F.count("*").alias("rows"), F.min("id").alias("id"))
    odd = checkpointed(seen.where("member is not null and (rows > 1 or id <> member)").select("member"))

    def chosen(rows: DataFrame) -> DataFrame:
        k = rows.alias("k").join(named.alias("n"), F.expr("k.key = n.key and k.member = n.id"))
        return checkpointed(k.select("id", "items").dropDuplicates(["id"]))

    if not is_small(odd, IDS):
        whole = chosen(keyed)
    else:
        others = keyed.where("member is not null").join(F.broadcast(odd), "member", "left_anti").select(F.col("member").alias("id"), "items")
        whole = others.unionByName(chosen(keyed.join(F.broadcast(odd), "member", "left_semi")))
    return whole.withColumn("n", F.size("items")), members


def _universe(sets: DataFrame) -> np.ndarray | None:
    """The hashes of all items in order, if there are at most ``COMMON``."""
    hashes = sets.select(F.explode(F.transform("items", lambda x: F.xxhash64(x))).alias("h"))
    if (hashes.agg(F.approx_count_distinct("h")).first()[0] or 0) > 2 * COMMON:
        return None
    found = hashes.distinct().limit(COMMON + 1).collect()
    return np.array(sorted(r["h"] for r in found), np.int64) if len(found) <= COMMON else None


def _marked(sets: DataFrame, universe: np.ndarray | None) -> DataFrame:
    """(``id``, ``n``, ``words``, ``marks``): the bits that a set's items have, or hash to, in ``words`` times 64 bits."""
    hashed = sets.select("id", "n", F.transform("items", lambda x: F.xxhash64(x)).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lists = batch.column(1).to_numpy().astype(np.int64), batch.column(2)
            if universe is not None:
                words = np.full(len(n), max(1, -(-len(universe) // 64)))
            else:
                words = np.clip(1 << np.ceil(np.log2(np.maximum(n * FULL / 64, 1))).astype(np.int64), LEAST_WORDS, MOST_WORDS)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            flat, marks = lists.flatten().to_numpy(), [b""] * len(n)
            for w in np.unique(words).tolist():
                rows, step = np.flatnonzero(words == w), max(1, (1 << 18) // w)
                for part in (rows[at : at + step] for at in range(0, len(rows), step)):
                    h = np.concatenate([flat[ends[r] : ends[r + 1]] for r in part])
                    at = np.searchsorted(universe, h) if universe is not None else (h.view(np.uint64) % np.uint64(64 * w)).astype(np.int64)
                    bits = np.zeros((len(part), 64 * w), bool)
                    bits[np.repeat(np.arange(len(part)), ends[part + 1] - ends[part]), at] = True
                    for r, m in zip(part.tolist(), np.packbits(bits, axis=1, bitorder="little")):
                        marks[r] = m.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.int32()), pa.array(marks, pa.binary())], names=["id", "n", "words", "marks"])

    return hashed.mapInArrow(run, StructType([*hashed.schema.fields[:2], StructField("words", IntegerType()), StructField("marks", BinaryType())]))


def _blocked(sets: DataFrame, universe: np.ndarray | None) -> DataFrame:
    """Blocks of sets of like sizes and as many words, a row each: ``block``, the least and largest size, and what its sets have."""
    marked = checkpointed(_marked(sets, universe))
    blocks = max(1, -(-marked.count() // BLOCK))
    # a number of the block: its partition, and the words of its sets
    dealt = marked.repartitionByRange(blocks, "words", "n", F.xxhash64("id")).withColumn("part", F.spark_partition_id())
    made = [StructField("block", LongType()), StructField("lo", IntegerType()), StructField("hi", IntegerType()), StructField("ids", ArrayType(sets.schema["id"].dataType)), StructField("sizes", BinaryType()), StructField("marks", BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (batches := list(batches)):
            return
        rows = pa.Table.from_batches(batches)
        for w in sorted(set(rows["words"].to_pylist())):
            own = rows.filter(pa.array(rows["words"].to_numpy() == w)).sort_by("n").combine_chunks()
            n = own["n"].to_numpy().astype(np.int32)
            ids = own["id"].combine_chunks()
            ids = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), ids)
            values = [pa.array([own["part"][0].as_py() * 2 * MOST_WORDS + w], pa.int64()), *(pa.array([int(x)], pa.int32()) for x in (n[0], n[-1])), ids, pa.array([n.tobytes()]), pa.array([b"".join(own["marks"].to_pylist())])]
            yield pa.RecordBatch.from_arrays(values, names=[f.name for f in made])

    return checkpointed(dealt.mapInArrow(run, StructType(made)))


def _met(x: DataFrame, y: DataFrame, near: Callable[[str, str], Column], meet: Callable[[dict, dict], Iterator[dict]], made: StructType, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``meet`` finds in each pair of blocks that are ``near``, finished and written down.

    Blocks are rows of few, large cells. Tasks read the written blocks of both sides again for each pair of their partitions, so
    nothing is copied to disk for its many meetings, and hold two blocks beside the right partition.
    """
    l, r = x.select(*[F.col(c).alias(f"l_{c}") for c in x.columns]), y.select(*[F.col(c).alias(f"r_{c}") for c in y.columns])
    pairs = l.join(r.hint("shuffle_replicate_nl"), near("l_", "r_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cells = {n: c.slice(k, 1).flatten() if pa.types.is_list(c.type) else c[k].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                for found in meet(*({n[2:]: v for n, v in cells.items() if n.startswith(side)} for side in ("l_", "r_"))):
                    yield pa.RecordBatch.from_arrays([found[f.name] for f in made], names=[f.name for f in made])

    conf, name = x.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, "1")  # a pair of blocks is a batch
    try:
        return checkpointed(finish(pairs.mapInArrow(run, made)))
    finally:
        conf.set(name, before)


def _alike(u: np.ndarray, nu: np.ndarray, v: np.ndarray, nv: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of sets whose sizes and marks allow as many shared items as the threshold asks; of one block, each pair once."""
    words = min(u.shape[1], v.shape[1])
    u, v = (np.bitwise_or.reduce(m.reshape(len(m), -1, words), axis=1) for m in (u, v))
    # items beyond a set's bits
    more_u, more_v = (n - np.bitwise_count(m).sum(1, dtype=np.int64) for n, m in ((nu, u), (nv, v)))
    u, v = np.ascontiguousarray(u.T), np.ascontiguousarray(v.T)
    part, (high, wide) = threshold / (1 + threshold), TILE
    both, ones, shared = np.empty(TILE, np.uint64), np.empty(TILE, np.uint8), np.empty(TILE, np.uint16)
    for at in range(0, len(nu), high):
        rows = slice(at, min(at + high, len(nu)))
        for to in range(0, len(nv), wide):
            cols = slice(to, min(to + wide, len(nv)))
            if (same and cols.stop <= rows.start) or nv[cols.stop - 1] < threshold * nu[at] - 1e-9 or nu[rows.stop - 1] < threshold * nv[to] - 1e-9:
                continue
            shape = (slice(0, rows.stop - at), slice(0, cols.stop - to))
            b, o, s = both[shape], ones[shape], shared[shape]
            s[:] = 0
            for k in range(words):
                np.bitwise_and(u[k, rows, None], v[k, None, cols], out=b)
                np.bitwise_count(b, out=o)
                np.add(s, o, out=s)
            least = np.ceil(part * (nu[rows] + nv[to]) - 1e-9) - np.minimum(more_u[rows], more_v[cols].max())
            i, j = np.nonzero(s >= np.clip(least, 0, 65535).astype(np.uint16)[:, None])
            if not len(i):
                continue
            a, c = i + at, j + to
            fits = s[i, j] + np.minimum(more_u[a], more_v[c]) >= np.ceil(part * (nu[a] + nv[c]) - 1e-9)
            fits &= np.minimum(nu[a], nv[c]) >= threshold * np.maximum(nu[a], nv[c]) - 1e-9
            if same:
                fits &= a < c
            if fits.any():
                yield a[fits], c[fits]


def set_join(left: DataFrame, right: DataFrame | None, threshold: float) -> DataFrame:
    """All pairs of sets whose shared items are at least ``threshold`` of their items together: (``a``, ``b``, ``shared``).

    ``left`` and ``right`` are sets as ``distinct_sets`` gives them, to be read several times; without ``right`` the pairs of ``left`` with a < b. A set
    stands as bits: one for each item where there are few different ones, else some hundred that grow with the set and that its items
    are hashed to. Blocks of sets of like sizes meet a pair at a time. The bits of two sets bound the items that they share, so the
    sets themselves meet only where the bits leave them alike, and are counted in full. The bits take some 100 bytes a set; all pairs
    of like sizes are compared by them, at a few nanoseconds each.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    alone = right is None
    universe = _universe(left if right is None else left.select("items").unionByName(right.select("items")))
    x = _blocked(left, universe)
    y = x if right is None else _blocked(right, universe)

    def near(l: str, r: str) -> Column:
        fits = (F.col(f"{l}hi") >= F.lit(threshold) * F.col(f"{r}lo") - 1e-9) & (F.col(f"{r}hi") >= F.lit(threshold) * F.col(f"{l}lo") - 1e-9)
        return fits & (F.col(f"{l}block") <= F.col(f"{r}block")) if alone else fits

    def meet(a: dict, b: dict) -> Iterator[dict]:
        (u, nu), (v, nv) = ((np.frombuffer(s["marks"], np.uint64).reshape(len(n), -1), n) for s in (a, b) for n in [np.frombuffer(s["sizes"], np.int32).astype(np.int64)])
        kept, held = [], 0
        for pair in _alike(u, nu, v, nv, threshold, alone and a["block"] == b["block"]):
            kept, held = [*kept, pair], held + len(pair[0])
            if held >= SENT:
                yield sent(a, b, kept)
                kept, held = [], 0
        if kept:
            yield sent(a, b, kept)

    def sent(a: dict, b: dict, kept: list) -> dict:
        return {name: side["ids"].take(pa.array(np.concatenate(at))) for name, side, at in zip("ab", (a, b), zip(*kept))}

    made = StructType([StructField("a", left.schema["id"].dataType), StructField("b", (left if right is None else right).schema["id"].dataType)])
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b") if alone else df
    pairs = _met(x, y, near, meet, made, ordered)

    counted = _counted(pairs, left, left if right is None else right, alone)
    return counted.where(F.col("shared") >= F.lit(threshold) * (F.col("n") - F.col("shared")) - F.lit(1e-9)).select("a", "b", "shared")


def _counted(pairs: DataFrame, left: DataFrame, right: DataFrame, alone: bool) -> DataFrame:
    """The pairs with the items that both have (``shared``) and the items of each together (``n``).

    Pairs are dealt to groups by the least neighbour of their first set, so that sets that are all alike are in one group, and
    each of them goes there once, not with every pair.
    """
    ends = pairs.select("a", F.col("b").alias("to"))
    if alone:
        ends = ends.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("to"))).unionByName(pairs.select("a", F.col("a").alias("to")))
    groups = max(1, -(-pairs.count() // GROUP))
    least = ends.groupBy("a").agg(F.pmod(F.xxhash64(F.min("to")), F.lit(groups)).alias("k"))
    dealt = checkpointed(pairs.join(least, "a").select("k", "a", "b"))

    def sets(side: DataFrame, name: str) -> DataFrame:
        own = side.select(F.col("id").alias(name), "items")
        return broadcast_join(own, dealt.select("k", name).distinct(), name, "inner", IDS).select(F.col("k").alias("g"), *[F.col(c) if c == name else F.lit(None).cast(dealt.schema[c].dataType).alias(c) for c in "ab"], "items")

    def count(found: pa.Table, rows: pa.Table) -> pa.Table:
        lists = rows["items"].combine_chunks()
        items, ends = lists.flatten().dictionary_encode(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        codes, at = items.indices.to_numpy(), {}
        for c in "ab":
            own = np.flatnonzero(rows[c].is_valid().to_numpy())
            at[c] = own[pc.index_in(found[c], value_set=rows[c].take(pa.array(own))).to_numpy()]
        sizes, shared, has = np.diff(ends), np.zeros(len(found), np.int32), np.zeros(len(items.dictionary), np.int32)
        order = np.argsort(at["a"], kind="stable")
        for part in np.split(order, 1 + np.flatnonzero(np.diff(at["a"][order]))):
            own = codes[ends[at["a"][part[0]]] : ends[at["a"][part[0]] + 1]]
            has[own] = 1
            for low in range(0, len(part), 256):
                some = at["b"][part[low : low + 256]]
                hits = has[np.concatenate([codes[ends[k] : ends[k + 1]] for k in some])]
                shared[part[low : low + 256]] = np.add.reduceat(hits, np.cumsum(sizes[some]) - sizes[some])
            has[own] = 0
        n = (sizes[at["a"]] + sizes[at["b"]]).astype(np.int32)
        return pa.table({"a": found["a"], "b": found["b"], "shared": pa.array(shared), "n": pa.array(n)})

    made = StructType([dealt.schema["a"], dealt.schema["b"], StructField("shared", IntegerType()), StructField("n", IntegerType())])
    both = sets(left, "a").unionByName(sets(right, "b"))
    return dealt.groupBy("k").cogroup(both.groupBy("g")).applyInArrow(count, made)


def directions(width: int, count: int, seed: int = 1) -> list[list[float]]:
    """Unit vectors at right angles to each other, at most ``width`` of them."""
    rnd, found = random.Random(seed), []
    while len(found) < min(count, width):
        v = [rnd.gauss(0, 1) for _ in range(width)]
        for u in found:
            along = sum(x * y for x, y in zip(u, v))
            v = [y - along * x for x, y in zip(u, v)]
        norm = math.sqrt(sum(x * x for x in v))
        found.append([x / norm for x in v])
    return found


def distance(x: Column, y: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))


def _given(side: DataFrame, vector: str, width: int, name: str) -> DataFrame:
    v = F.col(vector)
    v = v if side.schema[vector].dataType in (ArrayType(FloatType()), ArrayType(FloatType(), False)) else v.cast("array<double>")
    whole = (F.size(v) == width) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return side.where(whole).select(*[c for c in side.columns if c != vector], v.alias(name))


def near_join(left: DataFrame, right: DataFrame, vector: str, radius: float, width: int, cells: int = 2) -> DataFrame:
    """Pairs of vectors at most ``radius`` apart, with ``distance``; columns of both sides must have different names, but for the vector.

    Two near vectors are as near along any direction. Vectors are laid out by their cells along ``cells`` directions at right
    angles and cut into boxes of about ``BOX`` rows; boxes that are no further apart than ``radius`` along each direction meet,
    a pair of boxes at a time, by a matrix product that leaves out the far pairs, and the others are measured. So a task holds two
    boxes, and where directions tell nothing apart, all pairs are a matter of products. Null vectors, and those with null, NaN
    or infinite components or of another width, are near nothing. A right side that is small is sent to every task instead.
    """
    x, y = _given(left, vector, width, "_x"), _given(right, vector, width, "_y")
    if is_small(y, 1000):
        far = distance(F.col("_x").cast("array<double>"), F.col("_y").cast("array<double>"))
        return x.crossJoin(F.broadcast(y)).withColumn("distance", far).where(F.col("distance") <= radius).drop("_x", "_y")
    axes = directions(width, cells)
    boxes = _boxed(x, "_x", axes, radius), _boxed(y, "_y", axes, radius)
    return _near(*boxes, [f for f in x.schema if f.name != "_x"], [f for f in y.schema if f.name != "_y"], radius, width, len(axes))


def near_pairs(df: DataFrame, id_col: str, vector: str, radius: float, width: int, cells: int = 2) -> DataFrame:
    """``near_join`` of a table with itself, where the id of the first is below that of the second: (``a``, ``b``, ``distance``).

    Two boxes meet once, so it is half the work.
    """
    x, axes = _given(df.select(F.col(id_col).alias("a"), vector), vector, width, "_x"), directions(width, cells)
    x, own = _boxed(x, "_x", axes, radius), x.schema["a"].dataType
    return _near(x, x.withColumnRenamed("a", "b"), [StructField("a", own)], [StructField("b", own)], radius, width, len(axes), True)


def _near(x: DataFrame, y: DataFrame, names: list[StructField], others: list[StructField], radius: float, width: int, axes: int, once: bool = False) -> DataFrame:
    def near(l: str, r: str) -> Column:
        slack = F.lit(radius * (1 + 1e-9)) + 1e-13 * width * (F.col(f"{l}_long") + F.col(f"{r}_long"))
        fits = F.col(f"{l}_box") <= F.col(f"{r}_box") if once else F.lit(True)
        for k in range(axes):
            fits &= (F.col(f"{l}_lo{k}") <= F.col(f"{r}_hi{k}") + slack) & (F.col(f"{r}_lo{k}") <= F.col(f"{l}_hi{k}") + slack)
        return fits

    def meet(a: dict, b: dict) -> Iterator[dict]:
        u, v = (np.frombuffer(s["_v"], s["_kind"]).reshape(-1, width).astype(np.float64) for s in (a, b))
        for i, j, apart in _near_pairs(u, v, radius, once and a["_box"] == b["_box"]):
            yield {f.name: a[f.name].take(pa.array(i)) for f in names} | {f.name: b[f.name].take(pa.array(j)) for f in others} | {"distance": pa.array(apart)}

    # a box is some thousand rows: their pairs are far fewer than those of the rows
    ends = [c for c in x.columns if c in ("_box", "_long") or c[:3] in ("_lo", "_hi")]
    l, r = (x.select(*[F.col(c).alias(f"{side}{c}") for c in ends]) for side, x in (("l", x), ("r", y)))
    pairs = checkpointed(l.join(r.hint("shuffle_replicate_nl"), near("l", "r")).select(F.col("l_box").alias("_i"), F.col("r_box").alias("_j")))
    made = StructType([*names, *others, StructField("distance", DoubleType())])
    met = [x.join(F.broadcast(pairs.select(F.col(c).alias("_box")).distinct()), "_box", "left_semi") for x, c in ((x, "_i"), (y, "_j"))]
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance").where("a < b") if once else df
    return _met(*met, lambda l, r: near(l, r), meet, made, ordered)


def _boxed(side: DataFrame, vector: str, axes: list[list[float]], radius: float) -> DataFrame:
    """Boxes of near vectors, a row each: ends along the axes, the length of the longest vector, the vectors' bytes, and the other
    columns as lists. They are written down, as a second run of the range partitioner's sample could draw other bounds."""
    others = [f for f in side.schema if f.name != vector]
    kind = "<f4" if side.schema[vector].dataType.elementType == FloatType() else "<f8"
    for k, axis in enumerate(axes):
        along = F.aggregate(F.zip_with(F.col(vector).cast("array<double>"), F.array(*map(F.lit, axis)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        side = side.withColumn(f"_a{k}", along)
    boxes = max(1, -(-side.count() // BOX))
    cells = [F.floor(F.col(f"_a{k}") / (radius or 1.0)) for k in range(len(axes) - 1)]
    # equal vectors may be many: a number of the row tells them apart
    placed = side.withColumn("_tie", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(boxes, *cells, f"_a{len(axes) - 1}", "_tie").drop("_tie").withColumn("_box", F.spark_partition_id())
    ends = [StructField(f"_{n}{k}", DoubleType()) for k in range(len(axes)) for n in ("lo", "hi")]
    made = [StructField("_box", IntegerType()), StructField("_long", DoubleType()), *ends, StructField("_v", BinaryType()), *[StructField(f.name, ArrayType(f.dataType)) for f in others]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (batches := list(batches)):
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        if not len(rows):
            return
        v = rows[vector].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
        wide = v.reshape(len(rows), -1).astype(np.float64)
        with np.errstate(all="ignore"):
            facts = [float(np.sqrt((wide * wide).sum(1)).max())]
        for k in range(len(axes)):
            along = rows[f"_a{k}"].to_numpy()
            facts += [float(along.min()), float(along.max())]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows[f.name].combine_chunks()) for f in others]
        values = [pa.array([rows["_box"][0].as_py()], pa.int32()), *(pa.array([x], pa.float64()) for x in facts), pa.array([v.tobytes()], pa.binary()), *lists]
        yield pa.RecordBatch.from_arrays(values, names=[f.name for f in made])

    return checkpointed(placed.mapInArrow(run, StructType(made))).withColumn("_kind", F.lit(kind))


def _near_pairs(u: np.ndarray, v: np.ndarray, radius: float, same: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers of near vectors and their distances, summed component by component as ``distance`` does; of one box, each pair once."""
    with np.errstate(all="ignore"):
        uu, vv = (u * u).sum(1), (v * v).sum(1)
        # the product of these is the square of the distance: in single precision where that is no matter of range
        a, b = np.column_stack([u, uu, np.ones(len(u))]), np.column_stack([-2 * v, np.ones(len(v)), vv])
        single = max(uu.max(initial=0), vv.max(initial=0)) < 1e30
        a, b, grain = (a.astype(np.float32), b.astype(np.float32), 2.0**-22) if single else (a, b, 2.0**-51)
        # what rounding hides is let through, and measured below
        bound = (radius * radius * (1 + 1e-9) + grain * (u.shape[1] + 4) * (uu + vv.max(initial=0))).astype(a.dtype)
        for at in range(0, len(u), step := 512):
            near = ~(a[at : at + step] @ b.T > bound[at : at + step, None])
            i, j = np.nonzero(near)
            if same:
                i, j = i[i + at < j], j[i + at < j]
            for low in range(0, len(i), PAIRS):
                p, q = i[low : low + PAIRS] + at, j[low : low + PAIRS]
                total = np.zeros(len(p))
                for k in range(u.shape[1]):
                    d = u[p, k] - v[q, k]
                    total += d * d
                apart = np.sqrt(total)
                hit = apart <= radius
                if hit.any():
                    yield p[hit], q[hit], apart[hit]


def min_hash_join(left: DataFrame, right: DataFrame, model: MinHashLSHModel, bound: float) -> DataFrame:
    """(``a``, ``b``, ``distance``): ids of rows (``id``, ``features``) that share a hash in one of the model's tables, nearer than
    ``bound``: the rows of ``approxSimilarityJoin``. A hash travels with the id and a digest of its row, not with the features.
    """
    def hashed(side: DataFrame, name: str) -> DataFrame:
        at = F.unwrap_udt("features")["indices"]
        own = side.select("id", "features", at.alias("at"))
        keys = F.transform(F.col("hashes"), lambda h: F.unwrap_udt(h)["values"][0].cast("bigint"))
        out = model.transform(own).select(F.struct("id", F.xxhash64("at").alias("h"), F.size("at").alias("n")).alias(name), F.col("at").alias(f"{name}_at"), keys.alias("keys"))
        return checkpointed(out)

    a, b = hashed(left, "a"), hashed(right, "b")
    entries = [side.select(name, F.posexplode("keys").alias("table", "hash")) for side, name in ((a, "a"), (b, "b"))]
    # sets nearer than the bound share more than 1 - bound of their items together, and no more than the smaller one has
    most = F.least("a.n", "b.n")
    met = broadcast_join(entries[0], entries[1], ["table", "hash"]).where(F.lit(1.0) - most / F.greatest("a.n", "b.n") < bound + 1e-9).select("a", "b").distinct()
    items = b.select("b", "b_at").dropDuplicates(["b"])
    pairs = broadcast_join(met, items, "b").select("a", "b", "b_at") if is_small(items) else met.join(items, "b")
    whole = pairs.join(a.select("a", "a_at").dropDuplicates(["a"]), "a")
    shared = F.size(F.array_intersect("a_at", "b_at"))
    apart = whole.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), (F.lit(1.0) - shared / (F.col("a.n") + F.col("b.n") - shared)).alias("distance"))
    return apart.where(F.col("distance") < bound)
