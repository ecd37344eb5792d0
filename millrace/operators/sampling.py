"""Samples, sketches and frequent items."""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator
from statistics import NormalDist

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from millrace.session import checkpointed
from millrace.sources.generate import uniform


def bucket(df: DataFrame, x: int, y: int, on: str) -> DataFrame:
    """TABLESAMPLE (BUCKET x OUT OF y ON column): the same rows every time."""
    if not 1 <= x <= y:
        raise ValueError("the bucket must lie between 1 and the number of buckets")
    return df.where(F.pmod(F.hash(on), F.lit(y)) == x - 1)


def bucket_of_key(df: DataFrame, x: int, y: int, key: str) -> DataFrame:
    """Bucket of a whole-number key by its value, as any engine would cut it."""
    if not 1 <= x <= y:
        raise ValueError("the bucket must lie between 1 and the number of buckets")
    return df.where(F.pmod(F.col(key), F.lit(y)) == x - 1)


def percent(df: DataFrame, p: float, seed: int) -> DataFrame:
    if not 0 <= p <= 100:
        raise ValueError("the percentage must lie between 0 and 100")
    return df.sample(False, p / 100, seed)


def draw_range(df: DataFrame, keys: list[str], low: float, high: float, seed: int) -> DataFrame:
    """Rows whose draw lies in [low, high); the draw follows from the key, so ranges split the rows exactly."""
    u = uniform(seed, *[F.col(k) for k in keys])
    return df.where((u >= low) & (u < high))


def split(df: DataFrame, keys: list[str], weights: list[float], seed: int) -> list[DataFrame]:
    total, out, low = sum(weights), [], 0.0
    for i, w in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + w / total
        out.append(draw_range(df, keys, low, high, seed))
        low = high
    return out


def stratified(df: DataFrame, column: str, fractions: dict, keys: list[str], seed: int) -> DataFrame:
    """Each stratum with its own fraction; strata that are not named are left out."""
    share = F.lit(0.0)
    for value, fraction in fractions.items():
        share = F.when(F.col(column) == value, F.lit(float(fraction))).otherwise(share)
    return df.where(uniform(seed, *[F.col(k) for k in keys]) < share)


def poisson_sample(df: DataFrame, fraction: float, keys: list[str], seed: int) -> DataFrame:
    """Sample with replacement: each row is kept a Poisson number of times."""
    from millrace.sources.generate import poisson

    times = poisson(fraction, seed, *[F.col(k) for k in keys])
    return df.select("*", F.explode(F.array_repeat(F.lit(1), times)).alias("_copy")).drop("_copy")


def reservoir(df: DataFrame, k: int, keys: list[str], seed: int) -> DataFrame:
    """k rows drawn evenly, each task keeping its k smallest draws."""
    return df.orderBy(uniform(seed, *[F.col(c) for c in keys]), *keys).limit(k)


def reservoir_and_count(df: DataFrame, k: int, seed: int) -> tuple[DataFrame, int]:
    """``k`` rows drawn evenly (all, if there are fewer) and the number of all rows, in one pass over the table.

    Every row has a draw of its own, and the k smallest of all are wanted. A task holds the k smallest of its rows; how many
    rows it may pass before one gets a smaller draw is itself drawn, so most rows are counted and not looked at. The tasks'
    rows, k each, are written down with their draws and counts, and the k smallest of these are the sample. A task that runs
    again draws the same, if its input has the same order.
    """
    if k < 1:
        raise ValueError("a sample has at least one row")
    name = "_draw"
    while name in df.columns:
        name += "_"
    schema = StructType([*df.schema.fields, StructField(name, DoubleType()), StructField(f"{name}n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rnd = random.Random(f"{seed}:{TaskContext.get().partitionId()}")
        held: list[tuple[float, int, pa.RecordBatch]] = []  # a heap, largest draw first: its negative, place, row
        count, wait = 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                if len(held) < k:
                    heapq.heappush(held, (-rnd.random(), count + at, batch.slice(at, 1)))
                    at += 1
                    if len(held) == k:
                        wait = _passed(rnd, -held[0][0])
                elif wait >= batch.num_rows - at:
                    wait -= batch.num_rows - at
                    at = batch.num_rows
                else:
                    at += wait
                    heapq.heapreplace(held, (-rnd.random() * -held[0][0], count + at, batch.slice(at, 1)))
                    at += 1
                    wait = _passed(rnd, -held[0][0])
            count += batch.num_rows
            # a slice would hold on to its whole batch
            held = [(d, i, pa.RecordBatch.from_pylist(b.to_pylist(), schema=b.schema) if i >= count - batch.num_rows else b) for d, i, b in held]
        if held:
            rows = pa.Table.from_batches([b for _, _, b in held])
            rows = rows.append_column(name, pa.array([-d for d, _, _ in held])).append_column(f"{name}n", pa.array([count] + [0] * (len(held) - 1), pa.int64()))
            yield from rows.to_batches()

    drawn = checkpointed(df.mapInArrow(run, schema))
    total = drawn.agg(F.sum(f"{name}n")).first()[0] or 0
    return drawn.orderBy(name).limit(k).select(*[F.col(f"`{c}`") for c in df.columns]), total


def _passed(rnd: random.Random, bound: float) -> int:
    """How many rows go by before one draws less than ``bound``."""
    return int(math.log(1 - rnd.random()) / math.log1p(-bound)) if 0 < bound < 1 else 0


def fraction_for(size: int, total: int, with_replacement: bool = False, failure: float = 1e-4) -> float:
    """A sampling fraction that gives at least ``size`` of ``total`` rows, but for a chance of ``failure``.

    The normal quantile of ``failure`` says how many deviations the mean must lie above ``size``; the quadratic for the
    mean is then solved (for draws without replacement that is the upper end of a score interval of the share).
    """
    if size <= 0 or total <= 0:
        return 0.0
    z = NormalDist().inv_cdf(1 - failure)
    if with_replacement:
        return ((z + math.sqrt(z * z + 4 * size)) / 2) ** 2 / total
    share, spread = min(1.0, size / total), z * z / total
    return min(1.0, (share + spread / 2 + math.sqrt(spread * share * (1 - share) + spread * spread / 4)) / (1 + spread))


def frequent_items(df: DataFrame, column: str, support: float) -> DataFrame:
    """Values that make up more than ``support`` of the rows, with exact counts.

    At most 1/support values qualify, so the Misra-Gries candidates are few and one more pass counts them.
    """
    found = df.stat.freqItems([column], support).select(F.explode(f"{column}_freqItems").alias(column))
    total = df.agg((F.count("*") * support).alias("_floor"))
    counts = df.join(F.broadcast(found), column, "left_semi").groupBy(column).agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(total), F.col("n") > F.col("_floor")).drop("_floor")


def count_min(df: DataFrame, column: str, eps: float, confidence: float, seed: int, by: list[str] | None = None) -> DataFrame:
    """The built-in count-min sketch as bytes."""
    return df.groupBy(*(by or [])).agg(F.count_min_sketch(F.col(column), F.lit(eps), F.lit(confidence), F.lit(seed)).alias("sketch"))


def count_min_table(df: DataFrame, column: str, depth: int, width: int, seed: int = 0) -> DataFrame:
    """A count-min sketch as a table (row, cell, n): at most depth x width rows; two sketches merge by adding n."""
    cells = F.array(*[F.struct(F.lit(i).alias("row"), F.pmod(F.xxhash64(F.lit(seed + i), column), F.lit(width)).alias("cell")) for i in range(depth)])
    counts = df.groupBy(column).agg(F.count("*").alias("_n"))
    return counts.select("_n", F.inline(cells)).groupBy("row", "cell").agg(F.sum("_n").alias("n"))


def count_min_estimate(sketch: DataFrame, items: DataFrame, column: str, depth: int, width: int, seed: int = 0) -> DataFrame:
    """Estimated count of each item: the smallest of its cells."""
    cells = F.array(*[F.struct(F.lit(i).alias("row"), F.pmod(F.xxhash64(F.lit(seed + i), column), F.lit(width)).alias("cell")) for i in range(depth)])
    looked = items.select(column, F.inline(cells)).join(sketch, ["row", "cell"], "left")
    return looked.groupBy(column).agg(F.min(F.coalesce("n", F.lit(0))).alias("estimate"))


def bloom_positions(column: Column, bits: int, hashes: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), column), F.lit(bits)) for i in range(hashes)])


def bloom_build(df: DataFrame, column: str, bits: int, hashes: int) -> DataFrame:
    """A Bloom filter as bitmaps of 32,768 bits: (bucket, bits). Two filters merge by bitmap or."""
    at = df.select(F.explode(bloom_positions(F.col(column), bits, hashes)).alias("at"))
    return at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))


def bloom_merge(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bloom_might_contain(df: DataFrame, column: str, bloom: DataFrame, bits: int, hashes: int, name: str = "maybe") -> DataFrame:
    """Distinct values of the column with a flag: false means surely absent."""
    keys = df.select(column).distinct()
    probes = keys.select(column, F.explode(F.array_distinct(bloom_positions(F.col(column), bits, hashes))).alias("at"))
    probes = probes.select(column, F.bitmap_bucket_number("at").alias("bucket"), F.bitmap_bit_position("at").alias("bit"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    on = F.expr("shiftright(_byte, cast(bit % 8 as int)) & 1") == 1
    looked = probes.join(bloom, "bucket", "left").withColumn("_byte", F.coalesce(byte, F.lit(0)))
    return looked.groupBy(column).agg(F.bool_and(on).alias(name))
