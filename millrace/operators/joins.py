"""Join operators beyond the plain ``DataFrame.join``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.skew import HOT_ROWS, hot_keys, same_keys

SMALL_ROWS = 100_000


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """True when the frame has at most ``max_rows`` rows; reads no more than that many plus one."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def broadcast_join(left: DataFrame, right: DataFrame, on, how: str = "inner", max_rows: int = SMALL_ROWS) -> DataFrame:
    """Send ``right`` to every task when it is small; a shuffled join beyond that."""
    return left.join(F.broadcast(right) if is_small(right, max_rows) else right, on, how)


def strategy_join(left: DataFrame, right: DataFrame, on, strategy: str, how: str = "inner") -> DataFrame:
    """Join with the hinted strategy: ``merge``, ``shuffle_hash`` or ``shuffle_replicate_nl``."""
    return left.join(right.hint(strategy), on, how)


def cross_join(left: DataFrame, right: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Pair every row with every row of the right side."""
    return theta_join(left, right, None, max_rows)


def theta_join(left: DataFrame, right: DataFrame, condition: Column | None, max_rows: int = 10_000) -> DataFrame:
    """Join on any condition. A right side of at most ``max_rows`` is sent to every task; a larger one meets the left side
    block by block in Spark's product join. The rows are the same; ``range_join`` and ``inequality_counts`` are cheaper
    where they apply.
    """
    near = F.broadcast(right) if is_small(right, max_rows) else right.hint("shuffle_replicate_nl")
    return left.crossJoin(near) if condition is None else left.join(near, condition)


def existence_join(left: DataFrame, right: DataFrame, on: list[str], name: str = "exists") -> DataFrame:
    """Every left row once, with a flag telling whether the right side has its key."""
    keys = right.select(*on).distinct().withColumn("_hit", F.lit(True))
    return left.join(keys, on, "left").withColumn(name, F.col("_hit").isNotNull()).drop("_hit")


def not_in(left: DataFrame, column: str, right: DataFrame, other: str) -> DataFrame:
    """NOT IN with its null rules, as an anti join that needs no broadcast of the right side.

    An empty right side keeps every row; a missing value on the right keeps none; otherwise rows with a missing value on
    the left are dropped.
    """
    facts = right.agg(F.count("*").alias("_n"), F.count_if(F.col(other).isNull()).alias("_nulls"))
    rest = left.join(right.select(F.col(other).alias("_r")), F.col(column) == F.col("_r"), "left_anti")
    # one row of counts, safe to send everywhere
    return rest.join(F.broadcast(facts)).where((F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(column).isNotNull())).drop("_n", "_nulls")


def null_safe_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Equi join in which missing keys match each other."""
    return left.join(right, reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs]), how)


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", salts: int = 32,
                min_rows: int = HOT_ROWS) -> DataFrame:
    """Equi join that spreads the left side's hot keys over ``salts`` tasks; their right rows are copied to each.

    ``how`` is inner, left, left_semi or left_anti: kinds in which a copied right row cannot add a result of its own.
    The salt is a hash of the whole left row, so a re-run task gives the same salt; keep a row id among its columns.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    hot = hot_keys(left, on, min_rows)
    if hot is None:
        return left.join(right, on, how)
    marks = hot.select(*on, F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(0).cast("int")
    spread = left.join(F.broadcast(marks), on, "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = right.join(F.broadcast(marks), on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return spread.join(copied, [*on, "_salt"], how).drop("_salt")


def unique_join(sides: list[tuple[str, DataFrame, list[str], bool]]) -> DataFrame:
    """N-way join on one shared key. A side is (prefix, frame, key columns, preserve).

    A key gives rows when every side has it, or when a preserved side has it; sides without the key give nulls.
    Output columns are named ``prefix_column``.
    """
    width = len(sides[0][2])
    keys = [f"_k{i}" for i in range(width)]
    out = None
    for prefix, frame, on, _ in sides:
        part = frame.select(*[F.col(c).alias(k) for c, k in zip(on, keys)], *[F.col(c).alias(f"{prefix}_{c}") for c in frame.columns],
                            F.lit(True).alias(f"_has_{prefix}"))
        # a frame with a missing key part matches nothing, as in any equi join
        out = part if out is None else out.join(part, keys, "full")
    has = {prefix: F.coalesce(F.col(f"_has_{prefix}"), F.lit(False)) for prefix, *_ in sides}
    everywhere = reduce(lambda a, b: a & b, has.values())
    kept = reduce(lambda a, b: a | b, [has[p] for p, _, _, preserve in sides if preserve], everywhere)
    return out.where(kept).drop(*keys, *[f"_has_{p}" for p, *_ in sides])


def range_join(points: DataFrame, at: str, ranges: DataFrame, low: str, high: str, width: float,
               on: list[str] | None = None) -> DataFrame:
    """Rows of ``points`` joined to every range with low <= at <= high, with equal ``on`` columns if given.

    Both sides are cut into cells of ``width``, so the join is an equi join on the cell; a range is copied to each
    cell it covers. Choose ``width`` near the usual range length.
    """
    on = on or []
    left = points.withColumn("_cell", F.floor(F.col(at) / width).cast("bigint"))
    cells = F.sequence(F.floor(F.col(low) / width).cast("bigint"), F.floor(F.col(high) / width).cast("bigint"))
    right = ranges.where(F.col(low) <= F.col(high)).withColumn("_cell", F.explode(cells))
    return left.join(right, [*on, "_cell"]).where(F.col(at).between(F.col(low), F.col(high))).drop("_cell")


def inequality_counts(left: DataFrame, right: DataFrame, column: str, by: list[str], name: str = "below") -> DataFrame:
    """For each left row, how many right rows of the same ``by`` key have a smaller ``column``.

    The counting form of the join ``left.column > right.column``: one sorted pass instead of all pairs.
    """
    from millrace.operators.windows import running

    levels = left.select(*by, column, F.lit(0).alias("_r")).union(right.select(*by, column, F.lit(1).alias("_r")))
    counts = levels.groupBy(*by, column).agg(F.sum("_r").alias("_here"))
    upto = running(counts, by, [column], sums={"_upto": F.col("_here")})
    ranked = upto.select(*by, column, (F.col("_upto") - F.col("_here")).alias(name))
    return left.alias("l").join(ranked.alias("r"), same_keys("l", "r", [*by, column])).select("l.*", F.col(f"r.{name}"))


def cogroup_agg(sides: dict[str, tuple[DataFrame, list[Column]]], keys: list[str]) -> DataFrame:
    """Co-group N keyed tables: each side is reduced by its own aggregates, then the sides meet on the key."""
    grouped = [frame.groupBy(*keys).agg(*aggs) for frame, aggs in sides.values()]
    return reduce(lambda a, b: a.join(b, keys, "full"), grouped)
