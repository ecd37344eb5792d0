"""Window operators that stay correct and spread out when one key holds most of the rows.

With no hot key each operator is one plain window. With a hot key its rows are cut into slices that do not overlap in
the order. Running values add what the earlier slices hold; frames bring in the few rows they need from
neighbouring slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.skew import HOT_ROWS, LOOK, hot_keys, known_hot, same_keys, with_slices, window
from millrace.session import checkpointed


def running(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column] | None = None,
            maxes: dict[str, Column] | None = None, mins: dict[str, Column] | None = None, position: str | None = None,
            total: str | None = None, min_rows: int = HOT_ROWS, slices: int | None = None, hot=LOOK) -> DataFrame:
    """Running sum, max and min from the start of each key, row position, and the key's row count.

    ``order`` must identify a row within its key.
    """
    sums, maxes, mins = dict(sums or {}), dict(maxes or {}), dict(mins or {})
    inputs = {f"_in_{n}": c for n, c in {**sums, **maxes, **mins}.items()}
    keep = df.columns
    df = df.select("*", *[c.alias(n) for n, c in inputs.items()])
    df, hot = with_slices(df, keys, order, min_rows, slices, hot=hot)
    part = [*keys, "_slice"] if hot else keys
    w = window(part, *order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*part)
    out = df.select(
        "*",
        *[F.sum(f"_in_{n}").over(w).alias(n) for n in sums],
        *[F.max(f"_in_{n}").over(w).alias(n) for n in maxes],
        *[F.min(f"_in_{n}").over(w).alias(n) for n in mins],
        *([F.row_number().over(window(part, *order)).cast("bigint").alias(position)] if position else []),
        *([F.count(F.lit(1)).over(whole).alias(total)] if total and not hot else []),
    )
    extra = [*sums, *maxes, *mins, *([position] if position else []), *([total] if total else [])]
    if not hot:
        return out.select(*keep, *extra)
    per = df.groupBy(*part).agg(
        F.count("*").alias("_n"),
        *[F.sum(f"_in_{n}").alias(f"_s_{n}") for n in sums],
        *[F.max(f"_in_{n}").alias(f"_s_{n}") for n in maxes],
        *[F.min(f"_in_{n}").alias(f"_s_{n}") for n in mins],
    )
    # one row per key and slice: a row per slice, not per row of the key, meets in a task
    before = window(keys, "_slice").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(
        *part,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_b_n"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
        *[F.sum(f"_s_{n}").over(before).alias(f"_b_{n}") for n in sums],
        *[F.max(f"_s_{n}").over(before).alias(f"_b_{n}") for n in maxes],
        *[F.min(f"_s_{n}").over(before).alias(f"_b_{n}") for n in mins],
    )
    both = out.alias("a").join(base.alias("b"), same_keys("a", "b", keys) & (F.col("a._slice") == F.col("b._slice")))

    def added(n):
        return F.when(F.col(f"a.{n}").isNull(), F.col(f"b._b_{n}")).otherwise(
            F.col(f"a.{n}") + F.coalesce(F.col(f"b._b_{n}"), F.lit(0)))

    return both.select(
        *[F.col(f"a.{c}") for c in keep],
        *[added(n).alias(n) for n in sums],
        *[F.greatest(f"a.{n}", f"b._b_{n}").alias(n) for n in maxes],
        *[F.least(f"a.{n}", f"b._b_{n}").alias(n) for n in mins],
        *([(F.col(f"a.{position}") + F.col("b._b_n")).alias(position)] if position else []),
        *([F.col("b._total").alias(total)] if total else []),
    )


def rank_all(df: DataFrame, keys: list[str], order: str, tie: list[str], tiles: int = 4, min_rows: int = HOT_ROWS,
             slices: int | None = None) -> DataFrame:
    """row_number, rank, dense_rank, percent_rank, cume_dist and ntile of each row within its key.

    With a hot key the ranks come from the counts per distinct order value, so equal values cost one row, not one each.
    """
    hot = hot_keys(df, keys, min_rows)
    if hot is None:
        w, numbered = window(keys, order), window(keys, order, *tie)
        return df.select(
            "*", F.row_number().over(numbered).cast("bigint").alias("row_number"), F.rank().over(w).cast("bigint").alias("rank"),
            F.dense_rank().over(w).cast("bigint").alias("dense_rank"), F.percent_rank().over(w).alias("percent_rank"),
            F.cume_dist().over(w).alias("cume_dist"), F.ntile(tiles).over(numbered).cast("bigint").alias("ntile"))
    levels = df.groupBy(*keys, order).agg(F.count("*").alias("_ties"))
    levels = running(levels, keys, [order], sums={"_upto": F.col("_ties"), "_dense": F.lit(1).cast("bigint")},
                     total=None, min_rows=min_rows, slices=slices)
    totals = df.groupBy(*keys).agg(F.count("*").alias("_total"))
    placed = levels.alias("l").join(totals.alias("t"), same_keys("l", "t", keys)).select(
        *[F.col(f"l.{k}") for k in keys], F.col(f"l.{order}"), "_ties", "_upto", "_dense", "_total")
    numbered = running(df, keys, [order, *tie], position="row_number", min_rows=min_rows, slices=slices, hot=hot)
    joined = numbered.alias("a").join(placed.alias("p"), same_keys("a", "p", [*keys, order]))
    before = F.col("_upto") - F.col("_ties")
    big = F.col("_total") % tiles
    size = F.floor(F.col("_total") / tiles).cast("bigint")
    rn0 = F.col("row_number") - 1
    tile = F.when(rn0 < big * (size + 1), F.floor(rn0 / (size + 1))).otherwise(
        big + F.floor((rn0 - big * (size + 1)) / F.greatest(size, F.lit(1))))
    return joined.select(
        "a.*",
        (before + 1).alias("rank"),
        F.col("_dense").alias("dense_rank"),
        F.when(F.col("_total") > 1, before / (F.col("_total") - 1)).otherwise(0.0).alias("percent_rank"),
        (F.col("_upto") / F.col("_total")).alias("cume_dist"),
        (tile + 1).cast("bigint").alias("ntile"),
    )


def neighbours(df: DataFrame, keys: list[str], order: list[str], before: int, after: int, make,
               min_rows: int = HOT_ROWS, slices: int | None = None, hot=LOOK) -> DataFrame:
    """Columns over a frame of at most ``before`` rows back and ``after`` rows ahead.

    ``make(window)`` gets the ordered window and returns named columns: lag, lead, or aggregates over
    ``window.rowsBetween(-before, after)``. In a hot key each slice borrows the rows it needs from its neighbours.
    """
    keep = df.columns
    df, hot = with_slices(df, keys, order, min_rows, slices, hot=hot)
    if not hot:
        return df.select(*keep, *make(window(keys, *order)))
    part = [*keys, "_slice"]
    ends = df.select(
        "*",
        F.row_number().over(window(part, *order)).alias("_up"),
        F.row_number().over(window(part, *[F.desc(c) for c in order])).alias("_down"),
    )
    held = df.groupBy(*part).agg(F.count("*").alias("_n"))
    lent = []
    for count, edge, shift in ((before, "_down", 1), (after, "_up", -1)):
        if count <= 0:
            continue
        # every slice has a row, so the wanted rows lie within ``count`` filled slices
        upto = F.sum("_n").over(window(keys, "_slice").rowsBetween(Window.unboundedPreceding, 0))
        rank = held.select(*part, F.row_number().over(window(keys, "_slice")).alias("_nth"), upto.alias("_last"), (upto - F.col("_n")).alias("_first"))
        edges = ends.where(F.col(edge) <= count).alias("e").join(
            rank.alias("r"), same_keys("e", "r", keys) & (F.col("e._slice") == F.col("r._slice"))
        ).select("e.*", "r._nth", "r._first", "r._last").drop("_slice")
        spread = edges.withColumn("_nth", F.explode(F.sequence(F.col("_nth") + shift, F.col("_nth") + shift * count)))
        # the rows of the slices between count as well: a row goes no further than the frame reaches
        gap = F.col("r._first") - F.col("s._last") if shift > 0 else F.col("s._first") - F.col("r._last")
        lent.append(
            spread.alias("s").join(rank.alias("r"), same_keys("s", "r", keys) & (F.col("s._nth") == F.col("r._nth")) & (F.col(f"s.{edge}") + gap <= count))
            .select(*[F.col(f"s.{c}") for c in keep], F.col("r._slice").alias("_slice"), F.lit(False).alias("_own"))
        )
    rows = df.select(*keep, "_slice", F.lit(True).alias("_own"))
    for extra in lent:
        rows = rows.unionByName(extra)
    return rows.select(*keep, "_own", *make(window(part, *order))).where("_own").drop("_own")


def _finite(df: DataFrame, sums: dict[str, Column], look: bool = False) -> dict[str, Column]:
    """Sums for which differences of running totals are right: infinities and NaN are left out of a double and counted.

    With ``look`` the values are read first, and where all are finite nothing is counted beside them.
    """
    doubles = {n for n, c in sums.items() if df.select(c.alias("c")).schema["c"].dataType.typeName() in ("double", "float")}
    odd = dict.fromkeys(doubles, True)
    if look and doubles:
        found = df.agg(*[F.min(F.abs(sums[n].cast("double")) < float("inf")).alias(n) for n in doubles]).first()
        odd = {n: found[n] is False for n in doubles}
    out = {}
    for n, c in sums.items():
        if not odd.get(n):
            out[n] = c.cast("double") if n in doubles else c
            continue
        c = c.cast("double")
        kinds = {"up": c == float("inf"), "down": c == -float("inf"), "nan": F.isnan(c)}
        out[n] = F.when(c.isNull() | ~(kinds["up"] | kinds["down"] | kinds["nan"]), c).otherwise(0.0)
        out |= {f"_{kind}_{n}": F.coalesce(test, F.lit(False)).cast("bigint") for kind, test in kinds.items()}
    return out


def _with_infinities(n: str, names) -> Column:
    """The sum of a frame again, from its finite part and the counts of the other values."""
    if f"_up_{n}" not in names:
        return F.col(n)
    up, down, nan = (F.coalesce(F.col(f"_{kind}_{n}"), F.lit(0)) for kind in ("up", "down", "nan"))
    both = (nan > 0) | ((up > 0) & (down > 0))
    return F.when(both, float("nan")).when(up > 0, float("inf")).when(down > 0, -float("inf")).otherwise(F.col(n)).alias(n)


def range_frame(df: DataFrame, keys: list[str], at: str, before, after, sums: dict[str, Column] | None = None, count: str | None = None,
                maxes: dict[str, Column] | None = None, mins: dict[str, Column] | None = None, min_rows: int = HOT_ROWS,
                slices: int | None = None) -> DataFrame:
    """Sums, row count, maxima and minima over the rows of the same key whose ``at`` lies in [at - before, at + after].

    ``at`` is a number (epoch microseconds or days for times). With a hot key, rows are first combined per distinct ``at``.
    Sums and counts are then differences of running totals looked up at both ends of the frame, which slices like any
    running total; infinities and NaN are counted beside the totals, so they show in their own frames only; maxima and minima are running values of cells half as wide as the frame.
    """
    sums, maxes, mins = dict(sums or {}), dict(maxes or {}), dict(mins or {})
    keep = df.columns
    extra = [*sums, *([count] if count else []), *maxes, *mins]
    if hot_keys(df, keys, min_rows) is None:
        w = Window.partitionBy(*keys).orderBy(at).rangeBetween(-before, after)
        return df.select(
            "*", *[F.sum(c).over(w).alias(n) for n, c in sums.items()], *([F.count("*").over(w).alias(count)] if count else []),
            *[F.max(c).over(w).alias(n) for n, c in maxes.items()], *[F.min(c).over(w).alias(n) for n, c in mins.items()])
    wanted, sums = list(sums), _finite(df, sums, look=True)
    # a sum that has a value in each row needs no count of its own: a frame holds its own row
    counted = [n for n, c in sums.items() if df.select(c.alias("c")).schema["c"].nullable]
    levels = checkpointed(df.groupBy(*keys, at).agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()], *[F.count(sums[n]).alias(f"_c_{n}") for n in counted],
        *[F.max(c).alias(f"_x_{n}") for n, c in maxes.items()], *[F.min(c).alias(f"_m_{n}") for n, c in mins.items()]))
    parts = []
    if sums or count:
        totals = ["_n", *[f"_s_{n}" for n in sums], *[f"_c_{n}" for n in counted]]

        def probe(shift, kind, own):
            values = [F.coalesce(F.col(c), F.lit(0)).alias(c) if own else F.lit(0).cast(levels.schema[c].dataType).alias(c) for c in totals]
            return levels.select(*keys, (F.col(at) + shift).alias("_p"), F.lit(kind).alias("_kind"), F.col(at).alias("_at"), *values)

        points = probe(-before, 0, False).union(probe(0, 1, True)).union(probe(after, 2, False))
        upto = running(points, keys, ["_p", "_kind", "_at"], sums={f"_u{c}": F.col(c) for c in totals}, min_rows=min_rows, slices=slices)
        ends = upto.where("_kind <> 1").groupBy(*keys, F.col("_at").alias(at)).agg(
            *[(F.max(F.when(F.col("_kind") == 2, F.col(f"_u{c}"))) - F.max(F.when(F.col("_kind") == 0, F.col(f"_u{c}")))).alias(f"_d{c}") for c in totals])
        parts.append(ends.select(*keys, at, *([F.col("_d_n").alias(count)] if count else []),
                                 *[(F.when(F.col(f"_d_c_{n}") > 0, F.col(f"_d_s_{n}")) if n in counted else F.col(f"_d_s_{n}")).alias(n) for n in sums]))
    if maxes or mins:
        parts.append(_frame_extremes(levels, keys, at, before, after, list(maxes), list(mins), min_rows, slices))
    out = df
    for part in parts:
        names = [c for c in part.columns if c not in (*keys, at)]
        out = out.alias("a").join(part.alias("b"), same_keys("a", "b", [*keys, at])).select("a.*", *[F.col(f"b.{n}") for n in names])
    return out.select(*keep, *[_with_infinities(n, sums) if n in wanted else F.col(n) for n in extra])


def _frame_extremes(levels: DataFrame, keys: list[str], at: str, before, after, maxes: list[str], mins: list[str], min_rows: int, slices: int | None) -> DataFrame:
    """Maxima and minima over [at - before, at + after] of rows that are distinct in keys and ``at``.

    Cells are half as wide as the frame, so a frame is the end of its first cell, whole cells, and the start of its last one.
    Each of these is a running value of a cell, forwards or backwards, looked up at the frame's end: a row costs the same however
    many rows a frame holds, and a hot cell is sliced.
    """
    width, low, high = (before + after) / 2, F.col(at) - before, F.col(at) + after
    held = [*[f"_x_{n}" for n in maxes], *[f"_m_{n}" for n in mins]]
    names = dict(zip([*maxes, *mins], held))
    cell = lambda c: F.floor(c.cast("double") / (width or 1.0)).cast("bigint")
    # missing and endless places, and places too large to tell from their neighbours, are frames of their own
    wide = F.coalesce((F.abs(F.col(at).cast("double")) < float("inf")) & (cell(high) > cell(low)), F.lit(False)) if width > 0 else F.lit(False)
    alone = levels.where(~wide).select(*keys, at, *[F.col(c).alias(n) for n, c in names.items()])
    spread = levels.where(wide)

    ahead = F.transform(F.sequence(cell(low) + 1, cell(high)), lambda c: F.struct(c.alias("_cell"), F.lit(1).alias("_way"), high.alias("_p"), F.lit(2).alias("_kind")))
    back = F.struct(cell(low).alias("_cell"), F.lit(0).alias("_way"), (-low).alias("_p"), F.lit(2).alias("_kind"))
    own = [F.struct(cell(F.col(at)).alias("_cell"), F.lit(way).alias("_way"), (F.col(at) if way else -F.col(at)).cast(levels.select(high.alias("p")).schema["p"].dataType).alias("_p"), F.lit(1).alias("_kind")) for way in (0, 1)]
    points = spread.select(*keys, F.col(at).alias("_at"), *held, F.inline(F.concat(F.array(*own, back), ahead)))
    points = points.select(*keys, "_cell", "_way", "_p", "_kind", "_at", *[F.when(F.col("_kind") == 1, F.col(c)).alias(c) for c in held])
    upto = running(points, [*keys, "_cell", "_way"], ["_p", "_kind", "_at"], maxes={f"_u{n}": F.col(names[n]) for n in maxes}, mins={f"_l{n}": F.col(names[n]) for n in mins},
                   min_rows=min_rows, slices=slices)
    ends = upto.where("_kind = 2").groupBy(*keys, F.col("_at").alias(at)).agg(*[F.max(f"_u{n}").alias(n) for n in maxes], *[F.min(f"_l{n}").alias(n) for n in mins])
    return ends.unionByName(alone)


def range_moments(df: DataFrame, keys: list[str], at: str, before, after, x: Column, y: Column | None = None, min_rows: int = HOT_ROWS, slices: int | None = None) -> DataFrame:
    """``n``, ``mean``, ``var_pop``, ``skewness`` and, with ``y``, ``corr`` of the values in a range frame; null where they have none.

    The values are taken from their key's mean first, so that a large common offset does not drown the differences of the
    running sums that a hot key's frames are made of. Rows with a missing value count for nothing.
    """
    both = {"x": x.cast("double"), **({"y": y.cast("double")} if y is not None else {})}
    there = [c.isNotNull() for c in both.values()]
    whole = there[0] if y is None else there[0] & there[1]
    rows = df.select("*", *[F.when(whole, c).alias(f"_{n}") for n, c in both.items()])
    keep = df.columns
    means = rows.groupBy(*keys).agg(*[F.avg(f"_{n}").alias(f"_m{n}") for n in both])
    rows = rows.alias("a").join(means.alias("m"), same_keys("a", "m", keys)).select("a.*", *[f"m._m{n}" for n in both])
    d = {n: F.coalesce(F.col(f"_{n}") - F.col(f"_m{n}"), F.lit(0.0)) for n in both}
    sums = {"_n": F.when(whole, 1.0).otherwise(0.0), "_1": d["x"], "_2": d["x"] * d["x"], "_3": d["x"] * d["x"] * d["x"]}
    if y is not None:
        sums |= {"_y1": d["y"], "_y2": d["y"] * d["y"], "_xy": d["x"] * d["y"]}
    out = range_frame(rows, keys, at, before, after, sums, min_rows=min_rows, slices=slices)
    n = F.when(F.col("_n") > 0.5, F.round("_n"))
    m, v = F.col("_1") / n, F.col("_2") / n - (F.col("_1") / n) ** 2
    v = F.greatest(v, F.lit(0.0))
    spread = F.when(v > 1e-12 * (F.col("_2") / n + m * m), v)
    third = F.col("_3") / n - 3 * m * F.col("_2") / n + 2 * m * m * m
    made = {"n": F.coalesce(n, F.lit(0)).cast("bigint"), "mean": F.col("_mx") + m, "var_pop": F.when(n > 0, v), "skewness": third / F.pow(spread, F.lit(1.5))}
    if y is not None:
        my, vy = F.col("_y1") / n, F.greatest(F.col("_y2") / n - (F.col("_y1") / n) ** 2, F.lit(0.0))
        made["corr"] = (F.col("_xy") / n - m * my) / F.sqrt(spread * F.when(vy > 1e-12 * (F.col("_y2") / n + my * my), vy))
    return out.select(*keep, *[c.alias(name) for name, c in made.items()])


def whole_key(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates over all rows of the key, on every row: grouped with map-side combining and joined back, so a hot key's
    rows are not buffered in one window.
    """
    totals = df.groupBy(*keys).agg(*aggs)
    names = [c for c in totals.columns if c not in keys]
    return df.alias("a").join(totals.alias("b"), same_keys("a", "b", keys)).select("a.*", *[F.col(f"b.{n}") for n in names])


def fill_forward(df: DataFrame, keys: list[str], order: list[str], columns: list[str], min_rows: int = HOT_ROWS,
                 slices: int | None = None) -> DataFrame:
    """The last value that is not missing, up to and including the row: ``last_value(c) IGNORE NULLS``."""
    hot = hot_keys(df, keys, min_rows)
    out = running(df, keys, order, position="_pos", min_rows=min_rows, slices=slices, hot=hot)
    marks = {f"_at_{c}": F.when(F.col(c).isNotNull(), F.struct(F.col("_pos"), F.col(c).alias("_v"))) for c in columns}
    out = running(out, keys, order, maxes=marks, min_rows=min_rows, slices=slices, hot=hot)
    return out.select(*df.columns, *[F.col(f"_at_{c}._v").alias(f"{c}_filled") for c in columns])


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rn", method=F.row_number) -> DataFrame:
    """The first k rows of each key. Spark trims each map partition to k rows per key before the shuffle."""
    return df.withColumn(rank, method().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def sliding(df: DataFrame, keys: list[str], order: list[str], value: str, size: int, step: int, name: str = "items",
            min_rows: int = HOT_ROWS) -> DataFrame:
    """Arrays of ``size`` consecutive values, starting at every ``step``-th row; short tails give no array."""
    def make(w):
        ahead = [F.lead(value, i).over(w) if i else F.col(value) for i in range(size)]
        there = F.lead(F.lit(1), size - 1).over(w) if size > 1 else F.lit(1)
        return [F.array(*ahead).alias(name), there.alias("_full")]

    hot = hot_keys(df, keys, min_rows)
    placed = running(df, keys, order, position="_pos", min_rows=min_rows, hot=hot)
    rows = neighbours(placed, keys, order, 0, size - 1, make, min_rows, hot=hot)
    return rows.where((F.col("_full") == 1) & (F.pmod(F.col("_pos") - 1, F.lit(step)) == 0)).drop("_full", "_pos")


def runs(df: DataFrame, keys: list[str], order: list[str], symbol: str, min_rows: int = HOT_ROWS, hot=LOOK) -> DataFrame:
    """Runs of equal symbols in order: one row per run with its number, symbol, first and last position, length."""
    hot = known_hot(df, keys, min_rows, hot)
    placed = running(df.select(*keys, *order, symbol), keys, order, position="_pos", min_rows=min_rows, hot=hot)
    marked = neighbours(placed, keys, order, 1, 0, lambda w: [F.lag(symbol, 1).over(w).alias("_prev")], min_rows, hot=hot)
    starts = (F.col("_pos") == 1) | ~F.col(symbol).eqNullSafe(F.col("_prev"))
    numbered = running(marked.withColumn("_new", starts.cast("bigint")), keys, order,
                       sums={"run": F.col("_new")}, min_rows=min_rows, hot=hot)
    return numbered.groupBy(*keys, "run").agg(
        F.first(symbol).alias(symbol), F.min("_pos").alias("first_pos"), F.max("_pos").alias("last_pos"), F.count("*").alias("length"))


def match_path(df: DataFrame, keys: list[str], order: list[str], symbols: dict[str, Column], pattern: str,
               measures: dict[str, Column] | None = None, min_rows: int = HOT_ROWS) -> DataFrame:
    """Match a chain of symbols such as ``"LATE.LATE+"`` against the ordered rows of each key.

    A match is tried from every row; an element takes one row, ``+`` one or more and ``*`` any number, as long as
    the symbol's predicate holds. One output row per match: start and end position, size, and per measure the sum
    over the matched rows. Works by looking up where each symbol's streak ends, so rows of a key are never gathered.
    """
    wanted, measures = list(measures or {}), _finite(df, measures or {})
    elements = [(e.rstrip("+*"), e[-1] if e[-1] in "+*" else "") for e in pattern.split(".")]
    used = sorted({name for name, _ in elements})
    hot = hot_keys(df, keys, min_rows)
    base = running(df, keys, order, position="_pos", sums={f"_sum_{m}": c for m, c in measures.items()}, min_rows=min_rows, hot=hot)
    base = base.select("*", *[F.coalesce(symbols[s], F.lit(False)).alias(f"_is_{s}") for s in used], (-F.col("_pos")).alias("_back"))
    # the streak of a symbol ends before the next row, in order, where it does not hold
    ends = running(base, keys, ["_back"], mins={f"_end_{s}": F.when(~F.col(f"_is_{s}"), F.col("_pos")) for s in used},
                   total="_len", min_rows=min_rows, hot=hot)
    table = ends.select(*keys, "_pos", "_len", *[F.col(f"_is_{s}") for s in used],
                        *[F.coalesce(F.col(f"_end_{s}"), F.col("_len") + 1).alias(f"_end_{s}") for s in used],
                        *[F.col(f"_sum_{m}") for m in measures])
    first, quantifier = elements[0]
    at = table.select(*keys, F.col("_pos").alias("start_pos"), "_len", _step(first, quantifier).alias("_next")).where("_next IS NOT NULL")
    for name, quantifier in elements[1:]:
        look = table.select(*keys, "_pos", F.col(f"_is_{name}"), F.col(f"_end_{name}"))
        met = at.alias("a").join(look.alias("t"), same_keys("a", "t", keys) & (F.col("a._next") == F.col("t._pos")), "left")
        step = F.when(F.col("t._pos").isNull(), F.col("a._next") if quantifier == "*" else F.lit(None)).otherwise(_step(name, quantifier))
        at = met.select(*[F.col(f"a.{k}") for k in keys], "start_pos", F.col("a._len"), step.alias("_next")).where("_next IS NOT NULL")
    out = at.select(*keys, "start_pos", (F.col("_next") - 1).alias("end_pos"), (F.col("_next") - F.col("start_pos")).alias("size"))
    for m in measures:
        total = table.select(*keys, "_pos", F.col(f"_sum_{m}").alias("_v"))
        for edge, pos in (("_hi", F.col("o.end_pos")), ("_lo", F.col("o.start_pos") - 1)):
            out = out.alias("o").join(total.alias("t"), same_keys("o", "t", keys) & (pos == F.col("t._pos")), "left").select(
                "o.*", F.coalesce("t._v", F.lit(0)).alias(edge))
        out = out.withColumn(m, F.col("_hi") - F.col("_lo")).drop("_hi", "_lo")
    return out.select(*keys, "start_pos", "end_pos", "size", *[_with_infinities(m, measures) for m in wanted])


def _step(symbol: str, quantifier: str) -> Column:
    here = F.col(f"_is_{symbol}")
    if quantifier == "":
        return F.when(here, F.col("_pos") + 1)
    if quantifier == "+":
        return F.when(here, F.col(f"_end_{symbol}"))
    return F.col(f"_end_{symbol}")


def exact_percentiles(df: DataFrame, keys: list[str], value: str, points: list[float], name: str = "pct",
                      min_rows: int = HOT_ROWS, slices: int | None = None) -> DataFrame:
    """Exact interpolated percentiles per key from value counts: no key's values are held in one buffer.

    One row per key and point: (key, point, pct). A point p lies at position p * (n - 1) of the sorted values.
    """
    rows = df.where(F.col(value).isNotNull())
    levels = rows.groupBy(*keys, value).agg(F.count("*").alias("_ties"))
    levels = running(levels, keys, [value], sums={"_upto": F.col("_ties")}, min_rows=min_rows, slices=slices)
    totals = rows.groupBy(*keys).agg(F.count("*").alias("_total"))
    wanted = totals.select("*", F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("point")).select(
        *keys, "point", (F.col("point") * (F.col("_total") - 1)).alias("_spot"))
    if keys:
        pairs = levels.alias("l").join(wanted.alias("w"), same_keys("l", "w", keys))
    else:
        pairs = levels.alias("l").join(F.broadcast(wanted).alias("w"))
    low, high = F.floor("_spot"), F.ceil("_spot")
    inside = lambda spot: (spot >= F.col("_upto") - F.col("_ties")) & (spot < F.col("_upto"))
    lo, hi = F.col("_lo"), F.col("_hi")
    return (
        pairs.where(inside(low) | inside(high))
        .groupBy(*[F.col(f"w.{k}") for k in keys], "point", "_spot")
        .agg(F.max(F.when(inside(low), F.col(f"l.{value}"))).alias("_lo"), F.max(F.when(inside(high), F.col(f"l.{value}"))).alias("_hi"))
        .select(*keys, "point", (lo + (hi - lo) * (F.col("_spot") - low)).alias(name))
    )


def chunked_lists(df: DataFrame, keys: list[str], order: list[str], value: str, size: int, name: str = "items",
                  min_rows: int = HOT_ROWS) -> DataFrame:
    """All values of a key in order, as arrays of at most ``size``: (key, chunk, items)."""
    placed = running(df, keys, order, position="_pos", min_rows=min_rows)
    chunk = F.floor((F.col("_pos") - 1) / size).cast("bigint")
    lists = placed.groupBy(*keys, chunk.alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("_pos", F.col(value).alias("v")))).alias("_l"))
    return lists.select(*keys, "chunk", F.col("_l.v").alias(name))
