"""Row patterns with groups, alternatives and nested repetition over the ordered rows of each key.

A pattern is turned into an automaton whose states are the symbols as they stand in the pattern. Read from the last row
backwards, each row knows for each state how far a match can still go: the furthest of what the next row's states know. So
one pass gives the longest match from every row, and no row is read twice, however long the matches are.

Keys of more than ``SLICE_ROWS`` rows are cut into slices. A slice as a whole is a table: for each state, how far a match may
go inside it, and in which states it may leave it. The tables of a key (one row per slice) are put together from the back,
and then every slice is passed on its own with what its successor knows. So a hot key is spread over the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from millrace.operators.joins import is_small
from millrace.operators.skew import HOT_ROWS, hot_keys, same_keys
from millrace.operators.windows import running

SLICE_ROWS = 50_000
NEVER = -1


@dataclass
class _Part:
    """What a piece of a pattern may begin and end with, and whether it may take no row at all."""

    empty: bool = True
    first: set[int] = field(default_factory=set)
    last: set[int] = field(default_factory=set)


class Pattern:
    """Symbols joined by dots, ``|`` between alternatives, groups in parentheses, and ``+ * ?`` behind a symbol or group."""

    def __init__(self, text: str):
        self.tokens = re.findall(r"\w+|[().|+*?]", text)
        if "".join(self.tokens) != re.sub(r"\s", "", text):
            raise ValueError(f"pattern {text!r} has unknown characters")
        self.tokens.reverse()
        self.symbols: list[str] = []  # of state i + 1
        self.follow: list[set[int]] = [set()]
        whole = self._alternatives()
        if self.tokens:
            raise ValueError(f"pattern {text!r} has an unexpected {self.tokens[-1]!r}")
        self.follow[0] = whole.first
        self.last = whole.last
        if len(self.symbols) > 60:
            raise ValueError("a pattern has 60 symbols at most")

    def _alternatives(self) -> _Part:
        parts = [self._chain()]
        while self.tokens and self.tokens[-1] == "|":
            self.tokens.pop()
            parts.append(self._chain())
        return _Part(any(p.empty for p in parts), set().union(*(p.first for p in parts)), set().union(*(p.last for p in parts)))

    def _chain(self) -> _Part:
        whole = self._repeated()
        while self.tokens and self.tokens[-1] == ".":
            self.tokens.pop()
            part = self._repeated()
            for state in whole.last:
                self.follow[state] |= part.first
            whole = _Part(whole.empty and part.empty, whole.first | (part.first if whole.empty else set()), part.last | (whole.last if part.empty else set()))
        return whole

    def _repeated(self) -> _Part:
        token = self.tokens.pop() if self.tokens else ""
        if token == "(":
            part = self._alternatives()
            if not self.tokens or self.tokens.pop() != ")":
                raise ValueError("a group is not closed")
        elif re.fullmatch(r"\w+", token):
            self.symbols.append(token)
            self.follow.append(set())
            part = _Part(False, {len(self.symbols)}, {len(self.symbols)})
        else:
            raise ValueError(f"a symbol or group is missing before {token!r}")
        while self.tokens and self.tokens[-1] in "+*?":
            mark = self.tokens.pop()
            part = _Part(part.empty or mark in "*?", part.first, part.last)
            if mark in "+*":
                for state in part.last:
                    self.follow[state] |= part.first
        return part

    def names(self) -> list[str]:
        return sorted(set(self.symbols))

    def steps(self) -> _Steps:
        return _Steps(self)


class _Steps(dict):
    """For a set of symbols that a row holds (as bits, in the order of ``names``): where each state goes. Worked out once for each set."""

    def __init__(self, pattern: Pattern):
        bit = {n: 1 << k for k, n in enumerate(pattern.names())}
        self.own, self.follow = [0, *(bit[s] for s in pattern.symbols)], pattern.follow

    def __missing__(self, held: int) -> list[tuple[int, ...]]:
        self[held] = [tuple(sorted(x for x in f if self.own[x] & held)) for f in self.follow]
        return self[held]


def _backwards(pattern: Pattern):
    """``pass_(know, rows)``: rows are (position, symbols held), last first; yields after each what every state knows."""
    table, ends = pattern.steps(), pattern.last

    def pass_(know: list[int], rows: Iterator[tuple[int, int]]) -> Iterator[list[int]]:
        for position, held in rows:
            here = []
            for state, into in enumerate(table[held]):
                best = position - 1 if state in ends else NEVER
                for x in into:
                    best = max(best, know[x])
                here.append(best)
            know = here
            yield know

    return pass_


def _at_end(pattern: Pattern, position: int) -> list[int]:
    """What the states know behind the last row."""
    return [position if s in pattern.last else NEVER for s in range(len(pattern.follow))]


def _slice_tables(rows: DataFrame, keys: list[str], pattern: Pattern) -> DataFrame:
    """For each slice: per state the furthest end inside it, and the states (as bits) that it may be left in."""
    states = len(pattern.follow)
    schema = StructType([*(rows.schema[k] for k in keys), rows.schema["_slice"], StructField("_best", ArrayType(LongType())), StructField("_reach", ArrayType(LongType()))])
    table, ends = pattern.steps(), pattern.last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, reach, own = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*own, pa.array([best], pa.list_(pa.int64())), pa.array([reach], pa.list_(pa.int64()))], names=schema.names)

        for batch in batches:
            positions, held, last = (batch.column(c).to_pylist() for c in ("_pos", "_held", "_last"))
            for i, position in enumerate(positions):
                if last[i]:
                    if own is not None:
                        yield done()
                    own = [batch.column(c).slice(i, 1) for c in (*keys, "_slice")]
                    best, reach = [NEVER] * states, [1 << s for s in range(states)]
                steps = table[held[i]]
                best = [max([position - 1 if s in ends else NEVER, *(best[x] for x in steps[s])]) for s in range(states)]
                left = [0] * states
                for s in range(states):
                    for x in steps[s]:
                        left[s] |= reach[x]
                reach = left
        if own is not None:
            yield done()

    return _laid(rows, [*keys, "_slice"]).mapInArrow(run, schema)


def _known_behind(tables: DataFrame, keys: list[str], pattern: Pattern) -> DataFrame:
    """For each slice but the last of its key: what the states know behind its last row (``_know``)."""
    states = len(pattern.follow)
    schema = StructType([*(tables.schema[k] for k in keys), tables.schema["_slice"], StructField("_know", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        know = None
        for batch in batches:
            out = []
            for first, best, reach, end in zip(*(batch.column(c).to_pylist() for c in ("_final", "_best", "_reach", "_len"))):
                know = _at_end(pattern, end) if first else know
                know = [max([best[s], *(know[x] for x in range(states) if reach[s] >> x & 1)]) for s in range(states)]
                out.append(know)
            before = pa.array([n - 1 for n in batch.column("_slice").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), before, pa.array(out, pa.list_(pa.int64()))], names=schema.names)

    return tables.repartition(*keys).sortWithinPartitions(*keys, F.desc("_slice")).mapInArrow(run, schema).where("_slice >= 0")


def _laid(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.repartition(*by).sortWithinPartitions(*by, F.desc("_pos"))


def match_groups(df: DataFrame, keys: list[str], order: list[str], symbols: dict[str, Column], pattern: str, columns: dict[str, Column] | None = None,
                 sums: dict[str, Column] | None = None, min_rows: int = HOT_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The longest match of the pattern from every row that one starts at: start and end position, size, ``columns`` of the
    row that it starts at, and ``sums`` over its rows.

    ``order`` must identify a row within its key. A row may hold several symbols; a null predicate does not hold. Keys may
    be empty or null. ``path_rows`` gives the rows of the matches.
    """
    compiled, columns, sums = Pattern(pattern), dict(columns or {}), dict(sums or {})
    if missing := set(compiled.names()) - set(symbols):
        raise ValueError(f"symbols {sorted(missing)} are not defined")
    held = sum((F.when(symbols[s], F.lit(1 << k)).otherwise(F.lit(0)) for k, s in enumerate(compiled.names())), F.lit(0))
    hot = hot_keys(df, keys, min_rows)
    totals = {f"_upto_{n}": F.coalesce(c, F.lit(0)) for n, c in sums.items()}
    marked = df.select(*keys, *[c for c in order if c not in keys], held.cast("long").alias("_held"), *[c.alias(f"_c_{n}") for n, c in columns.items()], *[c.alias(f"_v{n}") for n, c in totals.items()])
    placed = running(marked, keys, order, position="_pos", total="_len", sums={n: F.col(f"_v{n}") for n in totals}, min_rows=min_rows, hot=hot)
    rows = placed.select(*keys, "_pos", "_len", "_held", *[f"_c_{n}" for n in columns], *[c for n in totals for c in (n, f"_v{n}")])
    rows = rows.withColumn("_slice", F.expr(f"(_pos - 1) div {slice_rows}")).withColumn("_last", (F.col("_pos") == F.col("_len")) | (F.col("_pos") % slice_rows == 0))
    longer = rows.where(F.col("_len") > slice_rows)
    if longer.limit(1).count():
        sizes = longer.groupBy(*keys).agg(F.max("_len").alias("_len"))
        tables = _slice_tables(longer, keys, compiled).alias("t").join(sizes.alias("s"), same_keys("t", "s", keys)).select("t.*", "s._len")
        known = _known_behind(tables.withColumn("_final", F.col("_slice") == F.expr(f"(_len - 1) div {slice_rows}")), keys, compiled)
        # one row per slice of a long key
        near = F.broadcast(known) if is_small(known) else known
        rows = rows.alias("a").join(near.alias("k"), same_keys("a", "k", keys) & (F.col("a._slice") == F.col("k._slice")) & F.col("a._last"), "left").select("a.*", "k._know")
    else:
        rows = rows.withColumn("_know", F.lit(None).cast("array<bigint>"))
    return _matched(rows, keys, compiled, list(columns), list(sums))


def _matched(rows: DataFrame, keys: list[str], pattern: Pattern, columns: list[str], sums: list[str]) -> DataFrame:
    schema = rows.schema.add("_end", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pass_, know = _backwards(pattern), None
        for batch in batches:
            given = zip(*(batch.column(c).to_pylist() for c in ("_pos", "_held", "_last", "_know")))
            ends = []
            for position, held, last, behind in given:
                if last:
                    know = behind if behind is not None else _at_end(pattern, position)
                know = next(pass_(know, [(position, held)]))
                ends.append(know[0] if know[0] >= position else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.int64())], names=schema.names)

    found = _laid(rows, [*keys, "_slice"]).mapInArrow(run, schema).where("_end IS NOT NULL")
    out = found.select(*keys, F.col("_pos").alias("start_pos"), F.col("_end").alias("end_pos"), (F.col("_end") - F.col("_pos") + 1).alias("size"),
                       *[F.col(f"_c_{n}").alias(n) for n in columns], *[(F.col(f"_upto_{n}") - F.col(f"_v_upto_{n}")).alias(f"_before_{n}") for n in sums])
    if not sums:
        return out
    ends = rows.select(*keys, "_pos", *[f"_upto_{n}" for n in sums])
    both = out.alias("o").join(ends.alias("e"), same_keys("o", "e", keys) & (F.col("o.end_pos") == F.col("e._pos")))
    return both.select(*[F.col(f"o.{c}") for c in (*keys, "start_pos", "end_pos", "size", *columns)], *[(F.col(f"e._upto_{n}") - F.col(f"o._before_{n}")).alias(n) for n in sums])


def path_rows(df: DataFrame, matches: DataFrame, keys: list[str], order: list[str], columns: dict[str, Column], min_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of each match of ``match_groups``: keys, start position, ``step`` (from 0) and ``columns`` of the row.

    As many rows as the matches have in all. A match's path is not gathered; ``path_chunks`` makes arrays of bounded length.
    """
    marked = df.select(*keys, *[c for c in order if c not in keys], *[c.alias(f"_c_{n}") for n, c in columns.items()])
    placed = running(marked, keys, order, position="_pos", min_rows=min_rows)
    steps = matches.select(*keys, "start_pos", F.posexplode(F.sequence("start_pos", "end_pos")).alias("step", "_pos"))
    both = steps.alias("m").join(placed.alias("r"), same_keys("m", "r", keys) & (F.col("m._pos") == F.col("r._pos")))
    return both.select(*[F.col(f"m.{k}") for k in keys], "m.start_pos", F.col("m.step").cast("bigint").alias("step"), *[F.col(f"r._c_{n}").alias(n) for n in columns])


def path_chunks(paths: DataFrame, keys: list[str], columns: list[str], size: int = 1000) -> DataFrame:
    """``path_rows`` as arrays of at most ``size`` rows: keys, start position, ``chunk`` (from 0) and ``tpath``."""
    item = F.struct("step", *columns)
    chunks = paths.groupBy(*keys, "start_pos", F.expr(f"step div {size}").alias("chunk")).agg(F.array_sort(F.collect_list(item)).alias("tpath"))
    return chunks.withColumn("tpath", F.transform("tpath", lambda x: F.struct(*[x[c].alias(c) for c in columns])))
