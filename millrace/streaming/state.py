"""Custom keyed state.

Before the shuffle each task combines the rows of a key that lie in one Arrow batch, so a hot key sends one row for some
thousands and a key's state is asked for once a batch. Results name a part of the key, which is 0: readers that add the parts
up stay right; the null key is another part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.times import as_instant

#: states of ``idle_groups``, and the types of keys that share them
BUCKETS = 1024
PLAIN = ("tinyint", "smallint", "int", "bigint", "string", "boolean", "binary")


def _combined(rows: DataFrame, combine: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """The rows with those of a key and Arrow batch made fewer by ``combine``."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from combine(pa.Table.from_batches([batch])).combine_chunks().to_batches()

    return rows.mapInArrow(each, schema)


def _sums(keys: list[str], aggregates: dict[str, tuple[str, str]]) -> Callable[[pa.Table], pa.Table]:
    """Groups a batch by its keys; ``aggregates`` maps a result column to a column and Arrow's name of the aggregate."""
    def combine(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        found = table.group_by(keys).aggregate([(c, f, pc.ScalarAggregateOptions(min_count=0) if f == "sum" else None) for c, f in aggregates.values()])
        return pa.table({**{k: found[k] for k in keys}, **{name: found[f"{c}_{f}"] for name, (c, f) in aggregates.items()}})

    return combine


def _number(value) -> Column:
    """As a double; NaN counts as missing."""
    v = F.col(value).cast("double")
    return F.when(~F.isnan(v), v)


def running_totals(stream: DataFrame, key: str, value: str, row_id: str, initial: dict | None = None) -> DataFrame:
    """updateStateByKey: per key the count and sum so far, starting from ``initial`` {key: (count, total)}.

    Rows (key, part, n, total); ``row_id`` may be any column, as a key's rows are combined before the shuffle.
    """
    start = initial or {}
    kind = stream.schema[key].dataType.simpleString()

    def update(keys, frames: Iterator[pd.DataFrame], state: GroupState):
        k, part = keys
        n, total = state.get if state.exists else (start.get(k, (0, 0.0)) if part == 0 else (0, 0.0))
        for f in frames:
            n, total = n + int(f["_n"].to_numpy().sum()), total + float(f["_v"].to_numpy().sum())
        state.update((int(n), float(total)))
        yield pd.DataFrame({key: [k], "part": [part], "n": [int(n)], "total": [float(total)]})

    rows = stream.select(key, F.lit(0).alias("part"), _number(value).alias("_v"), F.lit(1).cast("bigint").alias("_n"))
    rows = _combined(rows, _sums([key, "part"], {"_n": ("_n", "sum"), "_v": ("_v", "sum")}), f"{key} {kind}, part int, _n bigint, _v double")
    return rows.groupBy(key, "part").applyInPandasWithState(
        update, f"{key} {kind}, part int, n bigint, total double", "n bigint, total double", "update", GroupStateTimeout.NoTimeout)


def idle_groups(stream: DataFrame, key: str, time: str, idle_seconds: int, delay: str) -> DataFrame:
    """Emit a key's event count and last time once the watermark has moved ``idle_seconds`` past its last event.

    A state holds the keys of one of ``BUCKETS`` hashes, as each call of Python costs much more than a key, and times out with the
    first of them; keys of other types than ``PLAIN`` have a state each. The missing key is a bucket of its own.
    """
    kind = stream.schema[key].dataType.simpleString()
    plain = kind in PLAIN
    idle = idle_seconds * 1000

    def update(group, frames: Iterator[pd.DataFrame], state: GroupState):
        held, fresh = {}, set()
        if state.exists:
            held = {k: (n, last) for k, n, last in zip(*state.get)}
        if not state.hasTimedOut:
            for f in frames:
                found = f.groupby("_k", dropna=False)["_ms"].agg(["size", "max"])
                for k, n, last in zip(found.index.tolist(), found["size"].tolist(), found["max"].tolist()):
                    k = None if pd.isna(k) else k
                    had = held.get(k, (0, 0))
                    held[k] = (had[0] + n, max(had[1], int(last)))
                    fresh.add(k)
        # a key without new rows waits for the watermark to be past its time, one with new rows for no more than to reach it
        now = state.getCurrentWatermarkMs()
        ended = [k for k, (_, last) in held.items() if last + idle < now or (last + idle == now and k in fresh)]
        if ended:
            rows = [held.pop(k) for k in ended]
            yield pd.DataFrame({key: pd.Series(ended if plain else [group[0]], dtype=object), "n": [n for n, _ in rows], "last_ms": [last for _, last in rows]})
        if held:
            state.update(([*held], [n for n, _ in held.values()], [last for _, last in held.values()]))
            state.setTimeoutTimestamp(min(last for _, last in held.values()) + idle)
        else:
            state.remove()

    # zone-free times are taken as UTC, whatever the session's zone
    at = as_instant(time) if dict(stream.dtypes)[time] == "timestamp_ntz" else F.col(time)
    bucket = F.coalesce(F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(BUCKETS))), F.lit(-1))
    rows = stream.select((bucket if plain else F.col(key)).alias("_group"), (F.col(key) if plain else F.lit(0)).alias("_k"), at.alias("_t")).withWatermark("_t", delay)
    rows = rows.select("_group", "_k", "_t", F.unix_millis("_t").alias("_ms"))
    return rows.groupBy("_group").applyInPandasWithState(
        update, f"{key} {kind}, n bigint, last_ms bigint", f"keys array<{kind if plain else 'int'}>, n array<bigint>, last_ms array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def state_store(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, as timers, lists and maps need; the session's own choice comes back."""
    return _setting(spark, "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def merged_sessions(spark: SparkSession):
    """Streams started inside merge the sessions of a task before the shuffle, so a hot key sends one row per task and session."""
    return _setting(spark, "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")


def _parts(stream: DataFrame, key: str, *columns) -> DataFrame:
    """Keys as texts, and the null key as part 1: the state's groups of Python must not have null keys (``_keys_back``)."""
    return stream.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(key).isNull().cast("int").alias("part"), *columns)


def _keys_back(rows: DataFrame, kind: str) -> DataFrame:
    return rows.withColumn("key", F.when(F.col("part") == 0, F.col("key").cast(kind)))


def idle_sessions(stream: DataFrame, key: str, time: str, gap: str, delay: str) -> DataFrame:
    """A row per run of a key's events without a gap, once the watermark has passed its end: event count, first and last time.

    The event-time form of a state with a timeout. Start it inside ``merged_sessions``.
    """
    at = as_instant(time) if dict(stream.dtypes)[time] == "timestamp_ntz" else F.col(time)
    rows = stream.select(F.col(key).alias("key"), at.alias("_t")).withWatermark("_t", delay)
    sessions = rows.groupBy("key", F.session_window("_t", gap).alias("w")).agg(F.count("*").alias("n"), F.min("_t").alias("first"), F.max("_t").alias("last"))
    return sessions.select("key", "n", "first", "last")


class _IdleParts(StatefulProcessor):
    """Counts a part's rows; a timer of the processing clock gives them out when none has come for a while."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n bigint, last_ms bigint, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, last, due = self.seen.get() or (0, None, None)
        for frame in rows:
            n += int(frame["n"].to_numpy().sum())
            own = frame["ms"].dropna()
            last = last if own.empty else int(own.max()) if last is None else max(last, int(own.max()))
        if due is not None:
            self.handle.deleteTimer(due)
        due = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
        self.seen.update((n, last, due))
        self.handle.registerTimer(due)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, last, _ = self.seen.get()
        self.seen.clear()
        yield pd.DataFrame({"key": pd.Series([key[0]], dtype=object), "part": [key[1]], "n": [n], "last_ms": pd.array([last], dtype="Int64")})

    def close(self) -> None:
        pass


def idle_by_clock(stream: DataFrame, key: str, time: str, row_id: str, idle_ms: int) -> DataFrame:
    """Rows (key, part, n, last_ms) of parts for which no row has come for ``idle_ms`` of the processing clock.

    What a key gave out is the sum of n and the maximum of last_ms over its parts. Start it inside ``state_store``.
    """
    kind = stream.schema[key].dataType.simpleString()
    at = as_instant(time) if dict(stream.dtypes)[time] == "timestamp_ntz" else F.col(time)
    rows = _parts(stream, key, F.unix_millis(at).alias("ms"), F.lit(1).cast("bigint").alias("n"))
    rows = _combined(rows, _sums(["key", "part"], {"n": ("n", "sum"), "ms": ("ms", "max")}), "key string, part int, n bigint, ms bigint")
    return _keys_back(rows.groupBy("key", "part").transformWithStateInPandas(_IdleParts(idle_ms), "key string, part int, n bigint, last_ms bigint", "Append", "ProcessingTime"), kind)


class _Kinds(StatefulProcessor):
    """A map of counts and sums by kind, each entry forgotten some time after its last change. It is one value of the state, so
    a batch of a key asks for it once and writes it once.
    """

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kinds = handle.getValueState("kinds", "kinds array<struct<kind:string,n:bigint,total:double,at:bigint>>", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = 0 if self.ttl_ms is None else timerValues.getCurrentProcessingTimeInMs()
        held, changed = {}, set()
        for kind, n, total, at in (self.kinds.get() or ([],))[0]:
            if self.ttl_ms is None or at + self.ttl_ms > now:
                held[kind] = (n, total, at)
        for frame in rows:
            for kind, n, total in zip(frame["kind"].tolist(), frame["n"].tolist(), frame["value"].tolist()):
                had = held.get(kind, (0, 0.0))
                held[kind] = (had[0] + n, had[1] + total, now)
                changed.add(kind)
        self.kinds.update(([(kind, *entry) for kind, entry in held.items()],))
        made = sorted(changed)
        yield pd.DataFrame({"key": pd.Series([key[0]] * len(made), dtype=object), "part": key[1], "kind": made, "n": [held[k][0] for k in made], "total": [held[k][1] for k in made]})

    def close(self) -> None:
        pass


def kind_totals(stream: DataFrame, key: str, kind: str, value: str, row_id: str, ttl_ms: int | None = None) -> DataFrame:
    """Rows (key, part, kind, n, total) of the entries that a batch changed; a null kind is the empty one.

    With ``ttl_ms`` an entry that has not changed for so long counts from nothing again. Start it inside ``state_store``.
    """
    key_kind = stream.schema[key].dataType.simpleString()
    rows = _parts(stream, key, F.coalesce(F.col(kind).cast("string"), F.lit("")).alias("kind"), _number(value).alias("value"), F.lit(1).cast("bigint").alias("n"))
    rows = _combined(rows, _sums(["key", "part", "kind"], {"n": ("n", "sum"), "value": ("value", "sum")}), "key string, part int, kind string, n bigint, value double")
    return _keys_back(rows.groupBy("key", "part").transformWithStateInPandas(
        _Kinds(ttl_ms), "key string, part int, kind string, n bigint, total double", "Update", "None" if ttl_ms is None else "ProcessingTime"), key_kind)


class _Latest(StatefulProcessor):
    """A list of the last items of a part."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getListState("items", "at bigint, item bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        items = list(self.items.get())
        for frame in rows:
            # of a batch no more than the last ones are held
            items = sorted([*items, *frame.nlargest(self.keep, ["at", "item"])[["at", "item"]].itertuples(index=False, name=None)])[-self.keep :]
        items = [(int(a), int(i)) for a, i in items]
        self.items.put(items)
        yield pd.DataFrame({"key": pd.Series([key[0]] * len(items), dtype=object), "part": key[1], "slot": range(len(items)), "at": [a for a, _ in items], "item": [i for _, i in items]})

    def close(self) -> None:
        pass


def latest(stream: DataFrame, key: str, time: str, item: str, keep: int) -> DataFrame:
    """Rows (key, part, slot, at, item) of the last ``keep`` items of each part that a batch touched; ``item`` identifies a row.

    The last of a key are among those of its parts: ``latest_of``. Rows without a time or an item are left out.
    """
    kind = stream.schema[key].dataType.simpleString()
    at = as_instant(time) if dict(stream.dtypes)[time] == "timestamp_ntz" else F.col(time)
    rows = _parts(stream, key, F.unix_micros(at).alias("at"), F.col(item).cast("long").alias("item")).where("at IS NOT NULL AND item IS NOT NULL")

    def last(table: pa.Table) -> pa.Table:
        frame = table.to_pandas()
        return table.take(pa.array(frame.sort_values(["at", "item"]).groupby(["key", "part"]).tail(keep).index))

    rows = _combined(rows, last, "key string, part int, at bigint, item bigint")
    return _keys_back(rows.groupBy("key", "part").transformWithStateInPandas(_Latest(keep), "key string, part int, slot int, at bigint, item bigint", "Update", "None"), kind)


def latest_of(parts: DataFrame, keep: int) -> DataFrame:
    """The last ``keep`` items of each key, newest first (``rank`` from 1), out of those of its parts."""
    order = Window.partitionBy("key").orderBy(F.desc("at"), F.desc("item"))
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).select("key", "rank", "at", "item")
