"""Streaming pieces that the named queries do not pin down."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import sinks as sk, sources as ss, state as sx


def test_triggers():
    assert sk.trigger("once") == {"availableNow": True}
    assert sk.trigger("processing_time", "5 seconds") == {"processingTime": "5 seconds"}
    for bad in ("1 month", "2 years", None, "soon"):
        with pytest.raises(ValueError):
            sk.trigger("processing_time", bad)
    with pytest.raises(ValueError):
        sk.trigger("sometimes", "1 second")


def test_kafka_options():
    assert ss.kafka_options("h:1", subscribe="t")["subscribe"] == "t"
    for bad in ({}, {"subscribe": "a", "pattern": "b"}):
        with pytest.raises(ValueError):
            ss.kafka_options("h:1", **bad)


def test_output_modes(spark):
    with pytest.raises(ValueError):
        sk.run_batches(spark.range(1), lambda df, i: None, "sometimes")


def test_idle_groups_close_after_the_gap(spark):
    day = dt.datetime(2024, 1, 1)
    first = [("a", day), ("a", day + dt.timedelta(minutes=5)), ("b", day + dt.timedelta(minutes=1))]
    later = [("c", day + dt.timedelta(hours=5)), ("b", day + dt.timedelta(hours=5))]
    last = [("d", day + dt.timedelta(hours=6))]
    schema = "k string, ts timestamp_ntz"
    stream = ss.queue_stream([spark.createDataFrame(x, schema).coalesce(1) for x in (first, later, last)], "idle")
    path, _ = sk.run_append(sx.idle_groups(stream, "k", "ts", 1800, "10 minutes"), "idle")
    got = sorted((r["k"], r["n"]) for r in spark.read.parquet(path).collect())
    # b comes back before its gap is over by the watermark; d is still open when the input ends
    assert got == [("a", 2), ("b", 2), ("c", 1)]


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_idle_groups_share_states(spark, monkeypatch, kind):
    """Keys of one bucket end at their own times; a key whose time the watermark just reaches waits if it has no new rows."""
    monkeypatch.setattr(sx, "BUCKETS", 2, raising=False)
    minute = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    big = 0 if kind == "double" else 2**60
    batches = [[(None, 0), (1, 0), (2, 5), (3, 20), (3, 20)], [(4, 40), (1, 38)], [(None, 1), (2, 41), (5, 75)], [(6, 200)]]
    rows = [[(None if k is None else {"string": f"k{k}", "double": float(k)}.get(kind, big + k), minute(m)) for k, m in b] for b in batches]
    stream = ss.queue_stream([spark.createDataFrame(b, f"k {kind}, ts timestamp_ntz").coalesce(1) for b in rows], "share")
    path, _ = sk.run_append(sx.idle_groups(stream, "k", "ts", 1800, "10 minutes"), "share")
    at = lambda m: int(minute(m).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    # the watermark is 10 before the second batch, 30 before the third: (None, 1) is late, and the first null row's time is reached, not passed
    want = [(None, 1, 0), (1, 2, 38), (2, 2, 41), (3, 2, 20), (4, 1, 40), (5, 1, 75)]
    show = lambda k: None if k is None else {"string": f"k{k}", "double": float(k)}.get(kind, big + k)
    assert sorted(map(repr, spark.read.parquet(path).toLocalIterator())) == sorted(repr(r) for r in spark.createDataFrame([(show(k), n, at(m)) for k, n, m in want], f"k {kind}, n bigint, last_ms bigint").collect())


def test_idle_groups_call_python_once_for_many_keys(spark):
    """Two thousand keys share fewer states than there are keys."""
    rows = spark.range(2000).select(F.col("id").alias("k"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts")).coalesce(1)
    q = sx.idle_groups(ss.queue_stream([rows], "many"), "k", "ts", 1800, "10 minutes").writeStream.outputMode("append").format("noop")
    q = q.option("checkpointLocation", scratch_path(spark, "many")).trigger(availableNow=True).start()
    sk.finish(q)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 1025


def test_running_totals_over_batches(spark):
    rnd = random.Random(2)
    data = [(i, rnd.choice("xy"), float(i % 5)) for i in range(200)]
    batches = [spark.createDataFrame(data[i::3], "id bigint, k string, v double").coalesce(1) for i in range(3)]
    out = sk.run_updates(sx.running_totals(ss.queue_stream(batches, "totals"), "k", "v", "id", {"x": (10, 1.0)}), "totals", ["k", "part"])
    got = {r["k"]: (r["n"], r["t"]) for r in out.groupBy("k").agg(F.sum("n").alias("n"), F.sum("total").alias("t")).collect()}
    want = {k: (sum(1 for _, c, _ in data if c == k) + (10 if k == "x" else 0), sum(v for _, c, v in data if c == k) + (1.0 if k == "x" else 0)) for k in "xy"}
    assert got == want


class Ended(Exception):
    pass


def test_model_survives_an_end_between_write_and_commit(spark):
    """A batch whose version is stored and whose commit is missing runs again after a restart, and counts once."""
    from millrace.session import scratch_path
    from millrace.streaming import models as sm

    rnd = random.Random(7)
    files = [spark.createDataFrame([([float(rnd.randint(0, 20)), float(rnd.randint(0, 20))],) for _ in range(30)], "v array<double>").coalesce(1) for _ in range(3)]
    inbox = ss.queue(files, "points")
    stream = lambda: ss.file_stream(spark, inbox, files[0].schema, 1)
    start, decay = [[0.0, 0.0], [20.0, 20.0]], 0.5
    whole = sm.streaming_kmeans(stream(), "v", start, decay)

    def end(batch_id):
        if batch_id == 1:
            raise Ended

    checkpoint = scratch_path(spark, "ended")
    with pytest.raises(Exception):
        sm.streaming_kmeans(stream(), "v", start, decay, checkpoint, end)
    assert sm.streaming_kmeans(stream(), "v", start, decay, checkpoint) == whole
    assert sm.streaming_kmeans(stream(), "v", start, decay, checkpoint) == whole  # nothing new
    files[0].write.mode("append").parquet(inbox)
    centres, weights = sm.streaming_kmeans(stream(), "v", start, decay, checkpoint)
    assert centres != whole[0] and abs(sum(weights) - (sum(whole[1]) * decay + 30)) < 1e-9


def test_regression_with_offsets_and_missing_values(spark):
    from millrace.streaming import models as sm

    rows = [(1e9 + i, 3.0 * i + 5.0 if i % 7 else None) for i in range(60)]
    batches = [spark.createDataFrame(rows[a : a + 20], "x double, y double").coalesce(1) for a in (0, 20, 40)]
    fit = sm.streaming_regression(ss.queue_stream(batches, "line"), "x", "y")
    assert abs(fit["slope"] - 3) < 1e-8 and abs(fit["intercept"] / (5 - 3e9) - 1) < 1e-9


def test_kind_totals_forget_after_their_time(spark):
    import time

    from millrace.session import scratch_path

    schema = "id bigint, k string, kind string, v double"
    inbox = ss.queue([spark.createDataFrame([(1, "a", "x", 2.0), (2, "a", None, None)], schema)], "kinds")
    checkpoint = scratch_path(spark, "kinds-checkpoint")
    got = []

    def run():
        stream = sx.kind_totals(ss.file_stream(spark, inbox, spark.createDataFrame([], schema).schema), "k", "kind", "v", "id", 1000)
        with sx.state_store(spark):
            q = stream.writeStream.outputMode("update").foreachBatch(lambda df, i: got.append(sorted((r["kind"], r["n"], r["total"]) for r in df.collect()))).option("checkpointLocation", checkpoint).trigger(once=True).start()
            sk.finish(q)

    run()
    time.sleep(1.5)
    spark.createDataFrame([(1, "a", "x", 5.0)], schema).write.mode("append").parquet(inbox)  # the same part of the key
    run()
    assert [x for x in got if x] == [[("", 1, 0.0), ("x", 1, 2.0)], [("x", 1, 5.0)]]


def test_a_key_is_one_group_of_the_state(spark):
    """One key, a null one, missing values and NaN."""
    nan = float("nan")
    data = [(i, None if i % 10 == 9 else 2**60 + 1, None if i % 7 == 0 else "xy"[i % 2], None if i % 5 == 0 else nan if i % 11 == 0 else float(i % 3), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(400)]
    batches = [spark.createDataFrame(data[i::2], "id bigint, k bigint, kind string, v double, ts timestamp_ntz").coalesce(1) for i in range(2)]
    whole = lambda rows: sum(0.0 if r[3] is None or r[3] != r[3] else r[3] for r in rows)
    keys = [None, 2**60 + 1]
    out = sk.run_updates(sx.running_totals(ss.queue_stream(batches, "totals"), "k", "v", "id"), "totals", ["k", "part"])
    assert sorted((str(r["k"]), r["n"], r["total"]) for r in out.collect()) == sorted((str(k), len(x), whole(x)) for k in keys for x in [[r for r in data if r[1] == k]])
    with sx.state_store(spark):
        kinds = sk.run_updates(sx.kind_totals(ss.queue_stream(batches, "kinds"), "k", "kind", "v", "id"), "kinds", ["key", "part", "kind"]).collect()
        last = sk.run_updates(sx.latest(ss.queue_stream(batches, "latest"), "k", "ts", "id", 3), "latest", ["key", "part", "slot"])
        last = sx.latest_of(last, 3).collect()
    want = [(str(k), kind or "", len(x), whole(x)) for k in keys for kind in (None, "x", "y") for x in [[r for r in data if r[1] == k and r[2] == kind]] if x]
    assert sorted((str(r["key"]), r["kind"], r["n"], r["total"]) for r in kinds) == sorted(want)
    assert sorted((str(r["key"]), r["rank"], r["item"]) for r in last) == sorted((str(k), i + 1, r[0]) for k in keys for i, r in enumerate([r for r in data[::-1] if r[1] == k][:3]))
    assert {r["part"] for r in out.collect()} == {0}  # eight groups for a key before


def test_combining_keeps_one_row_for_a_key(spark):
    rows = spark.range(1000).coalesce(1).selectExpr("id % 2 AS k", "1L AS n", "CAST(NULL AS double) AS v")
    made = sx._combined(rows, sx._sums(["k"], {"n": ("n", "sum"), "v": ("v", "sum")}), "k bigint, n bigint, v double").collect()
    assert sorted(map(tuple, made)) == [(0, 500, 0.0), (1, 500, 0.0)]
