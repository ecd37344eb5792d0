"""Streaming queries over the events table, run until the input is used up and compared with the batch answer."""

import time

from pyspark.sql import functions as F

from millrace.functions.times import as_instant, from_instant
from millrace.operators import stats as st, windows as ow
from millrace.registry import query
from millrace.session import scratch_path
from millrace.streaming import commits as sc, models as sm, sinks as sk, sources as ss, state as sx


def days(t, upto=(8, 15, 22, 32)):
    """The events of January in four batches, in time order."""
    out, low = [], 0
    for high in upto:
        out.append(t.events.where((F.dayofmonth("ts") >= low) & (F.dayofmonth("ts") < high)))
        low = high
    return out


def events(t):
    return ss.queue_stream(days(t), "events")


def start_of(w="w"):
    return F.date_format(F.col(f"{w}.start"), "yyyy-MM-dd HH:mm").alias("start")


@query("stream_tumbling", """
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL""")
def stream_tumbling(t):
    counts = events(t).groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return sk.run_complete(counts, "tumbling").select(start_of(), "event_type", "n")


@query("stream_sliding", """
SELECT strftime(b - s * INTERVAL 6 HOUR, '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS b FROM events), (VALUES (0), (1)) v(s) GROUP BY 1""")
def stream_sliding(t):
    counts = events(t).groupBy(F.window("ts", "12 hours", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return sk.run_updates(counts.select("w", "n"), "sliding", ["w"]).select(start_of(), "n")


@query("stream_watermark", """
WITH kept AS (SELECT * FROM events WHERE NOT (ts < TIMESTAMP '2024-01-02' AND event_type = 'signup')),
w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS s, count(*) AS n FROM kept GROUP BY 1)
SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, n FROM w WHERE s + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM kept)""")
def stream_watermark(t):
    """The sign-ups of the first day arrive last; their windows are closed by then, so they are dropped."""
    late = (F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")) & (F.col("event_type") == "signup")
    batches = [b.where(~late) for b in days(t)] + [t.events.where(late)]
    rows = ss.queue_stream(batches, "late").withColumn("ts", as_instant("ts")).withWatermark("ts", "1 hour")
    counts = rows.groupBy(F.window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    path, _ = sk.run_append(counts, "watermark")
    return t.spark.read.parquet(path).select(F.date_format(from_instant(F.col("w.start")), "yyyy-MM-dd HH:mm").alias("start"), "n")


@query("stream_static_join", """
SELECT c_mktsegment, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events JOIN customer ON user_id = c_custkey GROUP BY ALL""")
def stream_static_join(t):
    joined = events(t).join(t.customer.select("c_custkey", "c_mktsegment"), F.col("user_id") == F.col("c_custkey"))
    totals = joined.groupBy("c_mktsegment", "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return sk.run_complete(totals, "static_join").withColumn("total", F.round("total", 2))


@query("stream_ranked_join", """
SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, c_mktsegment)::INTEGER AS rank
FROM (SELECT event_type, c_mktsegment, count(*) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY ALL) QUALIFY rank <= 3""")
def stream_ranked_join(t):
    """The stream meets the customers; after each batch the segments of each kind of event are ranked anew."""
    joined = events(t).join(t.customer.select("c_custkey", "c_mktsegment"), F.col("user_id") == F.col("c_custkey"))
    counts = sk.run_complete(joined.groupBy("event_type", "c_mktsegment").agg(F.count("*").alias("n")), "ranked")
    return ow.top_k(counts, ["event_type"], [F.desc("n"), F.col("c_mktsegment")], 3, "rank")


@query("stream_word_count", """
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents) WHERE word <> '' GROUP BY word""")
def stream_word_count(t):
    batches = [t.documents.where(F.pmod("doc_id", F.lit(3)) == i) for i in range(3)]
    return sk.run_complete(ss.words(ss.queue_stream(batches, "docs"), "text").groupBy("word").agg(F.count("*").alias("n")), "words")


@query("stream_running_count", """SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def stream_running_count(t):
    return sk.run_updates(events(t).groupBy("event_type").agg(F.count("*").alias("n")), "running", ["event_type"])


@query("stream_memory", """SELECT event_type, count(*) AS n, max(value) AS top FROM events GROUP BY event_type""")
def stream_memory(t):
    name = "millrace_" + scratch_path(t.spark, "m").rsplit("-", 1)[1]
    return sk.run_memory(events(t).groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("top")), name)


@query("stream_foreach_batch", """
SELECT event_type, round(sum(value), 2) AS total, count(DISTINCT user_id) AS users FROM events GROUP BY event_type""")
def stream_foreach_batch(t):
    """SQL over each batch as a view; partial results are stored per batch and added up."""
    path = scratch_path(t.spark, "per_batch")

    def handle(batch, batch_id):
        batch.createOrReplaceTempView("millrace_batch")
        part = batch.sparkSession.sql("SELECT event_type, user_id, sum(value) AS v FROM millrace_batch GROUP BY event_type, user_id")
        part.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    sk.run_batches(events(t), handle)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.round(F.sum("v"), 2).alias("total"), F.countDistinct("user_id").alias("users"))


@query("stream_foreach", """SELECT event_type, count(*) AS n FROM events WHERE value > 50 GROUP BY event_type""")
def stream_foreach(t):
    folder = scratch_path(t.spark, "foreach")
    sk.run_foreach(events(t).where("value > 50").select("event_id", "event_type"), folder)
    return t.spark.read.schema("event_id bigint, event_type string").json(folder).groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_epochs", """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type""")
def stream_epochs(t):
    """A sink of its own that commits each epoch once."""
    folder = scratch_path(t.spark, "epochs")
    stream = events(t).select("event_id", "event_type", "value")
    sc.run_epochs(stream, folder)
    return sc.read_epochs(t.spark, folder, stream.schema).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("stream_state", """
SELECT user_id, (count(*) + CASE WHEN user_id = 1 THEN 100 ELSE 0 END)::BIGINT AS n, round(sum(value) + CASE WHEN user_id = 1 THEN 5 ELSE 0 END, 2) AS total FROM events GROUP BY user_id""")
def stream_state(t):
    """User 1 starts with 100 events; part 0 of each state carries the start value."""
    parts = sk.run_updates(sx.running_totals(events(t), "user_id", "value", "event_id", {1: (100, 5.0)}), "state", ["user_id", "part"])
    return parts.groupBy("user_id").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("stream_state_timeout")
def stream_state_timeout(t):
    idle = sx.idle_groups(events(t), "user_id", "ts", 6 * 3600, "1 hour")
    path, _ = sk.run_append(idle, "idle")
    return t.spark.read.parquet(path)


@query("stream_idle_sessions", """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM g),
s AS (SELECT user_id, count(*) AS n, min(ts) AS first, max(ts) AS last FROM r GROUP BY user_id, run)
SELECT user_id, n, strftime(first, '%Y-%m-%d %H:%M:%S') AS first, strftime(last, '%Y-%m-%d %H:%M:%S') AS last FROM s
WHERE last + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_idle_sessions(t):
    """Event-time timeout: a user's events are given out when six hours have passed without one."""
    with sx.merged_sessions(t.spark):
        path, _ = sk.run_append(sx.idle_sessions(events(t), "user_id", "ts", "6 hours", "1 hour"), "sessions")
    show = lambda c: F.date_format(from_instant(F.col(c)), "yyyy-MM-dd HH:mm:ss").alias(c)
    return t.spark.read.parquet(path).select(F.col("key").alias("user_id"), "n", show("first"), show("last"))


@query("stream_idle_clock", """
SELECT user_id, count(*) AS n, epoch_us(max(ts)) // 1000 AS last_ms FROM events GROUP BY user_id""")
def stream_idle_clock(t):
    """Processing-time timeout. The second run comes after the idle time, with one row of no user, and fires all timers."""
    inbox = ss.queue(days(t), "clock")
    stream = lambda: ss.file_stream(t.spark, inbox, t.events.schema)
    with sx.state_store(t.spark):
        path, checkpoint = sk.run_append(sx.idle_by_clock(stream(), "user_id", "ts", "event_id", 200), "clock", kind="one_batch")
        time.sleep(0.3)
        t.events.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in t.events.schema]).write.mode("append").parquet(inbox)
        sk.run_append(sx.idle_by_clock(stream(), "user_id", "ts", "event_id", 200), "clock", checkpoint, path, "one_batch")
    out = t.spark.read.parquet(path).where("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n"), F.max("last_ms").alias("last_ms"))
    return out.withColumnRenamed("key", "user_id")


@query("stream_kind_totals", """
SELECT user_id, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY user_id, event_type""")
def stream_kind_totals(t):
    """A map in the state of each user: counts and sums by kind of event."""
    with sx.state_store(t.spark):
        parts = sk.run_updates(sx.kind_totals(events(t), "user_id", "event_type", "value", "event_id"), "kinds", ["key", "part", "kind"])
    out = parts.groupBy("key", "kind").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))
    return out.withColumnsRenamed({"key": "user_id", "kind": "event_type"})


@query("stream_latest", """
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)::INTEGER AS rank, event_id FROM events QUALIFY rank <= 3""")
def stream_latest(t):
    """A list in the state of each user: the last three events."""
    with sx.state_store(t.spark):
        parts = sk.run_updates(sx.latest(events(t), "user_id", "ts", "event_id", 3), "latest", ["key", "part", "slot"])
    return sx.latest_of(parts, 3).select(F.col("key").alias("user_id"), "rank", F.col("item").alias("event_id"))


@query("stream_recover", """SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def stream_recover(t):
    """Two runs with one checkpoint: the second run sees only the files that came after the first."""
    batches = days(t)
    inbox = ss.queue(batches[:2], "inbox")
    stream = lambda: ss.file_stream(t.spark, inbox, batches[0].schema, 1).select("event_id", "event_type")
    path, checkpoint = sk.run_append(stream(), "recovered")
    for b in batches[2:]:
        b.write.mode("append").parquet(inbox)
    sk.run_append(stream(), "recovered", checkpoint, path)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_transforms", """
SELECT kind, sum(v)::BIGINT AS total FROM (SELECT 'click' AS kind, user_id * 2 AS v FROM events WHERE event_type = 'click' UNION ALL SELECT 'other', user_id FROM events WHERE event_type <> 'click') GROUP BY kind""")
def stream_transforms(t):
    """Map, filter, union and reduce by key on streams."""
    clicks = events(t).where("event_type = 'click'").select(F.lit("click").alias("kind"), (F.col("user_id") * 2).alias("v"))
    others = events(t).where("event_type <> 'click'").select(F.lit("other").alias("kind"), F.col("user_id").alias("v"))
    return sk.run_complete(clicks.union(others).groupBy("kind").agg(F.sum("v").alias("total")), "transforms")


@query("stream_ab_test", """
WITH g AS (SELECT ts::DATE AS d, count(*) FILTER (WHERE x) AS n1, avg(value) FILTER (WHERE x) AS m1, var_samp(value) FILTER (WHERE x) AS v1,
  count(*) FILTER (WHERE NOT x) AS n0, avg(value) FILTER (WHERE NOT x) AS m0, var_samp(value) FILTER (WHERE NOT x) AS v0
  FROM (SELECT *, user_id % 2 = 1 AS x FROM events WHERE ts >= TIMESTAMP '2024-01-08') GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') AS day, round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) AS t FROM g""")
def stream_ab_test(t):
    """Daily Welch statistics; the first batch is the peace period and does not count."""
    rows = events(t).where(F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz"))
    tests = st.ab_test(rows, [F.window("ts", "1 day").alias("w")], F.col("user_id") % 2 == 1, "value")
    return sk.run_complete(tests, "ab").select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), F.round("t", 6).alias("t"))


@query("stream_regression", """SELECT round(regr_slope(value, user_id), 8) AS slope, round(regr_intercept(value, user_id), 6) AS intercept FROM events""")
def stream_regression(t):
    fit = sm.streaming_regression(events(t), "user_id", "value")
    return t.spark.createDataFrame([(round(fit["slope"], 8), round(fit["intercept"], 6))], "slope double, intercept double")


@query("stream_kmeans")
def stream_kmeans(t):
    batches = [t.embeddings.where(F.pmod("vec_id", F.lit(3)) == i).select("embedding") for i in range(3)]
    start = [[0.1 if (d + 7 * c) % 5 == 0 else -0.05 for d in range(64)] for c in range(3)]
    centres, weights = sm.streaming_kmeans(ss.queue_stream(batches, "vectors"), "embedding", start)
    return t.spark.createDataFrame([(i, float(w), float(c[0])) for i, (c, w) in enumerate(zip(centres, weights))], "cluster int, weight double, x0 double")
