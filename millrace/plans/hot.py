"""The window, run and row-pattern operators on their hot-key path, against plain windows in the SQL twins.

Half of the users are one user here, and the three order states and return flags are hot by themselves. ``min_rows`` is
low, so the path is taken at every size; slices are more than the tasks in some queries and fewer in others.
"""

from pyspark.sql import functions as F

from millrace.functions.times import epoch_micros
from millrace.operators import patterns, sequences, windows as ow
from millrace.registry import query

MIN_ROWS = 200
FEW, MANY = 5, 50
POINTS = [0.0, 0.25, 0.5, 0.99, 1.0]
BY = ["user_id"]
ORDER = ["ts", "event_id"]

EVENTS = """e AS (SELECT event_id, ts, event_type, CASE WHEN user_id % 2 = 0 THEN 0 ELSE user_id END AS user_id,
  CASE WHEN event_id % 11 <> 0 THEN value END AS v, CASE WHEN event_id % 401 = 400 THEN 'inf'::DOUBLE ELSE value END AS far,
  'https://site.example/item/' || event_id AS link FROM events)"""


def events(t):
    rows = t.events.select("event_id", "ts", "event_type", F.when(F.col("user_id") % 2 == 0, 0).otherwise(F.col("user_id")).alias("user_id"), "value",
                           F.concat(F.lit("https://site.example/item/"), "event_id").alias("link"))
    return rows.withColumns({"v": F.when(F.col("event_id") % 11 != 0, F.col("value")),
                             "far": F.when(F.col("event_id") % 401 == 400, float("inf")).otherwise(F.col("value"))}).drop("value")


@query("hot_running", f"""
WITH {EVENTS} SELECT event_id, round(sum(v) OVER w, 4) AS running, max(v) OVER w AS top, min(link) OVER w AS low, row_number() OVER w AS pos, count(*) OVER (PARTITION BY user_id) AS n
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_type, link ROWS UNBOUNDED PRECEDING)""")
def hot_running(t):
    """Heavy ties in the first order column, a long common prefix in the second, missing values, many slices."""
    out = ow.running(events(t), BY, ["event_type", "link"], {"running": F.col("v")}, {"top": F.col("v")}, {"low": F.col("link")}, "pos", "n", MIN_ROWS, MANY)
    return out.select("event_id", F.round("running", 4).alias("running"), "top", "low", "pos", "n")


@query("hot_running_infinite", f"""
WITH {EVENTS} SELECT event_id, far_sum = 'inf'::DOUBLE AS endless, CASE WHEN far_sum < 'inf'::DOUBLE THEN round(far_sum, 4) END AS far_sum
FROM (SELECT event_id, sum(far) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS far_sum FROM e)""")
def hot_running_infinite(t):
    out = ow.running(events(t), BY, ORDER, {"far_sum": F.col("far")}, min_rows=MIN_ROWS, slices=FEW)
    endless = F.col("far_sum") == float("inf")
    return out.select("event_id", endless.alias("endless"), F.when(~endless, F.round("far_sum", 4)).alias("far_sum"))


@query("hot_rank_all", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_orderkey) AS row_number, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
       round(percent_rank() OVER w, 8) AS percent_rank, round(cume_dist() OVER w, 8) AS cume_dist,
       ntile(7) OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_orderkey) AS ntile
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderpriority)""")
def hot_rank_all(t):
    out = ow.rank_all(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus"], "o_orderpriority", ["o_orderkey"], 7, MIN_ROWS, MANY)
    return out.select("o_orderkey", "row_number", "rank", "dense_rank", F.round("percent_rank", 8).alias("percent_rank"),
                      F.round("cume_dist", 8).alias("cume_dist"), "ntile")


@query("hot_neighbours", f"""
WITH {EVENTS} SELECT event_id, lag(v) OVER w AS prev, lead(link, 3) OVER w AS third_next, count(v) OVER (w ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING) AS n
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def hot_neighbours(t):
    return ow.neighbours(events(t), BY, ORDER, 4, 3, lambda w: [
        F.lag("v").over(w).alias("prev"), F.lead("link", 3).over(w).alias("third_next"), F.count("v").over(w.rowsBetween(-4, 3)).alias("n")],
        MIN_ROWS, MANY).select("event_id", "prev", "third_next", "n")


@query("hot_range_frame", f"""
WITH {EVENTS} SELECT event_id, count(*) OVER w AS n, (sum(event_id) OVER w)::BIGINT AS ids, max(v) OVER w AS top,
  far_sum = 'inf'::DOUBLE AS endless, CASE WHEN far_sum < 'inf'::DOUBLE THEN round(far_sum, 4) END AS far_sum
FROM (SELECT *, list_sum(list(far) OVER w) AS far_sum FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 1 HOUR FOLLOWING))
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 1 HOUR FOLLOWING)""")
def hot_range_frame(t):
    """An infinite value is in the sums of the frames that hold it, and in no others."""
    rows, hour = events(t).withColumn("at", epoch_micros("ts")), 3600 * 1_000_000
    out = ow.range_frame(rows, BY, "at", 3 * hour, hour, {"ids": F.col("event_id"), "far_sum": F.col("far")}, "n", {"top": F.col("v")}, min_rows=MIN_ROWS, slices=FEW)
    endless = F.col("far_sum") == float("inf")
    return out.select("event_id", "n", "ids", "top", endless.alias("endless"), F.when(~endless, F.round("far_sum", 4)).alias("far_sum"))


@query("hot_range_days", """
SELECT l_returnflag, day, n, near, items FROM (SELECT l_returnflag, day, n, (sum(n) OVER w)::BIGINT AS near, (sum(items) OVER w)::BIGINT AS items FROM
  (SELECT l_returnflag, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS day, count(*) AS n, sum(l_quantity::BIGINT) AS items FROM lineitem GROUP BY ALL)
  WINDOW w AS (PARTITION BY l_returnflag ORDER BY day RANGE BETWEEN 30 PRECEDING AND 7 FOLLOWING))""")
def hot_range_days(t):
    """Frames over whole lines: each return flag holds a third of them."""
    rows = t.lineitem.select("l_returnflag", F.unix_date(F.to_date("l_shipdate")).alias("day"), F.col("l_quantity").cast("bigint").alias("q"))
    out = ow.range_frame(rows, ["l_returnflag"], "day", 30, 7, {"items": F.col("q")}, "near", min_rows=MIN_ROWS, slices=MANY)
    return out.groupBy("l_returnflag", "day").agg(F.count("*").alias("n"), F.first("near").alias("near"), F.first("items").alias("items"))


@query("hot_fill_forward", f"""
WITH {EVENTS} SELECT event_id, last_value(p IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS p_filled
FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN v END AS p FROM e)""")
def hot_fill_forward(t):
    rows = events(t).withColumn("p", F.when(F.col("event_type") == "purchase", F.col("v")))
    return ow.fill_forward(rows, BY, ORDER, ["p"], MIN_ROWS, MANY).select("event_id", "p_filled")


@query("hot_sliding", f"""
WITH {EVENTS} SELECT user_id, array_to_string(items, ',') AS items FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
  list(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS items FROM e) WHERE len(items) = 5 AND (pos - 1) % 3 = 0""")
def hot_sliding(t):
    out = ow.sliding(events(t), BY, ORDER, "event_id", 5, 3, min_rows=MIN_ROWS)
    return out.select("user_id", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query("hot_runs", f"""
WITH {EVENTS}, p AS (SELECT user_id, event_type, row_number() OVER w AS pos, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS fresh
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, (sum(fresh) OVER (PARTITION BY user_id ORDER BY pos))::BIGINT AS run FROM p)
SELECT user_id, run, min(event_type) AS event_type, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS length FROM r GROUP BY user_id, run""")
def hot_runs(t):
    return ow.runs(events(t), BY, ORDER, "event_type", MIN_ROWS)


@query("hot_matchpath", f"""
WITH {EVENTS}, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, count(*) OVER (PARTITION BY user_id) AS len FROM e),
s AS (SELECT *, coalesce(min(CASE WHEN coalesce(v <= 20, true) THEN pos END) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), len + 1) AS ends,
  sum(event_id) OVER (PARTITION BY user_id ORDER BY pos) AS upto FROM p)
SELECT s.user_id, s.pos AS start_pos, s.ends - 1 AS end_pos, s.ends - s.pos AS size, (z.upto - s.upto + s.event_id)::BIGINT AS ids,
  z.seen > s.seen - s.far_here AS endless
FROM (SELECT *, (far = 'inf'::DOUBLE)::INT AS far_here, sum((far = 'inf'::DOUBLE)::INT) OVER (PARTITION BY user_id ORDER BY pos) AS seen FROM s) s
JOIN (SELECT user_id, pos, upto, sum((far = 'inf'::DOUBLE)::INT) OVER (PARTITION BY user_id ORDER BY pos) AS seen FROM s) z ON z.user_id = s.user_id AND z.pos = s.ends - 1
WHERE s.v > 20 AND s.ends - s.pos >= 2""")
def hot_matchpath(t):
    out = ow.match_path(events(t), BY, ORDER, {"BIG": F.col("v") > 20}, "BIG.BIG+", {"ids": F.col("event_id"), "far_sum": F.col("far")}, MIN_ROWS)
    return out.select("user_id", "start_pos", "end_pos", "size", "ids", (F.col("far_sum") == float("inf")).alias("endless"))


@query("hot_matchpath_groups", f"""
WITH {EVENTS}, l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
  CASE WHEN v > 50 THEN 'H' WHEN event_type = 'click' THEN 'C' WHEN event_type = 'view' THEN 'V' ELSE '-' END AS letter FROM e),
s AS (SELECT user_id, string_agg(letter, '' ORDER BY pos) AS path FROM l GROUP BY ALL),
m AS (SELECT l.*, length(regexp_extract(substr(path, pos::BIGINT, 2000), '^((V|C)+(H(V|C)*)+H)')) AS size FROM l JOIN s USING (user_id)),
u AS (SELECT user_id, pos, event_id, sum(event_id) OVER (PARTITION BY user_id ORDER BY pos) AS upto FROM l)
SELECT m.user_id, m.pos AS start_pos, m.pos + m.size - 1 AS end_pos, m.size, (z.upto - a.upto + a.event_id)::BIGINT AS ids
FROM m JOIN u a ON a.user_id = m.user_id AND a.pos = m.pos JOIN u z ON z.user_id = m.user_id AND z.pos = m.pos + m.size - 1 WHERE m.size > 0""")
def hot_matchpath_groups(t):
    """A group repeated inside a group, over a key that is cut into many slices, shorter than its longest matches."""
    kind, high = F.col("event_type"), F.coalesce(F.col("v") > 50, F.lit(False))
    symbols = {"HIGH": high, "CLICK": ~high & (kind == "click"), "VIEW": ~high & (kind == "view")}
    return patterns.match_groups(events(t), BY, ORDER, symbols, "(VIEW|CLICK)+.(HIGH.(VIEW|CLICK)*)+.HIGH", sums={"ids": F.col("event_id")}, min_rows=MIN_ROWS, slice_rows=7)


@query("hot_prefix_span", f"""
WITH {EVENTS}, p AS (SELECT user_id AS u, event_type AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM e),
one AS (SELECT u, k AS pattern, min(pos) AS pos FROM p GROUP BY u, k),
two AS (SELECT p.u, pattern || '>' || k AS pattern, min(p.pos) AS pos FROM one JOIN p ON p.u = one.u AND p.pos > one.pos GROUP BY ALL)
SELECT pattern, count(*) AS freq FROM (SELECT * FROM one UNION ALL SELECT * FROM two) GROUP BY pattern HAVING count(*) >= ceil(0.2 * (SELECT count(DISTINCT u) FROM p))""")
def hot_prefix_span(t):
    found = sequences.prefix_span(events(t), "user_id", F.struct("ts", "event_id"), F.col("event_type"), 0.2, 2, MIN_ROWS)
    return found.select(F.array_join(F.flatten("sequence"), ">").alias("pattern"), "freq")


@query("hot_range_moments", """
WITH l AS (SELECT o_orderstatus AS k, o_orderkey AS id, o_totalprice / 100 + 1e6 AS x FROM orders)
SELECT id, count(*) OVER w AS n, round(avg(x - 1e6) OVER w + 0.00123, 2) AS mean, round(stddev_pop(x - 1e6) OVER w, 2) AS sd
FROM l WINDOW w AS (PARTITION BY k ORDER BY id RANGE BETWEEN 60 PRECEDING AND 40 FOLLOWING)""")
def hot_range_moments(t):
    """Each order state is hot, and all values have a large common offset."""
    rows = t.orders.select(F.col("o_orderstatus").alias("k"), F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 100 + 1e6).alias("x"))
    out = ow.range_moments(rows, ["k"], "id", 60, 40, F.col("x"), min_rows=MIN_ROWS, slices=FEW)
    return out.select("id", "n", F.round(F.col("mean") - 1e6 + 0.00123, 2).alias("mean"), F.round(F.sqrt("var_pop"), 2).alias("sd"))


@query("hot_percentiles", " UNION ALL ".join(f"""
SELECT l_returnflag, {p}::DOUBLE AS point, round(quantile_cont(l_extendedprice, {p}), 4) AS pct FROM lineitem GROUP BY l_returnflag""" for p in POINTS))
def hot_percentiles(t):
    out = ow.exact_percentiles(t.lineitem, ["l_returnflag"], "l_extendedprice", POINTS, min_rows=MIN_ROWS, slices=MANY)
    return out.select("l_returnflag", "point", F.round("pct", 4).alias("pct"))


@query("hot_chunked_lists", f"""
WITH {EVENTS}, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS pos FROM e)
SELECT user_id, (pos - 1) // 7 AS chunk, string_agg(event_id::VARCHAR, ',' ORDER BY pos) AS ids FROM p GROUP BY ALL""")
def hot_chunked_lists(t):
    lists = ow.chunked_lists(events(t), BY, ["event_type", "event_id"], "event_id", 7, "ids", MIN_ROWS)
    return lists.select("user_id", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
