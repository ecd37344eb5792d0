"""Every window form. Windows keyed by user go through the operators that split a hot user's rows."""

import pandas as pd
from pyspark.sql import Window, functions as F

from millrace.functions.times import epoch_micros
from millrace.operators import patterns, windows as ow
from millrace.registry import query


def events(t):
    return t.events.select("event_id", "ts", "user_id", "event_type", "value")


@query("win_running", """
SELECT event_id, round(sum(value) OVER w, 4) AS running, max(value) OVER w AS top, min(value) OVER w AS low, row_number() OVER w AS pos
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def win_running(t):
    out = ow.running(events(t), ["user_id"], ["ts", "event_id"], {"running": F.col("value")}, {"top": F.col("value")}, {"low": F.col("value")}, "pos")
    return out.select("event_id", F.round("running", 4).alias("running"), "top", "low", "pos")


@query("win_rows", """
SELECT event_id, round(sum(value) OVER w, 4) AS s, count(*) OVER w AS n, round(avg(value) OVER w, 6) AS m, max(value) OVER w AS top
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)""")
def win_rows(t):
    def make(w):
        f = w.rowsBetween(-2, 1)
        return [F.round(F.sum("value").over(f), 4).alias("s"), F.count("*").over(f).alias("n"),
                F.round(F.avg("value").over(f), 6).alias("m"), F.max("value").over(f).alias("top")]

    return ow.neighbours(events(t), ["user_id"], ["ts", "event_id"], 2, 1, make).select("event_id", "s", "n", "m", "top")


@query("win_range_num", """
SELECT p_partkey, count(*) OVER w AS near, (sum(p_size) OVER w)::BIGINT AS sizes
FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 5 PRECEDING AND 2 FOLLOWING)""")
def win_range_num(t):
    return ow.range_frame(t.part, ["p_brand"], "p_size", 5, 2, {"sizes": F.col("p_size")}, "near").select("p_partkey", "near", "sizes")


@query("win_range_interval", """
SELECT event_id, count(*) OVER w AS n, round(sum(value) OVER w, 4) AS s
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)""")
def win_range_interval(t):
    rows = events(t).withColumn("at", epoch_micros("ts"))
    out = ow.range_frame(rows, ["user_id"], "at", 6 * 3600 * 1_000_000, 0, {"s": F.col("value")}, "n")
    return out.select("event_id", "n", F.round("s", 4).alias("s"))


@query("win_range_days", """
SELECT o_orderkey, count(*) OVER w AS n FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate::DATE RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND INTERVAL 30 DAY FOLLOWING)""")
def win_range_days(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.unix_date(F.to_date("o_orderdate")).alias("d"))
    return ow.range_frame(rows, ["o_custkey"], "d", 90, 30, count="n").select("o_orderkey", "n")


@query("win_range_desc", """
SELECT p_partkey, count(*) OVER w AS n FROM part WINDOW w AS (PARTITION BY p_type ORDER BY p_size DESC RANGE BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def win_range_desc(t):
    rows = t.part.select("p_partkey", "p_type", (-F.col("p_size")).alias("neg"))
    return ow.range_frame(rows, ["p_type"], "neg", 3, 0, count="n").select("p_partkey", "n")


@query("win_rank_all", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS row_number, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
       round(percent_rank() OVER w, 8) AS percent_rank, round(cume_dist() OVER w, 8) AS cume_dist,
       ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS ntile
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority)""")
def win_rank_all(t):
    out = ow.rank_all(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey"], "o_orderpriority", ["o_orderkey"])
    return out.select("o_orderkey", "row_number", "rank", "dense_rank", F.round("percent_rank", 8).alias("percent_rank"),
                      F.round("cume_dist", 8).alias("cume_dist"), "ntile")


@query("win_nav", """
SELECT event_id, lag(value) OVER w AS prev, lead(value, 2) OVER w AS after_next, lag(event_type, 1, 'none') OVER w AS prev_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_nav(t):
    return ow.neighbours(events(t), ["user_id"], ["ts", "event_id"], 1, 2, lambda w: [
        F.lag("value").over(w).alias("prev"), F.lead("value", 2).over(w).alias("after_next"),
        F.lag("event_type", 1, "none").over(w).alias("prev_type")]).select("event_id", "prev", "after_next", "prev_type")


@query("win_first_last", """
SELECT event_id, first_value(value) OVER w AS first_v, last_value(value) OVER w AS last_v FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def win_first_last(t):
    at = F.struct("ts", "event_id")
    ends = [F.min_by("value", at).alias("first_v"), F.max_by("value", at).alias("last_v")]
    return ow.whole_key(events(t), ["user_id"], ends).select("event_id", "first_v", "last_v")


@query("win_ignore_nulls", """
SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS v_filled
FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN value END AS v FROM events)""")
def win_ignore_nulls(t):
    rows = events(t).withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return ow.fill_forward(rows, ["user_id"], ["ts", "event_id"], ["v"]).select("event_id", "v_filled")


@query("win_named", """
SELECT l_orderkey, l_partkey, l_suppkey, sum(l_quantity) OVER w AS q, count(*) OVER w AS n, max(l_tax) OVER w AS tax FROM lineitem
WINDOW w AS (PARTITION BY l_orderkey)""")
def win_named(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_tax")
    out = ow.whole_key(rows, ["l_orderkey"], [F.sum("l_quantity").alias("q"), F.count("*").alias("n"), F.max("l_tax").alias("tax")])
    return out.drop("l_quantity", "l_tax")


@query("win_filter", """
SELECT event_id, count(*) FILTER (WHERE value > 50) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS big_so_far FROM events""")
def win_filter(t):
    big = F.when(F.col("value") > 50, 1).otherwise(0).cast("bigint")
    return ow.running(events(t), ["user_id"], ["ts", "event_id"], {"big_so_far": big}).select("event_id", "big_so_far")


@query("win_stats", """
SELECT o_orderkey, round(stddev_samp(o_totalprice) OVER w, 4) AS sd, round((var_pop(o_totalprice) OVER w) / 1000000, 3) AS vp, count(*) OVER w AS n
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
def win_stats(t):
    def make(w):
        f = w.rowsBetween(-3, 3)
        return [F.round(F.stddev_samp("o_totalprice").over(f), 4).alias("sd"), F.round(F.var_pop("o_totalprice").over(f) / 1000000, 3).alias("vp"),
                F.count("*").over(f).alias("n")]

    return ow.neighbours(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"], ["o_orderkey"], 3, 3, make).select(
        "o_orderkey", "sd", "vp", "n")


@query("win_shape", """
SELECT o_orderkey, CASE WHEN count(*) OVER w > 1 THEN round(corr(o_totalprice, o_orderkey) OVER w, 5) END AS r, count(DISTINCT o_orderpriority) OVER w AS kinds, CASE WHEN var_pop(o_totalprice) OVER w > 1 THEN
  round((avg((o_totalprice / 1000) ** 3) OVER w - 3 * avg(o_totalprice / 1000) OVER w * avg((o_totalprice / 1000) ** 2) OVER w + 2 * (avg(o_totalprice / 1000) OVER w) ** 3) / (stddev_pop(o_totalprice / 1000) OVER w) ** 3, 4) END AS skew
FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def win_shape(t):
    """Correlation, skewness and an approximate distinct count (exact for so few values) of the whole key, on every row."""
    x = F.col("o_totalprice") / 1000
    aggs = [F.round(F.corr("o_totalprice", "o_orderkey"), 5).alias("r"), F.approx_count_distinct("o_orderpriority", 0.01).alias("kinds"),
            F.when(F.var_pop("o_totalprice") > 1, F.round(F.skewness(x), 4)).alias("skew")]
    return ow.whole_key(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), ["o_custkey"], aggs).select("o_orderkey", "r", "kinds", "skew")


SHAPE = """CASE WHEN count(*) OVER w > 2 AND var_pop(x - 1e6) OVER w > 1 AND var_pop(q) OVER w > 0.01 THEN round(corr(x - 1e6, q) OVER w, 5) END AS r,
  CASE WHEN count(*) OVER w > 2 AND var_pop(x - 1e6) OVER w > 1 AND var_pop(q) OVER w > 0.01 THEN round((avg(((x - 1e6) / 1e3) ** 3) OVER w - 3 * avg((x - 1e6) / 1e3) OVER w * avg(((x - 1e6) / 1e3) ** 2) OVER w + 2 * (avg((x - 1e6) / 1e3) OVER w) ** 3)
    / (stddev_pop((x - 1e6) / 1e3) OVER w) ** 3, 4) END AS skew, count(*) OVER w AS n"""


def offset_orders(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), "o_orderpriority", (F.col("o_totalprice") / 100 + 1e6).alias("x"), F.col("o_custkey").alias("q"))


def shaped(n, r, skew, vx, vy):
    fine = (n > 2) & (vx > 1) & (vy > 0.01)
    return [F.when(fine, F.round(r, 5)).alias("r"), F.when(fine, F.round(skew, 4)).alias("skew"), n.alias("n")]


@query("win_shape_rows", f"""
SELECT id, {SHAPE} FROM (SELECT o_orderkey AS id, o_orderpriority, o_totalprice / 100 + 1e6 AS x, o_custkey AS q FROM orders)
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY id ROWS BETWEEN 6 PRECEDING AND 3 FOLLOWING)""")
def win_shape_rows(t):
    """Correlation and skewness over rows frames of values with a large common offset."""
    def make(w):
        f = w.rowsBetween(-6, 3)
        return shaped(F.count("*").over(f), F.corr("x", "q").over(f), F.skewness("x").over(f), F.var_pop("x").over(f), F.var_pop("q").over(f))

    return ow.neighbours(offset_orders(t), ["o_orderpriority"], ["id"], 6, 3, make).select("id", "r", "skew", "n")


@query("win_shape_range", f"""
SELECT id, {SHAPE} FROM (SELECT o_orderkey AS id, o_orderpriority, o_totalprice / 100 + 1e6 AS x, o_custkey AS q FROM orders)
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY id RANGE BETWEEN 800 PRECEDING AND 200 FOLLOWING)""")
def win_shape_range(t):
    rows = offset_orders(t)
    out = ow.range_moments(rows, ["o_orderpriority"], "id", 800, 200, F.col("x"), F.col("q"))
    vy = ow.range_moments(rows, ["o_orderpriority"], "id", 800, 200, F.col("q")).select("id", F.col("var_pop").alias("vy"))
    return out.join(vy, "id").select("id", *shaped(F.col("n"), F.col("corr"), F.col("skewness"), F.col("var_pop"), F.col("vy")))


@query("win_collect", """
SELECT o_orderkey, array_to_string(list(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), '|') AS recent FROM orders""")
def win_collect(t):
    return ow.neighbours(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey"], ["o_orderkey"], 2, 0, lambda w: [
        F.array_join(F.collect_list("o_orderpriority").over(w.rowsBetween(-2, 0)), "|").alias("recent")]).select("o_orderkey", "recent")


@query("win_udf", """
SELECT o_orderkey, sum(o_totalprice * 2 + 1) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)::DECIMAL(20, 2)::DOUBLE AS s FROM orders""")
def win_udf(t):
    @F.pandas_udf("double")
    def scaled(x: pd.Series) -> pd.Series:
        return x * 2 + 1

    rows = t.orders.select("o_orderkey", "o_custkey", scaled("o_totalprice").alias("x"))
    return ow.neighbours(rows, ["o_custkey"], ["o_orderkey"], 1, 0, lambda w: [F.sum("x").over(w.rowsBetween(-1, 0)).alias("s")]).select(
        "o_orderkey", F.round("s", 2).alias("s"))


MATCH = """
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, count(*) OVER (PARTITION BY user_id) AS len FROM events),
stop AS (SELECT *, coalesce(min(CASE WHEN value <= 20 THEN pos END) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), len + 1) AS ends,
  sum(value) OVER (PARTITION BY user_id ORDER BY pos) AS upto FROM e)
SELECT user_id, pos AS start_pos, ends - 1 AS end_pos, ends - pos AS size FROM stop WHERE value > 20 AND ends - pos >= 2"""


@query("win_matchpath", MATCH)
def win_matchpath(t):
    return ow.match_path(events(t), ["user_id"], ["ts", "event_id"], {"BIG": F.col("value") > 20}, "BIG.BIG+")


LETTERS = """l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
s AS (SELECT user_id, string_agg({letter}, '' ORDER BY pos) AS path FROM l GROUP BY ALL),
m AS (SELECT l.*, length(regexp_extract(substr(path, pos::BIGINT), '^({pattern})')) AS size FROM l JOIN s USING (user_id))"""


@query("win_matchpath_mixed", f"""
WITH {LETTERS.format(letter="CASE event_type WHEN 'view' THEN 'v' WHEN 'click' THEN 'c' WHEN 'purchase' THEN 'p' ELSE '-' END", pattern="vc*p")}
SELECT m.user_id, m.pos AS start_pos, m.pos + m.size - 1 AS end_pos, m.size, round(sum(l.value), 4) AS total
FROM m JOIN l ON l.user_id = m.user_id AND l.pos BETWEEN m.pos AND m.pos + m.size - 1 WHERE m.size > 0 GROUP BY ALL""")
def win_matchpath_mixed(t):
    """A view, any number of clicks, then a purchase, with the summed value of the matched rows."""
    kinds = {n.upper(): F.col("event_type") == n for n in ("view", "click", "purchase")}
    out = ow.match_path(events(t), ["user_id"], ["ts", "event_id"], kinds, "VIEW.CLICK*.PURCHASE", {"total": F.col("value")})
    return out.withColumn("total", F.round("total", 4))


def symbols():
    """A small or large view, a click, a purchase; whatever else holds none of them."""
    kind, large = F.col("event_type"), F.col("value") > 20
    return {"SMALL": (kind == "view") & ~large, "LARGE": (kind == "view") & large, "CLICK": kind == "click", "BUY": kind == "purchase"}


LETTER = "CASE event_type WHEN 'view' THEN CASE WHEN value > 20 THEN 'L' ELSE 'S' END WHEN 'click' THEN 'C' WHEN 'purchase' THEN 'B' ELSE '-' END"


@query("win_matchpath_groups", f"""
WITH {LETTERS.format(letter=LETTER, pattern="(S|L)+(C(B|L)?)*(B|C)")}
SELECT m.user_id, m.pos AS start_pos, m.pos + m.size - 1 AS end_pos, m.size, m.event_id AS start_id, round(sum(l.value), 4) AS total
FROM m JOIN l ON l.user_id = m.user_id AND l.pos BETWEEN m.pos AND m.pos + m.size - 1 WHERE m.size > 0 GROUP BY ALL""")
def win_matchpath_groups(t):
    """Alternatives, a group in a group and nested repetition; the longest match from each row."""
    out = patterns.match_groups(events(t), ["user_id"], ["ts", "event_id"], symbols(), "(SMALL|LARGE)+.(CLICK.(BUY|LARGE)?)*.(BUY|CLICK)", {"start_id": F.col("event_id")}, {"total": F.col("value")})
    return out.withColumn("total", F.round("total", 4))


@query("win_matchpath_paths", f"""
WITH {LETTERS.format(letter=LETTER, pattern="(L|S)(L|S|C)*B+")}
SELECT m.user_id, m.pos AS start_pos, (l.pos - m.pos) // 3 AS chunk, string_agg(l.event_id::VARCHAR, ',' ORDER BY l.pos) AS ids
FROM m JOIN l ON l.user_id = m.user_id AND l.pos BETWEEN m.pos AND m.pos + m.size - 1 WHERE m.size > 0 GROUP BY ALL""")
def win_matchpath_paths(t):
    """The path of each match, in arrays of three rows."""
    found = patterns.match_groups(events(t), ["user_id"], ["ts", "event_id"], symbols(), "(LARGE|SMALL).(LARGE|SMALL|CLICK)*.BUY+")
    paths = patterns.path_rows(events(t), found, ["user_id"], ["ts", "event_id"], {"event_id": F.col("event_id")})
    chunks = patterns.path_chunks(paths, ["user_id"], ["event_id"], 3)
    return chunks.select("user_id", "start_pos", "chunk", F.array_join(F.col("tpath.event_id").cast("array<string>"), ",").alias("ids"))


@query("win_sliding", """
SELECT user_id, array_to_string(items, ',') AS items FROM (SELECT user_id, row_number() OVER w AS pos, list(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS items
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE len(items) = 4 AND (pos - 1) % 2 = 0""")
def win_sliding(t):
    return ow.sliding(events(t), ["user_id"], ["ts", "event_id"], "event_id", 4, 2).select("user_id", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query("win_topk", """
SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders QUALIFY rn <= 3""")
def win_topk(t):
    return ow.top_k(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)


@query("win_ratio", """
SELECT p_partkey, round(100.0 * p_retailprice / sum(p_retailprice) OVER (PARTITION BY p_type), 8) AS share FROM part""")
def win_ratio(t):
    out = ow.whole_key(t.part.select("p_partkey", "p_type", "p_retailprice"), ["p_type"], [F.sum("p_retailprice").alias("total")])
    return out.select("p_partkey", F.round(100.0 * F.col("p_retailprice") / F.col("total"), 8).alias("share"))


@query("win_cumulative_full", """
WITH w AS (SELECT user_id, ts::DATE AS d, sum(value) AS v FROM events WHERE event_type = 'view' GROUP BY ALL),
p AS (SELECT user_id, ts::DATE AS d, sum(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY ALL),
cw AS (SELECT user_id, d, sum(v) OVER (PARTITION BY user_id ORDER BY d) AS c FROM w),
cp AS (SELECT user_id, d, sum(v) OVER (PARTITION BY user_id ORDER BY d) AS c FROM p),
j AS (SELECT coalesce(cw.user_id, cp.user_id) AS user_id, coalesce(cw.d, cp.d) AS d, cw.c AS a, cp.c AS b FROM cw FULL JOIN cp ON cw.user_id = cp.user_id AND cw.d = cp.d),
f AS (SELECT user_id, d, max(a) OVER w1 AS views, max(b) OVER w1 AS buys FROM j WINDOW w1 AS (PARTITION BY user_id ORDER BY d ROWS UNBOUNDED PRECEDING))
SELECT user_id, strftime(d, '%Y-%m-%d') AS d, round(views, 4) AS views, round(buys, 4) AS buys FROM f WHERE views > buys""")
def win_cumulative_full(t):
    def upto(kind, name):
        days = t.events.where(F.col("event_type") == kind).groupBy("user_id", F.to_date("ts").alias("d")).agg(F.sum("value").alias("v"))
        return ow.running(days, ["user_id"], ["d"], {name: F.col("v")}).drop("v")

    both = upto("view", "a").join(upto("purchase", "b"), ["user_id", "d"], "full")
    filled = ow.running(both, ["user_id"], ["d"], maxes={"views": F.col("a"), "buys": F.col("b")})
    return filled.where("views > buys").select(
        "user_id", F.date_format("d", "yyyy-MM-dd").alias("d"), F.round("views", 4).alias("views"), F.round("buys", 4).alias("buys"))


@query("win_moving_distinct", """
SELECT event_id, len(list_distinct(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))) AS kinds FROM events""")
def win_moving_distinct(t):
    return ow.neighbours(events(t), ["user_id"], ["ts", "event_id"], 4, 0, lambda w: [
        F.size(F.collect_set("event_type").over(w.rowsBetween(-4, 0))).alias("kinds")]).select("event_id", F.col("kinds").cast("bigint").alias("kinds"))


@query("win_global_running", """
SELECT d, n, (sum(n) OVER (ORDER BY d))::BIGINT AS upto, round(n / sum(n) OVER (), 8) AS share FROM (SELECT strftime(o_orderdate, '%Y-%m') AS d, count(*) AS n FROM orders GROUP BY 1)""")
def win_global_running(t):
    """A window without keys, over one row per month: the input is aggregated first, so its size does not grow."""
    months = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("d")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(F.lit(0))
    return months.select("d", "n", F.sum("n").over(w.orderBy("d")).alias("upto"), F.round(F.col("n") / F.sum("n").over(w), 8).alias("share"))
