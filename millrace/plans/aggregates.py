"""Every aggregation form on the star tables."""

from pyspark.sql import Observation, functions as F

from millrace.operators import aggregates as oa, partial as op, windows as ow
from millrace.registry import query
from millrace.session import spread


def r(c, digits, name):
    return F.round(c, digits).alias(name)


@query("agg_basic", """
SELECT o_orderstatus, year(o_orderdate) AS y, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(sum(o_totalprice), 2) / count(*) AS mean,
       min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY ALL""")
def agg_basic(t):
    return t.orders.groupBy("o_orderstatus", F.year("o_orderdate").cast("bigint").alias("y")).agg(
        F.count("*").alias("n"), r(F.sum("o_totalprice"), 2, "total"), (F.round(F.sum("o_totalprice"), 2) / F.count("*")).alias("mean"),
        F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@query("agg_having", """
SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_partkey HAVING sum(l_quantity) > 1000 AND count(*) < 45""")
def agg_having(t):
    return t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"), F.count("*").alias("n")).where("qty > 1000 AND n < 45").drop("n")


@query("agg_count_forms", """
SELECT k, count(*) AS all_rows, count(1) AS ones, count(a) AS a, count(b) AS b, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS both,
       count(a + b) AS a_plus_b, count(*) AS structs, count(NULL) AS none
FROM (SELECT l_returnflag AS k, nullif(l_linenumber, 3) AS a, nullif(l_quantity, 10) AS b FROM lineitem) GROUP BY k""")
def agg_count_forms(t):
    rows = t.lineitem.select(F.col("l_returnflag").alias("k"), F.expr("nullif(l_linenumber, 3)").alias("a"), F.expr("nullif(l_quantity, 10)").alias("b"))
    return rows.groupBy("k").agg(
        F.count("*").alias("all_rows"), F.count(F.lit(1)).alias("ones"), F.count("a").alias("a"), F.count("b").alias("b"),
        F.expr("count(a, b)").alias("both"), F.count(F.col("a") + F.col("b")).alias("a_plus_b"), F.count(F.struct("a", "b")).alias("structs"),
        F.count(F.lit(None)).alias("none"))


@query("agg_distinct_multi", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT (l_partkey, l_suppkey)) AS pairs,
       sum(DISTINCT l_quantity) AS qty FROM lineitem GROUP BY l_returnflag""")
def agg_distinct_multi(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"),
        F.countDistinct("l_partkey", "l_suppkey").alias("pairs"), F.sum_distinct("l_quantity").alias("qty"))


@query("agg_distinct_skewed", """
SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type""")
def agg_distinct_skewed(t):
    return oa.skewed_distinct(t.events, ["event_type"], "user_id", "users")


@query("agg_filter", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, round(sum(o_totalprice) FILTER (WHERE o_totalprice > 200000), 2) AS big
FROM orders GROUP BY o_orderpriority""")
def agg_filter(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.expr("count(*) FILTER (WHERE o_orderstatus = 'F')").alias("done"),
        r(F.sum(F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice"))), 2, "big"))


@query("agg_grouping_sets", """
SELECT l_returnflag, l_linestatus, l_linenumber, sum(l_quantity) AS qty FROM lineitem
GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), ())""")
def agg_grouping_sets(t):
    flag, status, line = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    return t.lineitem.groupingSets([[flag, status], [line], []], flag, status, line).agg(F.sum("l_quantity").alias("qty"))


@query("agg_cube", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def agg_cube(t):
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), r(F.sum("o_totalprice"), 2, "total"))


@query("agg_rollup", """
SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY ROLLUP (year(o_orderdate), month(o_orderdate))""")
def agg_rollup(t):
    return t.orders.rollup(F.year("o_orderdate").cast("bigint").alias("y"), F.month("o_orderdate").cast("bigint").alias("m")).agg(F.count("*").alias("n"))


@query("agg_grouping_id", """
SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus)::INT AS gs, grouping_id(o_orderstatus, o_orderpriority)::BIGINT AS gid, count(*) AS n
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority) HAVING grouping_id(o_orderstatus, o_orderpriority) > 0""")
def agg_grouping_id(t):
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(
        F.grouping("o_orderstatus").cast("int").alias("gs"), F.grouping_id("o_orderstatus", "o_orderpriority").alias("gid"),
        F.count("*").alias("n")).where("gid > 0")


@query("agg_pivot", """
SELECT l_linenumber, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS "A", sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS "N",
       sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS "R" FROM lineitem GROUP BY l_linenumber""")
def agg_pivot(t):
    return oa.pivot_table(t.lineitem, ["l_linenumber"], "l_returnflag", ["A", "N", "R"], [F.sum("l_quantity")])


@query("agg_pivot_two_keys", """
SELECT p_type, count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS af_n, max(l_quantity) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS af_top,
       count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'O') AS ro_n, max(l_quantity) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'O') AS ro_top
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def agg_pivot_two_keys(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_type", "l_quantity", F.lower(F.concat("l_returnflag", "l_linestatus")).alias("fs"))
    return oa.pivot_table(rows, ["p_type"], "fs", ["af", "ro"], [F.count_if(F.col("l_quantity").isNotNull()).alias("n"), F.max("l_quantity").alias("top")])


@query("agg_moments", """
SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, round(var_pop(l_quantity), 6) AS var_pop, round(var_samp(l_quantity), 6) AS var_samp,
       round(stddev_pop(l_quantity), 6) AS sd_pop, round(stddev_samp(l_quantity), 6) AS sd_samp,
       round(sum(pow(l_quantity - m, 3)) / count(*) / pow(stddev_pop(l_quantity), 3), 6) AS skew,
       round(sum(pow(l_quantity - m, 4)) / count(*) / pow(var_pop(l_quantity), 2) - 3, 6) AS kurt
FROM (SELECT l_returnflag, l_quantity, avg(l_quantity) OVER (PARTITION BY l_returnflag) AS m FROM lineitem) GROUP BY l_returnflag""")
def agg_moments(t):
    q = "l_quantity"
    return t.lineitem.groupBy("l_returnflag").agg(
        r(F.avg(q), 6, "mean"), r(F.var_pop(q), 6, "var_pop"), r(F.variance(q), 6, "var_samp"), r(F.stddev_pop(q), 6, "sd_pop"),
        r(F.std(q), 6, "sd_samp"), r(F.skewness(q), 6, "skew"), r(F.kurtosis(q), 6, "kurt"))


@query("agg_corr", """
SELECT l_linestatus, round(corr(l_quantity, l_extendedprice), 8) AS c, round(covar_pop(l_quantity, l_discount), 8) AS cp,
       round(covar_samp(l_quantity, l_tax), 8) AS cs FROM lineitem GROUP BY l_linestatus""")
def agg_corr(t):
    return t.lineitem.groupBy("l_linestatus").agg(
        r(F.corr("l_quantity", "l_extendedprice"), 8, "c"), r(F.covar_pop("l_quantity", "l_discount"), 8, "cp"),
        r(F.covar_samp("l_quantity", "l_tax"), 8, "cs"))


@query("agg_percentile", """
SELECT event_type, p AS point, round(CASE p WHEN 0.1 THEN a WHEN 0.5 THEN b ELSE c END, 6) AS pct FROM
(SELECT event_type, quantile_cont(value, 0.1) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.99) AS c FROM events GROUP BY event_type),
(VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.99::DOUBLE)) v(p)""")
def agg_percentile(t):
    return ow.exact_percentiles(t.events, ["event_type"], "value", [0.1, 0.5, 0.99]).select("event_type", "point", r(F.col("pct"), 6, "pct"))


@query("agg_percentile_builtin", """
SELECT l_returnflag, round(quantile_cont(l_quantity, 0.25), 6) AS q1, round(median(l_quantity), 6) AS med FROM lineitem GROUP BY l_returnflag""")
def agg_percentile_builtin(t):
    """The built-in keeps one counter per distinct value: fine here, quantities have 50 values."""
    return t.lineitem.groupBy("l_returnflag").agg(r(F.percentile("l_quantity", 0.25), 6, "q1"), r(F.percentile("l_quantity", 0.5), 6, "med"))


@query("agg_percentile_approx")
def agg_percentile_approx(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.percentile_approx("l_extendedprice", [0.25, 0.5, 0.75], 1000).alias("quartiles"))


@query("agg_histogram")
def agg_histogram(t):
    h = t.lineitem.groupBy("l_returnflag").agg(F.histogram_numeric("l_quantity", F.lit(8)).alias("h"))
    return h.select("l_returnflag", F.inline("h"))


@query("agg_bool", """
SELECT l_suppkey, bool_and(l_quantity >= 1) AS every_pos, bool_or(l_quantity = 50) AS some_50, bool_or(l_discount > 0.09) AS any_disc, bool_and(l_tax < 0.08) AS all_low
FROM lineitem GROUP BY l_suppkey""")
def agg_bool(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.every(F.col("l_quantity") >= 1).alias("every_pos"), F.some(F.col("l_quantity") == 50).alias("some_50"),
        F.expr("any(l_discount > 0.09)").alias("any_disc"), F.bool_and(F.col("l_tax") < 0.08).alias("all_low"))


@query("agg_bit", """
SELECT l_returnflag, bit_and(l_partkey) AS ba, bit_or(l_partkey) AS bo, bit_xor(l_partkey) AS bx FROM lineitem GROUP BY l_returnflag""")
def agg_bit(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.bit_and("l_partkey").alias("ba"), F.bit_or("l_partkey").alias("bo"), F.bit_xor("l_partkey").alias("bx"))


@query("agg_struct_max", """
SELECT o_custkey, o_orderkey AS best_order, o_totalprice AS best_price FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) = 1""")
def agg_struct_max(t):
    best = t.orders.groupBy("o_custkey").agg(F.max(F.struct("o_totalprice", "o_orderkey")).alias("b"))
    return best.select("o_custkey", F.col("b.o_orderkey").alias("best_order"), F.col("b.o_totalprice").alias("best_price"))


@query("agg_collect_sorted", """
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY user_id""")
def agg_collect_sorted(t):
    return t.events.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"))


@query("agg_collect_bag", """
SELECT l_suppkey, string_agg(l_quantity::INT || 'x' || n, ',' ORDER BY l_quantity) AS bag
FROM (SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_suppkey""")
def agg_collect_bag(t):
    return oa.bag(t.lineitem, ["l_suppkey"], "l_quantity").select(
        "l_suppkey", F.array_join(F.transform("items", lambda x: F.concat_ws("x", x["l_quantity"].cast("int"), x["n"])), ",").alias("bag"))


@query("agg_collect_list", """
SELECT o_custkey, (rn - 1) // 4 AS chunk, array_to_string(list(o_orderkey ORDER BY o_orderkey), ',') AS orders
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) GROUP BY ALL""")
def agg_collect_list(t):
    """Whole lists in chunks of a fixed length, so a hot key gives more rows and not a longer cell."""
    lists = ow.chunked_lists(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], "o_orderkey", 4, "orders")
    return lists.withColumn("orders", F.array_join(F.col("orders").cast("array<string>"), ","))


@query("agg_salted", """
SELECT event_type, round(sum(value), 2) AS total, count(*) AS n FROM events GROUP BY event_type""")
def agg_salted(t):
    return oa.two_stage_sum(t.events, ["event_type"], "value").withColumn("total", F.round("total", 2))


@query("agg_sorted_input", """
SELECT l_partkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY l_partkey""")
def agg_sorted_input(t):
    from millrace.operators.maintenance import bucket_count
    from millrace.sources.tables import bucketed_table

    return bucketed_table(t.lineitem.select("l_partkey", "l_quantity"), "by_part", ["l_partkey"], bucket_count(t.spark, t.path("lineitem"))).groupBy("l_partkey").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("agg_profile", """
SELECT 'l_quantity' AS "column", count(l_quantity) AS filled, count(*) - count(l_quantity) AS nulls, min(l_quantity) AS low, max(l_quantity) AS high, round(avg(l_quantity), 6) AS mean FROM lineitem
UNION ALL SELECT 'l_discount', count(l_discount), count(*) - count(l_discount), min(l_discount), max(l_discount), round(avg(l_discount), 6) FROM lineitem""")
def agg_profile(t):
    p = oa.profile(t.lineitem, ["l_quantity", "l_discount"])
    return p.select("column", "filled", "nulls", F.col("smallest").cast("double").alias("low"), F.col("largest").cast("double").alias("high"), r(F.col("mean"), 6, "mean"))


@query("agg_profile_text")
def agg_profile_text(t):
    return oa.profile(t.documents)


@query("agg_exact_profile", """
SELECT count(*) AS "rows", count(*) - count(p_size) AS nulls, count(DISTINCT p_size) AS distinct_values, min(p_size) AS smallest, max(p_size) AS largest FROM part""")
def agg_exact_profile(t):
    return oa.exact_profile(t.part, "p_size")


@query("agg_observe", """SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'O'""")
def agg_observe(t):
    """Named metrics gathered while another result is written.

    In a session of its own: once a session has observed, Spark 4.1 can no longer ship some of its model functions.
    """
    from millrace.session import scratch_path
    from millrace.sources.tables import staged

    path = scratch_path(t.spark, "open_orders")
    orders = t.spark.newSession().read.parquet(t.path("orders"))
    seen = Observation("open_orders")
    staged(orders.where("o_orderstatus = 'O'").observe(seen, F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), "open_orders", path=path)
    got = seen.get
    return t.spark.range(1).select(F.lit(got["n"]).cast("bigint").alias("n"), r(F.lit(got["total"]), 2, "total"))


@query("agg_estimate")
def agg_estimate(t):
    return oa.estimate(t.lineitem, 0.1, 11, "l_quantity", ["l_returnflag"])


@query("agg_partial", """
SELECT l_returnflag, m.measure, round(CASE m.measure WHEN 'count' THEN count(l_quantity) WHEN 'sum' THEN sum(l_quantity) ELSE avg(l_quantity) END, 6) AS value, true AS within
FROM lineitem, (VALUES ('count'), ('sum'), ('mean')) m(measure) GROUP BY l_returnflag, m.measure""")
def agg_partial(t):
    """Count, sum and mean by group with bounds: from half of the files, and from all of them, which is exact."""
    from millrace.sources.tables import staged

    path = staged(t.lineitem.select("l_returnflag", "l_quantity").repartition(24), "partial", "parquet")
    table = t.spark.read.parquet(path)
    read = lambda files: t.spark.read.schema(table.schema).parquet(*files)
    ask = lambda **how: op.approximate(t.spark, sorted(table.inputFiles()), read, F.col("l_quantity"), ["l_returnflag"], confidence=0.99999, seed=3, group=6, **how)
    clock = iter(range(10))
    half, whole = ask(seconds=2, clock=lambda: next(clock)), ask()
    both = whole.select("l_returnflag", "measure", "value").join(half.select("l_returnflag", "measure", "low", "high", "files_read"), ["l_returnflag", "measure"])
    within = F.col("value").between(F.col("low"), F.col("high")) & (F.col("files_read") == 12)
    return both.select("l_returnflag", "measure", F.round("value", 6).alias("value"), within.alias("within"))


@query("agg_distinct_shapes", """
WITH d AS (SELECT DISTINCT l_returnflag, l_linenumber, l_quantity FROM lineitem)
SELECT a.l_returnflag, a.x, b.r FROM (SELECT l_returnflag, bit_xor(DISTINCT l_linenumber) AS x FROM lineitem GROUP BY l_returnflag) a
JOIN (SELECT l_returnflag, round(corr(l_linenumber, l_quantity), 8) AS r FROM d GROUP BY l_returnflag) b ON a.l_returnflag = b.l_returnflag""")
def agg_distinct_shapes(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.expr("bit_xor(DISTINCT l_linenumber)").alias("x"), F.expr("round(corr(DISTINCT l_linenumber, l_quantity), 8)").alias("r"))


@query("agg_pivot_tuple", """
SELECT p_type, count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS af_n, max(l_quantity) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS af_top,
       count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'O') AS no_n, max(l_quantity) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'O') AS no_top
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def agg_pivot_tuple(t):
    """Two key columns as they are, and values with names of their own."""
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_type", "l_returnflag", "l_linestatus", "l_quantity")
    out = t.spark.sql("""SELECT * FROM {rows} PIVOT (count(l_quantity) AS n, max(l_quantity) AS top FOR (l_returnflag, l_linestatus) IN (('A', 'F') AS af, ('N', 'O') AS no))""", rows=rows)
    return out.select("p_type", *[(F.coalesce(c, F.lit(0)) if c.endswith("_n") else F.col(c)).alias(c) for c in out.columns[1:]])


@query("agg_pivot_complex", """
SELECT l_linenumber, sum(l_quantity) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS a_f, sum(l_quantity) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') AS r_f
FROM lineitem GROUP BY l_linenumber""")
def agg_pivot_complex(t):
    """An array as the key."""
    rows = t.lineitem.select("l_linenumber", "l_quantity", F.array("l_returnflag", "l_linestatus").alias("kinds"))
    return t.spark.sql("SELECT * FROM {rows} PIVOT (sum(l_quantity) FOR kinds IN (array('A', 'F') AS a_f, array('R', 'F') AS r_f))", rows=rows)


@query("agg_empty", """
SELECT count(*) AS n, sum(l_quantity) AS qty, max(l_shipdate) IS NULL AS none FROM lineitem WHERE l_quantity > 9999""")
def agg_empty(t):
    return t.lineitem.where("l_quantity > 9999").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.max("l_shipdate").isNull().alias("none"))


@query("agg_null_groups", """
SELECT nullif(l_linenumber, 2) AS k, count(*) AS n, avg(CASE WHEN l_linenumber = 2 THEN NULL ELSE l_linenumber END) AS m FROM lineitem GROUP BY 1""")
def agg_null_groups(t):
    k = F.expr("nullif(l_linenumber, 2)")
    return t.lineitem.groupBy(k.alias("k")).agg(F.count("*").alias("n"), F.avg(k).alias("m"))


@query("agg_bitmap", """
SELECT event_type, count(DISTINCT user_id) AS members FROM events GROUP BY event_type""")
def agg_bitmap(t):
    return oa.bitmap_count(oa.bitmap_by_key(t.events, ["event_type"], "user_id"), ["event_type"])


@query("agg_bitmap_and", """
SELECT a.k, count(DISTINCT a.o_custkey) AS both_kinds FROM (SELECT o_custkey % 10 AS k, o_custkey FROM orders WHERE o_orderstatus = 'F') a
JOIN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') b ON a.o_custkey = b.o_custkey GROUP BY a.k""")
def agg_bitmap_and(t):
    rows = t.orders.select((F.col("o_custkey") % 10).alias("k"), "o_custkey", "o_orderstatus")
    sides = [oa.bitmap_by_key(rows.where(F.col("o_orderstatus") == s), ["k"], "o_custkey") for s in "FP"]
    return oa.bitmap_and(*sides, ["k"], "both_kinds")


@query("agg_typed", """
SELECT l_returnflag, round(sum(l_quantity * l_tax), 4) AS s, count(l_tax) AS c, round(avg(l_quantity * 2), 6) AS a FROM lineitem GROUP BY l_returnflag""")
def agg_typed(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        r(F.sum(F.col("l_quantity") * F.col("l_tax")), 4, "s"), F.count("l_tax").alias("c"), r(F.avg(F.col("l_quantity") * 2), 6, "a"))


@query("agg_ordinals", """
SELECT p_type AS kind, p_size % 10 AS size_class, count(*) AS n FROM part GROUP BY 1, 2 ORDER BY 1, 2""")
def agg_ordinals(t):
    return t.part.select(F.col("p_type").alias("kind"), (F.col("p_size") % 10).alias("size_class")).groupBy(1, 2).agg(F.count("*").alias("n")).orderBy(1, 2)


@query("agg_mode_arg", """
SELECT o_custkey, max(o_totalprice) AS high, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS top_order FROM orders GROUP BY o_custkey""")
def agg_mode_arg(t):
    return t.orders.groupBy("o_custkey").agg(
        F.max("o_totalprice").alias("high"), F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("top_order"))


WORDS = """words AS (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents)"""


def docs(t):
    return spread(t.documents.select("doc_id", "text"), "doc_id")


@query("word_count", f"""
WITH {WORDS} SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY word""")
def word_count(t):
    return docs(t).select(F.explode(F.split("text", r"\s+")).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


@query("word_count_top", f"""
WITH {WORDS} SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 50""")
def word_count_top(t):
    return word_count(t).orderBy(F.desc("n"), "word").limit(50)


@query("ngrams_top")
def ngrams_top(t):
    return oa.top_ngrams(docs(t), "text", 2, 100)


@query("ngrams_context")
def ngrams_context(t):
    return oa.context_ngrams(docs(t), "text", ["the"], 20)
