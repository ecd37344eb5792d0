"""Projections, filters, predicates and subqueries."""

from pyspark.sql import Window, functions as F

from millrace.functions import rows as fr
from millrace.operators import joins as oj
from millrace.registry import query


@query("prj_select_star", """SELECT n.*, r.r_name AS region FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n.n_nationkey)""")
def prj_select_star(t):
    n, r = t.nation.alias("n"), t.region.alias("r")
    used = t.supplier.select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    return n.join(r, F.col("n.n_regionkey") == F.col("r.r_regionkey")).join(used, "n_nationkey", "left_semi").select("n.*", F.col("r.r_name").alias("region"))


@query("prj_regex_columns", """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate::DATE::VARCHAR AS d FROM orders WHERE o_totalprice > 400000""")
def prj_regex_columns(t):
    picked = fr.columns_like(t.orders.where("o_totalprice > 400000"), "o_order.*")
    return picked.withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd")).drop("o_orderdate")


@query("prj_where", """
SELECT c_custkey FROM customer WHERE (c_acctbal BETWEEN 1000 AND 5000 OR c_mktsegment LIKE 'B%') AND c_nationkey NOT IN (3, 4) AND NOT (c_name LIKE '%9')""")
def prj_where(t):
    c = F.col
    return t.customer.where((c("c_acctbal").between(1000, 5000) | c("c_mktsegment").like("B%")) & ~c("c_nationkey").isin(3, 4) & ~c("c_name").like("%9")).select("c_custkey")


@query("prj_three_valued", """
SELECT a > 20 AS gt, a IS NULL AS missing, count(*) AS n FROM (SELECT CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size END AS a FROM part) WHERE a > 30 OR a IS NULL OR NOT (a > 10) GROUP BY ALL""")
def prj_three_valued(t):
    a = F.when(F.col("p_size") % 4 != 0, F.col("p_size")).alias("a")
    rows = t.part.select(a).where("a > 30 OR a IS NULL OR NOT (a > 10)")
    return rows.groupBy((F.col("a") > 20).alias("gt"), F.col("a").isNull().alias("missing")).agg(F.count("*").alias("n"))


@query("prj_compare_coerced", """
SELECT count(*) FILTER (WHERE o_orderkey::DOUBLE > 7000.5) AS a, count(*) FILTER (WHERE o_custkey::VARCHAR = '17') AS b, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS c,
 count(*) FILTER (WHERE o_orderdate::DATE < DATE '1996-06-01') AS d FROM orders""")
def prj_compare_coerced(t):
    return t.orders.agg(F.expr("count_if(o_orderkey > 7000.5D)").alias("a"), F.expr("count_if(o_custkey = '17')").alias("b"),
                        F.expr("count_if(o_orderdate >= timestamp_ntz'1998-01-01')").alias("c"), F.expr("count_if(date(o_orderdate) < date'1996-06-01')").alias("d"))


@query("prj_null_safe", """
SELECT count(*) FILTER (WHERE a IS NOT DISTINCT FROM b) AS same, count(*) FILTER (WHERE a = b) AS equal, count(*) FILTER (WHERE a IS DISTINCT FROM b) AS other
FROM (SELECT nullif(l_linenumber, 1) AS a, nullif(l_quantity::INT % 7, 1) AS b FROM lineitem)""")
def prj_null_safe(t):
    a, b = F.expr("nullif(l_linenumber, 1)"), F.expr("nullif(int(l_quantity) % 7, 1)")
    return t.lineitem.select(a.alias("a"), b.alias("b")).agg(
        F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("same"), F.count_if(F.col("a") == F.col("b")).alias("equal"),
        F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("other"))


@query("prj_null_arithmetic", """
SELECT k, sum(b + c) AS s, count(b + c) AS n, sum(CASE WHEN b > 3 THEN 1 END)::BIGINT AS big, count(DISTINCT b) AS kinds FROM
(SELECT l_returnflag AS k, nullif(l_linenumber, 2) AS b, nullif(l_quantity, 10) AS c FROM lineitem) GROUP BY k""")
def prj_null_arithmetic(t):
    rows = t.lineitem.select(F.col("l_returnflag").alias("k"), F.expr("nullif(l_linenumber, 2)").alias("b"), F.expr("nullif(l_quantity, 10)").alias("c"))
    return rows.groupBy("k").agg(F.sum(F.col("b") + F.col("c")).alias("s"), F.count(F.col("b") + F.col("c")).alias("n"),
                                 F.sum(F.when(F.col("b") > 3, 1)).alias("big"), F.countDistinct("b").alias("kinds"))


@query("prj_soft_errors", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_retailprice / (p_size % 5) END AS ratio, NULL::INT AS bad FROM part""")
def prj_soft_errors(t):
    from millrace.functions.casts import soft_cast, soft_divide

    return t.part.select("p_partkey", soft_divide(F.col("p_retailprice"), F.col("p_size") % 5).alias("ratio"), soft_cast("p_name", "int").alias("bad"))


@query("prj_like", """
SELECT p_name LIKE '%ring' AS ring, p_name LIKE '_e%' AS e2, regexp_matches(p_name, '^(red|blue) ') AS tone, count(*) AS n FROM part GROUP BY ALL""")
def prj_like(t):
    c = F.col("p_name")
    return t.part.groupBy(c.like("%ring").alias("ring"), c.like("_e%").alias("e2"), c.rlike("^(red|blue) ").alias("tone")).agg(F.count("*").alias("n"))


@query("prj_literals", """
SELECT r_name, 1::BIGINT AS l, 2.5::DOUBLE AS d, 'x''y' AS s, strftime(DATE '2020-02-29', '%Y-%m-%d') AS dt, hex(unhex('0F')) AS b, 'Infinity'::DOUBLE AS inf, true AS ok FROM region""")
def prj_literals(t):
    return t.region.select("r_name", F.expr("1L").alias("l"), F.expr("2.5D").alias("d"), F.lit("x'y").alias("s"), F.expr("date_format(date'2020-02-29', 'yyyy-MM-dd')").alias("dt"),
                           F.expr("hex(x'0F')").alias("b"), F.expr("double('Infinity')").alias("inf"), F.lit(True).alias("ok"))


@query("prj_nan", """
SELECT CASE WHEN l_linenumber % 3 = 0 THEN 'nan' ELSE 'num' END AS kind, count(*) AS n, CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE count(DISTINCT l_linenumber) END::BIGINT AS kinds FROM lineitem GROUP BY l_linenumber % 3 = 0""")
def prj_nan(t):
    """All NaN values are one group and equal to each other."""
    x = F.when(F.col("l_linenumber") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("l_linenumber").cast("double"))
    groups = t.lineitem.groupBy(x.alias("x")).agg(F.count("*").alias("c"))
    return groups.groupBy(F.when(F.isnan("x"), "nan").otherwise("num").alias("kind")).agg(F.sum("c").alias("n"), F.count("*").alias("kinds"))


@query("prj_subquery_in", """
SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING sum(l_quantity) > 1000)""")
def prj_subquery_in(t):
    big = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q")).where("q > 1000")
    return t.part.join(big, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_brand")


@query("prj_subquery_not_in", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def prj_subquery_not_in(t):
    return oj.not_in(t.customer, "c_custkey", t.orders.where("o_totalprice > 400000"), "o_custkey").select("c_custkey", "c_name")


@query("prj_not_in_nulls", """
SELECT (SELECT count(*) FROM customer WHERE c_nationkey NOT IN (SELECT nullif(s_nationkey, 3) FROM supplier)) AS with_null,
 (SELECT count(*) FROM customer WHERE nullif(c_nationkey, 4) NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)) AS without_null,
 (SELECT count(*) FROM customer WHERE nullif(c_nationkey, 4) NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 99999)) AS with_empty""")
def prj_not_in_nulls(t):
    rows = t.customer.select(F.col("c_nationkey").alias("k"), F.expr("nullif(c_nationkey, 4)").alias("g"))
    some = t.supplier.select(F.expr("nullif(s_nationkey, 3)").alias("k"))
    parts = {
        "with_null": oj.not_in(rows, "k", some, "k"),
        "without_null": oj.not_in(rows, "g", t.supplier.where("s_acctbal > 5000"), "s_nationkey"),
        "with_empty": oj.not_in(rows, "g", t.supplier.where("s_acctbal > 99999"), "s_nationkey"),
    }
    counts = [df.agg(F.lit(name).alias("kind"), F.count("*").alias("n")) for name, df in parts.items()]
    return counts[0].union(counts[1]).union(counts[2]).agg(*[F.max(F.when(F.col("kind") == name, F.col("n"))).alias(name) for name in parts])


@query("prj_exists", """
SELECT o_orderpriority, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45) GROUP BY o_orderpriority""")
def prj_exists(t):
    key = F.col("o_orderkey") == F.col("l_orderkey")
    return t.orders.join(t.lineitem.where("l_returnflag = 'R'"), key, "left_semi").join(t.lineitem.where("l_quantity > 45"), key, "left_anti").groupBy(
        "o_orderpriority").agg(F.count("*").alias("n"))


@query("prj_in_having", """
SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand HAVING count(*) IN (SELECT count(*) FROM part WHERE p_size > 5 GROUP BY p_type, p_size) OR min(p_size) IN (SELECT n_nationkey FROM nation)""")
def prj_in_having(t):
    sizes = t.part.where("p_size > 5").groupBy("p_type", "p_size").agg(F.count("*").alias("k"))
    brands = t.part.groupBy("p_brand").agg(F.count("*").alias("n"), F.min("p_size").cast("bigint").alias("low"))
    flagged = oj.existence_join(brands, sizes.select(F.col("k").alias("n")), ["n"], "as_many")
    flagged = oj.existence_join(flagged, t.nation.select(F.col("n_nationkey").cast("bigint").alias("low")), ["low"], "as_low")
    return flagged.where("as_many OR as_low").select("p_brand", "n")


@query("prj_in_limit", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20)""")
def prj_in_limit(t):
    richest = t.customer.orderBy(F.desc("c_acctbal"), "c_custkey").limit(20)
    return t.orders.join(richest, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey")


@query("prj_in_correlated", """
SELECT p_partkey FROM part WHERE p_size IN (SELECT l_quantity FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag <> 'N')""")
def prj_in_correlated(t):
    lines = t.lineitem.where("l_returnflag <> 'N'")
    return t.part.join(lines, (F.col("l_partkey") == F.col("p_partkey")) & (F.col("l_quantity") == F.col("p_size")), "left_semi").select("p_partkey")


@query("prj_not_in_correlated", """
SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 10 = c_custkey % 10)""")
def prj_not_in_correlated(t):
    """Without missing values on either side NOT IN is an anti join on the column and the correlation."""
    met = (F.col("s_nationkey") == F.col("c_nationkey")) & (F.col("s_suppkey") % 10 == F.col("c_custkey") % 10)
    return t.customer.join(t.supplier, met, "left_anti").select("c_custkey")


@query("prj_nan_join", """
WITH e AS (SELECT event_id, event_id % 7 AS g, CASE WHEN event_id % 7 = 0 THEN 'nan'::DOUBLE WHEN event_id % 7 = 1 THEN -0.0 ELSE (event_id % 7)::DOUBLE END AS x FROM events),
k AS (SELECT unnest(['nan'::DOUBLE, 0.0, 3.0]) AS y)
SELECT g, count(*) AS n, any_value(isnan(x)) AS odd FROM e JOIN k ON x = y GROUP BY g""")
def prj_nan_join(t):
    """NaN equals itself as a join key, and the two zeros are one."""
    g = F.col("event_id") % 7
    rows = t.events.select(g.alias("g"), F.when(g == 0, float("nan")).when(g == 1, F.lit(-0.0)).otherwise(g.cast("double")).alias("x"))
    keys = t.spark.createDataFrame([(float("nan"),), (0.0,), (3.0,)], "y double")
    return rows.join(F.broadcast(keys), F.col("x") == F.col("y")).groupBy("g").agg(F.count("*").alias("n"), F.bool_and(F.isnan("x")).alias("odd"))


@query("prj_nan_order", """
SELECT event_id, row_number() OVER (ORDER BY CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END, CASE WHEN event_id % 50 = 0 THEN 0 ELSE value END, event_id) AS place FROM events QUALIFY place > (SELECT count(*) - 30 FROM events)""")
def prj_nan_order(t):
    """NaN sorts behind every number: the last rows of a full sort."""
    rows = t.events.select("event_id", F.when(F.col("event_id") % 50 == 0, float("nan")).otherwise(F.col("value")).alias("x"))
    last = rows.orderBy(F.desc("x"), F.desc("event_id")).limit(30)
    n = F.broadcast(t.events.agg(F.count("*").alias("n")))
    back = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("x"), F.desc("event_id")))
    return last.join(n).select("event_id", (F.col("n") + 1 - back).alias("place"))


@query("prj_scalar_subquery", """
SELECT p_partkey, p_retailprice FROM part o WHERE p_retailprice > (SELECT avg(i.p_retailprice) + 30 FROM part i WHERE i.p_brand = o.p_brand)""")
def prj_scalar_subquery(t):
    mean = t.part.groupBy("p_brand").agg((F.avg("p_retailprice") + 30).alias("floor"))
    return t.part.join(mean, "p_brand").where("p_retailprice > floor").select("p_partkey", "p_retailprice")


@query("prj_from_subquery", """
SELECT y, max(n) AS busiest FROM (SELECT year(o_orderdate)::INT AS y, month(o_orderdate) AS m, count(*) AS n FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') GROUP BY ALL) GROUP BY y""")
def prj_from_subquery(t):
    open_ = t.orders.where("o_orderstatus <> 'P'")
    months = open_.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.count("*").alias("n"))
    return months.groupBy("y").agg(F.max("n").alias("busiest"))


@query("prj_cte", """
WITH a(k, v) AS (SELECT o_custkey, sum(o_totalprice) FROM orders GROUP BY 1), b AS (WITH a AS (SELECT k, v FROM a WHERE v > 1000000) SELECT * FROM a)
SELECT count(*) AS big, (SELECT count(*) FROM a) AS everyone FROM b""")
def prj_cte(t):
    t.orders.createOrReplaceTempView("millrace_orders")
    return t.spark.sql("""
        WITH spent(k, v) AS (SELECT o_custkey, sum(o_totalprice) FROM millrace_orders GROUP BY o_custkey),
        rich AS (WITH spent_more AS (SELECT k, v FROM spent WHERE v > 1000000) SELECT * FROM spent_more)
        SELECT count(*) AS big, (SELECT count(*) FROM spent) AS everyone FROM rich""")


@query("prj_wide_case", """
SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'b' WHEN 'MACHINERY' THEN 'm' ELSE 'other' END AS seg, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'lots' END AS wealth, count(*) AS n FROM customer GROUP BY ALL""")
def prj_wide_case(t):
    seg = F.when(F.col("c_mktsegment") == "BUILDING", "b").when(F.col("c_mktsegment") == "MACHINERY", "m").otherwise("other")
    wealth = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "some").otherwise("lots")
    return t.customer.groupBy(seg.alias("seg"), wealth.alias("wealth")).agg(F.count("*").alias("n"))
