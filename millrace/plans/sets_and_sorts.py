"""Set operations, orders, limits and layout."""

import uuid

from pyspark.sql import functions as F

from millrace.operators import sorting as so, windows as ow
from millrace.registry import query


def buyers(t, status):
    return t.orders.where(F.col("o_orderstatus") == status).select("o_custkey")


@query("set_union_all", """
SELECT kind, count(*) AS n, sum(k)::BIGINT AS s FROM (SELECT 'c' AS kind, c_custkey AS k FROM customer UNION ALL SELECT 's', s_suppkey FROM supplier
UNION ALL SELECT 'n', n_nationkey FROM nation) GROUP BY kind""")
def set_union_all(t):
    rows = t.customer.select(F.lit("c").alias("kind"), F.col("c_custkey").alias("k")).union(
        t.supplier.select(F.lit("s"), "s_suppkey")).union(t.nation.select(F.lit("n"), "n_nationkey"))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum("k").alias("s"))


@query("set_union", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def set_union(t):
    return buyers(t, "F").union(buyers(t, "P")).distinct()


@query("set_intersect", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def set_intersect(t):
    return buyers(t, "F").intersect(buyers(t, "P"))


@query("set_intersect_all", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def set_intersect_all(t):
    return buyers(t, "F").intersectAll(buyers(t, "P"))


@query("set_except", """
SELECT nullif(p_size, 7) AS k FROM part WHERE p_type = 'LARGE' EXCEPT SELECT nullif(p_size, 7) FROM part WHERE p_type = 'SMALL' AND p_brand < 'Brand#14'""")
def set_except(t):
    k = F.expr("nullif(p_size, 7)").alias("k")
    return t.part.where("p_type = 'LARGE'").select(k).subtract(t.part.where("p_type = 'SMALL' AND p_brand < 'Brand#14'").select(k))


@query("set_except_all", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def set_except_all(t):
    return buyers(t, "F").exceptAll(buyers(t, "P"))


@query("set_distinct", """
SELECT DISTINCT l_returnflag, l_linestatus, nullif(l_linenumber, 1) AS line FROM lineitem""")
def set_distinct(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", F.expr("nullif(l_linenumber, 1)").alias("line")).distinct()


@query("set_chain", """
(SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
def set_chain(t):
    rich = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return buyers(t, "F").exceptAll(buyers(t, "P")).unionAll(buyers(t, "O").intersect(rich))


@query("set_union_by_name", """
SELECT k, name, acctbal FROM (SELECT c_custkey AS k, c_name AS name, c_acctbal AS acctbal FROM customer UNION ALL SELECT p_partkey, p_name, NULL FROM part)""")
def set_union_by_name(t):
    people = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    return people.unionByName(t.part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("k")), allowMissingColumns=True)


@query("sort_nulls", """
SELECT p_partkey, row_number() OVER (ORDER BY nullif(p_size, 5) DESC NULLS LAST, p_partkey) AS place FROM part
ORDER BY nullif(p_size, 5) DESC NULLS LAST, p_partkey LIMIT 100""")
def sort_nulls(t):
    """Top 100 by a key with gaps; the place is numbered over the 100 rows only."""
    from pyspark.sql import Window

    key = F.expr("nullif(p_size, 5)").desc_nulls_last()
    first = so.top(t.part, [key, F.col("p_partkey")], 100)
    return first.select("p_partkey", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(key, "p_partkey")).cast("bigint").alias("place"))


@query("sort_total_order", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey""")
def sort_total_order(t):
    return so.sort_by_key(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


@query("sort_by_partition", """
SELECT l_partkey, count(*) AS n, min(l_suppkey) AS low FROM lineitem GROUP BY l_partkey""")
def sort_by_partition(t):
    laid = so.cluster_by(t.lineitem.select("l_partkey", "l_suppkey", "l_orderkey"), ["l_partkey", "l_orderkey"])
    return laid.groupBy("l_partkey").agg(F.count("*").alias("n"), F.min("l_suppkey").alias("low"))


@query("filter_by_range", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 1000 AND 1999""")
def filter_by_range(t):
    return so.sort_by_key(so.filter_by_range(t.orders, "o_orderkey", 1000, 1999), ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("topk", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def topk(t):
    return so.top(t.orders, [F.desc("o_totalprice"), "o_orderkey"], 25).select("o_orderkey", "o_totalprice")


@query("limit_offset", """
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 20 OFFSET 10""")
def limit_offset(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy("c_acctbal", "c_custkey").offset(10).limit(20)


@query("topk_by_key", """
SELECT l_partkey, l_orderkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey) <= 2""")
def topk_by_key(t):
    return ow.top_k(t.lineitem.select("l_partkey", "l_orderkey", "l_extendedprice"), ["l_partkey"],
                    [F.desc("l_extendedprice"), F.col("l_orderkey")], 2).drop("rn")


@query("zip_index", """
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM events""")
def zip_index(t):
    return so.zip_with_index(t.events.select("ts", "event_id"), ["ts", "event_id"]).select("event_id", "idx")


@query("repartition_stable", """
SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY l_suppkey""")
def repartition_stable(t):
    """A layout by hash of the order spreads the rows evenly; the group then combines inside each task first."""
    return t.lineitem.select("l_suppkey", "l_quantity", "l_orderkey").repartition("l_orderkey").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("q"))


@query("checkpoint_reuse", """
SELECT kind, total FROM (SELECT 'sum' AS kind, round(sum(v), 2) AS total FROM (SELECT sum(o_totalprice) AS v FROM orders GROUP BY o_custkey)
UNION ALL SELECT 'top', round(max(v), 2) FROM (SELECT sum(o_totalprice) AS v FROM orders GROUP BY o_custkey))""")
def checkpoint_reuse(t):
    per = so.cut(t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v")))
    return per.select(F.lit("sum").alias("kind"), F.col("v")).groupBy("kind").agg(F.round(F.sum("v"), 2).alias("total")).union(
        per.select(F.lit("top").alias("kind"), F.col("v")).groupBy("kind").agg(F.round(F.max("v"), 2).alias("total")))


@query("cache_reuse", """
SELECT o_orderpriority, count(*) AS n, round(max(o_totalprice), 2) AS top, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS all_done FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
def cache_reuse(t):
    """A lazily cached view on disk, read twice and let go again; the results are written before that."""
    from millrace.session import checkpointed

    name = f"millrace_done_{uuid.uuid4().hex}"
    t.orders.where("o_orderstatus = 'F'").select("o_orderpriority", "o_totalprice").createOrReplaceTempView(name)
    t.spark.sql(f"CACHE LAZY TABLE {name} OPTIONS ('storageLevel' 'DISK_ONLY')")
    try:
        kept = t.spark.table(name)
        total = kept.count()
        return checkpointed(kept.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.round(F.max("o_totalprice"), 2).alias("top"), F.lit(total).cast("bigint").alias("all_done")))
    finally:
        t.spark.sql(f"UNCACHE TABLE {name}")
        t.spark.catalog.dropTempView(name)
