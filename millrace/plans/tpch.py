"""The 22 ad-hoc decision-support queries on the star tables.

There is no partsupp table: ``partsupp(t)`` derives it from the distinct part/supplier pairs of lineitem.
Small dimensions are left to the size-checked automatic broadcast.
"""

from pyspark.sql import Column, DataFrame, functions as F

from millrace.registry import Tables, query


def revenue() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def day(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def money(c: Column, name: str, digits: int = 4) -> Column:
    return F.round(F.sum(c), digits).alias(name)


def partsupp(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")).agg(
        F.min(F.col("l_extendedprice") / F.col("l_quantity")).alias("ps_supplycost"),
        F.sum("l_quantity").alias("ps_availqty"),
    )


PS = """ps AS (SELECT l_partkey ps_partkey, l_suppkey ps_suppkey,
    min(l_extendedprice / l_quantity) ps_supplycost, sum(l_quantity) ps_availqty
  FROM lineitem GROUP BY l_partkey, l_suppkey)"""


@query("tpch_q1", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 4) AS avg_qty, round(avg(l_extendedprice), 4) AS avg_price,
       round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-08-01' GROUP BY ALL ORDER BY ALL""")
def q1(t):
    return (
        t.lineitem.where(F.col("l_shipdate") <= day("2001-08-01"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            money(F.col("l_extendedprice"), "sum_base_price", 2),
            money(revenue(), "sum_disc_price"),
            money(revenue() * (1 + F.col("l_tax")), "sum_charge", 2),
            F.round(F.avg("l_quantity"), 4).alias("avg_qty"),
            F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_disc"),
            F.count("*").alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


@query("tpch_q2", f"""
WITH {PS}, offers AS (
  SELECT p_partkey, p_brand, s_name, s_acctbal, n_name, ps_supplycost,
         min(ps_supplycost) OVER (PARTITION BY p_partkey) AS best
  FROM ps JOIN part ON p_partkey = ps_partkey JOIN supplier ON s_suppkey = ps_suppkey
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
  WHERE p_size <= 15 AND p_type LIKE '%O%' AND r_name = 'EUROPE')
SELECT s_acctbal, s_name, n_name, p_partkey, p_brand FROM offers WHERE ps_supplycost = best
ORDER BY s_acctbal DESC, n_name, s_name, p_partkey LIMIT 100""")
def q2(t):
    sellers = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region.where("r_name = 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "s_name", "s_acctbal", "n_name")
    )
    parts = t.part.where((F.col("p_size") <= 15) & F.col("p_type").like("%O%")).select("p_partkey", "p_brand")
    offers = partsupp(t).join(parts, F.col("ps_partkey") == F.col("p_partkey")).join(
        sellers, F.col("ps_suppkey") == F.col("s_suppkey"))
    best = offers.groupBy("p_partkey").agg(F.min("ps_supplycost").alias("ps_supplycost"))
    return (
        offers.join(best, ["p_partkey", "ps_supplycost"])
        .select("s_acctbal", "s_name", "n_name", "p_partkey", "p_brand")
        .orderBy(F.desc("s_acctbal"), "n_name", "s_name", "p_partkey")
        .limit(100)
    )


@query("tpch_q3", """
SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1998-03-15' AND l_shipdate > TIMESTAMP '1998-03-15'
GROUP BY l_orderkey, orders.o_orderdate ORDER BY revenue DESC, l_orderkey LIMIT 10""")
def q3(t):
    cut = day("1998-03-15")
    orders = t.orders.where(F.col("o_orderdate") < cut).join(
        t.customer.where("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return (
        t.lineitem.where(F.col("l_shipdate") > cut)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_orderkey", "o_orderdate")
        .agg(money(revenue(), "revenue"))
        .select("l_orderkey", "revenue", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
        .orderBy(F.desc("revenue"), "l_orderkey")
        .limit(10)
    )


@query("tpch_q4", """
SELECT o_orderpriority, count(*) AS order_count FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-07-01' AND o_orderdate < TIMESTAMP '1997-10-01'
  AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate > o_orderdate + INTERVAL 60 DAY)
GROUP BY o_orderpriority ORDER BY o_orderpriority""")
def q4(t):
    orders = t.orders.where((F.col("o_orderdate") >= day("1997-07-01")) & (F.col("o_orderdate") < day("1997-10-01")))
    late = (F.col("l_orderkey") == F.col("o_orderkey")) & (
        F.col("l_shipdate") > F.col("o_orderdate") + F.expr("INTERVAL '60' DAY"))
    return (
        orders.join(t.lineitem, late, "left_semi")
        .groupBy("o_orderpriority").agg(F.count("*").alias("order_count")).orderBy("o_orderpriority")
    )


@query("tpch_q5", """
SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey
WHERE r_name = 'ASIA' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
GROUP BY n_name ORDER BY revenue DESC""")
def q5(t):
    nations = t.nation.join(t.region.where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_nationkey", "n_name")
    orders = t.orders.where((F.col("o_orderdate") >= day("1996-01-01")) & (F.col("o_orderdate") < day("1997-01-01")))
    return (
        t.lineitem.join(orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.supplier, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("s_nationkey") == F.col("c_nationkey")))
        .groupBy("n_name").agg(money(revenue(), "revenue")).orderBy(F.desc("revenue"))
    )


@query("tpch_q6", """
SELECT round(sum(l_extendedprice * l_discount), 4) AS revenue FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
  AND l_discount BETWEEN 0.045 AND 0.075 AND l_quantity < 24""")
def q6(t):
    return t.lineitem.where(
        (F.col("l_shipdate") >= day("1996-01-01")) & (F.col("l_shipdate") < day("1997-01-01"))
        & F.col("l_discount").between(0.045, 0.075) & (F.col("l_quantity") < 24)
    ).agg(money(F.col("l_extendedprice") * F.col("l_discount"), "revenue"))


@query("tpch_q7", """
SELECT a.n_name AS supp_nation, b.n_name AS cust_nation, CAST(year(l_shipdate) AS INTEGER) AS l_year,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation a ON a.n_nationkey = s_nationkey
JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation b ON b.n_nationkey = c_nationkey
WHERE (a.n_name, b.n_name) IN (('NATION_6', 'NATION_7'), ('NATION_7', 'NATION_6'))
  AND l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31'
GROUP BY ALL ORDER BY ALL""")
def q7(t):
    pair = F.col("n_name").isin("NATION_6", "NATION_7")
    sellers = t.supplier.join(t.nation.where(pair), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("supp_nation"))
    buyers = t.customer.join(t.nation.where(pair), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("cust_nation"))
    shipped = F.col("l_shipdate").between(day("1997-01-01"), day("1998-12-31"))
    return (
        t.lineitem.where(shipped).join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .where(F.col("supp_nation") != F.col("cust_nation"))
        .groupBy("supp_nation", "cust_nation", F.year("l_shipdate").alias("l_year"))
        .agg(money(revenue(), "revenue")).orderBy("supp_nation", "cust_nation", "l_year")
    )


@query("tpch_q8", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year,
       round(sum(CASE WHEN s.n_name = 'NATION_3' THEN l_extendedprice * (1 - l_discount) ELSE 0 END)
             / sum(l_extendedprice * (1 - l_discount)), 6) AS mkt_share
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN nation c ON c.n_nationkey = c_nationkey JOIN region ON r_regionkey = c.n_regionkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation s ON s.n_nationkey = s_nationkey
WHERE r_name = 'EUROPE' AND p_type = 'ECONOMY' AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31'
GROUP BY ALL ORDER BY ALL""")
def q8(t):
    europe = t.nation.join(t.region.where("r_name = 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t.customer.join(europe, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    orders = t.orders.where(F.col("o_orderdate").between(day("1997-01-01"), day("1998-12-31"))).join(
        buyers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    sellers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    ours = F.when(F.col("n_name") == "NATION_3", revenue()).otherwise(0.0)
    return (
        t.lineitem.join(t.part.where("p_type = 'ECONOMY'"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.year("o_orderdate").alias("o_year"))
        .agg(F.round(F.sum(ours) / F.sum(revenue()), 6).alias("mkt_share")).orderBy("o_year")
    )


@query("tpch_q9", f"""
WITH {PS}
SELECT n_name AS nation, CAST(year(o_orderdate) AS INTEGER) AS o_year,
       round(sum(l_extendedprice * (1 - l_discount) - ps_supplycost * l_quantity), 4) AS sum_profit
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN ps ON ps_partkey = l_partkey AND ps_suppkey = l_suppkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN orders ON o_orderkey = l_orderkey
WHERE p_name LIKE '%gear%' GROUP BY ALL ORDER BY nation, o_year DESC""")
def q9(t):
    gears = t.part.where(F.col("p_name").like("%gear%")).select("p_partkey")
    lines = t.lineitem.join(gears, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    costs = partsupp(t).join(gears, F.col("ps_partkey") == F.col("p_partkey"), "left_semi")
    sellers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("nation"))
    profit = revenue() - F.col("ps_supplycost") * F.col("l_quantity")
    return (
        lines.join(costs, (F.col("l_partkey") == F.col("ps_partkey")) & (F.col("l_suppkey") == F.col("ps_suppkey")))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("nation", F.year("o_orderdate").alias("o_year"))
        .agg(money(profit, "sum_profit")).orderBy("nation", F.desc("o_year"))
    )


@query("tpch_q10", """
SELECT c_custkey, c_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, c_acctbal, n_name
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON n_nationkey = c_nationkey
WHERE o_orderdate >= TIMESTAMP '1997-10-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND l_returnflag = 'R'
GROUP BY c_custkey, c_name, c_acctbal, n_name ORDER BY revenue DESC, c_custkey LIMIT 20""")
def q10(t):
    orders = t.orders.where((F.col("o_orderdate") >= day("1997-10-01")) & (F.col("o_orderdate") < day("1998-01-01")))
    spent = (
        t.lineitem.where("l_returnflag = 'R'").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey").agg(money(revenue(), "revenue"))
    )
    return (
        spent.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "revenue", "c_acctbal", "n_name")
        .orderBy(F.desc("revenue"), "c_custkey").limit(20)
    )


@query("tpch_q11", f"""
WITH {PS}, held AS (SELECT ps_partkey, sum(ps_supplycost * ps_availqty) AS v FROM ps
  JOIN supplier ON s_suppkey = ps_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE n_name = 'NATION_7' GROUP BY ps_partkey)
SELECT ps_partkey, round(v, 4) AS held_value FROM held WHERE v > (SELECT sum(v) * 0.001 FROM held) ORDER BY held_value DESC, ps_partkey""")
def q11(t):
    sellers = t.supplier.join(t.nation.where("n_name = 'NATION_7'"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    lines = t.lineitem.join(sellers, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    ps = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.min(F.col("l_extendedprice") / F.col("l_quantity")).alias("cost"), F.sum("l_quantity").alias("qty"))
    held = ps.groupBy(F.col("l_partkey").alias("ps_partkey")).agg(F.sum(F.col("cost") * F.col("qty")).alias("v"))
    total = held.agg((F.sum("v") * 0.001).alias("floor"))
    return (
        held.join(total, F.col("v") > F.col("floor"))
        .select("ps_partkey", F.round("v", 4).alias("held_value")).orderBy(F.desc("held_value"), "ps_partkey")
    )


@query("tpch_q12", """
SELECT l_linestatus, count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS high_line_count,
       count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS low_line_count
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' AND l_returnflag IN ('A', 'R') AND l_shipdate > o_orderdate
GROUP BY ALL ORDER BY ALL""")
def q12(t):
    high = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    lines = t.lineitem.where(
        (F.col("l_shipdate") >= day("1997-01-01")) & (F.col("l_shipdate") < day("1998-01-01")) & F.col("l_returnflag").isin("A", "R"))
    return (
        lines.join(t.orders, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate")))
        .groupBy("l_linestatus")
        .agg(F.count_if(high).alias("high_line_count"), F.count_if(~high).alias("low_line_count")).orderBy("l_linestatus")
    )


@query("tpch_q13", """
WITH per AS (SELECT c_custkey, count(o_orderkey) AS c_count FROM customer
  LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority NOT LIKE '%URGENT%' GROUP BY c_custkey)
SELECT c_count, count(*) AS custdist FROM per GROUP BY c_count ORDER BY custdist DESC, c_count DESC""")
def q13(t):
    placed = t.orders.where(~F.col("o_orderpriority").like("%URGENT%")).groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    return (
        t.customer.join(placed, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy(F.coalesce("n", F.lit(0).cast("bigint")).alias("c_count"))
        .agg(F.count("*").alias("custdist")).orderBy(F.desc("custdist"), F.desc("c_count"))
    )


@query("tpch_q14", """
SELECT round(100.0 * sum(l_extendedprice * (1 - l_discount)) FILTER (WHERE p_type LIKE 'PROMO%')
             / sum(l_extendedprice * (1 - l_discount)), 6) AS promo_revenue
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE l_shipdate >= TIMESTAMP '1997-09-01' AND l_shipdate < TIMESTAMP '1997-10-01'""")
def q14(t):
    lines = t.lineitem.where((F.col("l_shipdate") >= day("1997-09-01")) & (F.col("l_shipdate") < day("1997-10-01")))
    promo = F.when(F.col("p_type").like("PROMO%"), revenue())
    return lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).agg(
        F.round(100.0 * F.sum(promo) / F.sum(revenue()), 6).alias("promo_revenue"))


@query("tpch_q15", """
WITH takings AS (SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS total_revenue FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-04-01' GROUP BY l_suppkey)
SELECT s_suppkey, s_name, total_revenue FROM takings JOIN supplier ON s_suppkey = l_suppkey
WHERE total_revenue = (SELECT max(total_revenue) FROM takings) ORDER BY s_suppkey""")
def q15(t):
    takings = (
        t.lineitem.where((F.col("l_shipdate") >= day("1997-01-01")) & (F.col("l_shipdate") < day("1997-04-01")))
        .groupBy("l_suppkey").agg(money(revenue(), "total_revenue"))
    )
    best = takings.agg(F.max("total_revenue").alias("total_revenue"))
    return (
        takings.join(best, "total_revenue").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("s_suppkey", "s_name", "total_revenue").orderBy("s_suppkey")
    )


@query("tpch_q16", """
SELECT p_brand, p_type, p_size, count(DISTINCT l_suppkey) AS supplier_cnt
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN part ON p_partkey = l_partkey
WHERE p_brand <> 'Brand#4' AND p_type NOT LIKE 'MEDIUM%' AND p_size IN (3, 9, 14, 19, 23, 36, 45, 49)
  AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
GROUP BY ALL ORDER BY supplier_cnt DESC, p_brand, p_type, p_size""")
def q16(t):
    parts = t.part.where(
        (F.col("p_brand") != "Brand#4") & ~F.col("p_type").like("MEDIUM%") & F.col("p_size").isin(3, 9, 14, 19, 23, 36, 45, 49))
    return (
        t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier.where("s_acctbal < 0"), F.col("l_suppkey") == F.col("s_suppkey"), "left_anti")
        .groupBy("p_brand", "p_type", "p_size").agg(F.countDistinct("l_suppkey").alias("supplier_cnt"))
        .orderBy(F.desc("supplier_cnt"), "p_brand", "p_type", "p_size")
    )


@query("tpch_q17", """
SELECT round(sum(l_extendedprice) / 7.0, 4) AS avg_yearly FROM lineitem o JOIN part ON p_partkey = l_partkey
WHERE p_brand = 'Brand#3' AND p_type = 'STANDARD'
  AND l_quantity < (SELECT 0.2 * avg(i.l_quantity) FROM lineitem i WHERE i.l_partkey = o.l_partkey)""")
def q17(t):
    wanted = t.part.where("p_brand = 'Brand#3' AND p_type = 'STANDARD'").select("p_partkey")
    lines = t.lineitem.join(wanted, F.col("l_partkey") == F.col("p_partkey"), "left_semi").select(
        "l_partkey", "l_quantity", "l_extendedprice")
    floor = lines.groupBy("l_partkey").agg((0.2 * F.avg("l_quantity")).alias("few"))
    return (
        lines.join(floor, "l_partkey").where(F.col("l_quantity") < F.col("few"))
        .agg(F.round(F.sum("l_extendedprice") / 7.0, 4).alias("avg_yearly"))
    )


@query("tpch_q18", """
WITH big AS (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 250)
SELECT c_name, c_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice, qty AS sum_qty
FROM big JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def q18(t):
    big = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("sum_qty")).where("sum_qty > 250")
    return (
        big.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_name", "c_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_totalprice", "sum_qty")
        .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
    )


@query("tpch_q19", """
SELECT round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE l_linestatus = 'O' AND ((p_brand = 'Brand#12' AND p_type IN ('SMALL', 'PROMO') AND l_quantity BETWEEN 1 AND 11 AND p_size BETWEEN 1 AND 25)
   OR (p_brand = 'Brand#23' AND p_type IN ('MEDIUM', 'ECONOMY') AND l_quantity BETWEEN 10 AND 20 AND p_size BETWEEN 1 AND 30)
   OR (p_brand = 'Brand#5' AND p_type IN ('LARGE', 'STANDARD') AND l_quantity BETWEEN 20 AND 30 AND p_size BETWEEN 1 AND 45))""")
def q19(t):
    def pick(brand, types, low, size):
        return (
            (F.col("p_brand") == brand) & F.col("p_type").isin(*types)
            & F.col("l_quantity").between(low, low + 10) & F.col("p_size").between(1, size)
        )

    any_pick = (
        pick("Brand#12", ("SMALL", "PROMO"), 1, 25)
        | pick("Brand#23", ("MEDIUM", "ECONOMY"), 10, 30)
        | pick("Brand#5", ("LARGE", "STANDARD"), 20, 45)
    )
    return (
        t.lineitem.where("l_linestatus = 'O'").join(t.part, (F.col("l_partkey") == F.col("p_partkey")) & any_pick)
        .agg(money(revenue(), "revenue"))
    )


@query("tpch_q20", """
WITH moved AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS qty, count(*) AS n FROM lineitem GROUP BY ALL),
year97 AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS qty FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY ALL)
SELECT s_name, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey
WHERE n_regionkey = 3 AND s_suppkey IN (
  SELECT m.l_suppkey FROM moved m JOIN part ON p_partkey = m.l_partkey
  JOIN year97 y ON y.l_partkey = m.l_partkey AND y.l_suppkey = m.l_suppkey
  WHERE p_name LIKE 'red%' AND m.qty > 0.5 * y.qty)
ORDER BY s_name""")
def q20(t):
    reds = t.part.where(F.col("p_name").like("red%"))
    in97 = (F.col("l_shipdate") >= day("1997-01-01")) & (F.col("l_shipdate") < day("1998-01-01"))
    moved = (
        t.lineitem.join(reds, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.sum("l_quantity").alias("qty"), F.sum(F.when(in97, F.col("l_quantity"))).alias("qty97"))
        .where("qty > 0.5 * qty97")
    )
    return (
        t.supplier.join(moved, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi")
        .join(t.nation.where("n_regionkey = 3"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_name", "n_name").orderBy("s_name")
    )


@query("tpch_q21", """
WITH late AS (SELECT l_orderkey, l_suppkey, l_shipdate > o_orderdate + INTERVAL 60 DAY AS is_late
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F')
SELECT s_name, count(*) AS numwait FROM late a JOIN supplier ON s_suppkey = a.l_suppkey JOIN nation ON n_nationkey = s_nationkey
WHERE a.is_late AND n_regionkey = 1
  AND EXISTS (SELECT 1 FROM late b WHERE b.l_orderkey = a.l_orderkey AND b.l_suppkey <> a.l_suppkey)
  AND NOT EXISTS (SELECT 1 FROM late c WHERE c.l_orderkey = a.l_orderkey AND c.l_suppkey <> a.l_suppkey AND c.is_late)
GROUP BY s_name ORDER BY numwait DESC, s_name LIMIT 100""")
def q21(t):
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate").join(
        t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    is_late = F.col("l_shipdate") > F.col("o_orderdate") + F.expr("INTERVAL '60' DAY")
    per_supplier = lines.groupBy("l_orderkey", "l_suppkey").agg(F.count_if(is_late).alias("late"))
    # more than one supplier on the order, exactly one of them late: no self join needed
    blamed = (
        per_supplier.groupBy("l_orderkey")
        .agg(
            F.count("*").alias("suppliers"), F.count_if(F.col("late") > 0).alias("late_suppliers"),
            F.max(F.when(F.col("late") > 0, F.col("l_suppkey"))).alias("suppkey"), F.sum("late").alias("lines"),
        )
        .where("suppliers > 1 AND late_suppliers = 1")
    )
    sellers = t.supplier.join(t.nation.where("n_regionkey = 1"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    return (
        blamed.join(sellers, F.col("suppkey") == F.col("s_suppkey"))
        .groupBy("s_name").agg(F.sum("lines").alias("numwait")).orderBy(F.desc("numwait"), "s_name").limit(100)
    )


@query("tpch_q22", """
WITH rich AS (SELECT avg(c_acctbal) AS floor FROM customer WHERE c_acctbal > 0 AND c_nationkey IN (3, 7, 9, 13, 17, 18, 23))
SELECT c_nationkey AS cntrycode, count(*) AS numcust, round(sum(c_acctbal), 2) AS totacctbal FROM customer, rich
WHERE c_nationkey IN (3, 7, 9, 13, 17, 18, 23) AND c_acctbal > floor
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
GROUP BY ALL ORDER BY ALL""")
def q22(t):
    people = t.customer.where(F.col("c_nationkey").isin(3, 7, 9, 13, 17, 18, 23))
    floor = people.where("c_acctbal > 0").agg(F.avg("c_acctbal").alias("floor"))
    return (
        people.join(floor, F.col("c_acctbal") > F.col("floor"))
        .join(t.orders.where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")
        .groupBy(F.col("c_nationkey").alias("cntrycode"))
        .agg(F.count("*").alias("numcust"), F.round(F.sum("c_acctbal"), 2).alias("totacctbal")).orderBy("cntrycode")
    )
