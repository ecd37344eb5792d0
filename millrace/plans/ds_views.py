"""Retail tables of three sales channels, derived from the star, for the decision-support queries ``ds_*``.

A line is sold in a store, by catalog or on the web by its line number. The views are stated twice, once per engine,
because date arithmetic differs; the queries over them are plain SQL.
"""

import re

from pyspark.sql import DataFrame, functions as F

from millrace.functions.times import between, years
from millrace.registry import Tables, query

SQL_VIEWS = {
    "sales": """SELECT CASE l_linenumber % 3 WHEN 0 THEN 'store' WHEN 1 THEN 'catalog' ELSE 'web' END AS ch, l_partkey AS item, o_custkey AS cust, l_suppkey AS outlet,
  l_orderkey AS ord, l_linenumber AS line, l_quantity AS qty, l_extendedprice AS price, l_extendedprice * l_discount AS disc, l_extendedprice * (1 - l_discount) AS net,
  l_extendedprice * (0.3 - l_discount) AS profit, l_extendedprice * l_tax AS tax, l_returnflag AS flag, l_linestatus AS reason, o_orderpriority AS promo,
  date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS day, year(o_orderdate) AS yr, month(o_orderdate) AS mo, quarter(o_orderdate) AS qtr, dayofweek(o_orderdate) AS dow,
  (date_diff('day', DATE '1970-01-01', o_orderdate::DATE) + 4) // 7 AS wk, (l_orderkey * 7) % 24 AS hour, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS lag
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "returns": """SELECT ch, item, cust, outlet, ord, qty AS sold, floor(qty / 2) AS qty, price * 0.5 AS amt, price * 0.1 AS loss, reason, yr, mo, qtr, wk, day + 20 AS day FROM sales WHERE flag = 'R'""",
    "items": """SELECT p_partkey AS item, 'I' || p_partkey AS iname, p_brand AS brand, p_type AS cat, split_part(p_name, ' ', 2) AS cls, split_part(p_name, ' ', 1) AS color, p_size AS size,
  p_size % 20 AS manu, p_retailprice AS list FROM part""",
    "people": """SELECT c_custkey AS cust, c_name AS name, n_name AS state, r_name AS country, n_name || '-' || (c_custkey % 10) AS city, c_custkey % 100 AS zip, c_mktsegment AS seg, c_acctbal AS bal,
  c_custkey % 2 AS gender, c_custkey % 3 AS marital, c_custkey % 5 AS deps, c_custkey % 4 AS cars, c_custkey % 12 + 1 AS birth_mo FROM customer
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "outlets": """SELECT s_suppkey AS outlet, s_name AS oname, n_name AS state, r_name AS country, n_name || '-' || (s_suppkey % 10) AS city, s_suppkey % 100 AS zip, s_suppkey % 300 AS staff, s_suppkey % 5 AS wh,
  s_acctbal AS bal FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "stock": """SELECT item, outlet % 5 AS wh, yr, mo, min(day) AS day, sum(qty) AS qoh FROM sales GROUP BY item, outlet % 5, yr, mo""",
}
NEEDS = {"returns": ["sales"], "stock": ["sales"]}


def sales(t: Tables, dates: tuple[str, str] | None = None) -> DataFrame:
    """All sold lines; ``dates`` (from, before) limits the orders by a range that reaches the scan."""
    orders = between(t.orders, "o_orderdate", dates) if dates else t.orders
    price, discount, when = F.col("l_extendedprice"), F.col("l_discount"), F.to_date("o_orderdate")
    day = F.unix_date(when)
    line = F.col("l_linenumber") % 3
    return t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(line == 0, "store").when(line == 1, "catalog").otherwise("web").alias("ch"), F.col("l_partkey").alias("item"), F.col("o_custkey").alias("cust"),
        F.col("l_suppkey").alias("outlet"), F.col("l_orderkey").alias("ord"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty"), price.alias("price"),
        (price * discount).alias("disc"), (price * (1 - discount)).alias("net"), (price * (0.3 - discount)).alias("profit"), (price * F.col("l_tax")).alias("tax"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("reason"), F.col("o_orderpriority").alias("promo"), day.alias("day"), F.year(when).alias("yr"),
        F.month(when).alias("mo"), F.quarter(when).alias("qtr"), (F.dayofweek(when) - 1).alias("dow"), F.floor((day + 4) / 7).alias("wk"),
        ((F.col("l_orderkey") * 7) % 24).alias("hour"), F.datediff(F.to_date("l_shipdate"), when).alias("lag"))


def returns(t: Tables, dates: tuple[str, str] | None = None) -> DataFrame:
    return sales(t, dates).where("flag = 'R'").select(
        "ch", "item", "cust", "outlet", "ord", F.col("qty").alias("sold"), F.floor(F.col("qty") / 2).cast("double").alias("qty"), (F.col("price") * 0.5).alias("amt"),
        (F.col("price") * 0.1).alias("loss"), "reason", "yr", "mo", "qtr", "wk", (F.col("day") + 20).alias("day"))


def items(t: Tables) -> DataFrame:
    name = F.split("p_name", " ")
    return t.part.select(F.col("p_partkey").alias("item"), F.concat(F.lit("I"), "p_partkey").alias("iname"), F.col("p_brand").alias("brand"), F.col("p_type").alias("cat"),
                         name[1].alias("cls"), name[0].alias("color"), F.col("p_size").alias("size"), (F.col("p_size") % 20).alias("manu"), F.col("p_retailprice").alias("list"))


def _placed(t: Tables, df: DataFrame, nation: str) -> DataFrame:
    return df.join(t.nation, F.col(nation) == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))


def people(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return _placed(t, t.customer, "c_nationkey").select(
        k.alias("cust"), F.col("c_name").alias("name"), F.col("n_name").alias("state"), F.col("r_name").alias("country"), F.concat_ws("-", "n_name", k % 10).alias("city"),
        (k % 100).alias("zip"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal"), (k % 2).alias("gender"), (k % 3).alias("marital"), (k % 5).alias("deps"),
        (k % 4).alias("cars"), (k % 12 + 1).alias("birth_mo"))


def outlets(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return _placed(t, t.supplier, "s_nationkey").select(
        k.alias("outlet"), F.col("s_name").alias("oname"), F.col("n_name").alias("state"), F.col("r_name").alias("country"), F.concat_ws("-", "n_name", k % 10).alias("city"),
        (k % 100).alias("zip"), (k % 300).alias("staff"), (k % 5).alias("wh"), F.col("s_acctbal").alias("bal"))


def stock(t: Tables, dates: tuple[str, str] | None = None) -> DataFrame:
    return sales(t, dates).groupBy("item", (F.col("outlet") % 5).alias("wh"), "yr", "mo").agg(F.min("day").alias("day"), F.sum("qty").alias("qoh"))


VIEWS = {"sales": sales, "returns": returns, "items": items, "people": people, "outlets": outlets, "stock": stock}
DATED = ("sales", "returns", "stock")  # by the date of the order


def used_views(sql: str) -> list[str]:
    named = [v for v in VIEWS if re.search(rf"\b(?:FROM|JOIN)\s+{v}\b", sql)]
    wanted = {n for v in named for n in [*NEEDS.get(v, []), v]}
    return [v for v in VIEWS if v in wanted]


def for_duckdb(sql: str) -> str:
    heads = ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in used_views(sql))
    body = sql.strip()
    return f"WITH {heads},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {heads}\n{body}"


def run(t: Tables, sql: str, dates: tuple[str, str] | None = None) -> DataFrame:
    """The query over the views of this folder, bound by name for this one statement."""
    frames = {v: (VIEWS[v](t, dates) if v in DATED else VIEWS[v](t)) for v in VIEWS if re.search(rf"\b(?:FROM|JOIN)\s+{v}\b", sql)}
    return t.spark.sql(re.sub(r"\b(FROM|JOIN)\s+(" + "|".join(VIEWS) + r")\b", r"\1 {\2}", sql), **frames)


# The years that a query asks for in every place where it reads sales, returns or stock; the range reaches the scan.
# Weeks of q2 and q59 are compared with those of the next year and may begin in the year before.
YEARS = {
    (1997, 1997): "q55",
    (1998, 1998): """q1 q5 q6 q7 q8 q10 q12 q13 q15 q18 q20 q21 q22 q26 q27 q30 q31 q32 q33 q35 q36 q38 q39a q39b q40 q42 q43 q45 q48 q49 q50 q51 q53
        q56 q58 q60 q61 q62 q63 q65 q67 q69 q70 q71 q72 q77 q78 q80 q81 q83 q85 q86 q87 q89 q91 q92 q98 q99
        v27_q5a v27_q12 v27_q18a v27_q20 v27_q22a v27_q27a v27_q35 v27_q36a v27_q51a v27_q67a v27_q70a v27_q72 v27_q77a v27_q80a v27_q86a v27_q98""",
    (1999, 1999): "q19 q52 v27_q6 v27_q10a v27_q22 v27_q35a v27_q49 v27_q78",
    (1997, 1998): "q4 q11 q17 q25 q29 q74 q75 v27_q11 v27_q74 v27_q75",
    (1998, 1999): "q16 q54 q94 q95 v27_q34",
    (1997, 1999): "q14a q14b q34 q46 q47 q57 q68 q73 q79 v27_q14 v27_q14a v27_q47 v27_q57",
    (1996, 1999): "q2 q59",
}
DATES = {name: years(*span) for span, names in YEARS.items() for name in names.split()}


def ds(name: str, sql: str, dates: tuple[str, str] | None = None, spark: str | None = None) -> None:
    """Register a decision-support query: one text for both engines, or a text of its own for Spark where that reads less."""
    dates = dates or DATES.get(name)
    query(f"ds_{name}", for_duckdb(sql))(lambda t: run(t, spark or sql, dates))
