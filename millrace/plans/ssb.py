"""Star-schema queries: lineitem with its order as the fact table, dimensions derived from the star.

A "city" is a nation and the last digit of the key; a "category" is the part's type; the discount is in percent.
"""

from pyspark.sql import DataFrame, functions as F

from millrace.functions.times import between, years
from millrace.registry import query

FACT = """f AS (SELECT l.*, o_custkey, o_orderdate, year(o_orderdate)::INT AS d_year, month(o_orderdate)::INT AS d_month, weekofyear(o_orderdate)::INT AS d_week, round(l_discount * 100)::INT AS disc,
  l_extendedprice * (1 - l_discount) AS revenue FROM lineitem l JOIN orders ON o_orderkey = l_orderkey),
c AS (SELECT c_custkey, n_name AS c_nation, r_name AS c_region, n_name || '-' || (c_custkey % 10) AS c_city FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
s AS (SELECT s_suppkey, n_name AS s_nation, r_name AS s_region, n_name || '-' || (s_suppkey % 10) AS s_city FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def fact(t, span: tuple[int, int] | None = None) -> DataFrame:
    """Lines with their orders; ``span``, the first and last year asked for, becomes a date range of the scan."""
    day = F.col("o_orderdate")
    orders = (between(t.orders, "o_orderdate", years(*span)) if span else t.orders).select("o_orderkey", "o_custkey", F.year(day).alias("d_year"), F.month(day).alias("d_month"), F.weekofyear(day).alias("d_week"))
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.round(F.col("l_discount") * 100).cast("int").alias("disc"),
                              (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def places(t, table, key, nation, prefix) -> DataFrame:
    df = getattr(t, table)
    return df.join(t.nation, F.col(nation) == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        key, F.col("n_name").alias(f"{prefix}_nation"), F.col("r_name").alias(f"{prefix}_region"),
        F.concat_ws("-", "n_name", F.col(key) % 10).alias(f"{prefix}_city"))


def buyers(t):
    return places(t, "customer", "c_custkey", "c_nationkey", "c")


def sellers(t):
    return places(t, "supplier", "s_suppkey", "s_nationkey", "s")


def revenue(name="revenue"):
    return F.round(F.sum("revenue"), 4).alias(name)


def _flight1(number, year, rest):
    where = f"d_year = {year} AND {rest}"

    @query(f"ssb_1{number}", f"WITH {FACT} SELECT round(sum(l_extendedprice * l_discount), 4) AS revenue FROM f WHERE {where}")
    def build(t):
        return fact(t, (year, year)).where(where).agg(F.round(F.sum(F.col("l_extendedprice") * F.col("disc") / 100), 4).alias("revenue"))

    return build


_flight1(1, 1997, "disc BETWEEN 1 AND 3 AND l_quantity < 25")
_flight1(2, 1998, "d_month = 1 AND disc BETWEEN 4 AND 6 AND l_quantity BETWEEN 26 AND 35")
_flight1(3, 1998, "d_week = 6 AND disc BETWEEN 5 AND 7 AND l_quantity BETWEEN 26 AND 35")


def _flight2(number, part, region):
    @query(f"ssb_2{number}", f"""WITH {FACT} SELECT d_year, p_brand, round(sum(revenue), 4) AS revenue FROM f JOIN part ON p_partkey = l_partkey JOIN s ON s_suppkey = l_suppkey
WHERE {part} AND s_region = '{region}' GROUP BY d_year, p_brand ORDER BY d_year, p_brand""")
    def build(t):
        return (
            fact(t).join(t.part.where(part), F.col("l_partkey") == F.col("p_partkey"))
            .join(sellers(t).where(F.col("s_region") == region), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
            .groupBy("d_year", "p_brand").agg(revenue()).orderBy("d_year", "p_brand")
        )

    return build


_flight2(1, "p_type = 'MEDIUM'", "AMERICA")
_flight2(2, "p_brand BETWEEN 'Brand#14' AND 'Brand#21'", "ASIA")
_flight2(3, "p_brand = 'Brand#22'", "EUROPE")


def _flight3(number, group, where, span):
    low, high, month = span
    when = f"d_year BETWEEN {low} AND {high}" + (f" AND d_month = {month}" if month else "")
    c, s = f"c_{group}", f"s_{group}"

    @query(f"ssb_3{number}", f"""WITH {FACT} SELECT {c}, {s}, d_year, round(sum(revenue), 4) AS revenue FROM f JOIN c ON c_custkey = o_custkey JOIN s ON s_suppkey = l_suppkey
WHERE {where.format(p='c')} AND {where.format(p='s')} AND {when} GROUP BY ALL ORDER BY d_year, revenue DESC, {c}, {s}""")
    def build(t):
        return (
            fact(t, (low, high)).where(when).join(buyers(t).where(where.format(p="c")), F.col("o_custkey") == F.col("c_custkey"))
            .join(sellers(t).where(where.format(p="s")), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(c, s, "d_year").agg(revenue()).orderBy("d_year", F.desc("revenue"), c, s)
        )

    return build


CITIES = "{p}_city IN ('NATION_7-1', 'NATION_7-5', 'NATION_3-2', 'NATION_3-4', 'NATION_3-6', 'NATION_12-8', 'NATION_12-2', 'NATION_12-3')"
_flight3(1, "nation", "{p}_region = 'ASIA'", (1996, 2000, None))
_flight3(2, "city", "{p}_nation = 'NATION_7'", (1995, 2001, None))
_flight3(3, "city", CITIES, (1995, 2001, None))
_flight3(4, "city", CITIES.replace("'NATION_7-1'", "'NATION_0-1', 'NATION_0-5', 'NATION_7-1'"), (1995, 2001, 12))


def _flight4(number, group, where, extra, span=None):
    names = ", ".join(group)

    @query(f"ssb_4{number}", f"""WITH {FACT} SELECT {names}, round(sum(revenue - l_quantity * 500), 4) AS profit FROM f JOIN c ON c_custkey = o_custkey JOIN s ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
WHERE {where} AND {extra} GROUP BY {names} ORDER BY {names}""")
    def build(t):
        return (
            fact(t, span).join(buyers(t), F.col("o_custkey") == F.col("c_custkey")).join(sellers(t), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t.part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
            .where(where).where(extra)
            .groupBy(*group).agg(F.round(F.sum(F.col("revenue") - F.col("l_quantity") * 500), 4).alias("profit")).orderBy(*group)
        )

    return build


_flight4(1, ["d_year", "c_nation"], "c_region = 'AMERICA' AND s_region = 'AMERICA'", "p_type IN ('SMALL', 'LARGE')")
_flight4(2, ["d_year", "s_nation", "p_type"], "c_region = 'AMERICA' AND s_region = 'AMERICA'", "d_year IN (1997, 1998) AND p_type IN ('SMALL', 'LARGE')", (1997, 1998))
_flight4(3, ["d_year", "s_city", "p_brand"], "c_region = 'AMERICA' AND s_nation = 'NATION_6'", "d_year IN (1997, 1998) AND p_type = 'PROMO'", (1997, 1998))
