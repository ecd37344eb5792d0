"""Decision-support queries over the three-channel retail views, q1 to q50.

Comparisons of one channel or year with another are written as conditional sums over one scan instead of self joins.
Sort keys are complete, so limits are deterministic.
"""

from millrace.plans.ds_views import ds

ALL3 = "('store', 'catalog', 'web')"


def r(expr: str, name: str, digits: int = 4) -> str:
    """A rounded output column. A mean is the rounded sum over the count, which both engines work out alike."""
    if expr.startswith("avg(") and expr.endswith(")"):
        return f"round(sum({expr[4:-1]}), {digits}) / count({expr[4:-1]}) AS {name}"
    return f"round({expr}, {digits}) AS {name}"


def per_channel(expr: str, extra: str = "") -> str:
    """One conditional sum per channel."""
    return ", ".join(f"sum(CASE WHEN ch = '{c}'{extra} THEN {expr} ELSE 0 END) AS {c}_v" for c in ("store", "catalog", "web"))


ds("q1", """
WITH r AS (SELECT cust, outlet, sum(amt) AS total FROM returns WHERE ch = 'store' AND yr = 1998 GROUP BY cust, outlet), m AS (SELECT outlet, avg(total) * 1.2 AS lim FROM r GROUP BY outlet)
SELECT p.name, count(*) AS n FROM r JOIN m ON m.outlet = r.outlet JOIN outlets o ON o.outlet = r.outlet JOIN people p ON p.cust = r.cust WHERE r.total > m.lim AND o.country = 'ASIA'
GROUP BY p.name ORDER BY p.name LIMIT 100""")

DAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")
DAY_SUMS = ", ".join(f"sum(CASE WHEN dow = {i} THEN price END) AS {d}" for i, d in enumerate(DAYS))

ds("q2", f"""
WITH w AS (SELECT wk, min(yr) AS yr, {DAY_SUMS} FROM sales WHERE ch IN ('web', 'catalog') GROUP BY wk)
SELECT a.wk, {", ".join(r(f"a.{d} / b.{d}", d) for d in DAYS)} FROM w a JOIN w b ON b.wk = a.wk + 53 WHERE a.yr = 1997 ORDER BY a.wk""")

ds("q3", f"""
SELECT s.yr, i.brand, {r("sum(s.price)", "sum_agg", 2)} FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'store' AND i.manu = 8 AND s.mo = 11
GROUP BY s.yr, i.brand ORDER BY s.yr, sum_agg DESC, i.brand LIMIT 100""")

YEARLY = "WITH y AS (SELECT cust, " + ", ".join(
    f"sum(CASE WHEN ch = '{c}' AND yr = {y} THEN net ELSE 0 END) AS {c[0]}{y % 100}" for c in ("store", "catalog", "web") for y in (1997, 1998)) + " FROM sales WHERE yr IN (1997, 1998) GROUP BY cust)"

ds("q4", f"""{YEARLY}
SELECT p.cust, p.name FROM y JOIN people p ON p.cust = y.cust WHERE s97 > 0 AND c97 > 0 AND w97 > 0 AND c98 / c97 > s98 / s97 AND c98 / c97 > w98 / w97 ORDER BY p.cust, p.name LIMIT 100""")

CHANNEL_MOVES = """moves AS (SELECT ch, outlet, price AS sold, 0.0 AS back, profit AS gain, 0.0 AS lost FROM sales WHERE yr = 1998 AND mo = 8
UNION ALL SELECT ch, outlet, 0.0, amt, 0.0, loss FROM returns WHERE yr = 1998 AND mo = 8)"""

ds("q5", f"""
WITH {CHANNEL_MOVES}
SELECT ch, outlet, {r("sum(sold)", "sales", 2)}, {r("sum(back)", "returned")}, {r("sum(gain) - sum(lost)", "profit")} FROM moves GROUP BY ROLLUP (ch, outlet) ORDER BY ch NULLS FIRST, outlet NULLS FIRST LIMIT 100""")

ds("q6", """
WITH m AS (SELECT cat, avg(list) * 1.01 AS lim FROM items GROUP BY cat)
SELECT p.state, count(*) AS cnt FROM sales s JOIN items i ON i.item = s.item JOIN m ON m.cat = i.cat JOIN people p ON p.cust = s.cust
WHERE s.ch = 'store' AND s.yr = 1998 AND s.mo = 1 AND i.list > m.lim GROUP BY p.state HAVING count(*) >= 3 ORDER BY cnt, p.state LIMIT 100""")


def profile(ch: str, where: str) -> str:
    return f"""
SELECT i.iname, {r("avg(s.qty)", "a1")}, {r("avg(s.price)", "a2")}, {r("avg(s.disc)", "a3")}, {r("avg(s.net)", "a4")} FROM sales s JOIN items i ON i.item = s.item JOIN people p ON p.cust = s.cust
WHERE s.ch = '{ch}' AND {where} GROUP BY i.iname ORDER BY i.iname LIMIT 100"""


ds("q7", profile("store", "p.gender = 1 AND p.marital = 2 AND s.yr = 1998 AND s.promo NOT LIKE '5%'"))

ds("q8", f"""
WITH z AS (SELECT zip FROM people WHERE seg = 'BUILDING' INTERSECT SELECT zip FROM people WHERE bal > 2000 GROUP BY zip HAVING count(*) > 3)
SELECT o.oname, {r("sum(s.profit)", "profit")} FROM sales s JOIN outlets o ON o.outlet = s.outlet JOIN z ON z.zip = o.zip WHERE s.ch = 'store' AND s.yr = 1998 AND s.qtr = 2 GROUP BY o.oname ORDER BY o.oname LIMIT 100""")

BUCKETS = ((1, 10), (11, 20), (21, 30), (31, 40), (41, 50))
ds("q9", "SELECT " + ", ".join(
    f"round(CASE WHEN sum(CASE WHEN qty BETWEEN {a} AND {b} THEN 1 ELSE 0 END) > 3000 THEN avg(CASE WHEN qty BETWEEN {a} AND {b} THEN disc END) ELSE avg(CASE WHEN qty BETWEEN {a} AND {b} THEN net END) END, 4) AS bucket{i}"
    for i, (a, b) in enumerate(BUCKETS, 1)) + " FROM sales WHERE ch = 'store'")

ACTIVE = """act AS (SELECT cust, max(CASE WHEN ch = 'store' THEN 1 ELSE 0 END) AS st, max(CASE WHEN ch = 'web' THEN 1 ELSE 0 END) AS we, max(CASE WHEN ch = 'catalog' THEN 1 ELSE 0 END) AS ca
FROM sales WHERE yr = 1998 AND mo BETWEEN 1 AND 4 GROUP BY cust)"""

ds("q10", f"""
WITH {ACTIVE} SELECT p.gender, p.marital, p.seg, p.deps, count(*) AS cnt FROM people p JOIN act ON act.cust = p.cust WHERE st = 1 AND (we = 1 OR ca = 1) AND p.country IN ('ASIA', 'EUROPE')
GROUP BY p.gender, p.marital, p.seg, p.deps ORDER BY p.gender, p.marital, p.seg, p.deps LIMIT 100""")

GROWTH = """{yearly} SELECT p.cust, p.name FROM y JOIN people p ON p.cust = y.cust WHERE s97 > 0 AND w97 > 0 AND w98 / w97 > s98 / s97 ORDER BY p.cust, p.name LIMIT 100"""
ds("q11", GROWTH.format(yearly=YEARLY))


def class_share(ch: str, limit: str) -> str:
    return f"""
WITH g AS (SELECT i.iname, i.cat, i.cls, i.list, sum(s.price) AS rev FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = '{ch}' AND i.cat IN ('PROMO', 'SMALL', 'LARGE') AND s.yr = 1998 AND s.mo IN (2, 3)
GROUP BY i.iname, i.cat, i.cls, i.list)
SELECT iname, cat, cls, list, round(rev, 2) AS rev, round(rev * 100 / sum(rev) OVER (PARTITION BY cls), 4) AS ratio FROM g ORDER BY cat, cls, iname, list, ratio{limit}"""


ds("q12", class_share("web", " LIMIT 100"))

BANDS = "((p.marital = 1 AND p.deps = 3 AND s.price BETWEEN 10000 AND 50000) OR (p.marital = 2 AND p.deps = 1 AND s.price BETWEEN 5000 AND 80000) OR (p.marital = 0 AND p.deps = 2 AND s.price > 20000))"
ds("q13", f"""
SELECT {r("avg(s.qty)", "q")}, {r("avg(s.price)", "e")}, {r("avg(s.disc)", "d")}, {r("sum(s.disc)", "total")} FROM sales s JOIN people p ON p.cust = s.cust WHERE s.ch = 'store' AND s.yr = 1998 AND {BANDS}
AND ((p.country = 'ASIA' AND s.profit > 0) OR (p.country = 'EUROPE' AND s.profit > 500) OR p.country = 'AFRICA')""")

CROSS_ITEMS = """kinds AS (SELECT i.brand, i.cls, i.cat FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'store' AND s.yr BETWEEN 1997 AND 1999
INTERSECT SELECT i.brand, i.cls, i.cat FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'catalog' AND s.yr BETWEEN 1997 AND 1999
INTERSECT SELECT i.brand, i.cls, i.cat FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'web' AND s.yr BETWEEN 1997 AND 1999),
mean AS (SELECT avg(qty * price) AS lim FROM sales WHERE yr BETWEEN 1997 AND 1999),
g AS (SELECT s.ch, i.brand, i.cls, i.cat, sum(s.qty * s.price) AS v, count(*) AS n FROM sales s JOIN items i ON i.item = s.item JOIN kinds k ON k.brand = i.brand AND k.cls = i.cls AND k.cat = i.cat
  WHERE s.yr = 1999 AND s.mo = 11 GROUP BY s.ch, i.brand, i.cls, i.cat),
big AS (SELECT ch, brand, cls, cat, v, n FROM g WHERE v > (SELECT lim FROM mean))"""
# Once over the sales: kinds sold in all three channels, the mean of all sales, and the sums that are compared with it.
CROSS_ONCE = """m AS (SELECT s.ch, i.brand, i.cls, i.cat, {sums}, sum(s.qty * s.price) AS whole, count(s.qty * s.price) AS lines
  FROM sales s JOIN items i ON i.item = s.item WHERE s.yr BETWEEN 1997 AND 1999 GROUP BY s.ch, i.brand, i.cls, i.cat),
k AS (SELECT *, count(*) OVER (PARTITION BY brand, cls, cat) AS channels, sum(whole) OVER () / sum(lines) OVER () AS lim FROM m)"""


def month_sums(year: int, month: int, v: str, n: str) -> str:
    test = f"s.yr = {year} AND s.mo = {month}"
    return f"sum(CASE WHEN {test} THEN s.qty * s.price END) AS {v}, count(CASE WHEN {test} THEN 1 END) AS {n}"


CROSS_BIG = CROSS_ONCE.format(sums=month_sums(1999, 11, "v", "n")) + ", big AS (SELECT ch, brand, cls, cat, v, n FROM k WHERE channels = 3 AND v > lim)"
ROLLED = f"""SELECT ch, brand, cls, cat, {r("sum(v)", "v", 2)}, CAST(sum(n) AS BIGINT) AS n FROM big GROUP BY ROLLUP (ch, brand, cls, cat) ORDER BY ch NULLS FIRST, brand NULLS FIRST, cls NULLS FIRST, cat NULLS FIRST LIMIT 100"""
ds("q14a", f"""
WITH {CROSS_ITEMS} SELECT ch, brand, cls, cat, {r("sum(v)", "v", 2)}, CAST(sum(n) AS BIGINT) AS n FROM big GROUP BY ROLLUP (ch, brand, cls, cat) ORDER BY ch NULLS FIRST, brand NULLS FIRST, cls NULLS FIRST, cat NULLS FIRST LIMIT 100""", spark=f"WITH {CROSS_BIG} {ROLLED}")

TWO_WEEKS = CROSS_ITEMS.split("g AS (")[0] + """g AS (SELECT s.yr, i.brand, i.cls, i.cat, sum(s.qty * s.price) AS v, count(*) AS n FROM sales s JOIN items i ON i.item = s.item JOIN kinds k ON k.brand = i.brand AND k.cls = i.cls AND k.cat = i.cat
  WHERE s.ch = 'store' AND s.yr IN (1998, 1999) AND s.mo = 12 GROUP BY s.yr, i.brand, i.cls, i.cat),
big AS (SELECT yr, brand, cls, cat, v, n FROM g WHERE v > (SELECT lim FROM mean)),
wide AS (SELECT brand, cls, cat, sum(CASE WHEN yr = 1999 THEN v END) AS v99, CAST(sum(CASE WHEN yr = 1999 THEN n END) AS BIGINT) AS n99, sum(CASE WHEN yr = 1998 THEN v END) AS v98, CAST(sum(CASE WHEN yr = 1998 THEN n END) AS BIGINT) AS n98 FROM big GROUP BY brand, cls, cat)"""
LAST_YEAR = f"""WITH {TWO_WEEKS} SELECT brand, cls, cat, round(v99, 2) AS v99, n99, round(v98, 2) AS v98, n98 FROM wide WHERE v99 IS NOT NULL AND v98 IS NOT NULL ORDER BY brand, cls, cat LIMIT 100"""
ds("q14b", LAST_YEAR, spark=f"""WITH {CROSS_ONCE.format(sums=month_sums(1999, 12, "v99", "n99") + ", " + month_sums(1998, 12, "v98", "n98"))}
SELECT brand, cls, cat, round(v99, 2) AS v99, n99, round(v98, 2) AS v98, n98 FROM k WHERE ch = 'store' AND channels = 3 AND v99 > lim AND v98 > lim ORDER BY brand, cls, cat LIMIT 100""")

ds("q15", f"""
SELECT p.zip, {r("sum(s.price)", "total", 2)} FROM sales s JOIN people p ON p.cust = s.cust WHERE s.ch = 'catalog' AND s.qtr = 2 AND s.yr = 1998 AND (p.zip < 20 OR p.state IN ('NATION_1', 'NATION_7') OR s.price > 80000)
GROUP BY p.zip ORDER BY p.zip LIMIT 100""")


def multi_source(ch: str, returned: str) -> str:
    """Orders of a channel shipped by more than one outlet, with or without a return."""
    return f"""
WITH o AS (SELECT ord, count(DISTINCT outlet) AS sources, max(CASE WHEN flag = 'R' THEN 1 ELSE 0 END) AS back, sum(CASE WHEN lag <= 60 THEN 1 ELSE 0 END) AS quick, sum(CASE WHEN lag <= 60 THEN price ELSE 0 END) AS cost,
  sum(CASE WHEN lag <= 60 THEN profit ELSE 0 END) AS gain FROM sales WHERE ch = '{ch}' AND yr IN (1998, 1999) GROUP BY ord)
SELECT count(*) AS orders, {r("sum(cost)", "cost", 2)}, {r("sum(gain)", "gain")} FROM o WHERE sources > 1 AND back = {returned} AND quick > 0"""


ds("q16", multi_source("catalog", "0"))

CHAINED = """FROM returns r JOIN sales s ON s.ord = r.ord AND s.cust = r.cust JOIN items i ON i.item = r.item JOIN outlets o ON o.outlet = r.outlet WHERE r.ch = 'store' AND s.ch = 'catalog' AND r.yr IN (1997, 1998)"""
ds("q17", f"""
SELECT i.brand, o.country, count(*) AS n, {r("avg(r.sold)", "sold_mean")}, {r("stddev_samp(r.sold)", "sold_sd")}, {r("avg(r.qty)", "back_mean")}, {r("stddev_samp(s.qty) / avg(s.qty)", "next_cv")} {CHAINED}
GROUP BY i.brand, o.country ORDER BY i.brand, o.country LIMIT 100""")

GEO_AVG = ", ".join(r(f"avg({e})", f"a{i}") for i, e in enumerate(("s.qty", "s.price", "s.disc", "s.net", "s.profit"), 1))
GEO_FROM = "FROM sales s JOIN people p ON p.cust = s.cust JOIN items i ON i.item = s.item WHERE s.ch = 'catalog' AND s.yr = 1998 AND p.gender = 0 AND p.birth_mo IN (1, 6, 8, 9, 12, 2)"
ds("q18", f"""SELECT i.cat, p.country, p.state, {GEO_AVG} {GEO_FROM} GROUP BY ROLLUP (i.cat, p.country, p.state) ORDER BY p.country NULLS FIRST, p.state NULLS FIRST, i.cat NULLS FIRST LIMIT 100""")

ds("q19", f"""
SELECT i.brand, i.manu, {r("sum(s.price)", "price", 2)} FROM sales s JOIN items i ON i.item = s.item JOIN people p ON p.cust = s.cust JOIN outlets o ON o.outlet = s.outlet
WHERE s.ch = 'store' AND i.manu = 7 AND s.mo = 11 AND s.yr = 1999 AND p.zip <> o.zip GROUP BY i.brand, i.manu ORDER BY price DESC, i.brand, i.manu LIMIT 100""")

ds("q20", class_share("catalog", " LIMIT 100"))

ds("q21", """
WITH h AS (SELECT k.wh, i.iname, sum(CASE WHEN k.mo < 6 THEN k.qoh ELSE 0 END) AS before_q, sum(CASE WHEN k.mo >= 6 THEN k.qoh ELSE 0 END) AS after_q FROM stock k JOIN items i ON i.item = k.item
  WHERE k.yr = 1998 AND i.list BETWEEN 905 AND 995 GROUP BY k.wh, i.iname)
SELECT wh, iname, before_q, after_q FROM h WHERE before_q > 0 AND after_q / before_q BETWEEN 0.666 AND 1.5 ORDER BY wh, iname LIMIT 100""")

ds("q22", f"""SELECT i.cat, i.cls, i.brand, {r("avg(k.qoh)", "qoh")} FROM stock k JOIN items i ON i.item = k.item WHERE k.yr = 1998 GROUP BY ROLLUP (i.cat, i.cls, i.brand)
ORDER BY qoh, i.cat NULLS FIRST, i.cls NULLS FIRST, i.brand NULLS FIRST LIMIT 100""")

BEST = """often AS (SELECT item FROM sales WHERE ch = 'store' GROUP BY item HAVING count(*) > 8),
spent AS (SELECT cust, sum(qty * price) AS v FROM sales WHERE ch = 'store' GROUP BY cust), top AS (SELECT max(v) AS m FROM spent), best AS (SELECT cust FROM spent WHERE v > 0.5 * (SELECT m FROM top))"""
BEST_FROM = "FROM sales s JOIN often f ON f.item = s.item JOIN best b ON b.cust = s.cust WHERE s.ch IN ('catalog', 'web') AND s.yr = 1998"
ds("q23a", f"WITH {BEST} SELECT {r('sum(s.qty * s.price)', 'total', 2)} {BEST_FROM}")
ds("q23b", f"WITH {BEST} SELECT p.name, {r('sum(s.qty * s.price)', 'total', 2)} {BEST_FROM.replace('WHERE', 'JOIN people p ON p.cust = s.cust WHERE')} GROUP BY p.name ORDER BY p.name, total LIMIT 100")


def returned_color(color: str) -> str:
    return f"""
WITH g AS (SELECT p.name, o.oname, i.color, sum(s.net) AS paid FROM sales s JOIN items i ON i.item = s.item JOIN outlets o ON o.outlet = s.outlet JOIN people p ON p.cust = s.cust
  WHERE s.ch = 'store' AND s.flag = 'R' AND p.country = o.country GROUP BY p.name, o.oname, i.color), m AS (SELECT 0.05 * avg(paid) AS lim FROM g)
SELECT name, oname, round(paid, 4) AS paid FROM g WHERE color = '{color}' AND paid > (SELECT lim FROM m) ORDER BY name, oname, paid"""


ds("q24a", returned_color("red"))
ds("q24b", returned_color("blue"))

ds("q25", f"""SELECT i.brand, o.oname, {r("sum(s.profit)", "gain")}, {r("sum(r.loss)", "loss")}, {r("max(s.profit)", "best")} {CHAINED} GROUP BY i.brand, o.oname ORDER BY i.brand, o.oname LIMIT 100""")
ds("q26", profile("catalog", "p.gender = 1 AND p.marital = 0 AND s.yr = 1998 AND s.promo NOT LIKE '1%'"))

STATE_AVG = ", ".join(r(f"avg({e})", f"a{i}") for i, e in enumerate(("s.qty", "s.price", "s.disc", "s.net"), 1))
STATE_FROM = "FROM sales s JOIN people p ON p.cust = s.cust JOIN outlets o ON o.outlet = s.outlet JOIN items i ON i.item = s.item WHERE s.ch = 'store' AND p.gender = 1 AND p.marital = 1 AND s.yr = 1998"
ds("q27", f"""SELECT i.cls, o.state, grouping(o.state) AS g_state, {STATE_AVG} {STATE_FROM} GROUP BY ROLLUP (i.cls, o.state) ORDER BY i.cls NULLS FIRST, o.state NULLS FIRST LIMIT 100""")

ds("q28", "SELECT " + ", ".join(
    f"round(avg(CASE WHEN qty BETWEEN {a} AND {b} AND price > {p} THEN price END), 4) AS b{i}_mean, count(CASE WHEN qty BETWEEN {a} AND {b} AND price > {p} THEN price END) AS b{i}_n, count(DISTINCT CASE WHEN qty BETWEEN {a} AND {b} AND price > {p} THEN price END) AS b{i}_d"
    for i, (a, b, p) in enumerate(((0, 5, 1000), (6, 10, 2000), (11, 15, 3000), (16, 20, 4000), (21, 25, 5000), (26, 30, 6000)), 1)) + " FROM sales WHERE ch = 'store'")

ds("q29", f"""SELECT i.brand, o.oname, sum(r.sold) AS sold, sum(r.qty) AS back, sum(s.qty) AS next {CHAINED} GROUP BY i.brand, o.oname ORDER BY i.brand, o.oname LIMIT 100""")


def high_returners(ch: str) -> str:
    return f"""
WITH r AS (SELECT r.cust, p.state, sum(r.amt) AS total FROM returns r JOIN people p ON p.cust = r.cust WHERE r.ch = '{ch}' AND r.yr = 1998 GROUP BY r.cust, p.state), m AS (SELECT state, avg(total) * 1.2 AS lim FROM r GROUP BY state)
SELECT p.cust, p.name, p.city, p.bal, round(r.total, 4) AS total FROM r JOIN m ON m.state = r.state JOIN people p ON p.cust = r.cust WHERE r.total > m.lim ORDER BY p.cust, total LIMIT 100"""


ds("q30", high_returners("web"))

QUARTERS = ", ".join(f"sum(CASE WHEN s.ch = '{c}' AND s.qtr = {q} THEN s.price END) AS {c[0]}{q}" for c in ("store", "web") for q in (1, 2, 3))
ds("q31", f"""
WITH g AS (SELECT p.state, {QUARTERS} FROM sales s JOIN people p ON p.cust = s.cust WHERE s.yr = 1998 GROUP BY p.state)
SELECT state, round(w2 / w1, 4) AS web12, round(s2 / s1, 4) AS store12, round(w3 / w2, 4) AS web23, round(s3 / s2, 4) AS store23 FROM g WHERE w2 / w1 > s2 / s1 OR w3 / w2 > s3 / s2 ORDER BY state""")


def excess_discount(ch: str) -> str:
    return f"""
WITH x AS (SELECT s.item, s.disc FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = '{ch}' AND s.yr = 1998 AND i.manu < 10), m AS (SELECT item, 1.3 * avg(disc) AS lim FROM x GROUP BY item)
SELECT {r("sum(x.disc)", "excess")}, count(*) AS n FROM x JOIN m ON m.item = x.item WHERE x.disc > m.lim"""


ds("q32", excess_discount("catalog"))


def three_channels(key: str, where: str, order: str) -> str:
    """One scan and one group instead of a union of three."""
    return f"""SELECT i.{key}, {r("sum(s.price)", "total", 2)} FROM sales s JOIN items i ON i.item = s.item JOIN people p ON p.cust = s.cust WHERE s.ch IN {ALL3} AND {where} AND s.yr = 1998 AND s.mo = 5 AND p.country = 'ASIA'
GROUP BY i.{key} ORDER BY {order} LIMIT 100"""


ds("q33", three_channels("manu", "i.cat = 'LARGE'", "total, i.manu"))


def tickets(low: int, high: int, where: str) -> str:
    return f"""
WITH d AS (SELECT s.cust, s.ord, count(*) AS cnt FROM sales s JOIN outlets o ON o.outlet = s.outlet JOIN people p ON p.cust = s.cust WHERE s.ch = 'store' AND {where} GROUP BY s.cust, s.ord)
SELECT p.name, p.gender, d.ord, d.cnt FROM d JOIN people p ON p.cust = d.cust WHERE d.cnt BETWEEN {low} AND {high} ORDER BY p.name, p.gender, d.ord DESC, d.cnt"""


ds("q34", tickets(2, 5, "s.yr IN (1997, 1998, 1999) AND p.cars > 0 AND (p.seg = 'BUILDING' OR p.seg = 'MACHINERY')"))

DEMOGRAPHICS = ", ".join(f"min(p.{c}) AS {c}_lo, max(p.{c}) AS {c}_hi, round(avg(p.{c}), 4) AS {c}_mean" for c in ("deps", "cars"))
BY_STATE = f"""
WITH {ACTIVE} SELECT p.state, p.gender, p.marital, count(*) AS cnt, {DEMOGRAPHICS} FROM people p JOIN act ON act.cust = p.cust WHERE st = 1 AND (we = 1 OR ca = 1)
GROUP BY p.state, p.gender, p.marital ORDER BY p.state, p.gender, p.marital LIMIT 100"""
ds("q35", BY_STATE)


def ranked_rollup(measure: str, source: str, keys: tuple[str, str], down: str) -> str:
    a, b = keys
    return f"""
WITH g AS (SELECT {measure} AS v, {a} AS k1, {b} AS k2, grouping({a}) + grouping({b}) AS lochierarchy {source} GROUP BY ROLLUP ({a}, {b}))
SELECT round(v, 6) AS v, k1, k2, lochierarchy, rank() OVER (PARTITION BY lochierarchy, CASE WHEN lochierarchy = 0 THEN k1 END ORDER BY v {down}) AS place FROM g
ORDER BY lochierarchy DESC, k1 NULLS FIRST, place, k2 NULLS FIRST LIMIT 100"""


MARGIN = ranked_rollup("sum(s.profit) / sum(s.price)", "FROM sales s JOIN items i ON i.item = s.item JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = 'store' AND s.yr = 1998 AND o.country IN ('ASIA', 'EUROPE')", ("i.cat", "i.cls"), "ASC")
ds("q36", MARGIN)


def in_stock(ch: str) -> str:
    return f"""
SELECT DISTINCT i.iname, i.cls, i.list FROM items i JOIN stock k ON k.item = i.item JOIN sales s ON s.item = i.item WHERE s.ch = '{ch}' AND i.list BETWEEN 920 AND 950 AND i.manu IN (4, 7, 9, 12) AND k.yr = 1998 AND k.qoh BETWEEN 10 AND 500
ORDER BY i.iname LIMIT 100"""


ds("q37", in_stock("catalog"))


def buyer_days(ch: str) -> str:
    return f"SELECT p.name, s.mo FROM sales s JOIN people p ON p.cust = s.cust WHERE s.ch = '{ch}' AND s.yr = 1998"


ds("q38", f"""SELECT count(*) AS n FROM ({buyer_days("store")} INTERSECT {buyer_days("catalog")} INTERSECT {buyer_days("web")}) x""")


def stock_cv(limit: str) -> str:
    return f"""
WITH c AS (SELECT wh, cls, mo, stddev_samp(qoh) AS sd, avg(qoh) AS m FROM stock k JOIN items i ON i.item = k.item WHERE yr = 1998 AND mo IN (1, 2) GROUP BY wh, cls, mo),
v AS (SELECT wh, cls, mo, m, sd / m AS cv FROM c WHERE m > 0 AND sd / m > 0.3)
SELECT wh, cls, round(max(CASE WHEN mo = 1 THEN m END), 4) AS m1, round(max(CASE WHEN mo = 1 THEN cv END), 4) AS cv1, round(max(CASE WHEN mo = 2 THEN m END), 4) AS m2, round(max(CASE WHEN mo = 2 THEN cv END), 4) AS cv2
FROM v GROUP BY wh, cls HAVING count(*) = 2{limit} ORDER BY wh, cls"""


ds("q39a", stock_cv(""))
ds("q39b", stock_cv(" AND max(CASE WHEN mo = 1 THEN cv END) > 0.5"))

ds("q40", f"""
SELECT o.state, i.iname, {r("sum(CASE WHEN s.mo < 6 THEN s.price - coalesce(r.amt, 0) ELSE 0 END)", "before_v")}, {r("sum(CASE WHEN s.mo >= 6 THEN s.price - coalesce(r.amt, 0) ELSE 0 END)", "after_v")}
FROM sales s LEFT JOIN (SELECT ord, item, outlet, max(amt) AS amt FROM returns WHERE ch = 'catalog' GROUP BY ord, item, outlet) r ON r.ord = s.ord AND r.item = s.item AND r.outlet = s.outlet
JOIN items i ON i.item = s.item JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = 'catalog' AND s.yr = 1998 AND i.list BETWEEN 910 AND 990 GROUP BY o.state, i.iname ORDER BY o.state, i.iname LIMIT 100""")

ds("q41", """
WITH m AS (SELECT manu FROM items WHERE (cat = 'PROMO' AND color IN ('red', 'blue') AND size < 20) OR (cat = 'SMALL' AND color IN ('hot', 'cold') AND size > 30) OR (cat = 'LARGE' AND color = 'new') GROUP BY manu HAVING count(*) > 2)
SELECT DISTINCT i.brand FROM items i JOIN m ON m.manu = i.manu WHERE i.list BETWEEN 930 AND 960 ORDER BY i.brand LIMIT 100""")

ds("q42", f"""SELECT s.yr, i.cat, {r("sum(s.price)", "total", 2)} FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'store' AND i.manu = 1 AND s.mo = 11 AND s.yr = 1998 GROUP BY s.yr, i.cat ORDER BY total DESC, s.yr, i.cat LIMIT 100""")

ds("q43", f"""SELECT o.oname, {", ".join(f"round(sum(CASE WHEN s.dow = {i} THEN s.price END), 2) AS {d}" for i, d in enumerate(DAYS))} FROM sales s JOIN outlets o ON o.outlet = s.outlet
WHERE s.ch = 'store' AND s.yr = 1998 AND o.country IN ('ASIA', 'AMERICA') GROUP BY o.oname ORDER BY o.oname LIMIT 100""")

ds("q44", """
WITH g AS (SELECT item, avg(profit) AS v FROM sales WHERE ch = 'store' GROUP BY item HAVING count(*) > 3), hi AS (SELECT item, v FROM g ORDER BY v DESC, item LIMIT 10), lo AS (SELECT item, v FROM g ORDER BY v, item LIMIT 10),
best AS (SELECT item, row_number() OVER (ORDER BY v DESC, item) AS rk FROM hi), worst AS (SELECT item, row_number() OVER (ORDER BY v, item) AS rk FROM lo)
SELECT b.rk, x.iname AS best, y.iname AS worst FROM best b JOIN worst w ON w.rk = b.rk JOIN items x ON x.item = b.item JOIN items y ON y.item = w.item ORDER BY b.rk""")

ds("q45", f"""
SELECT p.zip, p.city, {r("sum(s.price)", "total", 2)} FROM sales s JOIN people p ON p.cust = s.cust LEFT JOIN (SELECT DISTINCT item AS pick FROM items WHERE size IN (2, 3, 5, 7, 11, 13)) k ON k.pick = s.item
WHERE s.ch = 'web' AND s.qtr = 2 AND s.yr = 1998 AND (p.zip < 10 OR k.pick IS NOT NULL) GROUP BY p.zip, p.city ORDER BY p.zip, p.city LIMIT 100""")


def trips(where: str) -> str:
    return f"""
WITH d AS (SELECT s.ord, s.cust, o.city AS bought, sum(s.disc) AS amt, sum(s.profit) AS gain FROM sales s JOIN outlets o ON o.outlet = s.outlet JOIN people p ON p.cust = s.cust WHERE s.ch = 'store' AND {where} GROUP BY s.ord, s.cust, o.city)
SELECT p.name, p.city, d.bought, d.ord, round(d.amt, 4) AS amt, round(d.gain, 4) AS gain FROM d JOIN people p ON p.cust = d.cust WHERE p.city <> d.bought ORDER BY p.name, p.city, d.bought, d.ord LIMIT 100"""


ds("q46", trips("s.dow IN (6, 0) AND s.yr IN (1997, 1998, 1999) AND (p.deps = 4 OR p.cars = 3)"))


def months_around(ch: str, keys: str) -> str:
    return f"""
WITH g AS (SELECT i.cat, i.brand, {keys}, s.yr, s.mo, sum(s.price) AS v FROM sales s JOIN items i ON i.item = s.item JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = '{ch}' AND (s.yr = 1998 OR (s.yr = 1997 AND s.mo = 12) OR (s.yr = 1999 AND s.mo = 1))
  GROUP BY i.cat, i.brand, {keys}, s.yr, s.mo),
w AS (SELECT cat, brand, {keys.split(".")[1]} AS place, yr, mo, v, round(sum(v) OVER (PARTITION BY cat, brand, {keys.split(".")[1]}, yr), 4) / count(*) OVER (PARTITION BY cat, brand, {keys.split(".")[1]}, yr) AS m, lag(v) OVER (PARTITION BY cat, brand, {keys.split(".")[1]} ORDER BY yr, mo) AS before_v,
  lead(v) OVER (PARTITION BY cat, brand, {keys.split(".")[1]} ORDER BY yr, mo) AS after_v FROM g)
SELECT cat, brand, place, yr, mo, round(v, 2) AS v, m, round(before_v, 2) AS before_v, round(after_v, 2) AS after_v FROM w
WHERE yr = 1998 AND m > 0 AND abs(v - m) / m > 0.1 AND before_v IS NOT NULL AND after_v IS NOT NULL ORDER BY v - m, cat, brand, place, mo LIMIT 100"""


ds("q47", months_around("store", "o.country"))

ds("q48", f"""SELECT sum(s.qty) AS qty FROM sales s JOIN people p ON p.cust = s.cust WHERE s.ch = 'store' AND s.yr = 1998 AND {BANDS}
AND ((p.country = 'ASIA' AND s.profit BETWEEN 0 AND 2000) OR (p.country = 'EUROPE' AND s.profit BETWEEN 150 AND 3000) OR (p.country = 'AFRICA' AND s.profit > 50))""")

RATIOS = """
WITH g AS (SELECT ch, item, sum(CASE WHEN flag = 'R' THEN floor(qty / 2) ELSE 0 END) / sum(qty) AS back, sum(CASE WHEN flag = 'R' THEN price * 0.5 ELSE 0 END) / sum(price) AS money FROM sales
  WHERE yr = 1998 AND profit > 1 GROUP BY ch, item HAVING sum(CASE WHEN flag = 'R' THEN 1 ELSE 0 END) > 0),
k AS (SELECT ch, item, back, money, rank() OVER (PARTITION BY ch ORDER BY back, item) AS r1, rank() OVER (PARTITION BY ch ORDER BY money, item) AS r2 FROM g)
SELECT ch, item, round(back, 6) AS back, r1, r2 FROM k WHERE r1 <= 10 OR r2 <= 10 ORDER BY ch, r1, r2, item LIMIT 100"""
# The ten first by each ratio, which Spark trims before it shuffles, and then the places of these few by the other one.
RATIO_PLACES = RATIOS.split("k AS (")[0] + """t AS (SELECT ch, item, back, money FROM (SELECT *, row_number() OVER (PARTITION BY ch ORDER BY back, item) AS p FROM g) WHERE p <= 10
  UNION SELECT ch, item, back, money FROM (SELECT *, row_number() OVER (PARTITION BY ch ORDER BY money, item) AS p FROM g) WHERE p <= 10)
SELECT /*+ BROADCAST(t) */ t.ch, t.item, round(t.back, 6) AS back, CAST(1 + count_if(g.back < t.back OR g.back = t.back AND g.item < t.item) AS INT) AS r1,
  CAST(1 + count_if(g.money < t.money OR g.money = t.money AND g.item < t.item) AS INT) AS r2
FROM t JOIN g ON g.ch = t.ch GROUP BY t.ch, t.item, t.back ORDER BY t.ch, r1, r2, t.item LIMIT 100"""  # t has twenty rows a channel
ds("q49", RATIOS, spark=RATIO_PLACES)

LAGS = ((None, 30), (30, 60), (60, 90), (90, 120), (120, None))


def lag_counts(lag: str) -> str:
    def test(a, b):
        return " AND ".join(x for x in (f"{lag} > {a}" if a else "", f"{lag} <= {b}" if b else "") if x)

    return ", ".join(f"count(CASE WHEN {test(a, b)} THEN 1 END) AS upto_{b or 'more'}" for a, b in LAGS)


ds("q50", f"""SELECT o.oname, o.state, {lag_counts("s.lag + 20")} FROM sales s JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = 'store' AND s.flag = 'R' AND s.yr = 1998 AND s.mo = 8 GROUP BY o.oname, o.state ORDER BY o.oname, o.state LIMIT 100""")
