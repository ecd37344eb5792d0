"""Decision-support queries over the three-channel retail views: q51 to q99, and the later and modified variants."""

from millrace.plans import ds_queries as d1
from millrace.plans.ds_queries import ACTIVE, ALL3, DAYS, DEMOGRAPHICS, DAY_SUMS, r
from millrace.plans.ds_views import ds


def running(place: str) -> str:
    """Cumulative daily sales of an item on the web and in stores; where the web leads."""
    return f"""
WITH g AS (SELECT item, day, sum(CASE WHEN ch = 'web' THEN price END) AS w, sum(CASE WHEN ch = 'store' THEN price END) AS s FROM sales WHERE yr = 1998 AND ch IN ('web', 'store') GROUP BY item, day),
c AS (SELECT item, day, sum(w) OVER (PARTITION BY item ORDER BY day) AS web, sum(s) OVER (PARTITION BY item ORDER BY day) AS store FROM g)
SELECT item, day, round(web, 2) AS web, round(store, 2) AS store{place} FROM c WHERE web > store ORDER BY item, day LIMIT 100"""


ds("q51", running(""))


def by_brand(where: str, keys: str = "i.brand") -> str:
    return f"""SELECT s.yr, {keys}, {r("sum(s.price)", "total", 2)} FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'store' AND {where} GROUP BY s.yr, {keys} ORDER BY s.yr, total DESC, {keys} LIMIT 100"""


ds("q52", by_brand("i.manu = 1 AND s.mo = 11 AND s.yr = 1999"))


def deviation(key: str, period: str, where: str) -> str:
    """Periods in which a group's sales lie more than a tenth off its yearly mean."""
    return f"""
WITH g AS (SELECT i.{key} AS k, s.{period} AS period, sum(s.price) AS v FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'store' AND s.yr = 1998 AND {where} GROUP BY i.{key}, s.{period}),
m AS (SELECT k, period, v, round(sum(v) OVER (PARTITION BY k), 4) / count(*) OVER (PARTITION BY k) AS m FROM g)
SELECT k, period, round(v, 2) AS v, m FROM m WHERE m > 0 AND abs(v - m) / m > 0.1 ORDER BY m, v, k, period LIMIT 100"""


PICKS = "((i.cat IN ('LARGE', 'PROMO') AND i.cls IN ('ring', 'gear')) OR (i.cat IN ('SMALL', 'ECONOMY') AND i.cls IN ('bolt', 'rod', 'plate')))"
ds("q53", deviation("manu", "qtr", PICKS))

ds("q54", """
WITH c AS (SELECT DISTINCT s.cust FROM sales s JOIN items i ON i.item = s.item WHERE s.ch IN ('catalog', 'web') AND i.cat = 'PROMO' AND s.yr = 1998 AND s.mo = 12),
g AS (SELECT c.cust, sum(s.price) AS v FROM c JOIN sales s ON s.cust = c.cust WHERE s.ch = 'store' AND s.yr = 1999 AND s.mo BETWEEN 1 AND 3 GROUP BY c.cust)
SELECT CAST(floor(v / 50000) AS BIGINT) AS segment, count(*) AS n, CAST(floor(v / 50000) * 50000 AS BIGINT) AS base FROM g GROUP BY floor(v / 50000) ORDER BY segment, n LIMIT 100""")

ds("q55", by_brand("i.manu = 8 AND s.mo = 11 AND s.yr = 1997"))
ds("q56", d1.three_channels("iname", "i.color IN ('red', 'old', 'new')", "total, i.iname"))
ds("q57", d1.months_around("catalog", "o.state"))

ds("q58", f"""
WITH g AS (SELECT i.brand, {d1.per_channel("s.price")} FROM sales s JOIN items i ON i.item = s.item WHERE s.yr = 1998 AND s.wk BETWEEN 1470 AND 1480 GROUP BY i.brand)
SELECT brand, round(store_v, 2) AS store_v, round(catalog_v, 2) AS catalog_v, round(web_v, 2) AS web_v, {r("(store_v + catalog_v + web_v) / 3", "mean_v")} FROM g
WHERE store_v BETWEEN 0.5 * catalog_v AND 1.5 * catalog_v AND store_v BETWEEN 0.5 * web_v AND 1.5 * web_v AND catalog_v BETWEEN 0.5 * web_v AND 1.5 * web_v ORDER BY brand LIMIT 100""")


def weekly_stores(limit: str) -> str:
    return f"""
WITH w AS (SELECT wk, outlet, min(yr) AS yr, {DAY_SUMS} FROM sales WHERE ch = 'store' GROUP BY wk, outlet)
SELECT o.oname, a.wk, {", ".join(r(f"a.{d} / b.{d}", d) for d in DAYS)} FROM w a JOIN w b ON b.outlet = a.outlet AND b.wk = a.wk + 52 JOIN outlets o ON o.outlet = a.outlet WHERE a.yr = 1997 ORDER BY o.oname, a.wk{limit}"""


ds("q59", weekly_stores(" LIMIT 100"))
ds("q60", d1.three_channels("iname", "i.cat = 'MEDIUM'", "i.iname, total"))

ds("q61", f"""
SELECT {r("sum(CASE WHEN s.promo IN ('1-URGENT', '2-HIGH') THEN s.price END)", "promotions", 2)}, {r("sum(s.price)", "total", 2)}, {r("sum(CASE WHEN s.promo IN ('1-URGENT', '2-HIGH') THEN s.price END) / sum(s.price) * 100", "share")}
FROM sales s JOIN items i ON i.item = s.item JOIN people p ON p.cust = s.cust JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = 'store' AND i.cat = 'PROMO' AND p.country = 'ASIA' AND o.country = 'EUROPE' AND s.yr = 1998""")


def ship_lags(ch: str) -> str:
    return f"""SELECT o.wh, o.state, s.promo, {d1.lag_counts("s.lag")} FROM sales s JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = '{ch}' AND s.yr = 1998 GROUP BY o.wh, o.state, s.promo ORDER BY o.wh, o.state, s.promo LIMIT 100"""


ds("q62", ship_lags("web"))
ds("q63", deviation("size", "mo", PICKS))


def cross_years(extra: str) -> str:
    return f"""
WITH back AS (SELECT item, sum(amt) AS refund, count(*) AS n FROM returns WHERE ch = 'catalog' GROUP BY item), sold AS (SELECT item, sum(price) AS v FROM sales WHERE ch = 'catalog' GROUP BY item),
ok AS (SELECT sold.item FROM sold JOIN back ON back.item = sold.item WHERE v > 2 * refund),
g AS (SELECT i.iname, o.oname, o.zip, s.yr, count(*) AS cnt, sum(s.cost_v) AS s1, sum(s.price) AS s2, sum(s.disc) AS s3 FROM (SELECT item, outlet, cust, yr, price, disc, price * 0.5 AS cost_v FROM sales WHERE ch = 'store' AND flag = 'R') s
  JOIN ok ON ok.item = s.item JOIN items i ON i.item = s.item JOIN outlets o ON o.outlet = s.outlet JOIN people p ON p.cust = s.cust WHERE p.marital <> 1 GROUP BY i.iname, o.oname, o.zip, s.yr),
w AS (SELECT iname, oname, zip, CAST(sum(CASE WHEN yr = 1998 THEN cnt END) AS BIGINT) AS cnt98, CAST(sum(CASE WHEN yr = 1999 THEN cnt END) AS BIGINT) AS cnt99, sum(CASE WHEN yr = 1998 THEN s1 END) AS a98, sum(CASE WHEN yr = 1999 THEN s1 END) AS a99 FROM g GROUP BY iname, oname, zip)
SELECT iname, oname, zip, cnt98, cnt99, round(a98, 3) AS a98, round(a99, 3) AS a99 FROM w WHERE cnt99 <= cnt98{extra} ORDER BY iname, oname, zip"""


ds("q64", cross_years(""))

LOW_REVENUE = """
WITH g AS (SELECT outlet, item, sum(price) AS rev FROM sales WHERE ch = 'store' AND yr = 1998 GROUP BY outlet, item), m AS (SELECT outlet, avg(rev) AS mean FROM g GROUP BY outlet)
SELECT o.oname, i.iname, round(g.rev, 2) AS rev, i.list, i.brand FROM g JOIN m ON m.outlet = g.outlet JOIN outlets o ON o.outlet = g.outlet JOIN items i ON i.item = g.item WHERE g.rev <= 0.1 * m.mean ORDER BY o.oname, i.iname, rev LIMIT 100"""
ds("q65", LOW_REVENUE)

KEYS67 = ("i.cat", "i.cls", "i.brand", "s.yr", "s.qtr", "o.oname")


def rank_by_category(grouping: str) -> str:
    return f"""
WITH g AS ({grouping}), k AS (SELECT cat, cls, brand, yr, qtr, oname, v, rank() OVER (PARTITION BY cat ORDER BY round(v, 2) DESC) AS rk FROM g)
SELECT cat, cls, brand, yr, qtr, oname, round(v, 2) AS v, rk FROM k WHERE rk <= 100
ORDER BY cat NULLS FIRST, rk, cls NULLS FIRST, brand NULLS FIRST, yr NULLS FIRST, qtr NULLS FIRST, oname NULLS FIRST LIMIT 100"""


FROM67 = "FROM sales s JOIN items i ON i.item = s.item JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = 'store' AND s.yr = 1998"
ds("q67", rank_by_category(f"SELECT {', '.join(KEYS67)}, sum(s.price * s.qty) AS v {FROM67} GROUP BY ROLLUP ({', '.join(KEYS67)})"))

ds("q68", d1.trips("s.mo IN (1, 2) AND s.yr IN (1997, 1998, 1999) AND (p.deps = 4 OR p.cars = 3) AND o.country IN ('ASIA', 'EUROPE')"))

ds("q69", f"""
WITH {ACTIVE} SELECT p.gender, p.marital, p.seg, count(*) AS cnt FROM people p JOIN act ON act.cust = p.cust WHERE p.state IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4') AND st = 1 AND we = 0 AND ca = 0
GROUP BY p.gender, p.marital, p.seg ORDER BY p.gender, p.marital, p.seg LIMIT 100""")

TOP_STATES = """(SELECT state AS top_state FROM (SELECT o.state, rank() OVER (PARTITION BY o.country ORDER BY sum(s.profit) DESC) AS rk FROM sales s JOIN outlets o ON o.outlet = s.outlet
  WHERE s.ch = 'store' AND s.yr = 1998 GROUP BY o.state, o.country) x WHERE rk <= 3)"""
PROFIT70 = d1.ranked_rollup("sum(s.profit)", f"FROM sales s JOIN outlets o ON o.outlet = s.outlet JOIN {TOP_STATES} t ON t.top_state = o.state WHERE s.ch = 'store' AND s.yr = 1998", ("o.country", "o.state"), "DESC")
ds("q70", PROFIT70)

ds("q71", f"""
SELECT i.brand, s.hour, {r("sum(s.price)", "total", 2)} FROM sales s JOIN items i ON i.item = s.item WHERE s.ch IN {ALL3} AND s.yr = 1998 AND s.mo = 11 AND i.manu = 1 AND s.hour IN (7, 8, 9, 18, 19, 20)
GROUP BY i.brand, s.hour ORDER BY total DESC, i.brand, s.hour""")


def shortage(extra: str) -> str:
    return f"""
SELECT i.iname, k.wh, s.wk, count(CASE WHEN s.promo <> '1-URGENT' THEN 1 END) AS no_promo, count(CASE WHEN s.promo = '1-URGENT' THEN 1 END) AS promo, count(*) AS total
FROM sales s JOIN items i ON i.item = s.item JOIN people p ON p.cust = s.cust JOIN stock k ON k.item = s.item AND k.yr = s.yr AND k.mo = s.mo
LEFT JOIN (SELECT ord, item, count(*) AS n FROM returns WHERE ch = 'catalog' GROUP BY ord, item) b ON b.ord = s.ord AND b.item = s.item
WHERE s.ch = 'catalog' AND k.qoh < s.qty + 30 AND s.lag > 5 AND s.yr = 1998 AND p.marital = 1{extra} GROUP BY i.iname, k.wh, s.wk ORDER BY total DESC, i.iname, k.wh, s.wk LIMIT 100"""


ds("q72", shortage(""))
ds("q73", d1.tickets(1, 5, "s.dow BETWEEN 1 AND 2 AND s.yr IN (1997, 1998, 1999) AND p.seg = 'BUILDING' AND p.cars > 0"))

SPEND = """
WITH y AS (SELECT cust, {sums} FROM sales WHERE yr IN (1997, 1998) AND ch IN ('store', 'web') GROUP BY cust)
SELECT p.cust, p.name FROM y JOIN people p ON p.cust = y.cust WHERE s97 > 0 AND w97 > 0 AND w98 / w97 > s98 / s97 ORDER BY p.name, p.cust LIMIT 100"""
LARGEST = ", ".join(f"max(CASE WHEN ch = '{c}' AND yr = {y} THEN net ELSE 0 END) AS {c[0]}{y % 100}" for c in ("store", "web") for y in (1997, 1998))
ds("q74", SPEND.format(sums=LARGEST))

DECLINE = """
WITH g AS (SELECT i.brand, i.cls, i.cat, sum(CASE WHEN s.yr = 1998 THEN s.qty - CASE WHEN s.flag = 'R' THEN floor(s.qty / 2) ELSE 0 END END) AS q98, sum(CASE WHEN s.yr = 1997 THEN s.qty - CASE WHEN s.flag = 'R' THEN floor(s.qty / 2) ELSE 0 END END) AS q97,
  sum(CASE WHEN s.yr = 1998 THEN s.price - CASE WHEN s.flag = 'R' THEN s.price * 0.5 ELSE 0 END END) AS v98, sum(CASE WHEN s.yr = 1997 THEN s.price - CASE WHEN s.flag = 'R' THEN s.price * 0.5 ELSE 0 END END) AS v97
  FROM sales s JOIN items i ON i.item = s.item WHERE s.yr IN (1997, 1998) AND i.cat = 'PROMO' GROUP BY i.brand, i.cls, i.cat)
SELECT brand, cls, cat, q97, q98, q98 - q97 AS diff, round(v98 - v97, 3) AS money FROM g WHERE q98 / q97 < 0.9 ORDER BY diff, money, brand, cls LIMIT 100"""
ds("q75", DECLINE)

ds("q76", f"""
SELECT s.ch, s.yr, s.qtr, i.cat, count(*) AS n, {r("sum(s.price)", "total", 2)} FROM (SELECT ch, yr, qtr, item, price, nullif(CASE ch WHEN 'store' THEN outlet % 7 WHEN 'web' THEN cust % 7 ELSE ord % 7 END, 0) AS gap FROM sales) s
JOIN items i ON i.item = s.item WHERE s.gap IS NULL GROUP BY s.ch, s.yr, s.qtr, i.cat ORDER BY s.ch, s.yr, s.qtr, i.cat LIMIT 100""")


def channel_profit(grouping: str) -> str:
    return f"""
WITH a AS (SELECT ch, outlet, sum(price) AS sold, sum(profit) AS gain FROM sales WHERE yr = 1998 AND mo = 8 GROUP BY ch, outlet), b AS (SELECT ch, outlet, sum(amt) AS back, sum(loss) AS lost FROM returns WHERE yr = 1998 AND mo = 8 GROUP BY ch, outlet),
j AS (SELECT a.ch, a.outlet, sold, coalesce(back, 0) AS back, gain - coalesce(lost, 0) AS gain FROM a LEFT JOIN b ON b.ch = a.ch AND b.outlet = a.outlet) {grouping}"""


SUM77 = f"{r('sum(sold)', 'sales', 2)}, {r('sum(back)', 'returned')}, {r('sum(gain)', 'profit')}"
END77 = "ORDER BY ch NULLS FIRST, outlet NULLS FIRST LIMIT 100"
ds("q77", channel_profit(f"SELECT ch, outlet, {SUM77} FROM j GROUP BY ROLLUP (ch, outlet) {END77}"))

LOYAL = f"""
WITH g AS (SELECT yr, cust, item, {d1.per_channel("qty")} FROM sales WHERE flag <> 'R' AND yr = 1998 GROUP BY yr, cust, item)
SELECT g.yr, g.cust, count(*) AS items, sum(store_v) AS store_q, sum(web_v + catalog_v) AS other_q, round(sum(store_v) / sum(web_v + catalog_v), 4) AS ratio FROM g GROUP BY g.yr, g.cust HAVING sum(web_v) > 0 AND sum(catalog_v) > 0 AND sum(store_v) > 0
ORDER BY ratio DESC, g.cust LIMIT 100"""
ds("q78", LOYAL)

MONDAYS = "s.dow = 1 AND s.yr IN (1997, 1998, 1999) AND (p.deps = 4 OR p.cars > 2) AND o.staff BETWEEN 0 AND 295"
TRIPS79 = f"""
WITH d AS (SELECT s.ord, s.cust, o.city, sum(s.disc) AS amt, sum(s.profit) AS gain FROM sales s JOIN outlets o ON o.outlet = s.outlet JOIN people p ON p.cust = s.cust WHERE s.ch = 'store' AND {MONDAYS} GROUP BY s.ord, s.cust, o.city)
SELECT p.name, d.city, d.ord, round(d.gain, 4) AS gain, round(d.amt, 4) AS amt FROM d JOIN people p ON p.cust = d.cust ORDER BY p.name, d.city, d.ord, gain LIMIT 100"""
ds("q79", TRIPS79)

MOVES80 = """
WITH b AS (SELECT ch, ord, item, outlet, max(amt) AS amt, max(loss) AS loss FROM returns GROUP BY ch, ord, item, outlet),
j AS (SELECT s.ch, s.outlet, s.price AS sold, coalesce(b.amt, 0) AS back, s.profit - coalesce(b.loss, 0) AS gain FROM sales s LEFT JOIN b ON b.ch = s.ch AND b.ord = s.ord AND b.item = s.item AND b.outlet = s.outlet JOIN items i ON i.item = s.item
  WHERE s.yr = 1998 AND s.mo = 8 AND i.size > 25 AND s.promo <> '5-LOW')"""
ds("q80", f"{MOVES80} SELECT ch, outlet, {SUM77} FROM j GROUP BY ROLLUP (ch, outlet) {END77}")

ds("q81", d1.high_returners("catalog"))
ds("q82", d1.in_stock("store"))

ds("q83", f"""
WITH g AS (SELECT i.brand, {d1.per_channel("r.qty")} FROM returns r JOIN items i ON i.item = r.item WHERE r.yr = 1998 AND r.wk IN (SELECT DISTINCT wk FROM sales WHERE yr = 1998 AND mo IN (3, 6, 9)) GROUP BY i.brand)
SELECT brand, store_v, catalog_v, web_v, {r("store_v / (store_v + catalog_v + web_v) / 3 * 100", "store_dev")}, round((store_v + catalog_v + web_v) / 3, 4) AS mean_v FROM g WHERE store_v > 0 AND catalog_v > 0 AND web_v > 0 ORDER BY brand LIMIT 100""")

ds("q84", """
SELECT p.cust, p.name FROM people p JOIN (SELECT cust, count(*) AS n FROM returns WHERE ch = 'store' GROUP BY cust) b ON b.cust = p.cust WHERE p.country = 'ASIA' AND p.bal BETWEEN 2000 AND 7000 ORDER BY p.cust LIMIT 100""")

ds("q85", f"""
SELECT r.reason, p.seg, {r("avg(r.qty)", "q")}, {r("avg(r.amt)", "refund")}, {r("avg(r.loss)", "fee")} FROM returns r JOIN people p ON p.cust = r.cust WHERE r.ch = 'web' AND r.yr = 1998
AND ((p.marital = 1 AND r.amt BETWEEN 1000 AND 15000) OR (p.marital = 2 AND r.amt BETWEEN 500 AND 10000) OR (p.marital = 0 AND r.amt > 5000)) GROUP BY r.reason, p.seg ORDER BY r.reason, p.seg LIMIT 100""")

WEB86 = d1.ranked_rollup("sum(s.net)", "FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'web' AND s.yr = 1998", ("i.cat", "i.cls"), "DESC")
ds("q86", WEB86)

ds("q87", f"""SELECT count(*) AS n FROM ({d1.buyer_days("store")} EXCEPT {d1.buyer_days("catalog")} EXCEPT {d1.buyer_days("web")}) x""")

HOURS = ", ".join(f"count(CASE WHEN s.hour = {h} THEN 1 END) AS h{h}" for h in range(8, 13))
ds("q88", f"""SELECT {HOURS} FROM sales s JOIN people p ON p.cust = s.cust JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = 'store' AND o.country = 'ASIA' AND ((p.deps = 4 AND p.cars <= 6) OR (p.deps = 2 AND p.cars <= 4) OR (p.deps = 0 AND p.cars <= 2))""")

CLASSES = f"""
WITH g AS (SELECT i.cat, i.cls, i.brand, o.country, s.mo, sum(s.price) AS v FROM sales s JOIN items i ON i.item = s.item JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = 'store' AND s.yr = 1998 AND {PICKS} GROUP BY i.cat, i.cls, i.brand, o.country, s.mo),
m AS (SELECT cat, cls, brand, country, mo, v, round(sum(v) OVER (PARTITION BY cat, brand, country), 4) / count(*) OVER (PARTITION BY cat, brand, country) AS m FROM g)
SELECT cat, cls, brand, country, mo, round(v, 2) AS v, m FROM m WHERE m <> 0 AND abs(v - m) / m > 0.1 ORDER BY v - m, cat, cls, brand, country, mo LIMIT 100"""
ds("q89", CLASSES)

ds("q90", f"""SELECT {r("sum(CASE WHEN s.hour IN (8, 9) THEN 1 ELSE 0 END) / sum(CASE WHEN s.hour IN (19, 20) THEN 1 ELSE 0 END)", "am_pm_ratio")} FROM sales s JOIN people p ON p.cust = s.cust WHERE s.ch = 'web' AND p.deps = 4""")

ds("q91", f"""
SELECT o.oname, o.state, {r("sum(r.loss)", "loss", 3)} FROM returns r JOIN outlets o ON o.outlet = r.outlet JOIN people p ON p.cust = r.cust WHERE r.ch = 'catalog' AND r.yr = 1998 AND r.mo = 11 AND ((p.marital = 1 AND p.seg = 'BUILDING') OR (p.marital = 0 AND p.seg LIKE 'MACH%'))
GROUP BY o.oname, o.state ORDER BY loss DESC, o.oname""")

ds("q92", d1.excess_discount("web"))

ds("q93", f"""SELECT cust, round(sum(CASE WHEN flag = 'R' AND reason = 'F' THEN (qty - floor(qty / 2)) * price / qty ELSE price END), 4) AS spent FROM sales WHERE ch = 'store' GROUP BY cust ORDER BY spent, cust LIMIT 100""")

ds("q94", d1.multi_source("web", "0"))
ds("q95", d1.multi_source("web", "1"))

ds("q96", """SELECT count(*) AS n FROM sales s JOIN people p ON p.cust = s.cust JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = 'store' AND s.hour = 20 AND p.deps = 3 AND o.country = 'ASIA'""")

ds("q97", """
WITH a AS (SELECT cust, item FROM sales WHERE ch = 'store' GROUP BY cust, item), b AS (SELECT cust, item FROM sales WHERE ch = 'catalog' GROUP BY cust, item)
SELECT count(CASE WHEN a.cust IS NOT NULL AND b.cust IS NULL THEN 1 END) AS store_only, count(CASE WHEN a.cust IS NULL AND b.cust IS NOT NULL THEN 1 END) AS catalog_only,
 count(CASE WHEN a.cust IS NOT NULL AND b.cust IS NOT NULL THEN 1 END) AS both_ways FROM a FULL JOIN b ON a.cust = b.cust AND a.item = b.item""")

ds("q98", d1.class_share("store", ""))
ds("q99", ship_lags("catalog"))


# Later variants: grouping by rollup becomes a union of one query per level.

def rolled(select: str, source: str, keys: list[str], measures: str, order: str) -> str:
    """The same by ROLLUP, for which Spark reads the finest groups once."""
    names = ", ".join(k.split(":")[0] for k in keys)
    return f"{source} {select} FROM (SELECT {names}, {measures} FROM base GROUP BY ROLLUP ({names})) u ORDER BY {order} LIMIT 100"


def rollup(name: str, *how) -> None:
    ds(name, levels(*how), spark=rolled(*how).replace(d1.CROSS_ITEMS, d1.CROSS_BIG))


def levels(select: str, source: str, keys: list[str], measures: str, order: str) -> str:
    """A rollup over ``keys`` from the finest groups: each level sums the finest one, so the base is scanned once."""
    parts = []
    for n in range(len(keys), -1, -1):
        names = ", ".join(f"{k}" if i < n else f"CAST(NULL AS {kind}) AS {k}" for i, (k, kind) in enumerate(k.split(":") for k in keys))
        group = f" GROUP BY {', '.join(k.split(':')[0] for k in keys[:n])}" if n else ""
        parts.append(f"SELECT {names}, {measures} FROM base{group}")
    return f"{source} {select} FROM ({' UNION ALL '.join(parts)}) u ORDER BY {order} LIMIT 100"


rollup("v27_q5a", f"SELECT ch, outlet, {r('sold', 'sales', 2)}, {r('back', 'returned')}, {r('gain', 'profit')}", f"WITH {d1.CHANNEL_MOVES}, base AS (SELECT ch, outlet, sum(sold) AS sold, sum(back) AS back, sum(gain) - sum(lost) AS gain FROM moves GROUP BY ch, outlet)",
                     ["ch:VARCHAR(10)", "outlet:BIGINT"], "sum(sold) AS sold, sum(back) AS back, sum(gain) AS gain", "ch NULLS FIRST, outlet NULLS FIRST")

ds("v27_q6", """
WITH m AS (SELECT cat, avg(list) * 1.005 AS lim FROM items GROUP BY cat)
SELECT p.state, count(*) AS cnt FROM sales s JOIN items i ON i.item = s.item JOIN m ON m.cat = i.cat JOIN people p ON p.cust = s.cust
WHERE s.ch = 'store' AND s.yr = 1999 AND s.mo = 4 AND i.list > m.lim GROUP BY p.state HAVING count(*) >= 5 ORDER BY cnt, p.state LIMIT 100""")

UNION_BUYERS = """SELECT DISTINCT cust FROM sales WHERE ch = 'web' AND yr = 1999 AND mo BETWEEN 2 AND 5 UNION SELECT DISTINCT cust FROM sales WHERE ch = 'catalog' AND yr = 1999 AND mo BETWEEN 2 AND 5"""
STORE_BUYERS = "SELECT DISTINCT cust FROM sales WHERE ch = 'store' AND yr = 1999 AND mo BETWEEN 2 AND 5"
ds("v27_q10a", f"""
WITH u AS ({UNION_BUYERS}), st AS ({STORE_BUYERS}) SELECT p.gender, p.marital, p.seg, p.deps, count(*) AS cnt FROM people p WHERE p.cust IN (SELECT cust FROM st) AND p.cust IN (SELECT cust FROM u) AND p.country IN ('ASIA', 'AFRICA')
GROUP BY p.gender, p.marital, p.seg, p.deps ORDER BY p.gender, p.marital, p.seg, p.deps LIMIT 100""")

ds("v27_q11", d1.GROWTH.format(yearly=d1.YEARLY.replace("net", "price - disc")))
ds("v27_q12", d1.class_share("web", " LIMIT 100").replace("(2, 3)", "(4, 5)"))
ds("v27_q14", d1.LAST_YEAR.replace("mo = 12", "mo = 6"))

rollup("v27_q14a", f"SELECT ch, brand, cls, cat, {r('v', 'v', 2)}, n", f"WITH {d1.CROSS_ITEMS}, base AS (SELECT ch, brand, cls, cat, v, n FROM big)",
                      ["ch:VARCHAR(10)", "brand:VARCHAR(20)", "cls:VARCHAR(20)", "cat:VARCHAR(20)"], "sum(v) AS v, CAST(sum(n) AS BIGINT) AS n", "ch NULLS FIRST, brand NULLS FIRST, cls NULLS FIRST, cat NULLS FIRST")

SUM_COUNT = ", ".join(f"sum({e}) AS t{i}" for i, e in enumerate(("s.qty", "s.price", "s.disc", "s.net", "s.profit"), 1)) + ", count(*) AS n"
rollup("v27_q18a", "SELECT cat, country, state, " + ", ".join(f"round(t{i}, 4) / n AS a{i}" for i in range(1, 6)), f"WITH base AS (SELECT i.cat, p.country, p.state, {SUM_COUNT} {d1.GEO_FROM} GROUP BY i.cat, p.country, p.state)",
                      ["cat:VARCHAR(20)", "country:VARCHAR(20)", "state:VARCHAR(20)"], ", ".join(f"sum(t{i}) AS t{i}" for i in range(1, 6)) + ", sum(n) AS n", "country NULLS FIRST, state NULLS FIRST, cat NULLS FIRST")

ds("v27_q20", d1.class_share("catalog", " LIMIT 100").replace("(2, 3)", "(6, 7)"))
ds("v27_q22", f"""SELECT i.cat, i.cls, i.color, {r("avg(k.qoh)", "qoh")} FROM stock k JOIN items i ON i.item = k.item WHERE k.yr = 1999 GROUP BY ROLLUP (i.cat, i.cls, i.color) ORDER BY qoh, i.cat NULLS FIRST, i.cls NULLS FIRST, i.color NULLS FIRST LIMIT 100""")
rollup("v27_q22a", "SELECT cat, cls, brand, round(t, 4) / n AS qoh", "WITH base AS (SELECT i.cat, i.cls, i.brand, sum(k.qoh) AS t, count(*) AS n FROM stock k JOIN items i ON i.item = k.item WHERE k.yr = 1998 GROUP BY i.cat, i.cls, i.brand)",
                      ["cat:VARCHAR(20)", "cls:VARCHAR(20)", "brand:VARCHAR(20)"], "sum(t) AS t, sum(n) AS n", "qoh, cat NULLS FIRST, cls NULLS FIRST, brand NULLS FIRST")
ds("v27_q24", d1.returned_color("new").replace("p.country = o.country", "p.country <> o.country"))

SUM27 = ", ".join(f"sum({e}) AS t{i}" for i, e in enumerate(("s.qty", "s.price", "s.disc", "s.net"), 1)) + ", count(*) AS n"
rollup("v27_q27a", "SELECT cls, state, " + ", ".join(f"round(t{i}, 4) / n AS a{i}" for i in range(1, 5)), f"WITH base AS (SELECT i.cls, o.state, {SUM27} {d1.STATE_FROM} GROUP BY i.cls, o.state)",
                      ["cls:VARCHAR(20)", "state:VARCHAR(20)"], ", ".join(f"sum(t{i}) AS t{i}" for i in range(1, 5)) + ", sum(n) AS n", "cls NULLS FIRST, state NULLS FIRST")

ds("v27_q34", d1.tickets(1, 3, "s.yr IN (1998, 1999) AND p.cars > 1 AND p.seg = 'FURNITURE'"))
ds("v27_q35", d1.BY_STATE.replace("we = 1 OR ca = 1", "ca = 1"))
ds("v27_q35a", f"""
WITH u AS ({UNION_BUYERS}), st AS ({STORE_BUYERS}) SELECT p.state, p.gender, p.marital, count(*) AS cnt, {DEMOGRAPHICS} FROM people p WHERE p.cust IN (SELECT cust FROM st) AND p.cust IN (SELECT cust FROM u)
GROUP BY p.state, p.gender, p.marital ORDER BY p.state, p.gender, p.marital LIMIT 100""")


def ranked(name: str, measure: str, base: str, down: str) -> None:
    """Ranks inside each level; Spark reads the finest groups once."""
    once = f"""
WITH base AS ({base}), u AS (SELECT {measure} AS v, k1, k2, CAST(grouping(k1) + grouping(k2) AS INT) AS lochierarchy FROM base GROUP BY ROLLUP (k1, k2))"""
    union = ranked_levels(measure, base, down)
    ds(name, union, spark=once + union[union.rindex("\nSELECT round(v, 6)") :])


def ranked_levels(measure: str, base: str, down: str) -> str:
    """A two-level rollup as a union, ranked inside each level."""
    return f"""
WITH base AS ({base}), u AS (SELECT {measure} AS v, k1, k2, 0 AS lochierarchy FROM base GROUP BY k1, k2 UNION ALL SELECT {measure}, k1, CAST(NULL AS VARCHAR(20)), 1 FROM base GROUP BY k1
UNION ALL SELECT {measure}, CAST(NULL AS VARCHAR(20)), CAST(NULL AS VARCHAR(20)), 2 FROM base)
SELECT round(v, 6) AS v, k1, k2, lochierarchy, rank() OVER (PARTITION BY lochierarchy, CASE WHEN lochierarchy = 0 THEN k1 END ORDER BY v {down}) AS place FROM u ORDER BY lochierarchy DESC, k1 NULLS FIRST, place, k2 NULLS FIRST LIMIT 100"""


ranked("v27_q36a", "sum(gain) / sum(v0)", "SELECT i.cat AS k1, i.cls AS k2, sum(s.profit) AS gain, sum(s.price) AS v0 FROM sales s JOIN items i ON i.item = s.item JOIN outlets o ON o.outlet = s.outlet WHERE s.ch = 'store' AND s.yr = 1998 AND o.country IN ('ASIA', 'EUROPE') GROUP BY i.cat, i.cls", "ASC")
ds("v27_q47", d1.months_around("store", "o.state"))
ds("v27_q49", d1.RATIOS.replace("yr = 1998", "yr = 1999"), spark=d1.RATIO_PLACES.replace("yr = 1998", "yr = 1999"))
ds("v27_q51a", running(", rank() OVER (PARTITION BY item ORDER BY day) AS place"))
ds("v27_q57", d1.months_around("catalog", "o.country"))
ds("v27_q64", cross_years(" AND a99 > 0"))

LEVEL_KINDS = {"cat": "VARCHAR(20)", "cls": "VARCHAR(20)", "brand": "VARCHAR(20)", "yr": "INT", "qtr": "INT", "oname": "VARCHAR(40)"}
LEVELS67 = " UNION ALL ".join(
    "SELECT " + ", ".join(k if i < n else f"CAST(NULL AS {kind}) AS {k}" for i, (k, kind) in enumerate(LEVEL_KINDS.items())) + ", sum(v) AS v FROM base" + (f" GROUP BY {', '.join(list(LEVEL_KINDS)[:n])}" if n else "")
    for n in range(6, -1, -1))
ds("v27_q67a", f"WITH base AS (SELECT {', '.join(KEYS67)}, sum(s.price * s.qty) AS v {FROM67} GROUP BY {', '.join(KEYS67)}), " + rank_by_category(LEVELS67).strip()[5:])

ranked("v27_q70a", "sum(v0)", f"SELECT o.country AS k1, o.state AS k2, sum(s.profit) AS v0 FROM sales s JOIN outlets o ON o.outlet = s.outlet JOIN {TOP_STATES} t ON t.top_state = o.state WHERE s.ch = 'store' AND s.yr = 1998 GROUP BY o.country, o.state", "DESC")
ds("v27_q72", shortage(" AND p.deps > 1"))
ds("v27_q74", SPEND.format(sums=LARGEST.replace("max(", "sum(")))
ds("v27_q75", DECLINE.replace("'PROMO'", "'ECONOMY'"))
ds("v27_q77a", channel_profit(f", base AS (SELECT ch, outlet, sold, back, gain FROM j) SELECT ch, outlet, {r('sold', 'sales', 2)}, {r('back', 'returned')}, {r('gain', 'profit')} FROM (SELECT ch, outlet, sum(sold) AS sold, sum(back) AS back, sum(gain) AS gain FROM base GROUP BY ch, outlet "
                              f"UNION ALL SELECT ch, CAST(NULL AS BIGINT), sum(sold), sum(back), sum(gain) FROM base GROUP BY ch UNION ALL SELECT CAST(NULL AS VARCHAR(10)), CAST(NULL AS BIGINT), sum(sold), sum(back), sum(gain) FROM base) u {END77}"))
ds("v27_q78", LOYAL.replace("flag <> 'R' AND yr = 1998", "flag <> 'R' AND yr = 1999"))
rollup("v27_q80a", f"SELECT ch, outlet, {r('sold', 'sales', 2)}, {r('back', 'returned')}, {r('gain', 'profit')}", f"{MOVES80}, base AS (SELECT ch, outlet, sum(sold) AS sold, sum(back) AS back, sum(gain) AS gain FROM j GROUP BY ch, outlet)",
                      ["ch:VARCHAR(10)", "outlet:BIGINT"], "sum(sold) AS sold, sum(back) AS back, sum(gain) AS gain", "ch NULLS FIRST, outlet NULLS FIRST")
ranked("v27_q86a", "sum(v0)", "SELECT i.cat AS k1, i.cls AS k2, sum(s.net) AS v0 FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'web' AND s.yr = 1998 GROUP BY i.cat, i.cls", "DESC")
ds("v27_q98", d1.class_share("store", "").replace("(2, 3)", "(8, 9)"))

# Modified variants: date ranges on the fact table, handed to its scan so that files and partitions are pruned.

ONE_YEAR, TWO_YEARS, THREE_YEARS = ("1998-01-01", "1999-01-01"), ("1998-01-01", "2000-01-01"), ("1997-01-01", "2000-01-01")

PRUNED = {"s.yr = 1998": "s.yr = 1998 AND s.day BETWEEN 10227 AND 10591"}


def pruned(sql: str) -> str:
    """The same query with the year also stated as a range of the fact's own day column."""
    for old, new in PRUNED.items():
        sql = sql.replace(old, new)
    return sql


ds("mod_q7", pruned(d1.profile("store", "p.gender = 0 AND p.marital = 1 AND s.yr = 1998 AND s.promo NOT LIKE '2%'")), ONE_YEAR)
ds("mod_q10", f"""
WITH v AS (SELECT cust FROM sales s WHERE ch = 'web' AND {PRUNED['s.yr = 1998']} UNION ALL SELECT cust FROM sales s WHERE ch = 'catalog' AND {PRUNED['s.yr = 1998']}), st AS (SELECT DISTINCT cust FROM sales s WHERE ch = 'store' AND {PRUNED['s.yr = 1998']})
SELECT p.gender, p.marital, p.deps, count(*) AS cnt FROM people p JOIN st ON st.cust = p.cust JOIN (SELECT DISTINCT cust FROM v) w ON w.cust = p.cust GROUP BY p.gender, p.marital, p.deps ORDER BY p.gender, p.marital, p.deps LIMIT 100""", ONE_YEAR)
ds("mod_q19", pruned(f"""
SELECT i.brand, i.manu, {r("sum(s.price)", "price", 2)} FROM sales s JOIN items i ON i.item = s.item JOIN people p ON p.cust = s.cust JOIN outlets o ON o.outlet = s.outlet
WHERE s.ch = 'store' AND i.manu = 9 AND s.mo = 11 AND s.yr = 1998 AND p.zip <> o.zip GROUP BY i.brand, i.manu ORDER BY price DESC, i.brand, i.manu LIMIT 100"""), ONE_YEAR)
ds("mod_q27", pruned(f"""
WITH g AS (SELECT i.cls, o.state, s.qty, s.price, s.disc, s.net {d1.STATE_FROM})
SELECT cls, state, {r("avg(qty)", "a1")}, {r("avg(price)", "a2")}, {r("avg(disc)", "a3")}, {r("avg(net)", "a4")} FROM g GROUP BY cls, state UNION ALL SELECT cls, CAST(NULL AS VARCHAR(20)), {r("avg(qty)", "a1")}, {r("avg(price)", "a2")}, {r("avg(disc)", "a3")}, {r("avg(net)", "a4")} FROM g GROUP BY cls"""), ONE_YEAR)
ds("mod_q34", d1.tickets(2, 6, "s.day BETWEEN 9862 AND 10956 AND p.cars > 0 AND p.seg IN ('BUILDING', 'HOUSEHOLD')"), THREE_YEARS)
ds("mod_q42", pruned(f"""SELECT s.yr, i.cat, {r("sum(s.price)", "total", 2)} FROM sales s JOIN items i ON i.item = s.item WHERE s.ch = 'store' AND i.manu = 2 AND s.mo = 12 AND s.yr = 1998 GROUP BY s.yr, i.cat ORDER BY total DESC, s.yr, i.cat LIMIT 100"""), ONE_YEAR)
ds("mod_q43", pruned(f"""SELECT o.oname, {", ".join(f"round(sum(CASE WHEN s.dow = {i} THEN s.price END), 2) AS {d}" for i, d in enumerate(DAYS))} FROM sales s JOIN outlets o ON o.outlet = s.outlet
WHERE s.ch = 'store' AND s.yr = 1998 AND o.country IN ('EUROPE', 'AFRICA') GROUP BY o.oname ORDER BY o.oname LIMIT 100"""), ONE_YEAR)
ds("mod_q46", d1.trips("s.dow IN (6, 0) AND s.day BETWEEN 9862 AND 10956 AND (p.deps = 3 OR p.cars = 1)"), THREE_YEARS)
ds("mod_q52", pruned(by_brand("i.manu = 2 AND s.mo = 12 AND s.yr = 1998")), ONE_YEAR)
ds("mod_q53", pruned(deviation("manu", "qtr", PICKS)).replace("> 0.1", "> 0.2"), ONE_YEAR)
ds("mod_q55", pruned(by_brand("i.manu = 13 AND s.mo = 12 AND s.yr = 1998")), ONE_YEAR)
ds("mod_q59", weekly_stores(" LIMIT 100").replace("a.yr = 1997", "a.yr = 1998").replace("WHERE ch = 'store'", "WHERE ch = 'store' AND day BETWEEN 10227 AND 10956"), TWO_YEARS)
ds("mod_q63", pruned(deviation("size", "mo", PICKS)).replace("> 0.1", "> 0.2"), ONE_YEAR)
ds("mod_q65", LOW_REVENUE.replace("yr = 1998", "day BETWEEN 10227 AND 10591"), ONE_YEAR)
ds("mod_q68", d1.trips("s.dow IN (1, 2) AND s.day BETWEEN 9862 AND 10956 AND (p.deps = 2 OR p.cars = 0)"), THREE_YEARS)
ds("mod_q73", d1.tickets(1, 4, "s.dow BETWEEN 3 AND 4 AND s.day BETWEEN 9862 AND 10956 AND p.seg = 'AUTOMOBILE' AND p.cars > 0"), THREE_YEARS)
ds("mod_q79", TRIPS79.replace("s.dow = 1 AND s.yr IN (1997, 1998, 1999)", "s.dow = 2 AND s.day BETWEEN 9862 AND 10956"), THREE_YEARS)
ds("mod_q89", pruned(CLASSES).replace("> 0.1", "> 0.3"), ONE_YEAR)
ds("mod_q98", pruned(d1.class_share("store", "")).replace("(2, 3)", "(10, 11)"), ONE_YEAR)
ds("mod_ss_max", """
SELECT count(*) AS total, count(day) AS days, max(day) AS day, max(item) AS item, max(cust) AS cust, max(outlet) AS outlet, max(ord) AS ord, count(DISTINCT cust) AS customers, count(DISTINCT item) AS items FROM sales WHERE ch = 'store'""")
