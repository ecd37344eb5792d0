"""Scalar functions by family, each over a whole table."""

from pyspark.sql import functions as F

from millrace.functions import casts
from millrace.functions.times import epoch_seconds
from millrace.registry import query
from millrace.session import spread


def r8(c, name, digits=8):
    return F.round(c, digits).alias(name)


@query("fn_string_case", """
SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, length(p_name) AS len, bit_length(p_name)::INT AS bits, strlen(p_name)::INT AS bytes,
       ascii(p_name) AS code, reverse(p_name) AS back, repeat(p_brand, 2) AS twice, p_name || '/' || p_brand AS joined,
       concat_ws('-', p_name, NULL, p_brand) AS dashed, length(p_name) AS chars, length(p_brand) AS characters FROM part""")
def fn_string_case(t):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"), F.length("p_name").cast("bigint").alias("len"),
        F.bit_length("p_name").alias("bits"), F.octet_length("p_name").alias("bytes"), F.ascii("p_name").alias("code"),
        F.reverse("p_name").alias("back"), F.repeat("p_brand", 2).alias("twice"), F.expr("p_name || '/' || p_brand").alias("joined"),
        F.concat_ws("-", "p_name", F.lit(None).cast("string"), "p_brand").alias("dashed"),
        F.char_length("p_name").cast("bigint").alias("chars"), F.character_length("p_brand").cast("bigint").alias("characters"))


@query("fn_string_parts", """
SELECT p_partkey, instr(p_name, 'g')::INT AS i, instr(p_name, ' ')::INT AS p, left(p_name, 3) AS l3, right(p_name, 3) AS r3, substr(p_name, 2, 4) AS mid,
       substr(p_name, -4, 2) AS tail, split_part(p_name, ' ', 2) AS second, lpad(p_size::VARCHAR, 5, '0') AS padded, rpad(p_type, 10, '*') AS starred,
       replace(p_name, 'r', 'R') AS swapped, translate(p_name, 'abc', '12') AS mapped, ['x', 'y', 'z'][p_size % 3 + 1] AS chosen,
       coalesce(list_position(['SMALL', 'PROMO', 'LARGE'], p_type), 0)::INT AS in_set,
       (instr(substr(p_name, 3), 'e') + CASE WHEN instr(substr(p_name, 3), 'e') > 0 THEN 2 ELSE 0 END)::INT AS located FROM part""")
def fn_string_parts(t):
    return t.part.select(
        "p_partkey", F.instr("p_name", "g").alias("i"), F.expr("position(' ' IN p_name)").alias("p"), F.left("p_name", F.lit(3)).alias("l3"),
        F.right("p_name", F.lit(3)).alias("r3"), F.substring("p_name", 2, 4).alias("mid"), F.substr("p_name", F.lit(-4), F.lit(2)).alias("tail"),
        F.split("p_name", " ")[1].alias("second"), F.lpad(F.col("p_size").cast("string"), 5, "0").alias("padded"), F.rpad("p_type", 10, "*").alias("starred"),
        F.replace("p_name", F.lit("r"), F.lit("R")).alias("swapped"), F.translate("p_name", "abc", "12").alias("mapped"),
        F.elt(F.col("p_size") % 3 + 1, F.lit("x"), F.lit("y"), F.lit("z")).alias("chosen"),
        F.find_in_set("p_type", F.lit("SMALL,PROMO,LARGE")).alias("in_set"), F.locate("e", "p_name", 3).alias("located"))


@query("fn_string_trim", """
SELECT c_custkey, trim('  ' || c_name || ' ') AS t, ltrim('  ' || c_name) AS l, rtrim(c_name || '  ') AS r, ltrim(c_name, 'Cust') AS lead,
       rtrim(c_name, '0123') AS trail, trim(c_name, 'C0') AS both_ends, repeat(' ', 2) || c_mktsegment AS spaced FROM customer""")
def fn_string_trim(t):
    return t.customer.select(
        "c_custkey", F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("t"), F.ltrim(F.concat(F.lit("  "), "c_name")).alias("l"),
        F.rtrim(F.concat("c_name", F.lit("  "))).alias("r"), F.expr("trim(LEADING 'Cust' FROM c_name)").alias("lead"),
        F.expr("trim(TRAILING '0123' FROM c_name)").alias("trail"), F.expr("trim(BOTH 'C0' FROM c_name)").alias("both_ends"),
        F.expr("space(2) || c_mktsegment").alias("spaced"))


@query("fn_string_format", """
SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price, printf('%08d-%s', o_orderkey, o_orderstatus) AS code, printf('%s:%d', o_orderstatus, o_custkey) AS pair,
       hex(o_orderpriority) AS hexed, base64(encode(o_orderpriority)) AS b64, decode(from_base64(base64(encode(o_orderpriority)))) AS plain,
       decode(unhex(hex(o_orderstatus))) AS unhexed FROM orders""")
def fn_string_format(t):
    return t.orders.select(
        "o_orderkey", F.format_number("o_totalprice", 2).alias("price"), F.format_string("%08d-%s", "o_orderkey", "o_orderstatus").alias("code"),
        F.printf(F.lit("%s:%d"), "o_orderstatus", "o_custkey").alias("pair"), F.hex("o_orderpriority").alias("hexed"),
        F.base64(F.encode("o_orderpriority", "UTF-8")).alias("b64"),
        F.decode(F.unbase64(F.base64(F.encode("o_orderpriority", "UTF-8"))), "UTF-8").alias("plain"),
        F.decode(F.unhex(F.hex("o_orderstatus")), "UTF-8").alias("unhexed"))


@query("fn_regex", """
SELECT url, regexp_extract(url, '^(https?)://([^/]+)', 2) AS host, regexp_replace(url, '[0-9]+', '#', 'g') AS masked, regexp_matches(url, 'page=[0-9]') AS paged,
       url LIKE '%/en/%' AS english, regexp_matches(url, '^https') AS secure, len(string_split(url, '/')) AS pieces FROM pages""")
def fn_regex(t):
    return t.pages.select(
        "url", F.regexp_extract("url", "^(https?)://([^/]+)", 2).alias("host"), F.regexp_replace("url", "[0-9]+", "#").alias("masked"),
        F.regexp("url", F.lit("page=[0-9]")).alias("paged"), F.col("url").like("%/en/%").alias("english"), F.col("url").rlike("^https").alias("secure"),
        F.size(F.split("url", "/")).cast("bigint").alias("pieces"))


@query("fn_url", """
SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, nullif(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '') AS path,
       nullif(regexp_extract(url, '\\?([^#]*)', 1), '') AS q, nullif(regexp_extract(url, '#(.*)$', 1), '') AS frag, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages""")
def fn_url(t):
    def part(what, name, key=None):
        c = F.try_parse_url("url", F.lit(what), F.lit(key)) if key else F.try_parse_url("url", F.lit(what))
        return F.when(c != "", c).alias(name)

    return t.pages.where(F.parse_url("url", F.lit("HOST")).isNotNull()).select("page_id", part("PROTOCOL", "scheme"), part("HOST", "host"), part("PATH", "path"), part("QUERY", "q"),
                          part("REF", "frag"), part("QUERY", "page", "page"))


@query("fn_sentences", """
SELECT p_partkey, p_name AS words, 1::BIGINT AS sentences FROM part""")
def fn_sentences(t):
    s = F.sentences("p_name")
    return t.part.select("p_partkey", F.array_join(F.flatten(s), " ").alias("words"), F.size(s).cast("bigint").alias("sentences"))


@query("fn_math", """
SELECT l_orderkey, l_partkey, l_suppkey, abs(l_quantity - 25) AS a, round(acos(l_discount), 8) AS ac, round(asin(l_discount), 8) AS asi, round(atan(l_quantity), 8) AS at,
       round(cos(l_quantity), 8) AS co, round(cot(l_quantity), 6) AS ct, round(sin(l_quantity), 8) AS si, round(tan(l_quantity), 6) AS ta,
       round(exp(l_discount), 8) AS ex, round(ln(l_quantity), 8) AS l, round(ln(l_extendedprice) / ln(3), 8) AS l3, round(log10(l_quantity), 8) AS l10, round(log2(l_quantity), 8) AS l2,
       round(sqrt(l_extendedprice), 8) AS sq, round(pow(l_quantity, 1.5), 6) AS pw, round(degrees(l_discount), 8) AS dg, round(radians(l_quantity), 8) AS rd,
       sign(l_quantity - 25)::DOUBLE AS sg, round(pi() * e_const, 8) AS pe FROM lineitem, (SELECT exp(1) AS e_const)""")
def fn_math(t):
    q, d, p = F.col("l_quantity"), F.col("l_discount"), F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", F.abs(q - 25).alias("a"), r8(F.acos(d), "ac"), r8(F.asin(d), "asi"), r8(F.atan(q), "at"), r8(F.cos(q), "co"),
        r8(F.cot(q), "ct", 6), r8(F.sin(q), "si"), r8(F.tan(q), "ta", 6), r8(F.exp(d), "ex"), r8(F.ln(q), "l"), r8(F.log(3.0, p), "l3"), r8(F.log10(q), "l10"),
        r8(F.log2(q), "l2"), r8(F.sqrt(p), "sq"), r8(F.power(q, F.lit(1.5)), "pw", 6), r8(F.degrees(d), "dg"), r8(F.radians(q), "rd"), F.sign(q - 25).alias("sg"),
        r8(F.pi() * F.e(), "pe"))


@query("fn_math_integer", """
SELECT o_orderkey, ceil(o_totalprice)::BIGINT AS c, floor(-o_totalprice)::BIGINT AS f, (o_custkey % 7)::BIGINT AS m, ((-o_custkey % 7) + 7) % 7 AS pm, -o_custkey AS neg,
       greatest(o_custkey, 500) AS g, least(o_custkey, 500) AS l, bit_count(o_custkey)::INT AS bits, o_custkey << 3 AS sh, bin(o_custkey) AS b, lower(hex(o_custkey)) AS h16,
       o_custkey AS pos, round(o_totalprice, -2) AS hundreds, ceil(o_totalprice / 7)::BIGINT AS c7, (o_orderkey // 3) AS third FROM orders""")
def fn_math_integer(t):
    k, p = F.col("o_custkey"), F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.ceil(p).alias("c"), F.floor(-p).alias("f"), F.expr("mod(o_custkey, 7)").alias("m"), F.pmod(-k, F.lit(7)).alias("pm"), F.negative(k).alias("neg"),
        F.greatest(k, F.lit(500)).alias("g"), F.least(k, F.lit(500)).alias("l"), F.bit_count(k).alias("bits"), F.shiftleft(k, 3).alias("sh"), F.bin(k).alias("b"),
        F.lower(F.conv(k.cast("string"), 10, 16)).alias("h16"), F.positive(k).alias("pos"), F.round(p, -2).alias("hundreds"), F.ceiling(p / 7).alias("c7"),
        F.expr("o_orderkey div 3").alias("third"))


@query("fn_bitwise", """
SELECT l_orderkey, l_partkey, l_suppkey, l_orderkey & l_partkey AS a, l_orderkey | l_partkey AS o, xor(l_orderkey, l_partkey) AS x, ~l_partkey AS n FROM lineitem""")
def fn_bitwise(t):
    a, b = F.col("l_orderkey"), F.col("l_partkey")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", a.bitwiseAND(b).alias("a"), a.bitwiseOR(b).alias("o"), a.bitwiseXOR(b).alias("x"), F.bitwise_not(b).alias("n"))


@query("fn_date_parts", """
SELECT event_id, year(ts)::INT AS y, quarter(ts)::INT AS q, month(ts)::INT AS mo, day(ts)::INT AS d, hour(ts)::INT AS h, minute(ts)::INT AS mi, second(ts)::INT AS s,
       (dayofweek(ts) + 1)::INT AS dow, dayofyear(ts)::INT AS doy, weekofyear(ts)::INT AS woy, (isodow(ts) - 1)::INT AS wd,
       strftime(ts, '%Y/%m/%d %H:%M') AS txt, strftime(date_trunc('week', ts), '%Y-%m-%d') AS wk, extract(day FROM ts)::INT AS dp FROM events""")
def fn_date_parts(t):
    return t.events.select(
        "event_id", F.year("ts").alias("y"), F.quarter("ts").alias("q"), F.month("ts").alias("mo"), F.dayofmonth("ts").alias("d"), F.hour("ts").alias("h"),
        F.minute("ts").alias("mi"), F.second("ts").alias("s"), F.dayofweek("ts").alias("dow"), F.dayofyear("ts").alias("doy"), F.weekofyear("ts").alias("woy"),
        F.weekday("ts").alias("wd"), F.date_format("ts", "yyyy/MM/dd HH:mm").alias("txt"), F.date_format(F.date_trunc("week", F.col("ts").cast("timestamp_ntz")), "yyyy-MM-dd").alias("wk"),
        F.date_part(F.lit("day"), "ts").alias("dp"))


@query("fn_extract", """
SELECT o_orderkey, extract(millennium FROM o_orderdate)::INT AS mil, extract(century FROM o_orderdate)::INT AS cent, extract(decade FROM o_orderdate)::INT AS deca,
       isoyear(o_orderdate)::INT AS iso, isodow(o_orderdate)::INT AS isod, quarter(o_orderdate)::INT AS qt FROM orders""")
def fn_extract(t):
    y = F.extract(F.lit("YEAR"), "o_orderdate")
    return t.orders.select("o_orderkey", F.floor((y - 1) / 1000 + 1).cast("int").alias("mil"), F.ceil(y / 100).cast("int").alias("cent"),
                           F.floor(y / 10).cast("int").alias("deca"), F.expr("extract(YEAROFWEEK FROM o_orderdate)").alias("iso"),
                           F.expr("extract(DAYOFWEEK_ISO FROM o_orderdate)").alias("isod"), F.extract(F.lit("QUARTER"), "o_orderdate").alias("qt"))


@query("fn_date_arith", """
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d') AS plus10, strftime(o_orderdate - INTERVAL 10 DAY, '%Y-%m-%d') AS minus10,
       date_diff('day', o_orderdate::DATE, DATE '2002-01-01')::INT AS left_days, strftime(o_orderdate + INTERVAL 2 MONTH, '%Y-%m-%d') AS plus2m,
       strftime(o_orderdate + INTERVAL 1 YEAR + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS later, strftime(last_day(o_orderdate), '%Y-%m-%d') AS eom,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS som, epoch(o_orderdate)::BIGINT AS ep, strftime(make_date(year(o_orderdate), 1, 1), '%Y-%m-%d') AS jan1 FROM orders""")
def fn_date_arith(t):
    d = F.col("o_orderdate")

    def text(c, name, fmt="yyyy-MM-dd"):
        return F.date_format(c, fmt).alias(name)

    return t.orders.select(
        "o_orderkey", text(F.date_add(d, 10), "plus10"), text(F.date_sub(d, 10), "minus10"), F.datediff(F.to_date(F.lit("2002-01-01")), d).alias("left_days"),
        text(F.add_months(d, 2), "plus2m"), text(d + F.expr("INTERVAL '1' YEAR") + F.expr("INTERVAL '90' MINUTE"), "later", "yyyy-MM-dd HH:mm:ss"),
        text(F.last_day(d), "eom"), text(F.trunc(d, "month"), "som"), epoch_seconds(d).cast("bigint").alias("ep"),
        text(F.make_date(F.year(d), F.lit(1), F.lit(1)), "jan1"))


@query("fn_date_parse", """
SELECT event_id, strftime(strptime(strftime(ts, '%d.%m.%Y'), '%d.%m.%Y'), '%Y-%m-%d') AS d, strftime(ts, '%Y-%m-%d %H:%M:%S') AS round_trip,
       strftime(ts, '%Y-%m-%d %H:%M') AS parsed, strftime(ts, '%H:%M') AS clock, strftime(ts + INTERVAL 1 DAY + INTERVAL 2 HOUR, '%Y-%m-%d %H') AS shifted FROM events""")
def fn_date_parse(t):
    seconds = F.unix_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss")
    moved = F.col("ts") + F.expr("make_interval(0, 0, 0, 1, 2, 0, 0)")
    zone = F.to_utc_timestamp(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Tokyo"), "Asia/Tokyo")
    return t.events.select(
        "event_id", F.date_format(F.to_date(F.date_format("ts", "dd.MM.yyyy"), "dd.MM.yyyy"), "yyyy-MM-dd").alias("d"),
        F.date_format(F.to_timestamp(F.date_format("ts", "yyyyMMdd HHmm"), "yyyyMMdd HHmm"), "yyyy-MM-dd HH:mm").alias("parsed"),
        F.from_unixtime(seconds).alias("round_trip"), F.date_format(zone, "HH:mm").alias("clock"), F.date_format(moved, "yyyy-MM-dd HH").alias("shifted"))


@query("fn_time_window", """
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM events GROUP BY 1""")
def fn_time_window(t):
    w = F.window(F.col("ts"), "6 hours")
    return t.events.groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("start"), "n")


@query("fn_now")
def fn_now(t):
    """Current date and time, unique ids and random draws: one row per type, only their shape can be checked."""
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).select(
        "event_type", F.current_date().alias("today"), F.current_timestamp().alias("now"), F.length(F.uuid()).alias("uuid_length"),
        F.rand(3).alias("u"), F.randn(3).alias("g"), F.expr("random(3)").alias("u2"), F.unix_timestamp().alias("epoch"))


@query("fn_conditional", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS i, ifnull(nullif(p_size, 10), -1) AS n, coalesce(nullif(p_type, 'PROMO'), p_brand) AS c,
       CASE WHEN nullif(p_size, 5) IS NOT NULL THEN 'set' ELSE 'unset' END AS n2, p_size BETWEEN 10 AND 20 AS b,
       CASE p_type WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 2 END AS simple, CASE WHEN p_size < 10 THEN 'a' WHEN p_size < 20 THEN 'b' ELSE 'c' END AS searched,
       p_type IN ('PROMO', 'LARGE') AS isin FROM part""")
def fn_conditional(t):
    size, kind = F.col("p_size"), F.col("p_type")
    return t.part.select(
        "p_partkey", F.expr("if(p_size > 25, 'big', 'small')").alias("i"), F.ifnull(F.nullif(size, F.lit(10)), F.lit(-1)).alias("n"),
        F.coalesce(F.nullif(kind, F.lit("PROMO")), "p_brand").alias("c"), F.nvl2(F.nullif(size, F.lit(5)), F.lit("set"), F.lit("unset")).alias("n2"),
        size.between(10, 20).alias("b"), F.when(kind == "PROMO", 1).when(kind == "SMALL", 2).alias("simple"),
        F.when(size < 10, "a").when(size < 20, "b").otherwise("c").alias("searched"), kind.isin("PROMO", "LARGE").alias("isin"))


@query("fn_nvl", """
SELECT coalesce(k, -1) AS k, count(*) AS n FROM (SELECT nullif(l_linenumber, 4) AS k FROM lineitem) GROUP BY 1""")
def fn_nvl(t):
    return t.lineitem.select(F.nvl(F.expr("nullif(l_linenumber, 4)"), F.lit(-1)).alias("k")).groupBy("k").agg(F.count("*").alias("n"))


@query("fn_cast", """
SELECT o_orderkey, try_cast(o_orderkey::VARCHAR AS INT) AS i, try_cast(o_orderpriority AS INT) AS bad, trunc(o_totalprice)::BIGINT AS cut, (o_orderkey % 100)::TINYINT AS ti, (o_custkey % 1000)::SMALLINT AS si,
       (o_custkey % 2)::BOOLEAN AS bo, o_custkey::DOUBLE AS dbl, round((o_custkey / 4.0)::FLOAT::DOUBLE, 4) AS fl, o_custkey::VARCHAR AS st, strftime(o_orderdate, '%Y-%m-%d') AS dt, 'bigint' AS ty FROM orders""")
def fn_cast(t):
    return t.orders.select(
        "o_orderkey", casts.soft_cast(F.col("o_orderkey").cast("string"), "int").alias("i"), casts.soft_cast("o_orderpriority", "int").alias("bad"),
        casts.text_to_integer(F.col("o_totalprice").cast("decimal(20,2)").cast("string"), "bigint").alias("cut"), F.expr("tinyint(bigint(o_orderkey) % 100)").alias("ti"), F.expr("smallint(o_custkey % 1000)").alias("si"),
        F.expr("boolean(o_custkey % 2)").alias("bo"), F.expr("double(o_custkey)").alias("dbl"), F.round(F.expr("double(float(o_custkey / 4.0))"), 4).alias("fl"),
        F.expr("string(o_custkey)").alias("st"), F.expr("string(date(timestamp(o_orderdate)))").alias("dt"), F.typeof("o_custkey").alias("ty"))


@query("fn_decimal", """
SELECT o_orderkey, (o_totalprice::DECIMAL(12, 2) * 3)::DOUBLE AS m, (o_totalprice::DECIMAL(12, 2) + 0.005)::DOUBLE AS a, (o_totalprice::DECIMAL(12, 2) % 7)::DOUBLE AS md,
       round(o_totalprice::DECIMAL(12, 2), 1)::DOUBLE AS r FROM orders""")
def fn_decimal(t):
    d = F.col("o_totalprice").cast("decimal(12,2)")
    return t.orders.select("o_orderkey", (d * 3).cast("double").alias("m"), (d + F.lit("0.005").cast("decimal(4,3)")).cast("double").alias("a"),
                           (d % 7).cast("double").alias("md"), F.round(d, 1).cast("double").alias("r"))


@query("fn_array", """
SELECT vec_id, len(e)::INT AS n, list_contains(e, 0.0::FLOAT) AS has0, e[1]::DOUBLE AS first, e[-1]::DOUBLE AS last, list_sort(e)[1]::DOUBLE AS low, list_max(e)::DOUBLE AS high,
       list_reverse_sort(e)[1]::DOUBLE AS top, list_reverse(e)[1]::DOUBLE AS rev, len(list_concat(e, [1.0::FLOAT]))::INT AS n1, len(list_distinct(e))::INT AS nd FROM (SELECT vec_id, embedding AS e FROM embeddings)""")
def fn_array(t):
    e = F.col("embedding")

    def d(c, name):
        return c.cast("double").alias(name)

    return t.embeddings.select(
        "vec_id", F.size(e).alias("n"), F.array_contains(e, F.lit(0.0).cast("float")).alias("has0"), d(e[0], "first"), d(F.element_at(e, -1), "last"),
        d(F.sort_array(e)[0], "low"), d(F.array_max(e), "high"), d(F.sort_array(e, False)[0], "top"), d(F.reverse(e)[0], "rev"),
        F.size(F.concat(e, F.array(F.lit(1.0).cast("float")))).alias("n1"), F.size(F.array_distinct(e)).alias("nd"))


@query("fn_array_text", """
SELECT doc_id, array_to_string(w, '|') AS joined, len(w) AS n, list_sort(w)[1] AS first FROM (SELECT doc_id, string_split(lang || ',' || source || ',x', ',') AS w FROM documents)""")
def fn_array_text(t):
    w = F.split(F.concat_ws(",", "lang", "source", F.lit("x")), ",")
    return t.documents.select("doc_id", F.array_join(w, "|").alias("joined"), F.size(w).cast("bigint").alias("n"), F.sort_array(w)[0].alias("first"))


@query("fn_hof", """
SELECT vec_id, round(list_sum(list_transform(e, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS norm2, len(list_filter(e, lambda x: x > 0))::INT AS pos, len(list_filter(e, lambda x: x > 0.4)) > 0 AS any_big,
       round(list_sum(list_transform(list_zip(e[1:32], e[33:64]), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)), 6) AS halves FROM (SELECT vec_id, embedding AS e FROM embeddings)""")
def fn_hof(t):
    e = F.col("embedding")
    square = F.transform(e, lambda x: x.cast("double") * x.cast("double"))
    zipped = F.zip_with(F.slice(e, 1, 32), F.slice(e, 33, 32), lambda a, b: a.cast("double") * b.cast("double"))

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    return t.embeddings.select("vec_id", F.round(total(square), 6).alias("norm2"), F.size(F.filter(e, lambda x: x > 0)).alias("pos"),
                               F.exists(e, lambda x: x > F.lit(0.4).cast("float")).alias("any_big"), F.round(total(zipped), 6).alias("halves"))


@query("fn_map", """
SELECT p_partkey, 'brand,size' AS keys, p_brand || ',' || p_size AS vals, p_brand AS got, (p_size + 1)::VARCHAR AS bumped, 'BRAND' AS up_key, 3::BIGINT AS merged, p_size || '/' || p_type AS zipped FROM part""")
def fn_map(t):
    m = F.create_map(F.lit("brand"), "p_brand", F.lit("size"), F.col("p_size").cast("string"))
    other = F.create_map(F.lit("size"), "p_type", F.lit("kind"), "p_type")
    only_kind = F.create_map(F.lit("kind"), "p_type")
    zipped = F.map_zip_with(m, other, lambda k, a, b: F.concat_ws("/", a, b))
    return t.part.select(
        "p_partkey", F.array_join(F.sort_array(F.map_keys(m)), ",").alias("keys"), F.array_join(F.map_values(m), ",").alias("vals"), m["brand"].alias("got"),
        F.transform_values(m, lambda k, v: F.when(k == "size", (v.cast("int") + 1).cast("string")).otherwise(v))["size"].alias("bumped"),
        F.map_keys(F.transform_keys(m, lambda k, v: F.upper(k)))[0].alias("up_key"), F.size(F.map_concat(m, only_kind)).cast("bigint").alias("merged"),
        zipped["size"].alias("zipped"))


@query("fn_str_to_map", """
SELECT c_custkey, c_nationkey::VARCHAR AS nation, c_mktsegment AS segment FROM customer""")
def fn_str_to_map(t):
    text = F.concat(F.lit("nation:"), F.col("c_nationkey").cast("string"), F.lit(",segment:"), F.col("c_mktsegment"))
    m = F.str_to_map(text, F.lit(","), F.lit(":"))
    return t.customer.select("c_custkey", m["nation"].alias("nation"), m["segment"].alias("segment"))


@query("fn_struct", """
SELECT c_custkey, c_name AS a, c_nationkey + 1 AS b, c_mktsegment AS seg FROM customer""")
def fn_struct(t):
    s = F.named_struct(F.lit("a"), F.col("c_name"), F.lit("b"), F.col("c_nationkey"))
    rows = t.customer.select("c_custkey", s.alias("st"), "c_mktsegment").select("c_custkey", F.struct("st.*", F.col("c_mktsegment").alias("seg")).alias("st"))
    return rows.select("c_custkey", F.col("st").withField("b", F.col("st.b") + 1).alias("st")).select("c_custkey", "st.*")


@query("fn_json", """
SELECT event_id, (props->>'k')::INT AS k, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS js, event_type AS back, (props->>'$.k')::INT AS path FROM events""")
def fn_json(t):
    js = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type")))
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k"), js.alias("js"),
                           F.from_json(js, "id bigint, type string")["type"].alias("back"), F.get_json_object("props", "$.k").cast("int").alias("path"))


@query("fn_json_schema", """
SELECT 'STRUCT<k: BIGINT>' AS schema, 'OBJECT<k: BIGINT>' AS all_rows, count(*) AS n FROM events""")
def fn_json_schema(t):
    """The schema of one text, which the function takes as a constant, and the one that fits the texts of all rows."""
    sample = t.events.select("props").first()["props"]
    whole = t.events.agg(F.schema_of_variant_agg(F.parse_json("props")).alias("all_rows"), F.count("*").alias("n"))
    return whole.select(F.schema_of_json(F.lit(sample)).alias("schema"), "all_rows", "n")


@query("fn_csv", """
SELECT p_partkey, p_brand AS brand, p_size AS size, p_brand || ',' || p_size || ',' || p_type AS line, 'STRUCT<_c0: INT, _c1: STRING>' AS schema FROM part""")
def fn_csv(t):
    line = F.to_csv(F.struct("p_brand", "p_size", "p_type"))
    parsed = F.from_csv(line, "brand string, size int, kind string")
    return t.part.select("p_partkey", parsed["brand"].alias("brand"), parsed["size"].alias("size"), line.alias("line"), F.schema_of_csv(F.lit("1,abc")).alias("schema"))


@query("fn_xpath", """
SELECT c_custkey, c_name AS name, true AS there, c_nationkey AS n, c_nationkey::SMALLINT AS sh, c_nationkey::BIGINT AS lo, c_acctbal AS bal, round(c_acctbal::FLOAT::DOUBLE, 1) AS fl,
       'x,y' AS tags, 2.0::DOUBLE AS counted FROM customer""")
def fn_xpath(t):
    xml = F.concat(F.lit("<c><n>"), F.col("c_name"), F.lit("</n><k>"), F.col("c_nationkey").cast("string"), F.lit("</k><b>"),
                   F.col("c_acctbal").cast("decimal(20,2)").cast("string"), F.lit("</b><t>x</t><t>y</t></c>"))

    def at(f, path, name):
        return f("xml", F.lit(path)).alias(name)

    return spread(t.customer, "c_custkey").select("c_custkey", xml.alias("xml")).select(
        "c_custkey", at(F.xpath_string, "c/n", "name"), at(F.xpath_boolean, "c/n", "there"), at(F.xpath_int, "c/k", "n"), at(F.xpath_short, "c/k", "sh"),
        at(F.xpath_long, "c/k", "lo"), at(F.xpath_double, "c/b", "bal"), F.round(F.xpath_float("xml", F.lit("c/b")).cast("double"), 1).alias("fl"),
        F.array_join(F.xpath("xml", F.lit("c/t/text()")), ",").alias("tags"), at(F.xpath_number, "count(c/t)", "counted"))


@query("fn_hash", """
SELECT count(*) AS n, count(*) AS distinct_rows FROM (SELECT DISTINCT o_orderkey FROM orders)""")
def fn_hash(t):
    """Hashes are engine specific; equal rows must agree and 64-bit hashes of few rows must not collide."""
    hashed = t.orders.select(F.xxhash64("o_orderkey").alias("h"), F.hash("o_orderkey").alias("h32"))
    return hashed.agg(F.count("*").alias("n"), F.countDistinct("h").alias("distinct_rows"))


@query("fn_vector_to_array", """
SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS first, len(embedding)::INT AS n FROM embeddings""")
def fn_vector_to_array(t):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = vector_to_array(array_to_vector("embedding"))
    return t.embeddings.select("vec_id", F.round(v[0], 6).alias("first"), F.size(v).alias("n"))
