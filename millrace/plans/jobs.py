"""Domain jobs on tables derived from the star."""

from pyspark.sql import functions as F

from millrace.jobs import attributes as ja, label_metrics as jl, logs_and_assets as jw
from millrace.functions.times import between, years
from millrace.registry import query
from millrace.sources.tables import staged

SNAP = """snap AS (SELECT l_partkey AS product_id, 's' || (l_suppkey % 5) AS source, l_suppkey % 3 AS org_id, year(l_shipdate)::INT AS day,
  max(l_returnflag) AS flag, max(l_linestatus) AS status, max(l_linenumber)::VARCHAR AS line, max(l_quantity)::INT::VARCHAR AS qty
  FROM lineitem WHERE year(l_shipdate) IN (1997, 1998) GROUP BY ALL),
pair AS (SELECT product_id, source, org_id, count(*) AS n, count(DISTINCT (flag, status, line, qty)) AS states,
  count(DISTINCT flag) AS f, count(DISTINCT status) AS s, count(DISTINCT line) AS l, count(DISTINCT qty) AS q FROM snap GROUP BY ALL),
changed AS (SELECT product_id, source, org_id, a AS attribute FROM pair,
  LATERAL (SELECT unnest(list_filter(['flag', 'status', 'line', 'qty'], lambda x: (x = 'flag' AND f = 2) OR (x = 'status' AND s = 2) OR (x = 'line' AND l = 2) OR (x = 'qty' AND q = 2))) AS a)
  WHERE states = 2)"""


def snapshots(t, first: int = 1997):
    """Attribute states of each part, source and organisation in a year and the next one."""
    rows = between(t.lineitem, "l_shipdate", years(first, first + 1))
    g = rows.groupBy(F.col("l_partkey").alias("product_id"), F.concat(F.lit("s"), F.col("l_suppkey") % 5).alias("source"),
                     (F.col("l_suppkey") % 3).alias("org_id"), F.year("l_shipdate").alias("day")).agg(
        F.max("l_returnflag").alias("flag"), F.max("l_linestatus").alias("status"), F.max("l_linenumber").cast("string").alias("line"),
        F.max("l_quantity").cast("int").cast("string").alias("qty"))
    return g.select("product_id", "source", "org_id", "day", F.to_json(F.struct("flag", "status", "line", "qty")).alias("attributes"))


KEYS = ["product_id", "source", "org_id"]


@query("attr_keys", """SELECT 'k' AS attribute, count(*) AS n FROM events WHERE event_type <> 'error'""")
def attr_keys(t):
    """The JSON of one kind of event is broken on purpose; its rows give no key."""
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("oops "), "props")).otherwise(F.col("props"))
    return ja.attribute_keys(t.events.select("event_id", text.alias("props")), "props").groupBy("attribute").agg(F.count("*").alias("n"))


@query("attr_diff", f"WITH {SNAP} SELECT * FROM changed")
def attr_diff(t):
    return ja.attribute_changes(snapshots(t), KEYS, "attributes")


@query("attr_top", f"WITH {SNAP} SELECT attribute, count(*) AS attr_count FROM changed GROUP BY attribute ORDER BY attr_count DESC, attribute LIMIT 250")
def attr_top(t):
    return ja.top_attributes(ja.attribute_changes(snapshots(t), KEYS, "attributes"), [], 250)


@query("attr_top_sources", f"""
WITH {SNAP}, per AS (SELECT attribute, source, count(*) AS n FROM changed GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY attribute ORDER BY n DESC, source) AS r FROM per)
SELECT attribute, sum(n)::BIGINT AS attr_count, max(CASE WHEN r = 1 THEN source END) AS source_name1, max(CASE WHEN r = 1 THEN n END) AS source_count1,
  max(CASE WHEN r = 2 THEN source END) AS source_name2, max(CASE WHEN r = 2 THEN n END) AS source_count2, max(CASE WHEN r = 3 THEN source END) AS source_name3, max(CASE WHEN r = 3 THEN n END) AS source_count3
FROM r GROUP BY attribute ORDER BY attr_count DESC, attribute LIMIT 25""")
def attr_top_sources(t):
    return ja.top_sources(ja.attribute_changes(snapshots(t), KEYS, "attributes"), 25)


@query("dup_check", """
WITH d AS (SELECT l_partkey AS product_id, l_shipdate::DATE AS day, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT product_id, sum(n)::BIGINT AS records, count(*) AS days FROM d GROUP BY product_id HAVING sum(n) > count(*)""")
def dup_check(t):
    return ja.duplicate_snapshots(t.lineitem.select(F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("day")), "product_id", "day")


@query("dup_reconcile", f"WITH {SNAP} SELECT count(*) AS records, count(DISTINCT product_id) AS products, count(DISTINCT day) AS days, count(DISTINCT product_id) * count(DISTINCT day) AS expected, count(*) - count(DISTINCT product_id) * count(DISTINCT day) AS surplus FROM snap")
def dup_reconcile(t):
    return ja.reconcile(snapshots(t), "product_id", "day")


@query("new_data_gate", """
SELECT 'later' AS run, count(*) AS n FROM events WHERE ts::DATE > DATE '2024-01-20' UNION ALL SELECT 'again', 0""")
def new_data_gate(t):
    """The first report covers the days up to 20 January; the next one sees only later rows; a third has nothing to do."""
    rows = t.events.select("event_id", F.to_date("ts").alias("day"))
    control = ja.empty_control(t.spark, "date")
    ja.mark_reported(rows.where("day <= '2024-01-20'"), "day", control)
    fresh = ja.new_rows(rows, "day", control)
    later = fresh.agg(F.lit("later").alias("run"), F.count("*").alias("n"))
    ja.mark_reported(fresh, "day", control)
    again = ja.new_rows(rows, "day", control)
    rest = rows.where("false") if again is None else again
    return later.union(rest.agg(F.lit("again").alias("run"), F.count("*").alias("n")))


LABELS = """pred AS (SELECT l_orderkey AS item_id, string_agg(DISTINCT l_returnflag, ';' ORDER BY l_returnflag) AS truth,
  coalesce(string_agg(DISTINCT l_returnflag, '__' ORDER BY l_returnflag) FILTER (WHERE l_quantity > 25), '') AS model FROM lineitem GROUP BY 1)"""


def predictions(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("item_id")).agg(
        F.array_join(F.sort_array(F.collect_set("l_returnflag")), ";").alias("trusted"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("l_quantity") > 25, F.col("l_returnflag")))), "__").alias("model"))
    return lines.select("item_id", "trusted", F.nullif("model", F.lit("")).alias("model"))


@query("label_metrics", f"""
WITH {LABELS}, m AS (SELECT l AS label, count(*) FILTER (WHERE contains(truth, l) AND contains(model, l)) AS hit, count(*) FILTER (WHERE contains(truth, l)) AS actual, count(*) FILTER (WHERE contains(model, l)) AS given
  FROM pred, (VALUES ('A'), ('N'), ('R')) v(l) GROUP BY l)
SELECT label, round(hit / given, 3) AS precision, round(hit / actual, 3) AS recall, round(2 * hit / (given + actual), 3) AS f1, actual::DOUBLE AS support FROM m""")
def label_metrics(t):
    return jl.label_metrics(jl.fill_truth(predictions(t), "trusted", "model"), "truth", "model")


@query("truth_fill", f"""
WITH {LABELS} SELECT item_id, truth, model FROM pred""")
def truth_fill(t):
    return jl.fill_truth(predictions(t), "trusted", "model").select("item_id", "truth", "model")


@query("payload_json", """
SELECT p_partkey, CASE WHEN p_size > 10 THEN '{"title":"' || p_name || '","size":' || p_size || ',"kind":"' || p_type || '"}' ELSE '{"title":"' || p_name || '","kind":"' || p_type || '"}' END AS payload FROM part""")
def payload_json(t):
    return t.part.select("p_partkey", ja.payload({"title": F.col("p_name"), "size": F.when(F.col("p_size") > 10, F.col("p_size")), "kind": F.col("p_type")}).alias("payload"))


@query("url_expand", """
SELECT page_id AS item_id, i::INT AS ordinal, lpad(i::VARCHAR, 3, '0') AS suffix, CASE i WHEN 1 THEN url WHEN 2 THEN url || '/a.PNG' ELSE url || '/b.tiff' END AS url,
 CASE i WHEN 1 THEN 'jpeg' WHEN 2 THEN 'png' ELSE 'tiff' END AS format, page_id % 8 AS bucket, false AS too_many FROM pages, range(1, 4) r(i)""")
def url_expand(t):
    line = F.concat_ws(",", "page_id", "url", F.concat("url", F.lit("/a.PNG")), F.concat("url", F.lit("/b.tiff")))
    return jw.expand_assets(t.pages.select(line.alias("line")), "line", 8)


@query("log_stats", """
SELECT '10.0.' || (user_id % 7) || '.1' AS ip, '"u' || user_id || '"' AS "user", 'GET /' || event_type || ' HTTP/1.1' AS query, count(*) AS hits, sum(event_id % 900)::BIGINT AS bytes
FROM events WHERE event_type <> 'error' GROUP BY ALL UNION ALL SELECT NULL, NULL, NULL, count(*), sum(event_id % 900)::BIGINT FROM events WHERE event_type = 'error'""")
def log_stats(t):
    user = F.when(F.col("event_type") == "error", '"-"').otherwise(F.concat(F.lit('"u'), "user_id", F.lit('"')))
    line = F.format_string('10.0.%d.1 - %s [%s +0000] "GET /%s HTTP/1.1" 200 %d "http://from" "agent" tail', F.col("user_id") % 7, user,
                           F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), "event_type", F.col("event_id") % 900)
    return jw.log_stats(t.spark.read.text(staged(t.events.select(line.alias("value")), "access_log", "text")))


RUNS = """p AS (SELECT user_id, event_type, row_number() OVER w AS pos, lag(event_type) OVER w AS prev FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(CASE WHEN pos = 1 OR event_type <> prev THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pos) AS run FROM p),
r AS (SELECT user_id, run::BIGINT AS run, min(event_type) AS sym, count(*) AS length FROM n GROUP BY user_id, run)"""


@query("run_length", f"""
WITH {RUNS} SELECT user_id, run, length, CASE WHEN length > 3 THEN sym || 'X' || length ELSE repeat(sym, length) END AS token FROM r""")
def run_length(t):
    return jw.compressed_runs(t.events, ["user_id"], ["ts", "event_id"], "event_type")


@query("longest_span", """
WITH p AS (SELECT user_id, event_type AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
l AS (SELECT user_id, pos, coalesce(max(CASE WHEN s = 'error' THEN pos END) OVER w, 0) AS a, coalesce(max(CASE WHEN s = 'click' THEN pos END) OVER w, 0) AS b, coalesce(max(CASE WHEN s = 'view' THEN pos END) OVER w, 0) AS c,
  coalesce(max(CASE WHEN s = 'signup' THEN pos END) OVER w, 0) AS d, coalesce(max(CASE WHEN s = 'purchase' THEN pos END) OVER w, 0) AS e FROM p WINDOW w AS (PARTITION BY user_id ORDER BY pos))
SELECT user_id, max(pos - list_reverse_sort([a, b, c, d, e])[3]) AS longest FROM l GROUP BY user_id""")
def longest_span(t):
    return jw.longest_two_symbol_span(t.events, ["user_id"], ["ts", "event_id"], "event_type")
