"""Access-log statistics, asset URL lists, and sequence summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.skew import hot_keys
from millrace.operators.windows import HOT_ROWS, neighbours, running, runs

# fixed pattern of a combined access-log line: host, ident, user, time, request, status, bytes, referer, agent
LOG_LINE = r'^([\d.]+) (\S+) (\S+) \[([\w\d:/]+\s[+\-]\d{4})\] "(.+?)" (\d{3}) ([\d\-]+) "([^"]+)" "([^"]+)".*'

# fixed list, tested in this order; anything else counts as jpeg
FORMATS = ("jpeg", "jpg", "png", "gif", "tiff", "bmp", "exif")


def log_stats(lines: DataFrame, column: str = "value") -> DataFrame:
    """Hits and bytes per (ip, user, query). Lines that do not parse, or have no user, share a null key."""
    c = F.col(column)
    ok = c.rlike(LOG_LINE)
    part = lambda i: F.regexp_extract(c, LOG_LINE, i)
    named = ok & (part(3) != '"-"')
    bytes_sent = F.when(ok, F.coalesce(part(7).try_cast("bigint"), F.lit(0))).otherwise(0)
    rows = lines.select(F.when(named, part(1)).alias("ip"), F.when(named, part(3)).alias("user"), F.when(named, part(5)).alias("query"), bytes_sent.alias("_b"))
    return rows.groupBy("ip", "user", "query").agg(F.count("*").alias("hits"), F.sum("_b").alias("bytes"))


def image_format(url: Column) -> Column:
    out = F.lit("jpeg")
    for f in reversed(FORMATS):
        out = F.when(F.contains(url, F.lit(f)), f).otherwise(out)
    return out


def expand_assets(lines: DataFrame, column: str, buckets: int) -> DataFrame:
    """``item,url,url,...`` lines to one row per URL: ordinal, three-digit suffix, format and bucket.

    Past 999 URLs the suffix is ERROR and the row is flagged.
    """
    fields = F.split(F.col(column), ",")
    rows = lines.select(F.element_at(fields, 1).cast("bigint").alias("item_id"), F.posexplode(F.slice(fields, 2, F.greatest(F.size(fields) - 1, F.lit(0)))).alias("_i", "url"))
    n = F.col("_i") + 1
    return rows.select(
        "item_id", n.alias("ordinal"), F.when(n < 1000, F.lpad(n.cast("string"), 3, "0")).otherwise("ERROR").alias("suffix"),
        "url", image_format(F.lower("url")).alias("format"), F.pmod("item_id", F.lit(buckets)).alias("bucket"), (n >= 1000).alias("too_many"))


def compressed_runs(df: DataFrame, keys: list[str], order: list[str], symbol: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Runs longer than three as ``symbolXcount``, shorter ones spelled out: one token per run, in run order."""
    r = runs(df, keys, order, symbol, min_rows)
    token = F.when(F.col("length") > 3, F.concat(F.col(symbol), F.lit("X"), F.col("length"))).otherwise(F.repeat(F.col(symbol), F.col("length").cast("int")))
    return r.select(*keys, "run", "length", token.alias("token"))


def longest_two_symbol_span(df: DataFrame, keys: list[str], order: list[str], symbol: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Length of the longest stretch with at most two distinct symbols, per key.

    In the sequence of runs a stretch goes on as long as each run repeats the symbol two runs before it; where it does
    not, a new stretch begins that also takes in the run just before.
    """
    hot = hot_keys(df, keys, min_rows)
    r = runs(df, keys, order, symbol, min_rows, hot).select(*keys, "run", symbol, "length")
    prior = neighbours(r, keys, ["run"], 2, 0, lambda w: [
        F.lag(symbol, 2).over(w).alias("_two"), F.lag("length", 1).over(w).alias("_before")], min_rows, hot=hot)
    starts = (F.col("run") > 2) & ~F.col(symbol).eqNullSafe(F.col("_two"))
    blocks = running(prior.withColumn("_new", starts.cast("bigint")), keys, ["run"], sums={"_block": F.col("_new")}, min_rows=min_rows, hot=hot)
    spans = blocks.groupBy(*keys, "_block").agg((F.sum("length") + F.sum(F.when(F.col("_new") == 1, F.col("_before")).otherwise(0))).alias("_span"))
    return spans.groupBy(*keys).agg(F.max("_span").alias("longest"))


def level_minimum(levels: DataFrame, level: str, value: str) -> DataFrame:
    """Smallest value on each level of a tree whose depths are known."""
    return levels.groupBy(level).agg(F.min(value).alias("smallest"))
