"""Generators and row transforms."""

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import rows as fr
from millrace.operators import reshape as rs
from millrace.registry import query


@query("gen_explode", """
SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings""")
def gen_explode(t):
    return rs.lateral(t.embeddings, F.explode("embedding"), ["x"], ["vec_id"]).withColumn("x", F.col("x").cast("double"))


@query("gen_explode_outer", """
SELECT doc_id, w FROM documents LEFT JOIN LATERAL (SELECT unnest(list_filter(string_split(text, ' '), lambda x: x LIKE 'q%')) AS w) ON true""")
def gen_explode_outer(t):
    words = F.filter(F.split("text", " ", -1), lambda w: w.like("q%"))
    return rs.lateral(t.documents, F.explode_outer(words), ["w"], ["doc_id"])


@query("gen_posexplode", """
SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM (SELECT doc_id, string_split(lang || ' ' || source || ' ' || n_chars, ' ') AS w FROM documents)""")
def gen_posexplode(t):
    return rs.lateral(t.documents, F.posexplode(F.split(F.concat_ws(" ", "lang", "source", "n_chars"), " ")), ["pos", "word"], ["doc_id"]).withColumn(
        "pos", F.col("pos").cast("bigint"))


@query("gen_stack", """
SELECT p_partkey, 'size' AS what, p_size::DOUBLE AS v FROM part UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part""")
def gen_stack(t):
    return t.part.select("p_partkey", F.stack(F.lit(2), F.lit("size"), F.col("p_size").cast("double"), F.lit("price"), F.col("p_retailprice")).alias("what", "v"))


@query("gen_unpivot", """
UNPIVOT (SELECT l_returnflag, sum(l_discount)::DECIMAL(20, 2)::DOUBLE AS discount, sum(l_tax)::DECIMAL(20, 2)::DOUBLE AS tax FROM lineitem GROUP BY 1)
ON discount, tax INTO NAME what VALUE v""")
def gen_unpivot(t):
    sums = t.lineitem.groupBy("l_returnflag").agg(F.round(F.sum("l_discount"), 2).alias("discount"), F.round(F.sum("l_tax"), 2).alias("tax"))
    return rs.unstack(sums, ["l_returnflag"], ["discount", "tax"], "what", "v")


@query("gen_inline", """
SELECT c_custkey, a, b FROM (SELECT c_custkey, unnest([{'a': c_nationkey, 'b': c_mktsegment}, {'a': c_nationkey + 100, 'b': c_name}], recursive := true) FROM customer)""")
def gen_inline(t):
    pair = F.array(F.struct(F.col("c_nationkey").alias("a"), F.col("c_mktsegment").alias("b")),
                   F.struct((F.col("c_nationkey") + 100).alias("a"), F.col("c_name").alias("b")))
    return t.customer.select("c_custkey", F.inline(pair))


@query("gen_json_tuple", """
SELECT event_id, props->>'k' AS k, props->>'missing' AS none FROM events""")
def gen_json_tuple(t):
    return t.events.select("event_id", F.json_tuple("props", "k", "missing").alias("k", "none"))


@query("transform_script", """
SELECT n_nationkey AS k, upper(n_name || ' of') AS label, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""")
def transform_script(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.concat("n_name", F.lit(" of")), "r_name").distinct()
    return rs.through_script(rows, "upper", "k int, label string, region string")


@query("transform_script_fields", """
SELECT p_size AS size, p_brand AS brand, p_partkey AS k FROM part""")
def transform_script_fields(t):
    return rs.through_script(t.part.select("p_partkey", "p_brand", "p_size"), "reverse_fields", "size int, brand string, k bigint")


@query("map_in_pandas", """
SELECT o_orderkey, floor(o_totalprice / 1000)::BIGINT AS thousands FROM orders WHERE o_orderstatus = 'P'""")
def map_in_pandas(t):
    def work(frames):
        for f in frames:
            f = f[f.o_orderstatus == "P"]
            yield pd.DataFrame({"o_orderkey": f.o_orderkey, "thousands": (f.o_totalprice // 1000).astype("int64")})

    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").mapInPandas(work, "o_orderkey bigint, thousands bigint")


@query("udf_scalar", """
SELECT p_partkey, upper(p_name) || '!' AS loud, p_size * 2 AS twice FROM part""")
def udf_scalar(t):
    @F.pandas_udf("string")
    def loud(s: pd.Series) -> pd.Series:
        return s.str.upper() + "!"

    @F.pandas_udf("int")
    def twice(s: pd.Series) -> pd.Series:
        return s * 2

    return t.part.select("p_partkey", loud("p_name").alias("loud"), twice("p_size").alias("twice"))


@query("udf_iterator", """
SELECT c_custkey, round(c_acctbal * 1.1, 4) AS lifted FROM customer""")
def udf_iterator(t):
    from collections.abc import Iterator

    @F.pandas_udf("double")
    def lifted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in parts:
            yield p * 1.1

    return t.customer.select("c_custkey", F.round(lifted("c_acctbal"), 4).alias("lifted"))


@query("udf_series_to_scalar", """
SELECT p_brand, round(sqrt(sum(n * p_size * p_size) / sum(n)), 6) AS rms, sum(n)::BIGINT AS n FROM (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ALL) GROUP BY p_brand""")
def udf_series_to_scalar(t):
    """A function from series to one value, by its type hints. It takes a row per value, so no group grows with the table."""
    @F.pandas_udf("double")
    def rms(size: pd.Series, n: pd.Series) -> float:
        return float(((size.astype("float64") ** 2 * n).sum() / n.sum()) ** 0.5)

    counts = t.part.groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    whole = counts.groupBy("p_brand").agg(F.sum("n").alias("n"))
    return counts.groupBy("p_brand").agg(rms("p_size", "n").alias("rms")).join(whole, "p_brand").select("p_brand", F.round("rms", 6).alias("rms"), "n")


@query("udf_agg", """
SELECT l_returnflag, round(sqrt(sum(l_quantity * l_quantity) / count(*)), 6) AS rms FROM lineitem GROUP BY l_returnflag""")
def udf_agg(t):
    """A user aggregate as an algebraic buffer: Arrow batches are folded to partial sums, then merged by Spark."""
    def fold(frames):
        for f in frames:
            g = f.assign(s=f.l_quantity**2, n=1).groupby("l_returnflag", as_index=False)[["s", "n"]].sum()
            yield g

    parts = t.lineitem.select("l_returnflag", "l_quantity").mapInPandas(fold, "l_returnflag string, s double, n bigint")
    return parts.groupBy("l_returnflag").agg(F.round(F.sqrt(F.sum("s") / F.sum("n")), 6).alias("rms"))


@query("udf_clauses", """
SELECT p_size % 3 + 1 AS g, count(*) AS n, max(p_retailprice) AS top FROM part WHERE p_size + 1 > 10 GROUP BY 1 HAVING count(*) + 1 > 2""")
def udf_clauses(t):
    @F.pandas_udf("bigint")
    def plus_one(s: pd.Series) -> pd.Series:
        return s + 1

    g = t.part.where(plus_one("p_size") > 10).groupBy(plus_one(F.col("p_size") % 3).alias("g")).agg(F.count("*").alias("n"), F.max("p_retailprice").alias("top"))
    return g.where(plus_one("n") > 2)


@query("udf_macro", """
SELECT c_custkey, round(1.0 / (1.0 + exp(-c_acctbal / 1000.0)), 10) AS s FROM customer""")
def udf_macro(t):
    out = fr.apply_macro(t.customer, "sigmoid", "x DOUBLE", "DOUBLE", "1.0 / (1.0 + EXP(-x))", ["c_acctbal / 1000.0"], "s")
    return out.select("c_custkey", F.round("s", 10).alias("s"))


@query("udf_in_file", """
SELECT c_custkey, c_mktsegment IN (SELECT c_mktsegment FROM customer GROUP BY 1 HAVING sum(c_acctbal) > (SELECT sum(c_acctbal) / 5 FROM customer)) AS in_file FROM customer""")
def udf_in_file(t):
    from millrace.sources.tables import staged

    sums = t.customer.groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("s"))
    total = t.customer.agg((F.sum("c_acctbal") / 5).alias("mean"))
    path = staged(sums.join(total, F.col("s") > F.col("mean")).select("c_mktsegment"), "segments", "text")
    return fr.in_lines(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", path).select("c_custkey", "in_file")


@query("fn_field", """
SELECT o_orderkey, coalesce(list_position(['O', 'F'], o_orderstatus), 0)::INT AS place FROM orders""")
def fn_field(t):
    return t.orders.select("o_orderkey", fr.position_of("o_orderstatus", "O", "F").alias("place"))


@query("fn_tagged_union", """
SELECT p_partkey, (p_size % 2)::INT AS tag, CASE WHEN p_size % 2 = 0 THEN p_retailprice END AS v0, CASE WHEN p_size % 2 = 1 THEN p_name END AS v1 FROM part""")
def fn_tagged_union(t):
    return t.part.select("p_partkey", fr.tagged_union(F.col("p_size") % 2, F.col("p_retailprice"), F.col("p_name")).alias("u")).select("p_partkey", "u.*")


@query("fn_bitmap_arrays", """
SELECT l_orderkey, l_partkey, l_suppkey, l_partkey & l_suppkey AS a0, l_partkey | l_suppkey AS o0, (l_partkey & l_suppkey) = 0 AS none FROM lineitem""")
def fn_bitmap_arrays(t):
    a, b = F.array("l_partkey"), F.array("l_suppkey")
    met = fr.bitmap_array_and(a, b)
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", met[0].alias("a0"), fr.bitmap_array_or(a, b)[0].alias("o0"),
                             fr.bitmap_array_empty(met).alias("none"))
