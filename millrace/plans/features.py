"""Feature operators with SQL twins."""

from pyspark.sql import functions as F

from millrace.operators import features as of
from millrace.registry import query
from millrace.session import spread

STOP = ["the", "and", "of", "to", "in", "de", "la", "le", "die", "der", "und", "el", "que", "les"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
TOK = "tok AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: length(w) >= 1) AS w FROM documents)"


def r(c, name, digits=6):
    return F.round(c, digits).alias(name)


def docs(t):
    return spread(t.documents.select("doc_id", "text"), "doc_id")


@query("feat_tokens", f"WITH {TOK} SELECT doc_id, len(w)::INT AS n, w[1] AS first, w[-1] AS last FROM tok")
def feat_tokens(t):
    w = of.tokens("text")
    return t.documents.select("doc_id", F.size(w).alias("n"), F.get(w, F.lit(0)).alias("first"), F.try_element_at(w, F.lit(-1)).alias("last"))


@query("feat_regex_tokens", """
SELECT doc_id, len(list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: length(w) >= 3))::INT AS n FROM documents""")
def feat_regex_tokens(t):
    return t.documents.select("doc_id", F.size(of.tokens("text", "[a-z]+", gaps=False, min_length=3)).alias("n"))


@query("feat_ngrams", f"""
WITH {TOK}, g AS (SELECT doc_id, unnest(list_zip(w[:-2], w[2:])) AS p FROM tok WHERE len(w) >= 2) SELECT p[1] || ' ' || p[2] AS ngram, count(*) AS n, count(DISTINCT doc_id) AS docs FROM g GROUP BY 1""")
def feat_ngrams(t):
    grams = docs(t).select("doc_id", F.explode(of.ngrams(of.tokens("text"), 2)).alias("ngram"))
    return grams.groupBy("ngram").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


@query("feat_stopwords", f"WITH {TOK} SELECT doc_id, len(list_filter(w, lambda x: x NOT IN ({STOP_SQL})))::INT AS kept FROM tok")
def feat_stopwords(t):
    return t.documents.select("doc_id", F.size(of.without(of.tokens("text"), STOP)).alias("kept"))


@query("feat_vocabulary", f"""
WITH {TOK}, c AS (SELECT doc_id, unnest(w) AS term FROM tok) SELECT term, count(DISTINCT doc_id) AS df, count(*) AS total FROM c GROUP BY term HAVING count(DISTINCT doc_id) >= 5 ORDER BY total DESC, term LIMIT 500""")
def feat_vocabulary(t):
    return of.vocabulary(of.term_counts(docs(t), "doc_id", of.tokens("text")), 500, 5)


@query("feat_tfidf", f"""
WITH {TOK}, c AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM tok) GROUP BY ALL),
i AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM c GROUP BY term HAVING count(*) >= 2)
SELECT doc_id, count(*) AS terms, round(sum(tf * idf), 4) AS weight, round(max(tf * idf), 6) AS top FROM c JOIN i USING (term) GROUP BY doc_id""")
def feat_tfidf(t):
    return of.tf_idf(docs(t), "doc_id", of.tokens("text"), 2).groupBy("doc_id").agg(
        F.count("*").alias("terms"), r(F.sum("tfidf"), "weight", 4), r(F.max("tfidf"), "top"))


SCALERS = {
    "minmax": "(x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ())",
    "standard": "(x - avg(x) OVER ()) / stddev_samp(x) OVER ()",
    "maxabs": "x / max(abs(x)) OVER ()",
    "robust": "(x - (SELECT quantile_cont(c_acctbal, 0.5) FROM customer)) / (SELECT quantile_cont(c_acctbal, 0.75) - quantile_cont(c_acctbal, 0.25) FROM customer)",
}


def _scaler(method):
    def build(t):
        return of.scaled(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"], method).select("c_custkey", r(F.col("c_acctbal_scaled"), "x", 8))

    return build


for _method, _formula in SCALERS.items():
    query(f"feat_scale_{_method}", f"SELECT c_custkey, round({_formula}, 8) AS x FROM (SELECT c_custkey, c_acctbal AS x FROM customer)")(_scaler(_method))


@query("feat_normalize", """
SELECT vec_id, round(embedding[1] / n, 6) AS x1, round(embedding[64] / n, 6) AS x64, round(n1, 5) AS n1 FROM (SELECT *, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n,
 list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))) AS n1 FROM embeddings)""")
def feat_normalize(t):
    v = of.normalized(F.col("embedding"))
    return t.embeddings.select("vec_id", r(v[0], "x1"), r(v[63], "x64"), r(of.p_norm(F.col("embedding"), 1.0), "n1", 5))


@query("feat_elementwise", """
SELECT vec_id, round(embedding[1]::DOUBLE * 0.5, 6) AS a, round(embedding[2]::DOUBLE * 2, 6) AS b, round(embedding[3]::DOUBLE * embedding[6]::DOUBLE, 6) AS i FROM embeddings""")
def feat_elementwise(t):
    e = F.transform("embedding", lambda x: x.cast("double"))
    w = of.elementwise(F.slice(e, 1, 2), [0.5, 2.0])
    return t.embeddings.select("vec_id", r(w[0], "a"), r(w[1], "b"), r(of.interaction(F.slice(e, 1, 3), F.slice(e, 4, 3))[8], "i"))


@query("feat_bucketize", """
SELECT p_partkey, CASE WHEN p_size < 10 THEN 0.0 WHEN p_size < 25 THEN 1.0 WHEN p_size <= 50 THEN 2.0 END::DOUBLE AS bin, (p_retailprice > 950)::INT::DOUBLE AS dear FROM part""")
def feat_bucketize(t):
    return t.part.select("p_partkey", of.bins("p_size", [0, 10, 25, 50]).alias("bin"), (F.col("p_retailprice") > 950).cast("double").alias("dear"))


@query("feat_quantile_bins", """
WITH q AS (SELECT quantile_cont(c_acctbal, 0.25) AS a, quantile_cont(c_acctbal, 0.5) AS b, quantile_cont(c_acctbal, 0.75) AS c FROM customer)
SELECT c_custkey, ((c_acctbal >= a)::INT + (c_acctbal >= b)::INT + (c_acctbal >= c)::INT)::DOUBLE AS bin FROM customer, q""")
def feat_quantile_bins(t):
    return of.quantile_bins(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 4, "bin").select("c_custkey", "bin")


CODES = "codes AS (SELECT c_mktsegment, (row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1)::DOUBLE AS code FROM customer GROUP BY 1)"


@query("feat_string_index", f"WITH {CODES} SELECT c_custkey, code, c_mktsegment AS back FROM customer JOIN codes USING (c_mktsegment)")
def feat_string_index(t):
    coded, table = of.string_index(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "code")
    return coded.select("c_custkey", "code").join(table.withColumnRenamed("c_mktsegment", "back"), "code")


@query("feat_one_hot", f"""
WITH {CODES} SELECT c_custkey, (code = 0)::INT::DOUBLE AS h0, (code = 1)::INT::DOUBLE AS h1, (code = 2)::INT::DOUBLE AS h2, (code = 3)::INT::DOUBLE AS h3 FROM customer JOIN codes USING (c_mktsegment)""")
def feat_one_hot(t):
    coded, _ = of.string_index(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "code")
    hot = of.one_hot("code", 5)
    return coded.select("c_custkey", *[hot[i].alias(f"h{i}") for i in range(4)])


@query("feat_impute", """
WITH x AS (SELECT p_partkey, nullif(p_size, 7)::DOUBLE AS v FROM part), m AS (SELECT avg(v) AS a, median(v) AS b, (SELECT v FROM x WHERE v IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1) AS c FROM x)
SELECT p_partkey, round(coalesce(v, a), 6) AS mean_fill, coalesce(v, b) AS median_fill, coalesce(v, c) AS mode_fill FROM x, m""")
def feat_impute(t):
    x = t.part.select("p_partkey", F.expr("nullif(p_size, 7)").alias("v"))
    parts = [of.imputed(x, "v", how).select("p_partkey", F.col("v_filled").alias(f"{how}_fill")) for how in ("mean", "median", "mode")]
    out = parts[0].join(parts[1], "p_partkey").join(parts[2], "p_partkey")
    return out.withColumn("mean_fill", F.round("mean_fill", 6))


@query("feat_sql_transform", """SELECT p_partkey, p_size + 1 AS v, p_size * p_retailprice AS w FROM part WHERE p_size > 5""")
def feat_sql_transform(t):
    from pyspark.ml.feature import SQLTransformer

    return SQLTransformer(statement="SELECT p_partkey, p_size + 1 AS v, p_size * p_retailprice AS w FROM __THIS__ WHERE p_size > 5").transform(t.part)


@query("feat_assoc_pairs", """
WITH b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON p_partkey = l_partkey), n AS (SELECT count(DISTINCT o) AS n FROM b), s AS (SELECT i, count(*) AS c FROM b GROUP BY i HAVING count(*) >= 0.02 * (SELECT n FROM n)),
p AS (SELECT x.i AS a, y.i AS c, count(*) AS ab FROM b x JOIN b y ON x.o = y.o AND x.i <> y.i WHERE x.i IN (SELECT i FROM s) AND y.i IN (SELECT i FROM s) GROUP BY ALL)
SELECT a AS antecedent, p.c AS consequent, round(ab / n, 8) AS support, round(ab / sa.c, 8) AS confidence, round(ab * n / (sa.c * sb.c), 8) AS lift
FROM p, n, s sa, s sb WHERE sa.i = a AND sb.i = p.c AND ab >= 0.02 * n""")
def feat_assoc_pairs(t):
    rows = t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    rules = of.item_pairs(rows, "l_orderkey", "p_brand", 0.02)
    return rules.select("antecedent", "consequent", r(F.col("support"), "support", 8), r(F.col("confidence"), "confidence", 8), r(F.col("lift"), "lift", 8))


@query("feat_ols", """
SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 2) AS value FROM lineitem UNION ALL SELECT 'slope', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem""")
def feat_ols(t):
    fit = t.lineitem.agg(F.regr_intercept("l_extendedprice", "l_quantity").alias("a"), F.regr_slope("l_extendedprice", "l_quantity").alias("b"))
    return fit.select(F.stack(F.lit(2), F.lit("intercept"), F.round("a", 2), F.lit("slope"), F.round("b", 4)).alias("term", "value"))


@query("feat_least_squares", """
WITH g AS (SELECT covar_pop(l_quantity, l_extendedprice) AS qy, covar_pop(l_tax, l_extendedprice) AS ty, var_pop(l_quantity) AS qq, var_pop(l_tax) AS tt, covar_pop(l_quantity, l_tax) AS qt FROM lineitem)
SELECT 'l_quantity' AS term, round((qy * tt - ty * qt) / (qq * tt - qt * qt), 2) AS value FROM g UNION ALL SELECT 'l_tax', round((ty * qq - qy * qt) / (qq * tt - qt * qt), 2) FROM g""")
def feat_least_squares(t):
    fit = of.least_squares(t.lineitem, ["l_quantity", "l_tax"], "l_extendedprice")
    return t.spark.createDataFrame([(c, round(fit[c], 2)) for c in ("l_quantity", "l_tax")], "term string, value double")


CENTRES = [[0.1 if (d + 7 * c) % 5 == 0 else -0.05 for d in range(64)] for c in range(4)]


@query("feat_kmeans_step", "WITH c AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {[float(x) for x in c]}::DOUBLE[])" for i, c in enumerate(CENTRES)) + """) v(i, c)),
d AS (SELECT vec_id, i, list_sum(list_transform(list_zip(embedding, c), lambda p: pow(p[1]::DOUBLE - p[2], 2))) AS d FROM embeddings, c)
SELECT vec_id, i::INT AS cluster FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, i) = 1""")
def feat_kmeans_step(t):
    return of.kmeans(t.embeddings, "vec_id", "embedding", CENTRES, 1)[0]


@query("feat_centre_means", """
SELECT label, i::INT AS i, round(avg(x), 6) AS x FROM (SELECT label, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL""")
def feat_centre_means(t):
    return of.centre_means(t.embeddings, "embedding", "label").select("label", "i", r(F.col("x"), "x"))


@query("feat_cosine_to_label", """
WITH m AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS x FROM (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL) GROUP BY label)
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], c), 6) AS cosine FROM embeddings JOIN m USING (label)""")
def feat_cosine_to_label(t):
    centres = of.centre_means(t.embeddings, "embedding", "label").groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("p"))
    c = F.col("p.x")
    return t.embeddings.join(centres, "label").select("vec_id", r(of.dot(F.col("embedding"), c) / (of.p_norm(F.col("embedding")) * of.p_norm(c)), "cosine"))
