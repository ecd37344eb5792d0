"""Samples, sketches, tests and metrics."""

from pyspark.sql import functions as F

from millrace.operators import sampling as sp, stats as st
from millrace.operators.skew import same_keys
from millrace.registry import query


def rounded(df, digits=6):
    """Every double column rounded, for comparison."""
    return df.select(*[F.round(c, digits).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


@query("sample_bucket", """SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey % 16 = 2 GROUP BY l_returnflag""")
def sample_bucket(t):
    return sp.bucket_of_key(t.lineitem, 3, 16, "l_orderkey").groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("sample_buckets_cover", """SELECT count(*) AS n FROM orders""")
def sample_buckets_cover(t):
    """The buckets by hash split the table: their sizes add up to it."""
    parts = [sp.bucket(t.orders, x, 4, "o_orderkey").agg(F.count("*").alias("n")) for x in (1, 2, 3, 4)]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3]).agg(F.sum("n").alias("n"))


@query("sample_bernoulli")
def sample_bernoulli(t):
    return sp.percent(t.lineitem, 5, 42).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.avg("l_quantity").alias("mean"))


@query("sample_poisson")
def sample_poisson(t):
    return sp.poisson_sample(t.orders, 1.5, ["o_orderkey"], 5).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("orders"))


@query("sample_split", """SELECT count(*) AS total, 0::BIGINT AS twice FROM orders""")
def sample_split(t):
    parts = sp.split(t.orders.select("o_orderkey"), ["o_orderkey"], [0.7, 0.2, 0.1], 9)
    ids = parts[0].union(parts[1]).union(parts[2])
    return ids.groupBy("o_orderkey").agg(F.count("*").alias("n")).agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 1).alias("twice"))


@query("sample_stratified")
def sample_stratified(t):
    return sp.stratified(t.orders, "o_orderstatus", {"F": 0.5, "O": 0.1}, ["o_orderkey"], 3).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("sample_reservoir", """SELECT least(count(*), 200) AS n FROM orders""")
def sample_reservoir(t):
    return sp.reservoir(t.orders.select("o_orderkey"), 200, ["o_orderkey"], 3).agg(F.countDistinct("o_orderkey").alias("n"))


@query("sample_reservoir_count", """SELECT count(*) AS total, least(count(*), 200) AS n, least(count(*), 200) AS there FROM orders""")
def sample_reservoir_count(t):
    """200 rows, all different and all from the table, and the number of rows, from one pass."""
    found, total = sp.reservoir_and_count(t.orders.select("o_orderkey", "o_totalprice"), 200, 3)
    back = found.distinct().join(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey", "o_totalprice"], "left_semi")
    return back.agg(F.lit(total).cast("bigint").alias("total"), F.count("*").alias("there")).withColumn("n", F.lit(found.count()).cast("bigint"))


@query("sample_wanted_size")
def sample_wanted_size(t):
    """A fraction large enough that 500 rows are there almost surely, then 500 of them."""
    total = t.orders.count()
    part = sp.percent(t.orders, 100 * sp.fraction_for(500, total), 8)
    return sp.reservoir(part.select("o_orderkey"), 500, ["o_orderkey"], 8)


@query("freq_items", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type HAVING count(*) > 0.15 * (SELECT count(*) FROM events)""")
def freq_items(t):
    return sp.frequent_items(t.events.select("event_type"), "event_type", 0.15)


@query("sketch_cms")
def sketch_cms(t):
    sketch = sp.count_min_table(t.lineitem, "l_partkey", 5, 2000)
    return sp.count_min_estimate(sketch, t.part.select(F.col("p_partkey").alias("l_partkey")), "l_partkey", 5, 2000)


@query("sketch_cms_builtin")
def sketch_cms_builtin(t):
    return sp.count_min(t.lineitem, "l_partkey", 0.001, 0.99, 7, ["l_returnflag"]).select("l_returnflag", F.length("sketch").alias("bytes"))


@query("sketch_bloom", """SELECT count(*) AS members, count(*) AS found FROM customer WHERE c_acctbal > 0""")
def sketch_bloom(t):
    """No member may be missed; the filter is merged from two halves."""
    members = t.customer.where("c_acctbal > 0").select("c_custkey")
    bloom = sp.bloom_merge(*[sp.bloom_build(members.where(F.col("c_custkey") % 2 == i), "c_custkey", 1 << 18, 5) for i in (0, 1)])
    return sp.bloom_might_contain(members, "c_custkey", bloom, 1 << 18, 5).agg(F.count("*").alias("members"), F.count_if("maybe").alias("found"))


@query("sketch_bloom_misses")
def sketch_bloom_misses(t):
    members = t.customer.where("c_acctbal > 0").select("c_custkey")
    others = t.customer.where("c_acctbal <= 0").select("c_custkey")
    bloom = sp.bloom_build(members, "c_custkey", 1 << 18, 5)
    return sp.bloom_might_contain(others, "c_custkey", bloom, 1 << 18, 5).agg(F.count("*").alias("others"), F.count_if("maybe").alias("false_hits"))


@query("approx_distinct")
def approx_distinct(t):
    # apart: beside a distinct count Spark would keep a sketch for every flag and order
    about = t.lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", 0.02).alias("about"))
    exact = t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_orderkey").alias("exact"))
    return about.alias("a").join(exact.alias("e"), same_keys("a", "e", ["l_returnflag"])).select("a.l_returnflag", "about", "exact")


@query("stat_correlation", """
SELECT 'q' AS "left", 'p' AS "right", round(corr(l_quantity, l_extendedprice), 8) AS r FROM lineitem UNION ALL SELECT 'q', 'd', round(corr(l_quantity, l_discount), 8) FROM lineitem
UNION ALL SELECT 'p', 'd', round(corr(l_extendedprice, l_discount), 8) FROM lineitem""")
def stat_correlation(t):
    rows = t.lineitem.select(F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("p"), F.col("l_discount").alias("d"))
    return rounded(st.correlation(rows, ["q", "p", "d"]).where(F.col("left") != F.col("right")), 8)


@query("stat_spearman", """
WITH n AS (SELECT p_size, p_retailprice, rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0 AS a,
  rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0 AS b FROM part)
SELECT round(corr(a, b), 8) AS r FROM n""")
def stat_spearman(t):
    return rounded(st.spearman(t.part, "p_size", "p_retailprice"), 8)


@query("stat_matrix")
def stat_matrix(t):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    rows = VectorAssembler(inputCols=["l_quantity", "l_extendedprice", "l_discount"], outputCol="v").transform(t.lineitem)
    return Correlation.corr(rows.select("v"), "v", "pearson").select(F.col("pearson(v)").cast("string").alias("matrix"))


CHI = """
WITH c AS (SELECT l_returnflag AS f, l_linestatus AS g, count(*) AS o FROM lineitem GROUP BY ALL),
e AS (SELECT f, g, o, sum(o) OVER (PARTITION BY f) * sum(o) OVER (PARTITION BY g) / sum(o) OVER ()::DOUBLE AS e FROM c)
SELECT round(sum((o - e) * (o - e) / e), 6) AS statistic, ((count(DISTINCT f) - 1) * (count(DISTINCT g) - 1))::BIGINT AS degrees FROM e"""


@query("stat_chi_square", CHI)
def stat_chi_square(t):
    return rounded(st.chi_square(t.lineitem, "l_returnflag", "l_linestatus"))


@query("stat_f_regression", """
WITH s AS (SELECT count(*) - 2 AS d, corr(l_quantity, l_extendedprice) AS a, corr(l_tax, l_extendedprice) AS b FROM lineitem)
SELECT 'l_quantity' AS feature, round(a * a / (1 - a * a) * d, 4) AS f, d AS degrees FROM s UNION ALL SELECT 'l_tax', round(b * b / (1 - b * b) * d, 4), d FROM s""")
def stat_f_regression(t):
    return rounded(st.f_regression(t.lineitem, ["l_quantity", "l_tax"], "l_extendedprice"), 4)


@query("stat_anova", """
WITH g AS (SELECT l_returnflag, count(*) AS n, avg(l_quantity) AS m, var_pop(l_quantity) AS v FROM lineitem GROUP BY 1),
s AS (SELECT sum(n) AS n, count(*) AS k, sum(n * v) AS w, sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n) AS b FROM g)
SELECT 'l_quantity' AS feature, round((b / (k - 1)) / (w / (n - k)), 4) AS f, (k - 1)::BIGINT AS "between", (n - k)::BIGINT AS within FROM s""")
def stat_anova(t):
    return rounded(st.anova(t.lineitem, ["l_quantity"], "l_returnflag"), 4)


@query("stat_ks", """
WITH v AS (SELECT l_quantity AS x, count(*) AS n FROM lineitem GROUP BY 1), u AS (SELECT x, n, sum(n) OVER (ORDER BY x) AS upto, sum(n) OVER () AS t FROM v)
SELECT round(max(greatest(upto / t - x / 50, x / 50 - (upto - n) / t)), 8) AS statistic FROM u""")
def stat_ks(t):
    return rounded(st.ks_statistic(t.lineitem, "l_quantity", F.col("l_quantity") / 50), 8)


@query("stat_ks_normal")
def stat_ks_normal(t):
    return st.ks_statistic(t.lineitem, "l_quantity", st.normal_cdf(F.col("l_quantity"), 25.5, 14.4))


@query("stat_kde", """
SELECT p AS point, round(avg(exp(-pow(l_quantity - p, 2) / 18.0)) / (3 * sqrt(2 * pi())), 8) AS density FROM lineitem, (VALUES (5.0::DOUBLE), (25.0::DOUBLE), (60.0::DOUBLE)) v(p) GROUP BY p""")
def stat_kde(t):
    return rounded(st.kernel_density(t.lineitem, "l_quantity", [5, 25, 60], 3.0), 8)


@query("stat_summary", """
SELECT 'l_quantity' AS "column", count(*) AS n, round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 6) AS variance, min(l_quantity) AS low, max(l_quantity) AS high,
 count(*) FILTER (WHERE l_quantity <> 0) AS non_zero, round(sum(abs(l_quantity)), 6) AS norm1, round(sqrt(sum(l_quantity * l_quantity)), 6) AS norm2 FROM lineitem
UNION ALL SELECT 'l_tax', count(*), round(avg(l_tax), 6), round(var_samp(l_tax), 6), min(l_tax), max(l_tax), count(*) FILTER (WHERE l_tax <> 0), round(sum(abs(l_tax)), 6), round(sqrt(sum(l_tax * l_tax)), 6) FROM lineitem""")
def stat_summary(t):
    return rounded(st.summary(t.lineitem, ["l_quantity", "l_tax"]))


@query("metric_auc", """
WITH p AS (SELECT l_quantity AS x, avg(l_discount) AS y FROM lineitem GROUP BY 1), s AS (SELECT x, y, lag(x) OVER (ORDER BY x) AS px, lag(y) OVER (ORDER BY x) AS py FROM p)
SELECT round(sum((x - px) * (y + py) / 2), 6) AS area FROM s""")
def metric_auc(t):
    points = t.lineitem.groupBy(F.col("l_quantity").alias("x")).agg(F.avg("l_discount").alias("y"))
    return rounded(st.area_under_curve(points, "x", "y"))


@query("metric_regression", """
WITH r AS (SELECT l_extendedprice / 1000 AS y, l_quantity * 1.8 AS p FROM lineitem), m AS (SELECT avg(y) AS my FROM r)
SELECT round(avg(pow(p - my, 2)), 4) AS explained_variance, round(avg(abs(y - p)), 4) AS mae, round(avg(pow(y - p, 2)), 4) AS mse, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse,
       round(1 - sum(pow(y - p, 2)) / sum(pow(y - my, 2)), 4) AS r2 FROM r, m""")
def metric_regression(t):
    rows = t.lineitem.select((F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_quantity") * 1.8).alias("p"))
    return rounded(st.regression_metrics(rows, "y", "p"), 4)


@query("metric_ranking", """
WITH pred AS (SELECT o_custkey AS q, o_orderkey AS i, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders),
truth AS (SELECT o_custkey AS q, o_orderkey AS i FROM orders WHERE o_orderstatus = 'F'),
nt AS (SELECT q, count(*) AS nt FROM truth GROUP BY q), np AS (SELECT q, count(*) AS np FROM pred GROUP BY q),
h AS (SELECT q, r, row_number() OVER (PARTITION BY q ORDER BY r) AS nth FROM pred JOIN truth USING (q, i)),
a AS (SELECT q, sum(nth / r) AS ap, sum(nth / r) FILTER (WHERE r <= 5) AS apk, count(*) FILTER (WHERE r <= 5) AS hits, sum(1 / ln(r + 1)) FILTER (WHERE r <= 5) AS dcg FROM h GROUP BY q),
b AS (SELECT np.q, coalesce(nt, 0) AS nt, coalesce(ap, 0) AS ap, coalesce(apk, 0) AS apk, coalesce(hits, 0) AS hits, coalesce(dcg, 0) AS dcg,
  (SELECT sum(1 / ln(g + 1)) FROM range(1, 6) x(g) WHERE g <= nt) AS best FROM np LEFT JOIN nt USING (q) LEFT JOIN a ON a.q = np.q)
SELECT round(avg(CASE WHEN nt > 0 THEN ap / nt ELSE 0 END), 6) AS map, round(avg(CASE WHEN nt > 0 THEN apk / least(nt, 5) ELSE 0 END), 6) AS map_at_k, round(avg(hits / 5.0), 6) AS precision_at_k,
       round(avg(CASE WHEN nt > 0 THEN hits / nt ELSE 0 END), 6) AS recall_at_k, round(avg(CASE WHEN nt > 0 THEN dcg / best ELSE 0 END), 6) AS ndcg_at_k FROM b""")
def metric_ranking(t):
    from millrace.operators.windows import running

    truth = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("q"), F.col("o_orderkey").alias("i"))
    pred = running(t.orders.select(F.col("o_custkey").alias("q"), F.col("o_orderkey").alias("i")), ["q"], ["i"], position="r")
    return rounded(st.ranking_metrics(pred, truth, "q", "i", "r", 5))


@query("metric_binary", """
WITH s AS (SELECT least(floor(n_chars / 100), 200) AS sc, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1),
c AS (SELECT sc, sum(p) OVER (ORDER BY sc DESC) AS tp, sum(n) OVER (ORDER BY sc DESC) AS fp, sum(p) OVER () AS tot_p, sum(n) OVER () AS tot_n FROM s),
d AS (SELECT *, lag(tp) OVER (ORDER BY sc DESC) AS ptp, lag(fp) OVER (ORDER BY sc DESC) AS pfp FROM c)
SELECT round(sum((fp - coalesce(pfp, 0)) / tot_n * (tp + coalesce(ptp, 0)) / tot_p / 2), 6) AS area_under_roc,
  round(sum((tp - coalesce(ptp, 0)) / tot_p * (tp / (tp + fp) + CASE WHEN ptp IS NULL THEN tp / (tp + fp) ELSE ptp / (ptp + pfp) END) / 2), 6) AS area_under_pr FROM d""")
def metric_binary(t):
    rows = t.documents.join(t.labels, "doc_id").select(F.least(F.floor(F.col("n_chars") / 100), F.lit(200)).cast("double").alias("score"), F.col("quality").alias("y"))
    return rounded(st.binary_metrics(rows, "score", "y"))


MULTI = """
WITH r AS (SELECT quality + toxic AS a, CASE WHEN n_chars > 1500 THEN 1 WHEN n_chars > 300 THEN 0 ELSE 2 END AS p FROM documents JOIN labels USING (doc_id)),
k AS (SELECT DISTINCT a AS c FROM r UNION SELECT p FROM r),
m AS (SELECT c, count(*) FILTER (WHERE a = c AND p = c) AS hit, count(*) FILTER (WHERE p = c) AS given, count(*) FILTER (WHERE a = c) AS actual FROM r, k GROUP BY c)
SELECT c AS class, round(CASE WHEN given > 0 THEN hit / given ELSE 0 END, 6) AS precision, round(CASE WHEN actual > 0 THEN hit / actual ELSE 0 END, 6) AS recall,
  round(CASE WHEN given + actual > 0 THEN 2 * hit / (given + actual) ELSE 0 END, 6) AS f1 FROM m"""


@query("metric_multiclass", MULTI)
def metric_multiclass(t):
    rows = t.documents.join(t.labels, "doc_id").select(
        (F.col("quality") + F.col("toxic")).alias("a"), F.when(F.col("n_chars") > 1500, 1).when(F.col("n_chars") > 300, 0).otherwise(2).alias("p"))
    return rounded(st.multiclass_metrics(rows, "a", "p"))


@query("metric_multilabel", """
WITH r AS (SELECT list_filter(['q', 't'], lambda x: (x = 'q' AND quality = 1) OR (x = 't' AND toxic = 1)) AS a,
  list_filter(['q', 't'], lambda x: (x = 'q' AND n_chars > 500) OR (x = 't' AND lang <> 'en')) AS p FROM documents JOIN labels USING (doc_id)),
m AS (SELECT l AS label, count(*) FILTER (WHERE list_contains(a, l) AND list_contains(p, l)) AS hit, count(*) FILTER (WHERE list_contains(p, l)) AS given, count(*) FILTER (WHERE list_contains(a, l)) AS actual
  FROM r, (VALUES ('q'), ('t')) v(l) GROUP BY l)
SELECT label, hit, given, actual, round(hit / given, 6) AS precision, round(hit / actual, 6) AS recall, round(2 * hit / (given + actual), 6) AS f1 FROM m""")
def metric_multilabel(t):
    rows = t.documents.join(t.labels, "doc_id").select(
        F.array_compact(F.array(F.when(F.col("quality") == 1, "q"), F.when(F.col("toxic") == 1, "t"))).alias("a"),
        F.array_compact(F.array(F.when(F.col("n_chars") > 500, "q"), F.when(F.col("lang") != "en", "t"))).alias("p"))
    return rounded(st.multilabel_metrics(rows, "a", "p"))


AB = """
WITH g AS (SELECT event_type, count(*) FILTER (WHERE x) AS n1, avg(value) FILTER (WHERE x) AS m1, var_samp(value) FILTER (WHERE x) AS v1,
  count(*) FILTER (WHERE NOT x) AS n0, avg(value) FILTER (WHERE NOT x) AS m0, var_samp(value) FILTER (WHERE NOT x) AS v0
  FROM (SELECT *, user_id % 2 = 1 AS x FROM events) GROUP BY event_type)
SELECT event_type, round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) AS t, round(pow(v1 / n1 + v0 / n0, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v0 / n0, 2) / (n0 - 1)), 4) AS degrees FROM g"""


@query("ab_welch", AB)
def ab_welch(t):
    out = st.ab_test(t.events, [F.col("event_type")], F.col("user_id") % 2 == 1, "value")
    return out.select("event_type", F.round("t", 6).alias("t"), F.round("degrees", 4).alias("degrees"))


@query("ab_student", """
WITH g AS (SELECT ts::DATE AS d, count(*) FILTER (WHERE x) AS n1, avg(value) FILTER (WHERE x) AS m1, var_samp(value) FILTER (WHERE x) AS v1,
  count(*) FILTER (WHERE NOT x) AS n0, avg(value) FILTER (WHERE NOT x) AS m0, var_samp(value) FILTER (WHERE NOT x) AS v0
  FROM (SELECT *, user_id % 2 = 1 AS x FROM events) GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') AS d, round((m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2) * (1 / n1 + 1 / n0)), 6) AS t, (n1 + n0 - 2)::DOUBLE AS degrees FROM g""")
def ab_student(t):
    out = st.ab_test(t.events, [F.date_format("ts", "yyyy-MM-dd").alias("d")], F.col("user_id") % 2 == 1, "value", "student")
    return out.select("d", F.round("t", 6).alias("t"), "degrees")


@query("stat_tests_ml")
def stat_tests_ml(t):
    """The library tests for chi-square and Kolmogorov-Smirnov, with p-values."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest, KolmogorovSmirnovTest

    rows = VectorAssembler(inputCols=["l_linenumber"], outputCol="v").transform(
        t.lineitem.select("l_linenumber", "l_quantity", F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("y")))
    chi = ChiSquareTest.test(rows, "v", "y", True).select(F.lit("chi_square").alias("test"), F.col("statistic").alias("statistic"), F.col("pValue").alias("p"))
    ks = KolmogorovSmirnovTest.test(rows, "l_quantity", "norm", 25.5, 14.4).select(F.lit("ks").alias("test"), "statistic", F.col("pValue").alias("p"))
    return chi.union(ks)
