"""Learned models and vector stages from ``pyspark.ml`` on whole tables. Checked by row count only."""

from pyspark.ml import classification as mc, clustering as mk, evaluation as me, feature as mf, fpm, recommendation, regression as mr, tuning
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace.operators import features as of, linalg, models as om, recommend, sequences
from millrace.registry import query

WIDTH = 64  # of the embeddings
W2V_ROWS = 20_000  # documents that one task of the word vectors' fit learns from


def lines(t):
    """Features of a line and whether it was returned."""
    return om.assembled(t.lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("int")), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "y")


def prices(t):
    return om.assembled(t.lineitem.withColumn("y", F.col("l_extendedprice") / 1000), ["l_quantity", "l_discount", "l_tax"], "y")


def words(t):
    return t.documents.select("doc_id", of.tokens("text").alias("words"))


def vectors(t):
    return t.embeddings.select("vec_id", "label", array_to_vector("embedding").alias("features"))


@query("ml_hashing_tf")
def ml_hashing_tf(t):
    tf = mf.HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 16).transform(words(t))
    scored = mf.IDF(inputCol="tf", outputCol="tfidf").fit(tf).transform(tf)
    # only what a vector holds: as an array it would be 65,536 doubles a row
    return scored.select("doc_id", F.size(F.filter(F.unwrap_udt("tfidf")["values"], lambda x: x > 0)).alias("terms"))


@query("ml_count_vectorizer")
def ml_count_vectorizer(t):
    cv = mf.CountVectorizer(inputCol="words", outputCol="counts", vocabSize=2000, minDF=5)
    out = cv.fit(words(t)).transform(words(t))
    return out.select("doc_id", F.aggregate(vector_to_array("counts"), F.lit(0.0), lambda s, x: s + x).alias("known_words"))


@query("ml_word2vec")
def ml_word2vec(t):
    # a partition of the fit is one task: their number grows with the documents
    parts = max(1, -(-t.documents.count() // W2V_ROWS))
    w2v = mf.Word2Vec(vectorSize=16, minCount=20, maxIter=1, seed=1, numPartitions=parts, inputCol="words", outputCol="v")
    return w2v.fit(words(t)).transform(words(t)).select("doc_id", vector_to_array("v")[0].alias("x0"))


@query("ml_feature_hasher")
def ml_feature_hasher(t):
    hashed = mf.FeatureHasher(inputCols=["c_mktsegment", "c_nationkey", "c_acctbal"], outputCol="features", numFeatures=256).transform(t.customer)
    return hashed.select("c_custkey", F.size(F.filter(vector_to_array("features"), lambda x: x != 0)).alias("filled"))


@query("ml_text_stages")
def ml_text_stages(t):
    out = om.transformed(t.documents, mf.Tokenizer(inputCol="text", outputCol="a"), mf.StopWordsRemover(inputCol="a", outputCol="b"), mf.NGram(n=3, inputCol="b", outputCol="c"),
                         mf.RegexTokenizer(inputCol="text", outputCol="d", pattern="\\W+"))
    return out.select("doc_id", F.size("a").alias("words"), F.size("b").alias("kept"), F.size("c").alias("trigrams"), F.size("d").alias("matches"))


def _rounded(vector):
    return F.transform(vector_to_array(vector), lambda x: F.round(x, 5) + F.lit(0.0))


# the products of the first four dimensions come column by column: x, xx, y, xy, yy, z, ...; the cosine transform and
# the scaled vectors are of all dimensions
@query("ml_vector_stages", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS len FROM embeddings)
SELECT vec_id,
  list_transform([v[1], v[1] * v[1], v[2], v[1] * v[2], v[2] * v[2], v[3], v[1] * v[3], v[2] * v[3], v[3] * v[3],
    v[4], v[1] * v[4], v[2] * v[4], v[3] * v[4], v[4] * v[4]], lambda x: round(x, 5) + 0.0) AS poly,
  list_transform(range(64), lambda k: round(list_sum(list_transform(range(64), lambda i: v[i + 1] * cos(pi() * (i + 0.5) * k / 64))) * CASE WHEN k = 0 THEN sqrt(1 / 64) ELSE sqrt(2 / 64) END, 5) + 0.0) AS dct,
  list_transform(range(64), lambda i: round(v[i + 1] * (i + 1), 5) + 0.0) AS ew,
  list_transform(v, lambda x: round(CASE WHEN len > 0 THEN x / len ELSE x END, 5) + 0.0) AS nrm FROM e""")
def ml_vector_stages(t):
    v = vectors(t)
    sized = mf.VectorSizeHint(inputCol="features", size=WIDTH).transform(v)
    out = om.transformed(sized, mf.VectorSlicer(inputCol="features", outputCol="s", indices=[0, 1, 2, 3]), mf.PolynomialExpansion(degree=2, inputCol="s", outputCol="poly"),
                         mf.DCT(inputCol="features", outputCol="dct"), mf.ElementwiseProduct(scalingVec=[float(i) for i in range(1, WIDTH + 1)], inputCol="features", outputCol="ew"),
                         mf.Normalizer(inputCol="features", outputCol="nrm"))
    return out.select("vec_id", *[_rounded(F.col(c)).alias(c) for c in ("poly", "dct", "ew", "nrm")])


@query("ml_interaction")
def ml_interaction(t):
    pair = mf.VectorAssembler(inputCols=["p_size", "p_retailprice"], outputCol="v").transform(t.part)
    out = mf.Interaction(inputCols=["p_partkey", "v"], outputCol="products").transform(pair)
    return out.select("p_partkey", vector_to_array("products").alias("products"))


@query("ml_scalers")
def ml_scalers(t):
    v = lines(t)
    for name, stage in {"mm": mf.MinMaxScaler(), "st": mf.StandardScaler(withMean=True), "ma": mf.MaxAbsScaler(), "ro": mf.RobustScaler()}.items():
        v = stage.setInputCol("features").setOutputCol(name).fit(v).transform(v)
    return v.groupBy("label").agg(*[F.avg(vector_to_array(c)[0]).alias(c) for c in ("mm", "st", "ma", "ro")])


@query("ml_indexers")
def ml_indexers(t):
    coded = om.indexed(t.customer, "c_mktsegment", "code")
    model = mf.StringIndexer(inputCol="c_mktsegment", outputCol="i").fit(t.customer)
    hot = mf.OneHotEncoder(inputCols=["code"], outputCols=["hot"]).fit(coded).transform(coded)
    back = mf.IndexToString(inputCol="code", outputCol="back", labels=model.labels).transform(hot)
    vec = om.assembled(back, ["c_nationkey"], None, ["c_custkey", "back", "hot"])
    out = mf.VectorIndexer(inputCol="features", outputCol="vi", maxCategories=30).fit(vec).transform(vec)
    return out.groupBy("back").agg(F.count("*").alias("n"), F.max(vector_to_array("vi")[0]).alias("top"))


@query("ml_binning")
def ml_binning(t):
    p = t.part.withColumn("size", F.col("p_size").cast("double"))
    out = mf.Bucketizer(splits=[0, 10, 25, 51], inputCol="size", outputCol="b").transform(p)
    out = mf.QuantileDiscretizer(numBuckets=4, inputCol="p_retailprice", outputCol="q").fit(out).transform(out)
    out = mf.Binarizer(threshold=25.0, inputCol="size", outputCol="z").transform(out)
    filled = mf.Imputer(strategy="median", inputCols=["size"], outputCols=["size_f"], missingValue=7.0).fit(out).transform(out)
    return filled.groupBy("b", "q", "z").agg(F.count("*").alias("n"), F.avg("size_f").alias("mean_size"))


@query("ml_rformula")
def ml_rformula(t):
    return mf.RFormula(formula="p_retailprice ~ p_size + p_type").fit(t.part).transform(t.part).select(
        "p_partkey", F.size(vector_to_array("features")).alias("width"), "label")


@query("ml_pca")
def ml_pca(t):
    return mf.PCA(k=3, inputCol="features", outputCol="p").fit(vectors(t)).transform(vectors(t)).select(
        "vec_id", *[vector_to_array("p")[i].alias(f"c{i}") for i in range(3)])


@query("ml_svd")
def ml_svd(t):
    """The eight largest singular values of the vectors."""
    values, _ = linalg.svd(t.embeddings, "embedding", 8)
    return t.spark.createDataFrame([(i, float(s)) for i, s in enumerate(values)], "i int, singular_value double")


@query("ml_selector")
def ml_selector(t):
    """Chi-square choice: the columns are binned first, as the test counts categories."""
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    rows = t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y"), *[F.col(c).cast("double").alias(c) for c in names])
    binned = [f"{c}_bin" for c in names]
    rows = mf.QuantileDiscretizer(numBuckets=8, inputCols=names, outputCols=binned, relativeError=0.001).fit(rows).transform(rows)
    rows = om.assembled(rows, binned, "y")
    sel = mf.UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="best").setFeatureType("categorical").setLabelType("categorical").setSelectionMode("numTopFeatures").setSelectionThreshold(2)
    model = sel.fit(rows)
    chosen = F.array(*[F.lit(names[i]) for i in model.selectedFeatures])
    return model.transform(rows).groupBy(F.array_join(chosen, ",").alias("chosen"), F.size(vector_to_array("best")).alias("width")).agg(F.count("*").alias("n"))


@query("ml_fp_growth")
def ml_fp_growth(t):
    baskets = t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.collect_set("p_type").alias("items"))
    model = fpm.FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.3).fit(baskets)
    return model.associationRules.select(F.array_join(F.sort_array("antecedent"), ",").alias("antecedent"), F.array_join("consequent", ",").alias("consequent"), "confidence", "lift")


@query("ml_prefix_span", """
WITH p AS (SELECT user_id AS u, event_type AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
one AS (SELECT u, k AS pattern, min(pos) AS pos FROM p GROUP BY u, k),
two AS (SELECT p.u, pattern || '>' || k AS pattern, min(p.pos) AS pos FROM one JOIN p ON p.u = one.u AND p.pos > one.pos GROUP BY ALL),
three AS (SELECT p.u, pattern || '>' || k AS pattern, min(p.pos) AS pos FROM two JOIN p ON p.u = two.u AND p.pos > two.pos GROUP BY ALL)
SELECT pattern, count(*) AS freq FROM (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three) GROUP BY pattern
HAVING count(*) >= ceil(0.4 * (SELECT count(DISTINCT u) FROM p))""")
def ml_prefix_span(t):
    """One sequence per user, of single events."""
    found = sequences.prefix_span(t.events, "user_id", F.struct("ts", "event_id"), F.col("event_type"), 0.4, 3)
    return found.select(F.array_join(F.flatten("sequence"), ">").alias("pattern"), "freq")


@query("ml_prefix_span_sets", """
WITH i AS (SELECT DISTINCT o_custkey AS c, o_orderkey AS o, l_linenumber % 4 AS x FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
one AS (SELECT c, x, min(o) AS f FROM i GROUP BY ALL),
wide AS (SELECT a.c, a.x, b.x AS y, min(a.o) AS f FROM i a JOIN i b ON a.c = b.c AND a.o = b.o AND a.x < b.x GROUP BY ALL),
apart AS (SELECT DISTINCT one.c, one.x, i.x AS y FROM one JOIN i ON i.c = one.c AND i.o > one.f),
p AS (SELECT c, x::VARCHAR AS pattern FROM one UNION ALL SELECT c, x || ',' || y FROM wide UNION ALL SELECT c, x || '>' || y FROM apart)
SELECT pattern, count(*) AS freq FROM p GROUP BY pattern HAVING count(*) >= ceil(0.3 * (SELECT count(DISTINCT c) FROM i))""")
def ml_prefix_span_sets(t):
    """One sequence per customer, of orders as sets of items; patterns of two items, in one set or in two."""
    items = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    found = sequences.prefix_span(items, "o_custkey", F.col("o_orderkey"), F.col("l_linenumber") % 4, 0.3, 2)
    return found.select(F.array_join(F.transform("sequence", lambda s: F.array_join(s.cast("array<string>"), ",")), ">").alias("pattern"), "freq")


@query("ml_als")
def ml_als(t):
    ratings = t.lineitem.groupBy(F.col("l_suppkey").cast("int").alias("s"), F.col("l_partkey").cast("int").alias("p")).agg(F.sum("l_quantity").alias("q"))
    model = recommendation.ALS(userCol="s", itemCol="p", ratingCol="q", rank=6, maxIter=3, seed=1, coldStartStrategy="drop").fit(ratings)
    return recommend.best_items(model.userFactors, model.itemFactors, 3).toDF("s", "p", "rating")


def _clusters(model, t):
    return om.tally(om.fit_score(model, vectors(t)))


@query("ml_kmeans")
def ml_kmeans(t):
    return _clusters(mk.KMeans(k=5, seed=1, maxIter=5), t)


@query("ml_bisecting_kmeans")
def ml_bisecting_kmeans(t):
    return _clusters(mk.BisectingKMeans(k=4, seed=1, maxIter=3), t)


@query("ml_gaussian_mixture")
def ml_gaussian_mixture(t):
    return om.tally(om.fit_score(mk.GaussianMixture(k=3, seed=1, maxIter=5), vectors(t)))


@query("ml_lda")
def ml_lda(t):
    counts = mf.CountVectorizer(inputCol="words", outputCol="features", vocabSize=500, minDF=5)
    model = counts.fit(words(t))
    topics = mk.LDA(k=4, maxIter=3, seed=1, optimizer="online").fit(model.transform(words(t))).describeTopics(5)
    names = F.array(*map(F.lit, model.vocabulary))
    pairs = topics.select("topic", F.inline(F.arrays_zip("termIndices", "termWeights")))
    return pairs.select("topic", F.element_at(names, F.col("termIndices") + 1).alias("term"), F.col("termWeights").alias("weight"))


def _classify(name, make):
    @query(f"ml_{name}")
    def build(t):
        return om.tally(om.fit_score(make(), lines(t)))

    return build


_classify("logistic", lambda: mc.LogisticRegression(maxIter=5, regParam=0.01, elasticNetParam=0.5))
_classify("linear_svc", lambda: mc.LinearSVC(maxIter=5))
_classify("decision_tree", lambda: mc.DecisionTreeClassifier(maxDepth=4, seed=1))
_classify("random_forest", lambda: mc.RandomForestClassifier(numTrees=5, maxDepth=4, seed=1))
_classify("gbt", lambda: mc.GBTClassifier(maxIter=3, maxDepth=3, seed=1))
_classify("naive_bayes", lambda: mc.NaiveBayes())
_classify("mlp", lambda: mc.MultilayerPerceptronClassifier(layers=[4, 5, 2], maxIter=5, seed=1))
_classify("fm_classifier", lambda: mc.FMClassifier(maxIter=3, factorSize=2, seed=1))
_classify("one_vs_rest", lambda: mc.OneVsRest(classifier=mc.LogisticRegression(maxIter=3)))


def _regress(name, make):
    @query(f"ml_{name}")
    def build(t):
        scored = om.fit_score(make(), prices(t))
        return scored.agg(F.count("*").alias("n"), F.avg(F.pow(F.col("label") - F.col("prediction"), 2)).alias("mse"))

    return build


_regress("linear", lambda: mr.LinearRegression(maxIter=5, regParam=0.1, elasticNetParam=0.5))
_regress("ridge", lambda: mr.LinearRegression(maxIter=5, regParam=0.1, elasticNetParam=0.0))
_regress("lasso", lambda: mr.LinearRegression(maxIter=5, regParam=0.1, elasticNetParam=1.0))
_regress("glm", lambda: mr.GeneralizedLinearRegression(family="gaussian", link="identity", maxIter=5))
_regress("tree_regressor", lambda: mr.DecisionTreeRegressor(maxDepth=4, seed=1))
_regress("forest_regressor", lambda: mr.RandomForestRegressor(numTrees=5, maxDepth=4, seed=1))
_regress("gbt_regressor", lambda: mr.GBTRegressor(maxIter=3, maxDepth=3, seed=1))
_regress("fm_regressor", lambda: mr.FMRegressor(maxIter=3, factorSize=2, seed=1))


@query("ml_isotonic")
def ml_isotonic(t):
    means = t.lineitem.groupBy(F.col("l_quantity").alias("x")).agg(F.avg("l_extendedprice").alias("label"))
    return om.fit_score(mr.IsotonicRegression(), om.assembled(means, ["x"], "label", ["x"])).select("x", "prediction")


@query("ml_aft_survival")
def ml_aft_survival(t):
    rows = om.assembled(t.lineitem.withColumn("y", F.col("l_quantity") / 10), ["l_discount", "l_tax"], "y", [(F.col("l_returnflag") == "R").cast("double").alias("censor")])
    return mr.AFTSurvivalRegression(maxIter=5).fit(rows).transform(rows).agg(F.count("*").alias("n"), F.avg("prediction").alias("mean"))


@query("ml_pipeline_tuning")
def ml_pipeline_tuning(t):
    rows = t.lineitem.select("l_quantity", "l_discount", "l_tax", (F.col("l_extendedprice") / 1000).alias("label"))
    lr = mr.LinearRegression(maxIter=3)
    flow = om.pipeline(mf.VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features"), lr)
    grid = tuning.ParamGridBuilder().addGrid(lr.regParam, [0.01, 1.0]).build()
    judge = me.RegressionEvaluator(metricName="rmse")
    cv = tuning.CrossValidator(estimator=flow, estimatorParamMaps=grid, evaluator=judge, numFolds=2, seed=1).fit(rows)
    tv = tuning.TrainValidationSplit(estimator=flow, estimatorParamMaps=grid, evaluator=judge, trainRatio=0.8, seed=1).fit(rows)
    return t.spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(cv.avgMetrics, tv.validationMetrics))], "grid_point int, cv_rmse double, split_rmse double")
