"""Every join kind on the star tables."""

from functools import reduce

from pyspark.ml.feature import BucketedRandomProjectionLSH, HashingTF, MinHashLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from millrace.functions.times import epoch_seconds
from millrace.operators import joins as oj, similarity
from millrace.registry import query


def two_digits(c, name):
    return F.round(F.sum(c), 2).alias(name)


@query("join_inner", """
SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL""")
def join_inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "o_orderpriority").agg(
        F.count("*").alias("n"), two_digits("o_totalprice", "total"))


@query("join_left", """
SELECT c_custkey, count(o_orderkey) AS n, round(coalesce(sum(o_totalprice), 0), 2) AS total
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' AND o_totalprice > 300000 GROUP BY c_custkey""")
def join_left(t):
    big = t.orders.where("o_orderstatus = 'F' AND o_totalprice > 300000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(
        F.count("o_orderkey").alias("n"), F.round(F.coalesce(F.sum("o_totalprice"), F.lit(0.0)), 2).alias("total"))


@query("join_right", """
SELECT p_partkey, p_brand, count(l_orderkey) AS n FROM lineitem RIGHT JOIN part ON l_partkey = p_partkey AND l_quantity >= 45
GROUP BY ALL""")
def join_right(t):
    return t.lineitem.where("l_quantity >= 45").join(t.part, F.col("l_partkey") == F.col("p_partkey"), "right").groupBy(
        "p_partkey", "p_brand").agg(F.count("l_orderkey").alias("n"))


@query("join_full", """
WITH a AS (SELECT o_custkey AS k, count(*) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' GROUP BY 1),
b AS (SELECT o_custkey AS k, count(*) AS low FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'O' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS custkey, urgent, low FROM a FULL JOIN b ON a.k = b.k""")
def join_full(t):
    def side(priority, status, name):
        return t.orders.where((F.col("o_orderpriority") == priority) & (F.col("o_orderstatus") == status)).groupBy(
            F.col("o_custkey").alias("custkey")).agg(F.count("*").alias(name))

    return side("1-URGENT", "P", "urgent").join(side("5-LOW", "O", "low"), "custkey", "full")


@query("join_full_never", """
SELECT r_name, n_name FROM region FULL JOIN nation ON 1 = 0""")
def join_full_never(t):
    return t.region.select("r_name", F.lit(0).alias("a")).join(t.nation.select("n_name", F.lit(1).alias("b")), F.col("a") == F.col("b"), "full").select(
        "r_name", "n_name")


@query("join_cross", """
SELECT r_name, c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer CROSS JOIN region GROUP BY ALL""")
def join_cross(t):
    return oj.cross_join(t.customer, t.region).groupBy("r_name", "c_mktsegment").agg(F.count("*").alias("n"), two_digits("c_acctbal", "total"))


@query("join_theta", """
SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey > n_nationkey AND c_acctbal < 0 GROUP BY n_name""")
def join_theta(t):
    return oj.theta_join(t.customer.where("c_acctbal < 0"), t.nation, F.col("c_nationkey") > F.col("n_nationkey")).groupBy("n_name").agg(
        F.count("*").alias("n"))


@query("join_inequality_counts", """
SELECT a.p_partkey, count(b.p_partkey) AS cheaper FROM part a LEFT JOIN part b
ON a.p_brand = b.p_brand AND a.p_retailprice > b.p_retailprice GROUP BY a.p_partkey""")
def join_inequality_counts(t):
    parts = t.part.select("p_partkey", "p_brand", "p_retailprice")
    return oj.inequality_counts(parts, parts, "p_retailprice", ["p_brand"], "cheaper").select("p_partkey", "cheaper")


@query("join_using", """
SELECT o_orderstatus, l_returnflag, count(*) AS n FROM (SELECT o_orderkey AS k, o_orderstatus FROM orders)
JOIN (SELECT l_orderkey AS k, l_returnflag FROM lineitem) USING (k) GROUP BY ALL""")
def join_using(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_returnflag")
    return lines.join(t.orders.select(F.col("o_orderkey").alias("k"), "o_orderstatus"), "k").groupBy(
        "o_orderstatus", "l_returnflag").agg(F.count("*").alias("n"))


@query("join_natural", """
SELECT suppkey, nationkey, n, m FROM (SELECT s_suppkey AS suppkey, s_nationkey AS nationkey, length(s_name) AS n FROM supplier)
NATURAL LEFT JOIN (SELECT l_suppkey AS suppkey, count(*) AS m FROM lineitem WHERE l_tax = 0.08 GROUP BY 1)""")
def join_natural(t):
    left = t.supplier.select(F.col("s_suppkey").alias("suppkey"), F.col("s_nationkey").alias("nationkey"), F.length("s_name").alias("n"))
    right = t.lineitem.where("l_tax = 0.08").groupBy(F.col("l_suppkey").alias("suppkey")).agg(F.count("*").alias("m"))
    return left.join(right, [c for c in left.columns if c in right.columns], "left")


@query("join_semi", """
SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""")
def join_semi(t):
    return t.customer.join(t.orders.where("o_totalprice > 450000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("join_anti", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""")
def join_anti(t):
    return t.customer.join(t.orders.where("o_totalprice > 400000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("join_exists_col", """
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P') AS has_high FROM customer""")
def join_exists_col(t):
    wanted = t.orders.where("o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return oj.existence_join(t.customer.select("c_custkey"), wanted, ["c_custkey"], "has_high")


@query("join_nullsafe", """
WITH a AS (SELECT nullif(p_size % 5, 0) AS k, count(*) AS n FROM part GROUP BY 1),
b AS (SELECT nullif(s_nationkey % 7, 0) AS k, count(*) AS m FROM supplier GROUP BY 1)
SELECT a.k AS ka, b.k AS kb, n, m FROM a LEFT JOIN b ON a.k IS NOT DISTINCT FROM b.k""")
def join_nullsafe(t):
    a = t.part.groupBy(F.expr("nullif(p_size % 5, 0)").alias("ka")).agg(F.count("*").alias("n"))
    b = t.supplier.groupBy(F.expr("nullif(s_nationkey % 7, 0)").alias("kb")).agg(F.count("*").alias("m"))
    return oj.null_safe_join(a, b, [("ka", "kb")], "left")


@query("join_broadcast", """
SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def join_broadcast(t):
    return oj.broadcast_join(t.customer, t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count("*").alias("n"), two_digits("c_acctbal", "total"))


LINES_BY_STATUS = """
SELECT o_orderstatus, count(*) AS n, sum(l_quantity) AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus"""


def _lines_by_status(t, strategy):
    lines = t.lineitem.select("l_orderkey", "l_quantity")
    return oj.strategy_join(lines, t.orders.select("o_orderkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"), strategy).groupBy(
        "o_orderstatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("join_merge", LINES_BY_STATUS)
def join_merge(t):
    return _lines_by_status(t, "merge")


@query("join_shuffle_hash", LINES_BY_STATUS)
def join_shuffle_hash(t):
    return _lines_by_status(t, "shuffle_hash")


@query("join_nested_loop", """
SELECT r_name, count(*) AS n FROM supplier JOIN region ON s_nationkey % 5 <> r_regionkey GROUP BY r_name""")
def join_nested_loop(t):
    return oj.strategy_join(t.supplier, t.region, F.col("s_nationkey") % 5 != F.col("r_regionkey"), "shuffle_replicate_nl").groupBy(
        "r_name").agg(F.count("*").alias("n"))


@query("join_bucketed", LINES_BY_STATUS)
def join_bucketed(t):
    from millrace.operators.maintenance import bucket_count
    from millrace.sources.tables import bucketed_table

    buckets = bucket_count(t.spark, t.path("lineitem"), t.path("orders"))
    lines = bucketed_table(t.lineitem.select("l_orderkey", "l_quantity"), "lines", ["l_orderkey"], buckets)
    orders = bucketed_table(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "orders", ["l_orderkey"], buckets)
    return lines.join(orders, "l_orderkey").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("join_skew_salted", """
SELECT event_type, count(*) AS n, round(sum(e.value / u.total), 6) AS share FROM events e
JOIN (SELECT user_id, event_type, sum(value) AS total FROM events GROUP BY ALL) u USING (user_id, event_type) GROUP BY event_type""")
def join_skew_salted(t):
    totals = t.events.groupBy("user_id", "event_type").agg(F.sum("value").alias("total"))
    e = t.events.select("event_id", "user_id", "event_type", "value")
    return oj.salted_join(e, totals, ["user_id", "event_type"]).groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("value") / F.col("total")), 6).alias("share"))


@query("join_star", """
SELECT r_name, p_brand, o_orderpriority, count(*) AS n, sum(l_quantity) AS qty FROM lineitem
JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE p_size < 10 GROUP BY ALL""")
def join_star(t):
    sellers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    return (
        t.lineitem.join(t.part.where("p_size < 10"), F.col("l_partkey") == F.col("p_partkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("r_name", "p_brand", "o_orderpriority").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    )


UNIQUE_SIDES = """a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000 GROUP BY 1),
b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000 GROUP BY 1),
c AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer WHERE c_acctbal > 8000),
j AS (SELECT a.k AS a_k, a.n AS a_n, b.k AS b_k, b.n AS b_n, c.k AS c_k, c.n AS c_n
  FROM a FULL JOIN b ON a.k = b.k FULL JOIN c ON coalesce(a.k, b.k) = c.k)"""


def _unique(t, keep):
    def counts(status):
        return t.orders.where((F.col("o_orderstatus") == status) & (F.col("o_totalprice") > 400000)).groupBy(
            F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))

    sides = {"a": counts("P"), "b": counts("F"),
             "c": t.customer.where("c_acctbal > 8000").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n"))}
    return oj.unique_join([(p, df, ["k"], p in keep) for p, df in sides.items()])


@query("join_unique3", f"WITH {UNIQUE_SIDES} SELECT * FROM j")
def join_unique3(t):
    return _unique(t, "abc")


@query("join_unique3_partial", f"WITH {UNIQUE_SIDES} SELECT * FROM j WHERE a_k IS NOT NULL OR c_k IS NOT NULL")
def join_unique3_partial(t):
    return _unique(t, "ac")


@query("join_unique3_strict", f"WITH {UNIQUE_SIDES} SELECT * FROM j WHERE a_k IS NOT NULL AND b_k IS NOT NULL AND c_k IS NOT NULL")
def join_unique3_strict(t):
    return _unique(t, "")


@query("join_empty_side", """
SELECT c_mktsegment, count(*) AS n, count(o_orderkey) AS matched FROM customer
LEFT JOIN (SELECT * FROM orders WHERE o_totalprice < 0) ON c_custkey = o_custkey GROUP BY c_mktsegment""")
def join_empty_side(t):
    return t.customer.join(t.orders.where("o_totalprice < 0"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.count("o_orderkey").alias("matched"))


EMPTY_KINDS = {"inner": "inner", "left": "left", "right": "right", "full": "full", "semi": "left_semi", "anti": "left_anti"}


@query("join_empty_kinds", " UNION ALL ".join(f"""
SELECT '{kind}' AS kind, '{side}' AS empty_side, count(*) AS n FROM (SELECT * FROM customer WHERE {'c_acctbal < -1e9' if side == 'left' else 'true'}) a
{kind.upper()} JOIN (SELECT * FROM nation WHERE {'n_nationkey < 0' if side == 'right' else 'true'}) b ON c_nationkey = n_nationkey""" for kind in EMPTY_KINDS for side in ("left", "right")))
def join_empty_kinds(t):
    """Every kind of join with an empty left side, then with an empty right side."""
    on, parts = F.col("c_nationkey") == F.col("n_nationkey"), []
    for kind, how in EMPTY_KINDS.items():
        for side in ("left", "right"):
            a = t.customer.where("c_acctbal < -1e9") if side == "left" else t.customer
            b = t.nation.where("n_nationkey < 0") if side == "right" else t.nation
            parts.append(a.join(b, on, how).agg(F.lit(kind).alias("kind"), F.lit(side).alias("empty_side"), F.count("*").alias("n")))
    return reduce(DataFrame.union, parts)


@query("join_self", """
SELECT a.n_name AS first_nation, b.n_name AS second_nation FROM nation a JOIN nation b
ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey
WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = a.n_nationkey)""")
def join_self(t):
    a, b = t.nation.alias("a"), t.nation.alias("b")
    near = (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))
    used = t.customer.select(F.col("c_nationkey").alias("used"))
    return a.join(used, F.col("a.n_nationkey") == F.col("used"), "left_semi").join(b, near).select(
        F.col("a.n_name").alias("first_nation"), F.col("b.n_name").alias("second_nation"))


@query("join_cogroup", """
SELECT coalesce(a.k, b.k) AS k, orders, spent, lines FROM
(SELECT o_custkey AS k, count(*) AS orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1) a FULL JOIN
(SELECT l_suppkey AS k, count(*) AS lines FROM lineitem GROUP BY 1) b ON a.k = b.k""")
def join_cogroup(t):
    return oj.cogroup_agg({
        "orders": (t.orders.select(F.col("o_custkey").alias("k"), "o_totalprice"), [F.count("*").alias("orders"), two_digits("o_totalprice", "spent")]),
        "lines": (t.lineitem.select(F.col("l_suppkey").alias("k")), [F.count("*").alias("lines")]),
    }, ["k"])


@query("join_subtract_key", """
SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000)""")
def join_subtract_key(t):
    return t.orders.select("o_custkey").join(t.customer.where("c_acctbal < 5000"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").distinct()


@query("join_range_bucket", """
WITH spans AS (SELECT user_id, epoch(ts) AS lo, epoch(ts) + 3600 AS hi, event_id AS err FROM events WHERE event_type = 'error')
SELECT err, count(*) AS n, round(sum(value), 2) AS total FROM spans JOIN events e
ON e.user_id = spans.user_id AND epoch(e.ts) BETWEEN lo AND hi GROUP BY err""")
def join_range_bucket(t):
    at = epoch_seconds("ts").cast("double")
    e = t.events.select("user_id", at.alias("at"), "value")
    spans = t.events.where("event_type = 'error'").select("user_id", at.alias("lo"), (at + 3600).alias("hi"), F.col("event_id").alias("err"))
    return oj.range_join(e, "at", spans, "lo", "hi", 3600.0, ["user_id"]).groupBy("err").agg(F.count("*").alias("n"), two_digits("value", "total"))


@query("join_hints", """
SELECT o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey < 5 GROUP BY o_orderpriority""")
def join_hints(t):
    return t.orders.hint("no_such_hint").join(t.customer.where("c_nationkey < 5").hint("merge"), F.col("o_custkey") == F.col("c_custkey")).groupBy(
        "o_orderpriority").agg(F.count("*").alias("n")).hint("coalesce", 1)


@query("join_minhash")
def join_minhash(t):
    """Documents near a benchmark passage by word sets; the passages are the small side of the join."""
    words = lambda df, k: df.select(F.col(k).alias("id"), F.filter(F.split(F.lower("text"), r"\s+"), lambda w: F.length(w) > 0).alias("words")).where(F.size("words") > 0)
    tf = HashingTF(inputCol="words", outputCol="features", binary=True, numFeatures=1 << 18)
    docs, items = tf.transform(words(t.documents, "doc_id")), tf.transform(words(t.benchmark, "item_id"))
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=48, seed=7).fit(docs)  # nine of ten pairs just within the bound meet
    return similarity.min_hash_join(docs, items, model, 0.9).withColumnsRenamed({"a": "doc_id", "b": "item_id"})


@query("join_brp")
def join_brp(t):
    """Each vector joined to the label centres that lie near it, by random projections."""
    vectors = t.embeddings.select("vec_id", "label", array_to_vector("embedding").alias("features"))
    dims = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    centres = dims.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("p")).select(
        F.col("label").alias("centre"), array_to_vector(F.col("p.x")).alias("features"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=2.0, numHashTables=4, seed=7).fit(vectors)
    pairs = model.approxSimilarityJoin(vectors, centres, 1.2, "distance")
    return pairs.select(F.col("datasetA.vec_id").alias("vec_id"), F.col("datasetB.centre").alias("centre"), "distance")


@query("nearest_vectors")
def nearest_vectors(t):
    """The ten vectors nearest to a given one among the candidates that share a projection bucket."""
    vectors = t.embeddings.select("vec_id", array_to_vector("embedding").alias("features"))
    key = vectors.where("vec_id = 0").first()["features"]
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=2.0, numHashTables=4, seed=7).fit(vectors)
    return model.approxNearestNeighbors(vectors, key, 10, distCol="distance").select("vec_id", "distance")


def word_sets(df, key):
    return similarity.distinct_sets(df, key, F.filter(F.split(F.lower("text"), r"\s+"), lambda w: F.length(w) > 0))


@query("join_set_similarity", """
WITH s AS (SELECT doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> ''))) AS w FROM documents),
c AS (SELECT min(doc_id) AS id, count(*) AS members, w FROM s WHERE len(w) > 0 GROUP BY w),
i AS (SELECT id, len(w) AS n, unnest(w) AS x FROM c),
p AS (SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared FROM i a JOIN i b ON a.x = b.x AND a.id < b.id AND b.n BETWEEN 0.7 * a.n AND a.n / 0.7 GROUP BY a.id, b.id)
SELECT p.a, p.b, shared, x.members AS members_a, y.members AS members_b FROM p JOIN c x ON x.id = p.a JOIN c y ON y.id = p.b WHERE shared >= 0.7 * (na + nb - shared)""")
def join_set_similarity(t):
    """Documents whose word sets are 70 % alike: pairs of different sets, with the number of documents that have each."""
    sets, members = word_sets(t.documents, "doc_id")
    counts = members.groupBy("id").agg(F.count("*").alias("members"))
    pairs = similarity.set_join(sets, None, 0.7)
    for side in ("a", "b"):
        pairs = pairs.join(counts.select(F.col("id").alias(side), F.col("members").alias(f"members_{side}")), side)
    return pairs.select("a", "b", F.col("shared").cast("bigint").alias("shared"), "members_a", "members_b")


@query("join_set_similarity_sides", """
WITH a AS (SELECT user_id, list_sort(list_distinct(list(event_type || (hour(ts) // 3)::VARCHAR))) AS w FROM events WHERE event_id % 2 = 0 GROUP BY user_id),
b AS (SELECT user_id, list_sort(list_distinct(list(event_type || (hour(ts) // 3)::VARCHAR))) AS w FROM events WHERE event_id % 2 = 1 GROUP BY user_id),
x AS (SELECT min(user_id) AS id, w FROM a GROUP BY w), y AS (SELECT min(user_id) AS id, w FROM b GROUP BY w)
SELECT x.id AS a, y.id AS b, len(list_intersect(x.w, y.w)) AS shared FROM x, y WHERE len(list_intersect(x.w, y.w)) >= 0.8 * (len(x.w) + len(y.w) - len(list_intersect(x.w, y.w)))""")
def join_set_similarity_sides(t):
    """What users did in which hours, of every other event, against the rest: two sides with sets of common items."""
    def side(odd):
        kinds = t.events.where(F.col("event_id") % 2 == odd).groupBy("user_id").agg(F.collect_set(F.concat("event_type", F.floor(F.hour("ts") / 3).cast("string"))).alias("w"))
        return similarity.distinct_sets(kinds, "user_id", F.col("w"))[0]

    return similarity.set_join(side(0), side(1), 0.8).withColumn("shared", F.col("shared").cast("bigint"))


@query("join_near_vectors", """
WITH v AS (SELECT vec_id, embedding AS e FROM embeddings),
w AS (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.e, b.e) AS d FROM v a JOIN v b ON a.vec_id < b.vec_id)
SELECT a, b, round(d, 6) AS distance FROM w WHERE d <= (SELECT 0.6 * avg(sqrt(list_inner_product(e, e))) FROM v)""")
def join_near_vectors(t):
    """All pairs of vectors nearer than six tenths of their mean length, exactly."""
    vectors = t.embeddings.select("vec_id", "embedding")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    facts = vectors.agg(F.avg(length).alias("length"), F.max(F.size("embedding")).alias("width")).first()
    return similarity.near_pairs(vectors, "vec_id", "embedding", 0.6 * facts["length"], facts["width"], 3).withColumn("distance", F.round("distance", 6))
