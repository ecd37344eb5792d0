"""Graph operators on graphs derived from whole tables.

Three graphs: consecutive orders of a customer (chains), consecutive parts of an order (a meshed graph), and the parts as
a binary tree in which part k hangs below part k / 2.
"""

from pyspark.sql import functions as F

from millrace.jobs.logs_and_assets import level_minimum
from millrace.operators import graph as og
from millrace.operators.windows import neighbours
from millrace.registry import query


def order_chain(t):
    rows = t.orders.select("o_custkey", "o_orderkey")
    steps = neighbours(rows, ["o_custkey"], ["o_orderkey"], 0, 1, lambda w: [F.lead("o_orderkey").over(w).alias("dst")])
    return steps.select(F.col("o_orderkey").alias("src"), "dst").where("dst IS NOT NULL")


def part_mesh(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    steps = neighbours(rows, ["l_orderkey"], ["l_partkey"], 0, 1, lambda w: [F.lead("l_partkey").over(w).alias("dst")])
    return steps.select(F.col("l_partkey").alias("src"), "dst").where("dst IS NOT NULL").distinct()


def part_tree(t):
    """Edges from parent to child, weighted by the child's size."""
    return t.part.where("p_partkey > 0").select(F.expr("p_partkey div 2").alias("src"), F.col("p_partkey").alias("dst"), F.col("p_size").cast("double").alias("w"))


MESH = """mesh AS (SELECT DISTINCT src, dst FROM (SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS dst
  FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) WHERE dst IS NOT NULL)"""
IDS = "ids AS (SELECT src AS id FROM mesh UNION SELECT dst FROM mesh)"


@query("graph_degree", f"""
WITH {MESH} SELECT id, sum(i)::BIGINT AS in_degree, sum(o)::BIGINT AS out_degree, count(*) AS degree FROM (SELECT src AS id, 0 AS i, 1 AS o FROM mesh UNION ALL SELECT dst, 1, 0 FROM mesh) GROUP BY id""")
def graph_degree(t):
    return og.degrees(part_mesh(t))


@query("graph_triplets", f"""
WITH {MESH} SELECT a.p_type AS src_p_type, b.p_type AS dst_p_type, count(*) AS n FROM mesh JOIN part a ON a.p_partkey = dst JOIN part b ON b.p_partkey = src GROUP BY ALL""")
def graph_triplets(t):
    """Of the edges the other way round."""
    v = t.part.select(F.col("p_partkey").alias("id"), "p_type")
    return og.triplets(v, og.reverse(part_mesh(t))).groupBy("src_p_type", "dst_p_type").agg(F.count("*").alias("n"))


@query("graph_messages", f"""
WITH {MESH} SELECT dst AS id, count(*) AS smaller, avg(p_size) AS mean_size FROM mesh JOIN part a ON p_partkey = src
WHERE p_size < (SELECT b.p_size FROM part b WHERE b.p_partkey = dst) GROUP BY dst""")
def graph_messages(t):
    v = t.part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"))
    sent = F.when(F.col("src_size") < F.col("dst_size"), F.col("src_size"))
    return og.aggregate_messages(v, part_mesh(t), [F.count("*").alias("smaller"), F.avg("msg").alias("mean_size")], to_dst=sent)


@query("graph_cc", """
SELECT o_orderkey AS id, min(o_orderkey) OVER (PARTITION BY o_custkey) AS component FROM orders""")
def graph_cc(t):
    return og.connected_components(order_chain(t), t.orders.select(F.col("o_orderkey").alias("id")))


@query("graph_sssp", """
WITH RECURSIVE d AS (SELECT 0::BIGINT AS id, 0::DOUBLE AS distance UNION ALL SELECT p_partkey, distance + p_size FROM d JOIN part ON p_partkey > 0 AND p_partkey // 2 = id)
SELECT id, distance FROM d""")
def graph_sssp(t):
    return og.shortest_distance(part_tree(t), 0, "w")


@query("graph_pregel", f"""
WITH {MESH}, {IDS}, s0 AS (SELECT id, id AS s FROM ids),
s1 AS (SELECT id, greatest(s, coalesce((SELECT max(b.s) FROM mesh JOIN s0 b ON b.id = src WHERE dst = a.id), s)) AS s FROM s0 a),
s2 AS (SELECT id, greatest(s, coalesce((SELECT max(b.s) FROM mesh JOIN s1 b ON b.id = src WHERE dst = a.id), s)) AS s FROM s1 a)
SELECT id, s AS state FROM s2""")
def graph_pregel(t):
    """The largest id that reaches a part in at most two steps."""
    e = part_mesh(t)
    start = og.vertices_of(e).withColumn("state", F.col("id"))
    return og.pregel(start, e, F.col("state"), F.max, F.col("msg"), F.col("msg") > F.col("state"), 2)


@query("graph_landmarks", """
WITH RECURSIVE h AS (SELECT p_partkey AS id, p_partkey AS landmark, 0 AS hops FROM part WHERE p_partkey IN (1, 5, 6)
UNION ALL SELECT p_partkey, landmark, hops + 1 FROM h JOIN part ON p_partkey > 0 AND p_partkey // 2 = id) SELECT id, landmark, hops FROM h""")
def graph_landmarks(t):
    return og.hops_to_landmarks(og.reverse(part_tree(t).select("src", "dst")), [1, 5, 6])


@query("graph_triangles", f"""
WITH {MESH}, {IDS}, e AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM mesh WHERE src <> dst),
tri AS (SELECT x.a, x.b, y.b AS c FROM e x JOIN e y ON x.b = y.a JOIN e z ON z.a = x.a AND z.b = y.b),
n AS (SELECT unnest([a, b, c]) AS id FROM tri), c AS (SELECT id, count(*) AS n FROM n GROUP BY id)
SELECT ids.id, coalesce(n, 0) AS triangles FROM ids LEFT JOIN c ON c.id = ids.id""")
def graph_triangles(t):
    return og.triangle_count(part_mesh(t))


def unrolled_ranks(steps):
    parts = [f"WITH {MESH}", IDS, "o AS (SELECT src, count(*) AS d FROM mesh GROUP BY src)", "r0 AS (SELECT id, 1.0::DOUBLE AS rank FROM ids)"]
    for i in range(steps):
        parts.append(f"""r{i + 1} AS (SELECT ids.id, 0.15 + 0.85 * coalesce(g, 0) AS rank FROM ids LEFT JOIN
  (SELECT dst, sum(rank / d) AS g FROM mesh JOIN o USING (src) JOIN r{i} ON r{i}.id = mesh.src GROUP BY dst) ON dst = ids.id)""")
    return ", ".join(parts) + f" SELECT id, round(rank, 8) AS rank FROM r{steps}"


@query("graph_pagerank", unrolled_ranks(5))
def graph_pagerank(t):
    return og.page_rank(part_mesh(t), 5).withColumn("rank", F.round("rank", 8))


@query("graph_pagerank_tolerance")
def graph_pagerank_tolerance(t):
    return og.page_rank(part_mesh(t), None, 0.01)


def unrolled_labels(steps):
    parts = [f"WITH {MESH}", IDS, "a AS (SELECT src, dst FROM mesh UNION ALL SELECT dst, src FROM mesh)", "l0 AS (SELECT id, id AS label FROM ids)"]
    for i in range(steps):
        parts.append(f"l{i + 1} AS (SELECT dst AS id, label FROM (SELECT dst, label, count(*) AS n FROM a JOIN l{i} ON id = src GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY dst ORDER BY n DESC, label) = 1)")
    return ", ".join(parts) + f" SELECT id, label FROM l{steps}"


@query("graph_label_prop", unrolled_labels(3))
def graph_label_prop(t):
    return og.label_propagation(part_mesh(t), 3)


@query("graph_closure", """
WITH RECURSIVE c AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part WHERE p_partkey > 0
UNION SELECT src // 2, dst FROM c WHERE src > 0) SELECT src, dst FROM c""")
def graph_closure(t):
    return og.transitive_closure(part_tree(t))


@query("graph_tree_level_min", """
WITH RECURSIVE d AS (SELECT 0::BIGINT AS id, 1 AS level UNION ALL SELECT p_partkey, level + 1 FROM d JOIN part ON p_partkey > 0 AND p_partkey // 2 = id)
SELECT level, min(p_retailprice) AS smallest FROM d JOIN part ON p_partkey = id GROUP BY level""")
def graph_tree_level_min(t):
    up = F.when(F.col("p_partkey") > 0, F.expr("p_partkey div 2"))
    depth = og.levels(t.part.select("p_partkey", up.alias("up")), "p_partkey", "up")
    return level_minimum(depth.join(t.part, F.col("id") == F.col("p_partkey")), "level", "p_retailprice")


@query("graph_partition_1d", f"""
WITH {MESH} SELECT count(*) AS edges, true AS fits, 1::BIGINT AS most_of_src FROM mesh""")
def graph_partition_1d(t):
    """All edges of a source lie in one part."""
    return spread_of_src(og.edge_partition(part_mesh(t), "1d", 16))


@query("graph_partition_2d", f"""
WITH {MESH} SELECT count(*) AS edges, true AS fits, true AS in_one_row, true AS in_one_column FROM mesh""")
def graph_partition_2d(t):
    """Parts form a grid of 4 by 4: all edges of a source lie in one row, all edges of a target in one column."""
    cut = og.edge_partition(part_mesh(t), "2d", 16).withColumns({"row": F.floor(F.col("part") / 4), "column": F.col("part") % 4})
    one = lambda end, place: cut.groupBy(end).agg(F.countDistinct(place).alias("n")).agg((F.max("n") == 1).alias(f"in_one_{place}"))
    return cut.agg(F.count("*").alias("edges"), F.bool_and(F.col("part").between(0, 15)).alias("fits")).join(F.broadcast(one("src", "row"))).join(F.broadcast(one("dst", "column")))


def spread_of_src(cut):
    per_src = cut.groupBy("src").agg(F.count("*").alias("edges"), F.countDistinct("part").alias("n"), F.bool_and(F.col("part").between(0, 15)).alias("fits"))
    return per_src.agg(F.sum("edges").alias("edges"), F.bool_and("fits").alias("fits"), F.max("n").alias("most_of_src"))


@query("graph_partition_cuts", f"""
WITH {MESH} SELECT true AS same, count(*) AS edges FROM mesh""")
def graph_partition_cuts(t):
    """The canonical cut puts both directions of an edge in one part; the random cut covers all edges."""
    e = part_mesh(t)
    cut = og.edge_partition(e, "canonical", 16, "c")
    turned = og.edge_partition(og.reverse(e), "canonical", 16, "c2").select(F.col("src").alias("dst"), F.col("dst").alias("src"), "c2")
    both = og.edge_partition(cut.join(turned, ["src", "dst"]), "random", 16, "r")
    return both.agg(F.bool_and((F.col("c") == F.col("c2")) & F.col("r").between(0, 15)).alias("same"), F.count("*").alias("edges"))


@query("graph_pic")
def graph_pic(t):
    # even ids are suppliers, odd ones parts
    weights = t.lineitem.groupBy((2 * F.col("l_suppkey")).alias("src"), (2 * F.col("l_partkey") + 1).alias("dst")).agg(F.sum("l_quantity").alias("w"))
    return og.power_iteration_clusters(weights, 3, 5)
