"""Steps that must stay spread over tasks and off the driver, read from the plans."""

from pyspark.sql import functions as F

import millrace.plans  # noqa: F401
from millrace.operators import graph as og
from millrace.plans import models
from millrace.registry import QUERIES


def table(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_pregel_sends_no_vertices_to_the_driver(spark, monkeypatch):
    plans, keep = [], og.checkpointed

    def checkpointed(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)

    monkeypatch.setattr(og, "checkpointed", checkpointed)
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 2, 2.0), (0, 2, 5.0), (7, 8, 1.0)], "src int, dst int, w double")
    got = {r["id"]: r["distance"] for r in og.shortest_distance(edges, 0, "w").collect()}
    assert got == {0: 0.0, 1: 1.0, 2: 3.0, 7: None, 8: None}
    assert len(plans) > 2 and not any("Broadcast" in p for p in plans)


def test_terms_are_counted_without_whole_arrays(spark, tmp_path):
    texts = [(1, "a b b c"), (2, "a"), (3, "")]
    table(spark, tmp_path, "documents", texts, "doc_id bigint, text string")
    out = QUERIES["ml_hashing_tf"](spark, str(tmp_path))
    # the idf of a term in two of three documents is above 0
    assert sorted((r["doc_id"], r["terms"]) for r in out.collect())[:2] == [(1, 3), (2, 1)]
    assert "UDF(tfidf" not in out._jdf.queryExecution().analyzed().toString()


def test_sketches_are_not_kept_for_every_order(spark, tmp_path):
    rows = [("A", 1), ("A", 1), ("A", 2), ("A", None), (None, 3), (None, 3), ("R", None)]
    table(spark, tmp_path, "lineitem", rows, "l_returnflag string, l_orderkey bigint")
    out = QUERIES["approx_distinct"](spark, str(tmp_path))
    assert sorted(map(str, out.collect())) == sorted(f"Row(l_returnflag={k!r}, about={n}, exact={n})" for k, n in (("A", 2), (None, 1), ("R", 0)))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("approx_count_distinct" in line and "l_orderkey" in line.split("]")[0] for line in plan.splitlines())


def test_xpaths_are_read_by_several_tasks(spark, tmp_path):
    table(spark, tmp_path, "customer", [(i, f"c{i}", i % 5, 1.5) for i in range(20)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double")
    out = QUERIES["fn_xpath"](spark, str(tmp_path))
    assert out.groupBy(F.spark_partition_id()).count().count() > 1 or "Repartition" in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["c_custkey"], r["name"], r["n"], r["counted"]) for r in out.collect()) == [(i, f"c{i}", i % 5, 2.0) for i in range(20)]


def test_word_vectors_are_learnt_by_tasks_of_so_many_documents(spark, tmp_path, monkeypatch):
    table(spark, tmp_path, "documents", [(i, "some words come here again and again") for i in range(90)], "doc_id bigint, text string")
    seen, fit = [], models.mf.Word2Vec.fit
    monkeypatch.setattr(models, "W2V_ROWS", 40)
    monkeypatch.setattr(models.mf.Word2Vec, "fit", lambda self, df: seen.append(self.getNumPartitions()) or fit(self, df))
    assert QUERIES["ml_word2vec"](spark, str(tmp_path)).count() == 90 and seen == [3]
