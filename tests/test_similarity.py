"""Exact similarity joins against brute force, and the recall of the approximate ones against them."""

import math
import random

import pytest
from pyspark.sql import functions as F

import millrace.plans  # noqa: F401
from millrace.operators import similarity as si
from millrace.registry import QUERIES, Tables

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("threshold", [0.3, 0.75, 1.0])
def test_set_join(spark, monkeypatch, threshold):
    monkeypatch.setattr(si, "COMMON", 8)
    r = random.Random(5)
    sets = {i: [r.choice(["a", "b", "c", None]) if r.random() < 0.5 else f"x{r.randrange(12)}" for _ in range(r.randrange(9))] for i in range(120)}
    sets |= {200: None, 201: [], 202: [None], 203: ["a"], 204: ["a"], 205: ["a", "b", "a"]}
    df = spark.createDataFrame(list(sets.items()), "id int, items array<string>")
    whole, members = si.distinct_sets(df, "id", F.col("items"))
    named = {i: frozenset(x for x in s or [] if x is not None) for i, s in sets.items()}
    least = {s: min(i for i, t in named.items() if t == s) for s in named.values() if s}
    assert sorted(map(tuple, members.collect())) == sorted((least[s], i) for i, s in named.items() if s)
    alike = lambda s, t: len(s & t) >= threshold * len(s | t) - 1e-9
    want = sorted((a, b, len(s & t)) for s, a in least.items() for t, b in least.items() if a < b and alike(s, t))
    assert sorted(map(tuple, si.set_join(whole, None, threshold).collect())) == want
    left, right = whole.where("id % 2 = 0"), whole.where("id % 2 = 1")
    want = sorted((a, b, len(s & t)) for s, a in least.items() for t, b in least.items() if a % 2 == 0 and b % 2 == 1 and alike(s, t))
    assert sorted(map(tuple, si.set_join(left, right, threshold).collect())) == want
    assert si.set_join(whole.limit(0), None, threshold).collect() == []


def test_unlike_sets_do_not_travel(spark, monkeypatch):
    """Sets of common items meet all others, in several blocks of an item; few of them are laid down as pairs."""
    monkeypatch.setattr(si, "BLOCK", 20)
    r, laid, keep = random.Random(8), [], si.checkpointed
    sets = {i: frozenset(r.sample(range(60), r.randint(15, 25))) for i in range(300)}
    sets |= {1000 + i: sets[i] ^ {0, 1} for i in range(20)}

    def checkpointed(df):
        out = keep(df)
        if out.columns == ["a", "b"]:
            laid.append(out.count())
        return out

    monkeypatch.setattr(si, "checkpointed", checkpointed)
    whole, _ = si.distinct_sets(spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id int, items array<int>"), "id", F.col("items"))
    named = {s: i for i, s in sorted(sets.items(), reverse=True)}
    want = sorted((a, b, len(s & t)) for s, a in named.items() for t, b in named.items() if a < b and len(s & t) >= 0.8 * len(s | t))
    assert sorted(map(tuple, si.set_join(whole, None, 0.8).collect())) == want and len(want) >= 10
    assert laid[0] <= 3 * len(want)  # thousands before


@pytest.mark.parametrize("small", [True, False])
def test_near_join(spark, monkeypatch, small):
    monkeypatch.setattr(si, "is_small", lambda df, n: small)
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 1) for _ in range(5)]) for i in range(150)] + [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [0.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    fine = [(i, v) for i, v in rows[:150]]
    want = {(i, j): math.dist(v, w) for i, v in fine for j, w in fine if math.dist(v, w) <= 1.1}
    got = {(x["a"], x["b"]): x["distance"] for x in si.near_join(df.withColumnRenamed("id", "a"), df.withColumnRenamed("id", "b"), "v", 1.1, 5).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(want) > 200


def test_recall_of_min_hash(spark):
    t = Tables(spark, FOLDER)
    words = lambda df, key: df.select(F.col(key).alias("id"), F.filter(F.split(F.lower("text"), r"\s+"), lambda w: F.length(w) > 0).alias("w"))
    docs, doc_of = si.distinct_sets(words(t.documents, "doc_id"), "id", F.col("w"))
    items, item_of = si.distinct_sets(words(t.benchmark, "item_id"), "id", F.col("w"))
    pairs = si.set_join(docs, items, 0.1000001).join(doc_of.withColumnsRenamed({"id": "a", "member": "doc_id"}), "a").join(item_of.withColumnsRenamed({"id": "b", "member": "item_id"}), "b")
    want = {(r["doc_id"], r["item_id"]) for r in pairs.collect()}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["join_minhash"](spark, FOLDER).collect()}
    assert len(want) > 10 and len(got & want) >= 0.9 * len(want), (len(got & want), len(want))


def test_recall_of_projections(spark):
    t = Tables(spark, FOLDER)
    dims = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    centres = dims.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("p")).select(F.col("label").alias("centre"), F.col("p.x").alias("v"))
    vectors = t.embeddings.select("vec_id", F.col("embedding").alias("v"))
    want = {(r["vec_id"], r["centre"]) for r in si.near_join(vectors, centres, "v", 1.2, 64).where("distance < 1.2").collect()}
    got = {(r["vec_id"], r["centre"]) for r in QUERIES["join_brp"](spark, FOLDER).collect()}
    assert len(want) > 10 and got <= want and len(got) >= 0.9 * len(want), (len(got & want), len(want))


def test_boxes_of_vectors(spark, monkeypatch):
    """Many boxes, equal vectors and far groups: all near pairs, bit for bit, and far boxes do not meet."""
    monkeypatch.setattr(si, "is_small", lambda df, n: False)
    monkeypatch.setattr(si, "BOX", 20)
    r, met, keep = random.Random(9), [], si.checkpointed
    rows = [(i, [r.gauss(40 * (i % 3), 1) for _ in range(6)]) for i in range(240)] + [(1000 + i, [0.5] * 6) for i in range(60)] + [(2000, [float("inf")] * 6)]

    def checkpointed(df):
        out = keep(df)
        if out.columns == ["_i", "_j"]:
            met.append(out.count())
        return out

    monkeypatch.setattr(si, "checkpointed", checkpointed)
    df = spark.createDataFrame(rows, "id int, v array<double>")
    pairs = df.toDF("a", "v").crossJoin(df.toDF("b", "w")).withColumn("distance", si.distance(F.col("v"), F.col("w"))).where("distance <= 1.5").select("a", "b", "distance")
    got = si.near_join(df.toDF("a", "v"), df.toDF("b", "v"), "v", 1.5, 6, 3)
    assert got.columns == ["a", "b", "distance"] and sorted(map(tuple, got.collect())) == sorted(map(tuple, pairs.collect())) and got.count() > 3600
    assert met[0] < 15 * 15 / 2
    assert si.near_join(df.toDF("a", "v").limit(0), df.toDF("b", "v"), "v", 1.5, 6, 3).collect() == []


def test_min_hash_join_is_the_models_own(spark):
    """Equal ids, equal rows and a null id; no features travel with the hashes."""
    from pyspark.ml.feature import HashingTF, MinHashLSH

    r = random.Random(3)
    rows = [(i % 70 if i % 9 else None, [f"w{r.randrange(40)}" for _ in range(r.randint(1, 60))]) for i in range(90)]
    df = HashingTF(inputCol="w", outputCol="features", binary=True, numFeatures=1 << 12).transform(spark.createDataFrame([*rows, *rows[:5]], "id int, w array<string>"))
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=6, seed=7).fit(df)
    left, right = df.select("id", "features"), df.where("id < 20").select("id", "features")
    want = model.approxSimilarityJoin(left, right, 0.7, "distance").select("datasetA.id", "datasetB.id", "distance")
    got = si.min_hash_join(left, right, model, 0.7)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect()))) and got.count() > 50


def laid_down(monkeypatch):
    """The tables that the joins write, with the plans that they are made by."""
    made, keep = [], si.checkpointed

    def checkpointed(df):
        out = keep(df)
        made.append((out, df._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(si, "checkpointed", checkpointed)
    return made


def test_sets_are_written_once(spark, monkeypatch):
    """A set's items are on disk once, and nothing else of a set grows with its items but bits."""
    r, made = random.Random(21), laid_down(monkeypatch)
    sets = {i: frozenset(r.sample(range(20_000), 300)) for i in range(400)}
    sets |= {1000 + i: sets[i] ^ {i} for i in range(0, 400, 8)} | {2000 + i: sets[i] for i in range(5)}
    df = spark.createDataFrame([(i, [f"word{x}" for x in s]) for i, s in sets.items()], "id int, items array<string>")
    whole, members = si.distinct_sets(df, "id", F.col("items"))
    got = sorted(map(tuple, si.set_join(whole, None, 0.7).collect()))
    assert got == sorted((i, 1000 + i, len(sets[i] & sets[1000 + i])) for i in range(0, 400, 8)) and members.count() == len(sets)
    rows = [(out.count(), len(out.columns), "items" in out.columns) for out, _ in made]
    assert sum(n for n, _, items in rows if items) <= 1.05 * len(sets)
    assert sum(n for n, _, items in rows if not items) <= 6 * len(sets)  # some 90 rows a set before


def test_sets_of_few_items_meet_in_blocks(spark, monkeypatch):
    """Two sides with forty items in all: sets are not laid out by their items, and pairs that are counted are alike."""
    r, made = random.Random(22), laid_down(monkeypatch)
    monkeypatch.setattr(si, "BLOCK", 64)
    monkeypatch.setattr(si, "TILE", (8, 16))
    sets = {i: frozenset(x for x in range(40) if r.random() < 0.55) for i in range(500)}
    sets |= {1001 + i: sets[i] ^ {3, 7} for i in range(0, 500, 10)}
    rows = [(i, sorted(s)) for i, s in sets.items()]
    left, right = (si.distinct_sets(spark.createDataFrame([x for x in rows if x[0] % 2 == k], "id int, items array<int>"), "id", F.col("items"))[0] for k in (0, 1))
    del made[:]
    want = sorted((i, j, len(s & t)) for i, s in sets.items() for j, t in sets.items() if i % 2 == 0 and j % 2 and len(s & t) >= 0.8 * len(s | t))
    assert sorted(map(tuple, si.set_join(left, right, 0.8).collect())) == want and len(want) >= 50
    laid = [out.count() for out, _ in made if out.columns == ["a", "b"]]
    assert laid == [len(want)] and sum(out.count() for out, _ in made) <= 1.5 * len(sets) + 2 * len(want)


def test_boxes_are_not_copied_for_their_meetings(spark, monkeypatch):
    """A table's near pairs with itself, equal ids and vectors among them: boxes are written once and read again for each meeting."""
    made = laid_down(monkeypatch)
    monkeypatch.setattr(si, "BOX", 30)
    r = random.Random(23)
    rows = [(i % 300, [r.gauss(0, 1) for _ in range(6)]) for i in range(320)] + [(1000 + i, [0.25] * 6) for i in range(50)] + [(2000, None), (2001, [1.0])]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    left, right = df.toDF("a", "v").where("size(v) = 6"), df.toDF("b", "w").where("size(w) = 6")
    wide = lambda c: F.col(c).cast("array<double>")
    want = left.crossJoin(right).where("a < b").withColumn("distance", si.distance(wide("v"), wide("w"))).where("distance <= 1.4").select("a", "b", "distance")
    got = si.near_pairs(df, "id", "v", 1.4, 6, 3)
    assert got.columns == ["a", "b", "distance"] and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 1300
    (plan,) = [plan for out, plan in made if out.columns == ["a", "b", "distance"]]
    assert "CartesianProduct" in plan and "FlatMapCoGroups" not in plan
    assert sum(out.count() for out, _ in made if "_v" in out.columns) < 30
    assert si.near_pairs(df.limit(0), "id", "v", 1.4, 6, 3).collect() == []


def test_ranges_beyond_single_precision():
    """Very long and very short vectors are measured as others are."""
    import numpy as np

    for scale in (1e-30, 1.0, 1e18, 1e40):
        u = np.random.default_rng(24).normal(size=(40, 5)) * scale
        found = {(int(i), int(j)) for a, b, _ in si._near_pairs(u, u, 1.5 * scale, True) for i, j in zip(a, b)}
        assert found == {(i, j) for i in range(40) for j in range(i + 1, 40) if np.sqrt(((u[i] - u[j]) ** 2).sum()) <= 1.5 * scale} and found
