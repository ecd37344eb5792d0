"""The best items of users against all products."""

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from millrace.operators import recommend


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id int, features array<float>")


@pytest.mark.parametrize("k, cell", [(3, 16), (1, 512)])
def test_best_items_are_those_of_all_products(spark, monkeypatch, k, cell):
    monkeypatch.setattr(recommend, "CELL", cell)
    monkeypatch.setattr(recommend, "LAID", 300)
    monkeypatch.setattr(recommend, "SCOUTS", 5)
    monkeypatch.setattr(recommend, "TOGETHER", 7)
    r = np.random.RandomState(k)
    users, items = r.randn(60, 4), r.randn(900, 4) * r.gamma(1, 1, 900)[:, None]
    users[0], items[5], items[700:720] = 0, 0, items[int((items**2).sum(1).argmax())]  # equal products
    got = {}
    for row in recommend.best_items(frame(spark, users), frame(spark, items), k).collect():
        got.setdefault(row["user"], []).append((row["rating"], row["item"]))
    score = recommend._products(users.astype(np.float32), items.astype(np.float32))
    for u in range(60):
        assert sorted(got[u]) == sorted((float(s), i) for i, s in enumerate(score[u]))[-k:]


def test_best_items_of_a_model(spark):
    ratings = spark.range(4000).select((F.col("id") % 40).cast("int").alias("s"), (F.col("id") * 7919 % 611).cast("int").alias("p"), (F.col("id") % 50).cast("double").alias("q"))
    model = ALS(userCol="s", itemCol="p", ratingCol="q", rank=6, maxIter=2, seed=1).fit(ratings)
    got = recommend.best_items(model.userFactors, model.itemFactors, 3).collect()
    assert sorted(got) == sorted(model.recommendForAllUsers(3).select("s", F.inline("recommendations")).collect())


def test_few_items_or_none(spark):
    users, items = frame(spark, [[1, 2], [0, -1]]), frame(spark, [[1, 1], [2, 0]])
    assert recommend.best_items(users, items, 3).count() == 4
    assert recommend.best_items(users, items.limit(0), 3).count() == recommend.best_items(users.limit(0), items, 3).count() == 0
