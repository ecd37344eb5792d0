"""Delimited text whose values hold the marks, and forests with cycles."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph as og
from millrace.session import scratch_path
from millrace.sources import files as sf

KIND = "id int, s string, xs array<string>, m map<string,string>, n double"


@pytest.mark.parametrize("how", [{"field": "|", "item": ";", "key": "=", "escape": "\\", "null": "\\N"}, {"field": "\t", "item": ",", "key": ":", "escape": "$", "null": "NULL", "line": "\x1e"}])
def test_round_trip(spark, how):
    r = random.Random(11)
    bits = ["|", ";", "=", "\\", "\n", "\r", "n", "r", "N", "NULL", "\\N", "\t", ",", ":", "$", "x", "é", " ", "\x1e", "\x00", "$NULL"]
    text = lambda: None if r.random() < 0.1 else "".join(r.choice(bits) for _ in range(r.randrange(5)))
    filled = lambda: text() or "k"
    rows = [(i, text(), None if i % 9 == 0 else [text() or "y" if i % 2 else filled() for _ in range(r.randint(1, 3))], None if i % 7 == 0 else {filled(): text()}, r.choice([None, 1.5])) for i in range(400)]
    df = spark.createDataFrame(rows, KIND)
    path = scratch_path(spark, "delimited")
    sf.write_delimited(df, path, **how)
    back = sf.read_delimited(spark, path, {"id": "int", "s": "string", "xs": "array<string>", "m": "map<string,string>", "n": "double"}, **how)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_marks_without_an_escape(spark):
    df = spark.createDataFrame([("a|b",)], "s string")
    with pytest.raises(Exception, match="holds a mark"):
        sf.write_delimited(df, scratch_path(spark, "bad"), field="|")
    with pytest.raises(ValueError):
        sf.write_delimited(df, scratch_path(spark, "bad"), field="|", escape="|")


def test_levels_of_a_cycle(spark):
    forest = [(1, None), (2, 1), (3, 2), (4, 99)]
    links = spark.createDataFrame(forest, "c int, p int")
    assert sorted(map(tuple, og.levels(links, "c", "p").collect())) == [(1, 1), (2, 2), (3, 3), (4, 1)]
    with pytest.raises(RuntimeError, match="cycle"):
        og.levels(links.union(spark.createDataFrame([(7, 8), (8, 7)], "c int, p int")), "c", "p")
    assert og.levels(links.where(F.lit(False)), "c", "p").collect() == []
