"""Frequent sequences against the library's own, which takes a sequence as one cell."""

import random

import pytest
from pyspark.ml.fpm import PrefixSpan
from pyspark.sql import functions as F

from millrace.operators.sequences import prefix_span


@pytest.mark.parametrize("seed, min_rows", [(1, 10), (2, 10**9)])
def test_prefix_span(spark, seed, min_rows):
    r = random.Random(seed)
    seqs = {k: [sorted(r.sample("abcd", r.randint(1, 3))) for _ in range(r.randint(0, 6) if k else 40)] for k in [None, *range(1, 30)]}
    rows = [(k, p, x) for k, sets in seqs.items() for p, s in enumerate(sets) for x in s] + [(k, None, None) for k in seqs] + [(1, None, "a"), (2, 3, None)]
    rows += rows[:20]  # a repeated row is no other item
    df = spark.createDataFrame(rows, "user int, at int, kind string")
    whole = spark.createDataFrame([([*s],) for s in seqs.values()], "sequence array<array<string>>")
    want = PrefixSpan(minSupport=0.3, maxPatternLength=4).findFrequentSequentialPatterns(whole)
    got = prefix_span(df, "user", F.col("at"), F.col("kind"), 0.3, 4, min_rows)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_prefix_span_empty(spark):
    assert prefix_span(spark.createDataFrame([], "user int, at int, kind string"), "user", F.col("at"), F.col("kind"), 0.3).collect() == []


def test_prefix_span_by_counting(spark):
    """Every pattern of at most three items, counted in each sequence by hand; most events hold several items."""
    from itertools import combinations, product

    r = random.Random(7)
    seqs = {k: [sorted(r.sample("abcd", r.randint(1, 3))) for _ in range(r.randint(0, 5) if k else 40)] for k in [None, *range(1, 30)]}
    sets = [list(c) for n in (1, 2, 3) for c in combinations("abcd", n)]
    patterns = [list(p) for n in (1, 2, 3) for p in product(sets, repeat=n) if sum(map(len, p)) <= 3]

    def holds(seq, pattern):
        done = 0
        for s in seq:
            done += done < len(pattern) and set(pattern[done]) <= set(s)
        return done == len(pattern)

    counts = [(p, sum(holds(s, p) for s in seqs.values())) for p in patterns]
    df = spark.createDataFrame([(k, p, x) for k, s in seqs.items() for p, e in enumerate(s) for x in e] + [(k, None, None) for k in seqs], "user int, at int, kind string")
    for min_rows in (10, 10**9):
        got = prefix_span(df, "user", F.col("at"), F.col("kind"), 0.3, 3, min_rows)
        assert sorted((x["sequence"], x["freq"]) for x in got.collect()) == sorted((p, n) for p, n in counts if n >= 9)


def test_single_events_meet_no_patterns(spark, monkeypatch):
    """Events of one item are looked up in order; only sets of several items are met by patterns."""
    from millrace.operators import sequences

    met, keep = [], sequences.salted_join
    monkeypatch.setattr(sequences, "salted_join", lambda left, *a, **b: met.append(left.count()) or keep(left, *a, **b))
    df = spark.range(400).selectExpr("id % 4 AS user", "id AS at", "string(id % 3) AS kind")
    assert prefix_span(df, "user", F.col("at"), F.col("kind"), 0.5, 3).count() == 39 and met == [0, 0]
