"""Operators on small hand-made tables, against answers worked out in plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from millrace.functions import casts, rows as fr
from millrace.jobs import attributes as ja, label_metrics as jl, logs_and_assets as jw
from millrace.operators import aggregates as oa, features as of, graph as og, joins as oj, reshape as rs, sampling as sp, sorting as so, stats as st
from millrace.session import scratch_path
from millrace.sources import files as sf, generate as sg
from millrace.sources.avro import avro_available, avro_schema, decode_struct, encode_struct


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# joins


def test_unique_join_keeps_preserved_sides(spark):
    a = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), (None, "n")], "key string, val string")
    b = spark.createDataFrame([("2", "x"), ("3", "y"), ("4", "z")], "key string, val string")
    c = spark.createDataFrame([("2", "p"), ("2", "q"), ("5", "r")], "key string, val string")

    def keys(keep):
        out = oj.unique_join([("a", a, ["key"], "a" in keep), ("b", b, ["key"], "b" in keep), ("c", c, ["key"], "c" in keep)])
        return rows(out.select("a_key", "b_key", "c_key"))

    def by(r):
        return repr(r)

    both = [("2", "2", "2"), ("2", "2", "2")]
    assert keys("") == both
    # the row without a key is on a preserved side, so it stays and matches nothing
    assert keys("a") == sorted([*both, ("1", None, None), ("3", "3", None), (None, None, None)], key=by)
    assert keys("abc") == sorted([*both, ("1", None, None), ("3", "3", None), (None, None, None), (None, "4", None), (None, None, "5")], key=by)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    rnd = random.Random(3)
    left = spark.createDataFrame([(i, "hot" if rnd.random() < 0.6 else rnd.choice([None, "a", "b", "c"])) for i in range(400)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("z", 4)], "k string, w int")
    assert rows(oj.salted_join(left, right, ["k"], how, 5, min_rows=20)) == rows(left.join(right, ["k"], how))


def test_salted_join_refuses_right_joins(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        oj.salted_join(df, df, ["k"], "right")


def test_range_join(spark):
    points = [(i, i * 7 % 50) for i in range(60)]
    spans = [(j, j * 3, j * 3 + j % 9) for j in range(20)] + [(99, 10, 5)]
    got = oj.range_join(spark.createDataFrame(points, "p int, at int"), "at", spark.createDataFrame(spans, "s int, lo int, hi int"), "lo", "hi", 4.0)
    assert rows(got.select("p", "s")) == sorted(((p, s) for p, at in points for s, lo, hi in spans if lo <= at <= hi), key=repr)


@pytest.mark.parametrize("left,right,want", [
    ([1, 2, None], [2], [1]), ([1, 2, None], [2, None], []), ([1, None], [], [1, None]),
])
def test_not_in(spark, left, right, want):
    a = spark.createDataFrame([(v,) for v in left], "x int")
    b = spark.createDataFrame([(v,) for v in right], "y int")
    assert rows(oj.not_in(a, "x", b, "y")) == sorted(((v,) for v in want), key=repr)


def test_joins_check_sizes(spark):
    big, small = spark.range(100), spark.range(3).withColumnRenamed("id", "s")
    assert oj.is_small(small, 3) and not oj.is_small(big, 99)
    assert rows(oj.cross_join(small, big, max_rows=50)) == rows(oj.cross_join(small, big)) and oj.cross_join(small, big, max_rows=50).count() == 300
    near = F.col("s") * 40 < F.col("id")
    assert rows(oj.theta_join(small, big, near, max_rows=50)) == rows(oj.theta_join(small, big, near))
    plan = oj.broadcast_join(big, small, F.col("id") == F.col("s"), max_rows=2)
    assert plan.count() == 3


def test_inequality_counts(spark):
    data = [("a", 1), ("a", 1), ("a", 3), ("b", 2), ("b", 5)]
    df = spark.createDataFrame(data, "g string, v int")
    want = sorted(((g, v, sum(1 for h, w in data if h == g and w < v)) for g, v in data), key=repr)
    assert rows(oj.inequality_counts(df, df, "v", ["g"])) == want


# aggregates, text


def test_ngrams_stay_inside_sentences(spark):
    df = spark.createDataFrame([("One two three! Two three four.",), ("",)], "t string")
    assert rows(oa.ngram_counts(df, "t", 2)) == sorted([("one two", 1), ("three four", 1), ("two three", 2)], key=repr)
    assert rows(oa.context_ngrams(df, "t", ["two"], 5)) == [("three", 2)]


def test_word_ngrams_and_tokens(spark):
    df = spark.createDataFrame([("  A b  c ",), ("x",), ("",)], "t string")
    assert [r[0] for r in df.select(of.tokens("t")).collect()] == [["a", "b", "c"], ["x"], []]
    assert [r[0] for r in df.select(of.ngrams(of.tokens("t"), 2)).collect()] == [["a b", "b c"], [], []]


def test_profile_counts_missing_values(spark):
    df = spark.createDataFrame([(1, "a"), (None, "bbb"), (3, None)], "n int, s string")
    out = {r["column"]: r for r in oa.profile(df).collect()}
    assert (out["n"]["filled"], out["n"]["nulls"], out["n"]["mean"], out["s"]["longest"], out["s"]["largest"]) == (2, 1, 2.0, 3, "bbb")


def test_bitmaps(spark):
    a = spark.createDataFrame([(1, v) for v in (1, 5, 5, 40000, 70000)], "k int, v bigint")
    b = spark.createDataFrame([(1, v) for v in (5, 40000, 9)], "k int, v bigint")
    x, y = oa.bitmap_by_key(a, ["k"], "v"), oa.bitmap_by_key(b, ["k"], "v")
    assert oa.bitmap_count(x, ["k"]).first()["members"] == 4
    assert oa.bitmap_and(x, y, ["k"], "n").first()["n"] == 2


def test_estimate_covers_the_truth(spark):
    df = spark.range(20000).withColumn("v", (F.col("id") % 10).cast("double"))
    e = oa.estimate(df, 0.2, 5, "v", z=4).first()
    assert e["row_count_low"] < 20000 < e["row_count_high"] and e["total_low"] < 90000 < e["total_high"] and e["mean_low"] < 4.5 < e["mean_high"]


def test_tf_idf_and_pairs(spark):
    import math

    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "b")], "id int, t string")
    out = {(r["id"], r["term"]): (r["tf"], r["tfidf"]) for r in of.tf_idf(docs, "id", of.tokens("t")).collect()}
    assert out[1, "a"][0] == 2 and abs(out[1, "a"][1] - 2 * math.log(4 / 2)) < 1e-12 and abs(out[2, "b"][1]) < 1e-12
    baskets = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (2, "x"), (2, "y"), (3, "x"), (4, "z")], "b int, i string")
    rules = {(r["antecedent"], r["consequent"]): (r["support"], r["confidence"]) for r in of.item_pairs(baskets, "b", "i", 0.5).collect()}
    assert rules == {("x", "y"): (0.5, 2 / 3), ("y", "x"): (0.5, 1.0)}


# sampling


def test_sketches(spark):
    rnd = random.Random(1)
    data = [(int(rnd.paretovariate(1)),) for _ in range(3000)]
    df = spark.createDataFrame(data, "v int")
    truth = Counter(v for v, in data)
    est = {r["v"]: r["estimate"] for r in sp.count_min_estimate(sp.count_min_table(df, "v", 4, 300), df.distinct(), "v", 4, 300).collect()}
    assert all(est[v] >= n for v, n in truth.items())
    assert sum(est[v] - n > 3 * 3000 / 300 for v, n in truth.items()) <= len(truth) * 0.02 + 1
    assert rows(sp.frequent_items(df, "v", 0.2)) == sorted(((v, n) for v, n in truth.items() if n > 600), key=repr)
    bloom = sp.bloom_build(spark.range(0, 500), "id", 1 << 13, 4)
    flags = sp.bloom_might_contain(spark.range(0, 1500), "id", bloom, 1 << 13, 4)
    assert flags.where("id < 500 AND NOT maybe").count() == 0
    assert flags.where("id >= 500 AND maybe").count() < 50


def test_samples(spark):
    df = spark.range(5000).withColumn("s", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    n = dict(rows(sp.stratified(df, "s", {"even": 0.2}, ["id"], 1).groupBy("s").count()))
    assert set(n) == {"even"} and 400 < n["even"] < 600
    parts = sp.split(df, ["id"], [1, 1, 2], 4)
    assert rows(parts[0].union(parts[1]).union(parts[2])) == rows(df) and abs(parts[2].count() - 2500) < 200
    assert sp.reservoir(df, 7, ["id"], 2).count() == 7
    assert abs(sp.poisson_sample(df, 1.5, ["id"], 3).count() - 7500) < 500
    assert 100 / 5000 < sp.fraction_for(100, 5000) < 0.06
    for bad in (lambda: sp.bucket(df, 0, 4, "id"), lambda: sp.percent(df, -1, 1)):
        with pytest.raises(ValueError):
            bad()


def test_random_columns(spark):
    m = sg.random_table(spark.range(20000), "id").agg(*[F.avg(c).alias(c) for c in ("uniform", "normal", "poisson", "exponential", "gamma")]).first()
    assert abs(m["uniform"] - 0.5) < 0.02 and abs(m["normal"]) < 0.05 and abs(m["poisson"] - 4) < 0.1 and abs(m["exponential"] - 2) < 0.1 and abs(m["gamma"] - 4.5) < 0.15


def test_zip_with_index(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    assert rows(so.zip_with_index(df, ["v"])) == sorted(((i, i) for i in range(1000)), key=repr)


# statistics


def test_normal_cdf(spark):
    import math

    out = spark.range(-3, 4).select("id", st.normal_cdf(F.col("id").cast("double"), 0.5, 1.5).alias("c")).collect()
    assert all(abs(r["c"] - 0.5 * math.erfc(-(r["id"] - 0.5) / 1.5 / math.sqrt(2))) < 2e-7 for r in out)


def test_ranking_metrics_of_a_known_case(spark):
    # the third query has no relevant items
    pred = [(1, i, r) for r, i in enumerate([1, 6, 2, 7, 8, 3, 9, 10, 4, 5], 1)] + [(2, i, r) for r, i in enumerate([4, 1, 5, 6, 2, 7, 3, 8, 9, 10], 1)] + [(3, i, r) for r, i in enumerate([1, 2, 3, 4, 5], 1)]
    truth = [(1, i) for i in (1, 2, 3, 4, 5)] + [(2, i) for i in (1, 2, 3)]
    m = st.ranking_metrics(spark.createDataFrame(pred, "q int, i int, r int"), spark.createDataFrame(truth, "q int, i int"), "q", "i", "r", 2).first()
    assert abs(m["map"] - 0.355026) < 1e-5 and abs(m["precision_at_k"] - 1 / 3) < 1e-9 and abs(m["recall_at_k"] - (1 / 5 + 1 / 3) / 3) < 1e-9


def test_ab_test_needs_two_rows_per_side(spark):
    df = spark.createDataFrame([("a", True, 1.0), ("a", False, 2.0), ("b", True, 1.0), ("b", True, 3.0), ("b", False, 5.0), ("b", False, 7.0)], "g string, e boolean, v double")
    out = {r["g"]: r for r in st.ab_test(df, [F.col("g")], F.col("e"), "v").collect()}
    assert out["a"]["t"] is None and abs(out["b"]["t"] + 4 / 2**0.5) < 1e-9 and abs(out["b"]["degrees"] - 2) < 1e-9


# graphs


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def test_components_of_random_graphs(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(70)] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(1, 30)]
    parent = {v: v for p in pairs for v in p}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert rows(og.connected_components(edges(spark, pairs))) == sorted(((v, find(v)) for v in parent), key=repr)


def test_triangles(spark):
    def count(pairs):
        return dict(rows(og.triangle_count(edges(spark, pairs))))

    assert count([(0, 1), (1, 2), (2, 0)]) == {0: 1, 1: 1, 2: 1}
    two = [(0, 1), (1, 2), (2, 0), (0, -1), (-1, -2), (-2, 0)]
    assert count(two) == {0: 2, 1: 1, 2: 1, -1: 1, -2: 1}
    # reversed and repeated edges and self loops change nothing
    assert count(two + [(b, a) for a, b in two] + [(1, 1)]) == count(two)


def test_landmarks_and_closure(spark):
    pairs = [(1, 2), (1, 5), (2, 3), (2, 5), (3, 4), (4, 5), (4, 6)]
    both = edges(spark, pairs + [(b, a) for a, b in pairs])
    want = {(1, 1): 0, (1, 4): 2, (2, 1): 1, (2, 4): 2, (3, 1): 2, (3, 4): 1, (4, 1): 2, (4, 4): 0, (5, 1): 1, (5, 4): 1, (6, 1): 3, (6, 4): 1}
    assert {(r["id"], r["landmark"]): r["hops"] for r in og.hops_to_landmarks(both, [1, 4]).collect()} == want
    closed = {(a, b) for a, b in pairs}
    while True:
        more = closed | {(a, d) for a, b in closed for c, d in closed if b == c}
        if more == closed:
            break
        closed = more
    assert {tuple(r) for r in og.transitive_closure(edges(spark, pairs)).collect()} == closed


def test_label_propagation_finds_two_groups(spark):
    groups = [[(i, j) for i in range(g, g + 6) for j in range(g, g + 6) if i < j] for g in (0, 10)]
    out = dict(rows(og.label_propagation(edges(spark, groups[0] + groups[1] + [(0, 10)]), 20)))
    assert len({out[i] for i in range(6)}) == 1 and len({out[i] for i in range(10, 16)}) == 1 and out[1] != out[11]


def test_page_rank_and_distance(spark):
    e = edges(spark, [(1, 2), (2, 1), (3, 1)])
    ranks = dict(rows(og.page_rank(e, None, 0.02)))
    assert ranks[3] == 0.15 and abs(ranks[1] - (0.15 + 0.85 * (ranks[2] + ranks[3]))) < 0.05
    w = spark.createDataFrame([(1, 2, 5.0), (1, 3, 1.0), (3, 2, 1.5), (4, 1, 1.0)], "src bigint, dst bigint, w double")
    assert dict(rows(og.shortest_distance(w, 1, "w"))) == {1: 0.0, 2: 2.5, 3: 1.0, 4: None}


def test_edge_partitions(spark):
    e = edges(spark, [(i, j) for i in range(30) for j in range(30, 60)])
    for strategy, parts in (("1d", 7), ("2d", 9), ("2d", 10), ("random", 8), ("canonical", 8)):
        out = og.edge_partition(e, strategy, parts)
        assert out.where(F.col("part").between(0, parts - 1)).count() == 900
    # a grid bounds how many parts one vertex reaches
    assert og.edge_partition(e, "2d", 9).groupBy("src").agg(F.countDistinct("part").alias("n")).agg(F.max("n")).first()[0] <= 3
    with pytest.raises(ValueError):
        og.edge_partition(e, "3d", 4)


# jobs


def test_attribute_changes(spark):
    data = [("p1", '{"a": 1, "b": {"x": 2}, "c": null}'), ("p1", '{"a": 1, "b": {"x": 3}, "d": "n"}'), ("p2", '{"a": 1}'), ("p2", '{"a": 1}'), ("p3", '{"a": 1}'), ("p3", '{"a": 2}'), ("p3", '{"a": 3}'),
            ("p4", "oops {"), ("p4", '{"a": 1}')]
    out = ja.attribute_changes(spark.createDataFrame(data, "p string, j string"), ["p"], "j")
    got = {tuple(r) for r in out.collect()}
    assert {("p1", "b"), ("p1", "d")} <= got and not any(p in ("p2", "p3") or a == "a" and p == "p1" for p, a in got)


def test_label_metrics_use_one_separator_per_text(spark):
    # "a__b;c" holds a by the first separator and c by the second, but not b
    df = spark.createDataFrame([("a__b;c", "a"), ("b", "b"), ("c", "x"), (None, "a")], "t string, p string")
    out = {r["label"]: tuple(r)[1:] for r in jl.label_metrics(jl.fill_truth(df, "t", "p"), "truth", "p").collect()}
    assert out["a"] == (0.5, 1.0, 0.667, 1.0) and out["b"] == (1.0, 1.0, 1.0, 1.0)
    assert out["c"] == (0.0, 0.0, 0.0, 0.0) and out["x"] == (0.0, 0.0, 0.0, 0.0)


def test_assets(spark):
    many = ",".join(["7"] + [f"http://h/{i}.PNG" for i in range(1001)])
    out = jw.expand_assets(spark.createDataFrame([("12,http://a/x.jpeg,http://a/y",), (many,), ("5",)], "l string"), "l", 5)
    got = {(r["item_id"], r["ordinal"]): r for r in out.collect()}
    assert got[12, 1]["format"] == "jpeg" and got[12, 2]["format"] == "jpeg" and got[12, 1]["bucket"] == 2
    assert got[7, 999]["suffix"] == "999" and got[7, 1000]["suffix"] == "ERROR" and got[7, 1000]["too_many"] and got[7, 3]["format"] == "png"
    assert (5, 1) not in got


def sequence(spark, text):
    return spark.createDataFrame([("u", i, c) for i, c in enumerate(text)], "u string, i int, s string")


def test_runs_of_symbols(spark):
    out = jw.compressed_runs(sequence(spark, "uuuummpppppuu"), ["u"], ["i"], "s").orderBy("run").collect()
    assert [r["token"] for r in out] == ["uX4", "mm", "pX5", "uu"]


@pytest.mark.parametrize("min_rows", [6, 10**9])
def test_longest_two_symbol_span(spark, min_rows):
    want = {"kpyzyyyyyzyyyhdyx": 11, "a": 1, "aaaa": 4, "abcabc": 2, "aabbaacbb": 6}
    df = spark.createDataFrame([(text, i, c) for text in want for i, c in enumerate(text)], "u string, i int, s string")
    assert dict(rows(jw.longest_two_symbol_span(df, ["u"], ["i"], "s", min_rows))) == want


def test_log_lines(spark):
    line = '1.2.3.4 - "BOB" [18/Jan/2013:17:56:07 +1100] "GET /x HTTP/1.1" 200 {} "http://r" "agent" tail'
    df = spark.createDataFrame([(line.format(10),), (line.format(5),), (line.replace('"BOB"', '"-"').format(7),), ("rubbish",)], "value string")
    assert rows(jw.log_stats(df)) == sorted([("1.2.3.4", '"BOB"', "GET /x HTTP/1.1", 2, 15), (None, None, None, 2, 7)], key=repr)


# sources and functions


def test_delimited_round_trip(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, ["a", None], {"k": "v"}, None), (2, [], {"x": None, "y": "z"}, "t")], "i int, a array<string>, m map<string,string>, s string")
    sf.write_delimited(df, path, "|", "+", "^")
    back = sf.read_delimited(spark, path, {"i": "int", "a": "array<string>", "m": "map<string,string>", "s": "string"}, "|", "+", "^")
    assert back.orderBy("i").collect() == df.orderBy("i").collect()


def test_text_sources(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([("# note",), ("2 1",), ("3\t4",), ("",)], "value string").coalesce(1).write.text(path)
    assert rows(sf.edge_list(spark, path)) == [(2, 1), (3, 4)]
    assert rows(sf.edge_list(spark, path, canonical=True)) == [(1, 2), (3, 4)]
    assert rows(sf.regex_table(spark, path, r"([0-9]) ([0-9])", ["a", "b"])) == sorted([(None, None)] * 3 + [("2", "1")], key=repr)


def test_fixed_records_drop_a_short_tail(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([("abcdefgh",)], "value string").coalesce(1).write.text(path)
    got = sf.fixed_records(spark, path, 4, "*.txt").select(F.decode("record", "UTF-8")).collect()
    assert [r[0] for r in got] == ["abcd", "efgh"]


def test_small_functions(spark):
    one = spark.range(1)
    assert one.select(fr.position_of(F.lit("c"), "a", "b", "c"), fr.position_of(F.lit("x"), "a"), fr.position_of(F.lit(None).cast("string"), "a")).first()[:] == (3, 0, 0)
    ints = spark.createDataFrame([(" 1.23 ",), ("7",), ("x",), ("-4.",), ("99999999999",), (None,)], "s string")
    assert [r[0] for r in ints.select(casts.text_to_integer("s")).collect()] == [1, 7, None, -4, None, None]
    maps = one.select(fr.bitmap_array_or(F.array(F.lit(5), F.lit(1)), F.array(F.lit(2))), fr.bitmap_array_and(F.array(F.lit(5), F.lit(1)), F.array(F.lit(4)))).first()
    assert list(maps) == [[7, 1], [4, 0]]


def test_scripts_keep_missing_values(spark):
    odd = "a\tb\nc\\n\rd\\011 \\N"
    df = spark.createDataFrame([(1, odd), (2, None), (3, "\\N"), (4, "")], "i int, s string")
    assert rows(rs.through_script(df, "upper", "i int, s string")) == sorted([(1, odd.upper()), (2, None), (3, "\\N"), (4, "")], key=repr)
    with pytest.raises(KeyError):
        rs.through_script(df, "rm", "i int")


def test_avro_columns_need_the_package(spark):
    df = spark.createDataFrame([(1, (2,))], "i int, s struct<a: int>")
    if avro_available(spark):
        back = decode_struct(encode_struct(df, "s", "b"), "b", "s", df.schema["s"].dataType)
        assert rows(back) == rows(df)
    else:
        with pytest.raises(RuntimeError):
            encode_struct(df, "s", "b")


def test_missing_values_keep_their_rows(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), (None,), (None,), ("b",)], "c string")
    assert sorted(map(repr, rows(of.string_index(df, "c", "i")[0]))) == sorted(map(repr, [("a", 1.0), ("b", 0.0), ("b", 0.0)] + [(None, None)] * 3))
    assert of.string_index(df, "c", "i", "skip")[0].count() == 3
    with pytest.raises(Exception, match="missing value"):
        of.string_index(df, "c", "i", "error")[0].collect()
    ranks = st.mean_rank(spark.createDataFrame([(5,), (None,), (5,), (9,)], "v int"), "v", "r")
    assert sorted(map(repr, rows(ranks))) == sorted(map(repr, [(5, 1.5), (5, 1.5), (9, 3.0), (None, None)]))


def test_avro_schema(spark):
    schema = avro_schema(spark.createDataFrame([], "a int, b struct<c: array<string>>").schema)
    assert schema["fields"][0] == {"name": "a", "type": ["null", "int"]} and schema["fields"][1]["type"][1]["name"] == "rec_b"


@pytest.mark.parametrize("frame", [
    "RANGE BETWEEN 1 PRECEDING AND CURRENT ROW", "ORDER BY a, b RANGE BETWEEN 1 PRECEDING AND CURRENT ROW", "ORDER BY s RANGE BETWEEN 1 PRECEDING AND CURRENT ROW",
    "ORDER BY a ROWS BETWEEN UNBOUNDED FOLLOWING AND 1 FOLLOWING",
])
def test_bad_window_frames_are_refused(spark, frame):
    spark.createDataFrame([(1, 2, "x")], "a int, b int, s string").createOrReplaceTempView("frames")
    with pytest.raises(AnalysisException):
        spark.sql(f"SELECT sum(a) OVER (PARTITION BY b {frame}) FROM frames").collect()


@pytest.mark.parametrize("limit", ["-1", "CAST(NULL AS INT)", "a"])
def test_bad_limits_are_refused(spark, limit):
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("limits")
    with pytest.raises(AnalysisException):
        spark.sql(f"SELECT a FROM limits LIMIT {limit}").collect()


def test_string_index_beyond_the_small_limit(spark, monkeypatch):
    df = spark.createDataFrame([(c,) for c in "bbaaaccz"], "c string")
    want = {"a": 0.0, "b": 1.0, "c": 2.0, "z": 3.0}
    assert dict(rows(of.string_index(df, "c", "i")[1])) == want
    monkeypatch.setattr(of, "is_small", lambda df: False)
    assert dict(rows(of.string_index(df, "c", "i")[1])) == want


def test_pregel_matches_a_walk(spark):
    pairs = [(1, 2), (2, 3), (4, 3)]
    start = og.vertices_of(edges(spark, pairs)).withColumn("state", F.col("id"))
    out = og.pregel(start, edges(spark, pairs), F.col("state"), F.min, F.col("msg"), F.col("msg") < F.col("state"))
    assert dict(rows(out)) == {1: 1, 2: 1, 3: 1, 4: 4}


def test_levels_of_a_forest(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 3), (9, 77)], "c int, p int")
    assert dict(rows(og.levels(df, "c", "p"))) == {1: 1, 2: 2, 3: 2, 4: 3, 9: 1}


def test_parallelized_slices(spark):
    from millrace.sources.tables import parallelized

    df = parallelized(spark, [(i,) for i in range(10)], "i int", 3)
    parts = defaultdict(list)
    for r in df.select("i", F.spark_partition_id().alias("p")).collect():
        parts[r["p"]].append(r["i"])
    assert [parts[p] for p in sorted(parts)] == [[0, 1, 2], [3, 4, 5], [6, 7, 8, 9]]
    with pytest.raises(ValueError):
        parallelized(spark, [(1,)], "i int", 0)


def test_export_keeps_schema_and_partitions(spark):
    from millrace.operators import maintenance as om

    folder = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "i bigint, p string, x double")
    om.export_table(df, folder, ["p"])
    back = om.import_table(spark, folder)
    assert back.schema.simpleString() == df.schema.simpleString() and rows(back) == rows(df)
    assert rows(om.import_table(spark, folder, "p = 'b'")) == [(2, "b", None)]


def test_new_data_gate(spark):
    control = ja.empty_control(spark, "int")
    df = spark.createDataFrame([(1,), (2,), (3,)], "d int")
    assert ja.new_rows(df, "d", control).count() == 3
    ja.mark_reported(df.where("d < 3"), "d", control)
    assert rows(ja.new_rows(df, "d", control)) == [(3,)]
    ja.mark_reported(df, "d", control)
    assert ja.new_rows(df, "d", control) is None


def test_unfinished_loops_raise(spark):
    """A chain longer than the limit is an error, not an answer that looks like 'unreachable'."""
    chain = spark.createDataFrame([(i, i + 1, 1.0) for i in range(8)], "src long, dst long, w double")
    tree = spark.createDataFrame([(i + 1, i) for i in range(8)] + [(0, None)], "c long, p long")
    for run in (
        lambda: og.shortest_distance(chain, 0, "w", max_iterations=3), lambda: og.hops_to_landmarks(chain, [8], max_iterations=3),
        lambda: og.page_rank(chain, iterations=None, tolerance=1e-12, max_iterations=2), lambda: og.levels(tree, "c", "p", max_levels=4),
    ):
        with pytest.raises(RuntimeError):
            run()
    assert og.shortest_distance(chain, 0, "w").where("distance is null").count() == 0


def test_fraction_for_gives_enough_rows():
    """Simulated: the wanted size is missed no more often than the failure chance allows."""
    import numpy as np

    rng = np.random.default_rng(1)
    for size, total in ((5, 100), (100, 5000), (900, 1000), (1, 10_000)):
        assert (rng.binomial(total, sp.fraction_for(size, total, failure=1e-2), 20_000) < size).mean() <= 1.5e-2
        assert (rng.poisson(total * sp.fraction_for(size, total, True, failure=1e-2), 20_000) < size).mean() <= 1.5e-2


def test_votes_and_ranks_travel_as_lists(spark, monkeypatch):
    """A hub's edges are in several lists, its votes in several parts; repeated edges count, and the results are plain ones."""
    monkeypatch.setattr(og, "FAN", 4)
    monkeypatch.setattr(og, "TASK_ROWS", 10)
    pairs = [(0, i) for i in range(1, 40)] + [(i, (i * 7) % 40) for i in range(40)] + [(3, 5), (3, 5)]
    e = edges(spark, pairs)
    fans = og._fans(e).collect()
    assert sorted((f["src"], x["dst"]) for f in fans for x in f["fan"]) == sorted(pairs) and sum(f["src"] == 0 for f in fans) > 4
    ids = sorted({x for p in pairs for x in p})
    label, rank = {i: i for i in ids}, {i: 1.0 for i in ids}
    for _ in range(3):
        votes = {i: {} for i in ids}
        for a, b in pairs:
            for x, y in ((a, b), (b, a)):
                votes[y][label[x]] = votes[y].get(label[x], 0) + 1
        label = {i: min(v, key=lambda k: (-v[k], k)) for i, v in votes.items()}
        rank = {i: 0.15 + 0.85 * sum(rank[a] / sum(x == a for x, _ in pairs) for a, b in pairs if b == i) for i in ids}
    assert dict(rows(og.label_propagation(e, 3))) == label
    assert dict(rows(og.label_propagation(e.union(edges(spark, [(3, None), (None, 3)])), 1)))[None] == 3
    got = dict(rows(og.page_rank(e, 3)))
    assert got.keys() == rank.keys() and all(abs(got[i] - rank[i]) < 1e-9 for i in ids)


class Values:
    """Gives out each point's value in place of a cluster."""

    def __init__(self, **_):
        self.fit = lambda points: self

    def transform(self, points):
        return points.withColumn("prediction", vector_to_array("features")[0])


def test_power_iteration_over_tables(spark, monkeypatch):
    """Beyond the library's edges the same steps run over tables: lists of a hub are several, repeated edges add up, loops are none."""
    from pyspark.ml.clustering import PowerIterationClustering

    monkeypatch.setattr(og, "FAN", 4)
    monkeypatch.setattr(og, "TASK_ROWS", 40)
    r = random.Random(5)
    pairs = [(b, a, r.uniform(0.5, 1.5)) for g in (range(0, 8), range(20, 34), range(50, 75)) for a in g for b in g if a < b and r.random() < 0.7]
    pairs += [(0, 20, 0.01), (21, 50, 0.02), (7, 7, 3.0), (99, 99, 1.0), (90, 91, 0.0), (50, 51, 0.5), (51, 50, 0.25), (50, 51, 0.5)]
    e = spark.createDataFrame(pairs, "src int, dst long, w double")
    parts = lambda df: {frozenset(x["ids"]) for x in df.groupBy("cluster").agg(F.collect_list("id").alias("ids")).collect()}
    monkeypatch.setattr(og, "PowerIterationClustering", None)  # the library is for small graphs only
    for steps in (1, 6):
        got = og.power_iteration_clusters(e, 3, steps, "degree", 0)
        assert got.schema.simpleString() == "struct<id:bigint,cluster:int>"
        assert parts(got) == parts(PowerIterationClustering(k=3, maxIter=steps, initMode="degree", weightCol="w").assignClusters(e))
    # the values by hand; the random start goes by vertex id, so tasks and lists do not tell
    total, near = Counter(), defaultdict(Counter)
    for a, b, w in pairs:
        for x, y in ((a, b), (b, a)) if a != b else ():
            near[x][y] += w
            total[x] += w
    want = dict(rows(spark.createDataFrame([(i,) for i in near], "id long").select("id", og._normal("id"))))
    for _ in range(3):
        want = {i: sum(w * want[j] for j, w in near[i].items()) / (total[i] or 1) for i in near}
        want = {i: x / sum(map(abs, want.values())) for i, x in want.items()}
    monkeypatch.setattr(og, "KMeans", Values)
    for fan, rows_of_task in ((4, 40), (1000, 10**6)):
        monkeypatch.setattr(og, "FAN", fan)
        monkeypatch.setattr(og, "TASK_ROWS", rows_of_task)
        seen = rows(og.power_iteration_clusters(e, 3, 3, library_edges=0))
        assert len(seen) == len(want) == 49 and all(abs(x - want[i]) < 1e-12 for i, x in seen)
    for bad in ((None, 3, 1.0), (3, None, 1.0), (3, 4, None), (3, 4, -1.0), (3, 4, float("nan")), (3, 4, float("inf"))):
        with pytest.raises(ValueError, match="1 edges with a missing id or a weight"):
            og.power_iteration_clusters(e.union(spark.createDataFrame([bad], e.schema)), 3, 5, library_edges=0)


def test_a_random_start_is_normal(spark):
    mean, spread, tail, n = spark.range(200_000).select(og._normal("id").alias("x")).agg(F.avg("x"), F.stddev("x"), F.avg((F.abs("x") > 1.96).cast("int")), F.countDistinct("x")).first()
    assert abs(mean) < 0.01 and abs(spread - 1) < 0.01 and abs(tail - 0.05) < 0.003 and n == 200_000


def test_lists_of_a_graph_are_not_moved(spark):
    e = spark.createDataFrame([(i, (i * 7 + 1) % 50, 1.0) for i in range(50)], "src long, dst long, w double")
    ends = e.groupBy("src").agg(F.lit(1).cast("bigint").alias("lists"))
    fans = og._weighted_fans(e, ends, 50)
    told = spark.range(50).select(F.col("id").alias("src"), (F.col("id") % 1).alias("_part"), F.lit(1.0).alias("x"))
    plan = fans.join(told.hint("shuffle_hash"), ["src", "_part"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "ShuffledHashJoin" in plan


def test_a_fit_is_cut_into_tasks(spark, monkeypatch):
    from millrace.operators import models as om

    monkeypatch.setattr(om, "FIT_ROWS", 30)
    df = spark.range(0, 100, 1, 1)
    assert om.in_parts(df).rdd.getNumPartitions() == 4 and om.in_parts(df).count() == 100 and om.in_parts(df.limit(20)).rdd.getNumPartitions() == 1
