"""Window operators with a hot key must equal the plain window, row by row."""

import random

import pytest
from pyspark.sql import Window, functions as F

from millrace.operators import skew, windows as ow


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if rnd.random() < 0.5 else rnd.choice("abcd")
        data.append((key, rnd.randrange(60), i, rnd.choice([None, 1.0, 2.0, 3.0]), rnd.choice("xyz")))
    data.append((None, 3, 1000, 1.0, "x"))
    return spark.createDataFrame(data, "k string, v int, id int, x double, s string").cache()


def same(left, right):
    cols = sorted(left.columns)
    assert cols == sorted(right.columns)
    a = sorted(map(repr, (tuple(r[c] for c in cols) for r in left.collect())))
    b = sorted(map(repr, (tuple(r[c] for c in cols) for r in right.collect())))
    assert a == b


@pytest.mark.parametrize("min_rows", [20, 10**9])
def test_running(rows, min_rows):
    w = Window.partitionBy("k").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select("*", F.sum("x").over(w).alias("sx"), F.max("x").over(w).alias("mx"), F.min("x").over(w).alias("mn"),
                       F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("bigint").alias("pos"),
                       F.count("*").over(Window.partitionBy("k")).alias("n"))
    got = ow.running(rows, ["k"], ["v", "id"], {"sx": F.col("x")}, {"mx": F.col("x")}, {"mn": F.col("x")}, "pos", "n", min_rows, 7)
    same(got, want)


@pytest.mark.parametrize("min_rows", [20, 10**9])
def test_rank_all(rows, min_rows):
    w, wt = Window.partitionBy("k").orderBy("v"), Window.partitionBy("k").orderBy("v", "id")
    want = rows.select("*", F.row_number().over(wt).cast("bigint").alias("row_number"), F.rank().over(w).cast("bigint").alias("rank"),
                       F.dense_rank().over(w).cast("bigint").alias("dense_rank"), F.percent_rank().over(w).alias("percent_rank"),
                       F.cume_dist().over(w).alias("cume_dist"), F.ntile(4).over(wt).cast("bigint").alias("ntile"))
    same(ow.rank_all(rows, ["k"], "v", ["id"], 4, min_rows, 7), want)


@pytest.mark.parametrize("min_rows", [20, 10**9])
def test_neighbours(rows, min_rows):
    def make(w):
        f = w.rowsBetween(-3, 2)
        return [F.lag("id", 2).over(w).alias("lag2"), F.lead("id", 1).over(w).alias("lead1"), F.sum("x").over(f).alias("fs"), F.count("*").over(f).alias("fc")]

    w = Window.partitionBy("k").orderBy("v", "id")
    same(ow.neighbours(rows, ["k"], ["v", "id"], 3, 2, make, min_rows, 40), rows.select("*", *make(w)))


@pytest.mark.parametrize("min_rows", [20, 10**9])
@pytest.mark.parametrize("frame", [(5, 0), (0, 4), (3, 6)])
def test_range_frame(rows, min_rows, frame):
    before, after = frame
    w = Window.partitionBy("k").orderBy("v").rangeBetween(-before, after)
    want = rows.select("*", F.sum("x").over(w).alias("fs"), F.count("*").over(w).alias("fc"), F.max("id").over(w).alias("hi"), F.min("x").over(w).alias("lo"))
    x = F.col("x")
    same(ow.range_frame(rows, ["k"], "v", before, after, {"fs": x}, "fc", {"hi": F.col("id")}, {"lo": x}, min_rows, 7), want)


@pytest.mark.parametrize("min_rows", [20, 10**9])
def test_slices_split_ties(spark, min_rows):
    """All rows of the hot key agree in the first order column."""
    rows = spark.range(400).select(F.lit("k").alias("k"), F.lit(1).alias("v"), F.col("id"), F.lit(2.0).alias("x"))
    got = ow.running(rows, ["k"], ["v", "id"], {"sx": F.col("x")}, position="pos", min_rows=min_rows, slices=6)
    assert got.where("pos <> id + 1 OR sx <> 2 * (id + 1)").count() == 0


def test_whole_key(rows):
    want = rows.select("*", F.sum("x").over(Window.partitionBy("k")).alias("t"))
    same(ow.whole_key(rows, ["k"], [F.sum("x").alias("t")]), want)


def test_chunked_lists(rows):
    want = sorted(repr((k, i // 5, [r.id for r in rs[i:i + 5]])) for k, rs in by_key(rows).items() for i in range(0, len(rs), 5))
    got = ow.chunked_lists(rows, ["k"], ["v", "id"], "id", 5, min_rows=20)
    assert sorted(repr((r.k, r.chunk, r["items"])) for r in got.collect()) == want


@pytest.mark.parametrize("min_rows", [20, 10**9])
def test_fill_forward(rows, min_rows):
    w = Window.partitionBy("k").orderBy("v", "id")
    want = rows.select("*", F.last("x", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("x_filled"))
    same(ow.fill_forward(rows, ["k"], ["v", "id"], ["x"], min_rows, 7), want)


def by_key(rows):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r.v, r.id)):
        out.setdefault(r.k, []).append(r)
    return out


@pytest.mark.parametrize("min_rows", [20, 10**9])
def test_sliding(rows, min_rows):
    want = sorted(repr((k, [r.id for r in rs[i:i + 4]])) for k, rs in by_key(rows).items() for i in range(0, len(rs) - 3, 3))
    got = ow.sliding(rows, ["k"], ["v", "id"], "id", 4, 3, min_rows=min_rows)
    assert sorted(repr((r.k, r["items"])) for r in got.collect()) == want


@pytest.mark.parametrize("min_rows", [20, 10**9])
def test_runs(rows, min_rows):
    want = []
    for k, rs in by_key(rows).items():
        start = 0
        for i in range(1, len(rs) + 1):
            if i == len(rs) or rs[i].s != rs[start].s:
                want.append(repr((k, rs[start].s, start + 1, i, i - start)))
                start = i
    got = ow.runs(rows, ["k"], ["v", "id"], "s", min_rows)
    assert sorted(repr((r.k, r.s, r.first_pos, r.last_pos, r.length)) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("min_rows", [20, 10**9])
@pytest.mark.parametrize("pattern", ["A.A+", "A.B*.A", "A*.B+", "B"])
def test_match_path(rows, min_rows, pattern):
    hold = {"A": lambda r: r.s in "xy", "B": lambda r: (r.x or 0) > 1}
    want = []
    for k, rs in by_key(rows).items():
        for i in range(len(rs)):
            at = i
            for e in pattern.split("."):
                sym, q, first = e.rstrip("+*"), e[-1], at
                while at < len(rs) and hold[sym](rs[at]) and (q in "+*" or at == first):
                    at += 1
                if at == first and q != "*":
                    at = None
                    break
            if at is not None:
                want.append(repr((k, i + 1, at, at - i, sum(r.id for r in rs[i:at]))))
    got = ow.match_path(rows, ["k"], ["v", "id"], {"A": F.col("s").isin("x", "y"), "B": F.col("x") > 1}, pattern,
                        {"ids": F.col("id").cast("bigint")}, min_rows)
    assert sorted(repr((r.k, r.start_pos, r.end_pos, r.size, r.ids)) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("min_rows", [20, 10**9])
def test_exact_percentiles(rows, min_rows):
    got = ow.exact_percentiles(rows, ["k"], "v", [0.0, 0.25, 0.9, 1.0], min_rows=min_rows, slices=5)
    want = rows.groupBy("k").agg(*[F.percentile("v", p).alias(str(i)) for i, p in enumerate([0.0, 0.25, 0.9, 1.0])])
    exp = {(r.k, p): r[str(i)] for r in want.collect() for i, p in enumerate([0.0, 0.25, 0.9, 1.0])}
    out = {(r.k, r.point): r.pct for r in got.collect()}
    assert out.keys() == exp.keys()
    assert all(abs(out[k] - exp[k]) < 1e-9 for k in out)


@pytest.mark.parametrize("slices", [2, 5, 64])
@pytest.mark.parametrize("kind", ["half of the first column tied", "no ties", "long common prefixes", "nulls"])
def test_hot_key_keeps_two_column_order(spark, kind, slices):
    """Positions of a hot key ordered by two columns equal those of the plain window, whatever the slices are."""
    import random

    r = random.Random(5)
    first = {
        "half of the first column tied": lambda i: 7 if i % 2 else i,
        "no ties": lambda i: i,
        "long common prefixes": lambda i: f"https://site.example/a/long/common/prefix/{i % 40:05d}",
        "nulls": lambda i: None if i % 3 == 0 else i % 50,
    }[kind]
    rows = [("k" if i % 10 else "other", first(i), i) for i in range(3000)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, f"k string, a {'string' if kind.startswith('long') else 'long'}, b long")
    hot = ow.running(df, ["k"], ["a", "b"], sums={"total": F.col("b")}, position="nth", min_rows=100, slices=slices)
    plain = ow.running(df, ["k"], ["a", "b"], sums={"total": F.col("b")}, position="nth")
    assert sorted(hot.select("b", "nth", "total").collect()) == sorted(plain.select("b", "nth", "total").collect())


@pytest.mark.parametrize("name,keys", [("events", ["user_id"]), ("orders", ["o_orderstatus"]), ("lineitem", ["l_returnflag"])])
def test_hot_queries_have_hot_keys(spark, name, keys):
    from millrace.operators.skew import hot_keys
    from millrace.plans import hot
    from millrace.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    df = hot.events(t) if name == "events" else getattr(t, name)
    assert hot_keys(df, keys, hot.MIN_ROWS) is not None


def test_infinite_values_stay_in_their_frames(spark):
    data = [("k", i, float("inf") if i == 10 else float("nan") if i == 90 else -float("inf") if i == 12 else None if i % 7 == 0 else float(i)) for i in range(120)]
    df = spark.createDataFrame(data, "k string, at long, x double")
    plain = ow.range_frame(df, ["k"], "at", 3, 1, {"s": F.col("x")})
    hot = ow.range_frame(df, ["k"], "at", 3, 1, {"s": F.col("x")}, min_rows=10, slices=7)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, hot.collect()))


def longest(pattern, names, rows):
    """The furthest end of a match from each row, by trying every end with a regular expression over one symbol per row at a time."""
    import itertools
    import re

    letters = {n: chr(97 + k) for k, n in enumerate(names)}
    expression = re.compile(re.sub(r"\w+", lambda m: letters[m.group()], pattern).replace(".", ""))
    for i in range(len(rows)):
        ends = [e for e in range(i + 1, len(rows) + 1) if any(expression.fullmatch("".join(x)) for x in itertools.product(*([letters[n] for n in names if n in r] for r in rows[i:e])))]
        if ends:
            yield i, max(ends)


@pytest.mark.parametrize("slice_rows, pattern", [(1, "(A|B.A)+.B?"), (4, "((A.B?)+.A|B)*.B.A"), (50_000, "A.A+"), (3, "A*.B+|A.A.A"), (50_000, "A?")])
def test_match_groups(spark, pattern, slice_rows):
    import random

    from millrace.operators import patterns

    r = random.Random(slice_rows)
    kinds = [{"A"}, {"B"}, {"A", "B"}, set(), {"A"}]
    held = {k: [r.choice(kinds) for _ in range(n)] for k, n in ((None, 9), (1, 8), (2, 1), (3, 10))}
    rows = [(k, i, "A" in x or None, "B" in x, f"{k}:{i}") for k, xs in held.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "k int, at int, a boolean, b boolean, name string")
    want = sorted(repr((k, i + 1, e, f"{k}:{i}", sum(range(i, e)))) for k, xs in held.items() for i, e in longest(pattern, ["A", "B"], xs))
    got = patterns.match_groups(df, ["k"], ["at"], {"A": F.col("a"), "B": F.col("b")}, pattern, {"name": F.col("name")}, {"total": F.col("at")}, 5, slice_rows)
    assert sorted(repr((x.k, x.start_pos, x.end_pos, x.name, x.total)) for x in got.collect()) == want
    if slice_rows == 1:
        return
    paths = patterns.path_chunks(patterns.path_rows(df, got, ["k"], ["at"], {"at": F.col("at"), "a": F.col("a")}), ["k"], ["at", "a"], 3).collect()
    assert sorted(repr((x.k, x.start_pos, x.chunk, [tuple(p) for p in x.tpath])) for x in paths) == sorted(
        repr((k, i + 1, c, [(p, "A" in xs[p] or None) for p in range(i + 3 * c, min(e, i + 3 * c + 3))])) for k, xs in held.items() for i, e in longest(pattern, ["A", "B"], xs) for c in range(-(-(e - i) // 3)))
    assert patterns.match_groups(df.limit(0), ["k"], ["at"], {"A": F.col("a"), "B": F.col("b")}, pattern).collect() == []


def test_match_groups_bad_patterns():
    from millrace.operators.patterns import Pattern

    for bad in ("", "(A", "A.", "A B", "A)", "+A", "A|", "A&B"):
        with pytest.raises(ValueError):
            Pattern(bad)


def test_extremes_of_wide_frames(spark):
    """Cells that hold many places, odd places, and no count beside sums that are always there and finite."""
    r = random.Random(4)
    at = [r.randrange(400) / 8 for _ in range(600)] + [None, float("nan"), float("inf"), -float("inf"), 1e300, 1e300]
    rows = spark.createDataFrame([(i % 7 == 0, a, i, r.random() if i % 5 else None) for i, a in enumerate(at)], "k boolean, at double, id int, x double")
    for before, after in ((20, 15), (0, 0), (-2, 9)):
        w = Window.partitionBy("k").orderBy("at").rangeBetween(-before, after)
        want = rows.select("*", F.max("x").over(w).alias("hi"), F.min("id").over(w).alias("lo"))
        got = ow.range_frame(rows, ["k"], "at", before, after, maxes={"hi": F.col("x")}, mins={"lo": F.col("id")}, min_rows=20, slices=4)
        finite = "at IS NOT NULL" if before < 0 else "true"  # a frame that starts behind its own row
        same(got.where(finite), want.where(finite))


def test_finite_sums_are_not_counted(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "x double, y double")
    assert ow._finite(rows, {"x": F.col("x"), "y": F.col("y")}, look=True).keys() == {"x", "y"}
    assert len(ow._finite(rows.union(rows.select(F.lit(float("nan")), F.lit(-float("inf")))), {"x": F.col("x"), "y": F.col("y")}, look=True)) == 8


def test_slices_grow_with_hot_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "SLICE_ROWS", 50)
    rows = spark.range(1000).select(F.lit("k").alias("k"), F.col("id"))
    cut, hot = skew.with_slices(rows, ["k"], ["id"], 10, 5)
    assert hot and cut.groupBy("_slice").count().agg(F.max("count")).first()[0] < 150
