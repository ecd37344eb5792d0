"""Feature operators with a relational form. Learned models stay calls into ``pyspark.ml`` (see ``models``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.joins import is_small
from millrace.operators.sorting import zip_with_index
from millrace.operators.windows import exact_percentiles


def tokens(text: str | Column, pattern: str = r"\s+", gaps: bool = True, min_length: int = 1, lowercase: bool = True) -> Column:
    """Words of a text: split at the pattern, or its matches when ``gaps`` is off."""
    c = F.col(text) if isinstance(text, str) else text
    c = F.lower(c) if lowercase else c
    words = F.split(c, pattern) if gaps else F.regexp_extract_all(c, F.lit(f"({pattern})"))
    return F.filter(words, lambda w: F.length(w) >= min_length)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once per row, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def ngrams(words: Column, n: int) -> Column:
    """Every run of n words, joined by a space."""
    def grams(w):
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1)))
        return F.when(F.size(w) < n, F.array().cast("array<string>")).otherwise(F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(n)), " ")))

    return let(words, grams)


def without(words: Column, stop: list[str]) -> Column:
    return F.filter(words, lambda w: ~w.isin(*stop))


def term_counts(df: DataFrame, key: str, words: Column) -> DataFrame:
    """Term frequencies: (key, term, tf)."""
    return df.select(key, F.explode(words).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, size: int | None = None, min_documents: int = 1) -> DataFrame:
    """Terms with document frequency and total count, the most frequent first when ``size`` limits them."""
    v = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= min_documents)
    return v if size is None else v.orderBy(F.desc("total"), "term").limit(size)


def tf_idf(df: DataFrame, key: str, words: Column, min_documents: int = 1) -> DataFrame:
    """(key, term, tf, tfidf) with idf = ln((documents + 1) / (df + 1))."""
    counts = term_counts(df, key, words)
    # the number of documents is one row, safe to send everywhere
    n = df.agg(F.count("*").alias("_n"))
    idf = vocabulary(counts, None, min_documents).join(F.broadcast(n)).select("term", F.ln((F.col("_n") + 1) / (F.col("df") + 1)).alias("_idf"))
    # sizes guessed from compressed text would have Spark send the counts to every task
    return counts.join(idf.hint("shuffle_hash"), "term").select(key, "term", "tf", (F.col("tf") * F.col("_idf")).alias("tfidf"))


def scaled(df: DataFrame, columns: list[str], method: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Rescale columns by one row of aggregates: ``minmax``, ``standard``, ``maxabs`` or ``robust`` (median and quartiles)."""
    if method == "robust":
        q = None
        for c in columns:
            p = exact_percentiles(df.select(c), [], c, [0.25, 0.5, 0.75]).agg(*[
                F.max(F.when(F.col("point") == at, F.col("pct"))).alias(f"{c}_{n}") for n, at in (("a", 0.25), ("m", 0.5), ("b", 0.75))])
            q = p if q is None else q.join(F.broadcast(p))
        stats = q
        formula = {c: (F.col(c) - F.col(f"{c}_m")) / (F.col(f"{c}_b") - F.col(f"{c}_a")) for c in columns}
    else:
        stats = df.agg(*[x for c in columns for x in (
            F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"), F.avg(c).alias(f"{c}_m"), F.stddev_samp(c).alias(f"{c}_sd"), F.max(F.abs(c)).alias(f"{c}_abs"))])
        formula = {}
        for c in columns:
            lo, hi = F.col(f"{c}_lo"), F.col(f"{c}_hi")
            if method == "minmax":
                formula[c] = F.when(hi == lo, (low + high) / 2).otherwise((F.col(c) - lo) / (hi - lo) * (high - low) + low)
            elif method == "standard":
                formula[c] = F.when(F.col(f"{c}_sd") == 0, 0.0).otherwise((F.col(c) - F.col(f"{c}_m")) / F.col(f"{c}_sd"))
            elif method == "maxabs":
                formula[c] = F.when(F.col(f"{c}_abs") == 0, 0.0).otherwise(F.col(c) / F.col(f"{c}_abs"))
            else:
                raise ValueError(f"no scaler {method}")
    return df.join(F.broadcast(stats)).select(*df.columns, *[formula[c].alias(f"{c}_scaled") for c in columns])


def p_norm(vector: Column, p: float = 2.0) -> Column:
    if p == float("inf"):
        return F.array_max(F.transform(vector, F.abs)).cast("double")
    total = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(F.abs(x.cast("double")), F.lit(p)))
    return F.pow(total, F.lit(1.0 / p))


def normalized(vector: Column, p: float = 2.0) -> Column:
    """The vector divided by its p-norm; a zero vector stays as it is."""
    return let(p_norm(vector, p), lambda n: F.transform(vector, lambda x: F.when(n == 0, x.cast("double")).otherwise(x.cast("double") / n)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def elementwise(vector: Column, weights: list[float]) -> Column:
    return F.zip_with(vector, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x.cast("double") * w)


def interaction(a: Column, b: Column) -> Column:
    """All products of one value of each vector, the second varying fastest."""
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: x * y)))


def bins(column: str, splits: list[float]) -> Column:
    """0-based bin between growing split points; the last bin includes its upper end, values outside give null."""
    c = F.col(column)
    inner = F.size(F.filter(F.array(*[F.lit(float(s)) for s in splits[1:-1]]), lambda s: s <= c))
    return F.when((c >= splits[0]) & (c <= splits[-1]), inner.cast("double"))


def quantile_bins(df: DataFrame, column: str, n: int, name: str) -> DataFrame:
    """Bins with nearly equal counts, cut at exact quantiles that are looked up once (n - 1 numbers)."""
    points = [i / n for i in range(1, n)]
    rows = exact_percentiles(df.select(column), [], column, points).orderBy("point").collect()
    cuts = sorted({r["pct"] for r in rows})
    return df.withColumn(name, bins(column, [-float("inf"), *cuts, float("inf")]))


def string_index(df: DataFrame, column: str, name: str, nulls: str = "keep") -> tuple[DataFrame, DataFrame]:
    """Codes by falling frequency, ties by value. Returns the coded frame and the (value, code) table.

    Missing values take no code: their rows are kept without one, dropped (``skip``) or an ``error`` when the frame is read.
    """
    if nulls not in ("keep", "skip", "error"):
        raise ValueError(f"nulls cannot be {nulls}")
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg((-F.count("*")).alias("_neg"))
    if is_small(counts):
        place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_neg", column)) - 1
        coded = counts.select(column, place.cast("double").alias(name))
    else:
        coded = zip_with_index(counts, ["_neg", column], "_code").select(column, F.col("_code").cast("double").alias(name))
    out = df.join(coded, column, "inner" if nulls == "skip" else "left")
    if nulls == "error":
        out = out.withColumn(name, F.when(F.col(column).isNull(), F.raise_error(F.lit(f"missing value in {column}")).cast("double")).otherwise(F.col(name)))
    return out, coded


def one_hot(code: str, size: int, drop_last: bool = True) -> Column:
    width = size - 1 if drop_last else size
    return F.array(*[(F.col(code) == i).cast("double") for i in range(width)])


def imputed(df: DataFrame, column: str, how: str) -> DataFrame:
    """Fill missing values with the mean, the median or the most frequent (then smallest) value."""
    if how == "mean":
        fill = df.agg(F.avg(column).alias("_fill"))
    elif how == "median":
        fill = exact_percentiles(df.select(column), [], column, [0.5]).select(F.col("pct").alias("_fill"))
    elif how == "mode":
        fill = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), column).limit(1).select(F.col(column).alias("_fill"))
    else:
        raise ValueError(f"no fill {how}")
    return df.join(F.broadcast(fill)).withColumn(f"{column}_filled", F.coalesce(F.col(column).cast("double"), F.col("_fill").cast("double"))).drop("_fill")


def gram(df: DataFrame, columns: list[str]) -> DataFrame:
    """Means and sums of products of all column pairs, one row: enough for covariance, PCA, SVD and least squares."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    return df.agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s_{c}") for c in columns], *[F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in pairs])


def least_squares(df: DataFrame, features: list[str], label: str) -> dict[str, float]:
    """Coefficients by the normal equations; the driver solves a system as large as the number of features."""
    import numpy as np

    columns = [*features, label]
    g = gram(df, columns).first().asDict()
    pair = lambda a, b: g.get(f"p_{a}_{b}", g.get(f"p_{b}_{a}"))
    d = len(features)
    m, y = np.empty((d + 1, d + 1)), np.empty(d + 1)
    m[0, 0], y[0] = g["n"], g[f"s_{label}"]
    for i, a in enumerate(features, 1):
        m[0, i] = m[i, 0] = g[f"s_{a}"]
        y[i] = pair(a, label)
        for j, b in enumerate(features, 1):
            m[i, j] = pair(a, b)
    beta = np.linalg.solve(m, y)
    return {"intercept": float(beta[0]), **{c: float(b) for c, b in zip(features, beta[1:])}}


def nearest_centre(vector: Column, centres: list[list[float]]) -> Column:
    """Index of the nearest of a short list of centres, the first one among equals."""
    best = None
    for i, centre in enumerate(centres):
        d = F.aggregate(F.zip_with(vector, F.array(*[F.lit(float(x)) for x in centre]), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)),
                        F.lit(0.0), lambda s, x: s + x)
        entry = F.struct(d.alias("d"), F.lit(i).alias("i"))
        best = entry if best is None else F.least(best, entry)
    return best["i"]


def centre_means(df: DataFrame, vector: str, group: str) -> DataFrame:
    """Mean vector of each group, dimension by dimension: (group, i, x)."""
    return df.select(group, F.posexplode(vector).alias("i", "x")).groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))


def kmeans(df: DataFrame, key: str, vector: str, centres: list[list[float]], rounds: int) -> tuple[DataFrame, list[list[float]]]:
    """Lloyd's rounds from given centres. Only k x d numbers come to the driver in each round."""
    assigned = None
    for _ in range(rounds):
        assigned = df.select(key, vector, nearest_centre(F.col(vector), centres).alias("cluster"))
        new = [list(c) for c in centres]
        for r in centre_means(assigned, vector, "cluster").collect():
            new[r["cluster"]][r["i"]] = r["x"]
        centres = new
    return assigned.select(key, "cluster"), centres


def item_pairs(df: DataFrame, basket: str, item: str, support: float) -> DataFrame:
    """Association rules between two items: (antecedent, consequent, support, confidence, lift).

    Items below the support are dropped first and repeats within a basket count once. Pairs come from a join of the kept
    rows on the basket and are counted before they are shuffled, so no basket is gathered in a cell.
    """
    rows = df.select(basket, item).distinct()
    n = rows.agg(F.countDistinct(basket).alias("_n"))
    single = rows.groupBy(item).agg(F.count("*").alias("c")).join(F.broadcast(n)).where(F.col("c") >= F.col("_n") * support)
    kept = rows.join(single.select(item), item, "left_semi")
    ends = [kept.select(F.col(basket).alias("_basket"), F.col(item).alias(end)) for end in ("a", "b")]
    counts = ends[0].join(ends[1], "_basket").where("a < b").groupBy("a", "b").agg(F.count("*").alias("ab"))
    way = counts.select("a", "b", "ab").union(counts.select("b", "a", "ab")).toDF("antecedent", "consequent", "ab")
    left = single.select(F.col(item).alias("antecedent"), F.col("c").alias("ca"), "_n")
    right = single.select(F.col(item).alias("consequent"), F.col("c").alias("cb"))
    joined = way.join(left, "antecedent").join(right, "consequent").where(F.col("ab") >= F.col("_n") * support)
    return joined.select("antecedent", "consequent", (F.col("ab") / F.col("_n")).alias("support"), (F.col("ab") / F.col("ca")).alias("confidence"),
                         (F.col("ab") * F.col("_n") / (F.col("ca") * F.col("cb"))).alias("lift"))
