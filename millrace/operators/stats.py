"""Tests, correlations and evaluation metrics as aggregates over tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.windows import HOT_ROWS, neighbours, running


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations of all column pairs in one pass: (left, right, r)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = F.array(*[F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(entries))


def mean_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows with the mean rank of their value among all rows that have one; a missing value has no rank."""
    levels = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    upto = running(levels, [], [column], sums={"_upto": F.col("_n")})
    ranks = upto.select(column, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(name))
    return df.join(ranks, column, "left")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation of two columns, ties by mean rank, over the rows that have both."""
    ranked = mean_rank(mean_rank(df.select(a, b).dropna(), a, "_ra"), b, "_rb")
    return ranked.agg(F.corr("_ra", "_rb").alias("r"))


def chi_square(df: DataFrame, feature: str, label: str) -> DataFrame:
    """Pearson's independence statistic of two categorical columns and its degrees of freedom."""
    cells = df.groupBy(feature, label).agg(F.count("*").alias("o"))
    rows = cells.groupBy(feature).agg(F.sum("o").alias("_r"))
    cols = cells.groupBy(label).agg(F.sum("o").alias("_c"))
    total = cells.agg(F.sum("o").alias("_t"))
    # sum (o - e)^2 / e over all cells = t * (sum o^2 / (r c) - 1), so empty cells need no row
    joined = cells.join(rows, feature).join(cols, label)
    inner = joined.agg(F.sum(F.col("o") * F.col("o") / (F.col("_r") * F.col("_c"))).alias("_s"),
                       F.countDistinct(feature).alias("_fr"), F.countDistinct(label).alias("_fc"))
    one = inner.join(F.broadcast(total))
    return one.select((F.col("_t") * (F.col("_s") - 1)).alias("statistic"), ((F.col("_fr") - 1) * (F.col("_fc") - 1)).alias("degrees"))


def f_regression(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """F statistic of each feature's simple regression on the label: (feature, f, degrees)."""
    wide = df.agg(F.count("*").alias("n"), *[F.corr(c, label).alias(f"r{i}") for i, c in enumerate(features)])
    df2 = F.col("n") - 2
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(f"r{i}") ** 2 / (1 - F.col(f"r{i}") ** 2) * df2).alias("f"), df2.alias("degrees"))
                     for i, c in enumerate(features)])
    return wide.select(F.inline(rows))


def anova(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """F statistic of each feature across the label's classes: (feature, f, between, within)."""
    per = df.groupBy(label).agg(F.count("*").alias("_n"), *[x for i, c in enumerate(features) for x in (F.avg(c).alias(f"_m{i}"), F.var_pop(c).alias(f"_v{i}"))])
    # total mean and spread follow from the class means, which are few
    total = per.agg(F.sum("_n").alias("n"), F.count("*").alias("k"), *[
        x for i in range(len(features)) for x in (
            F.sum(F.col("_n") * F.col(f"_v{i}")).alias(f"w{i}"),
            (F.sum(F.col("_n") * F.col(f"_m{i}") ** 2) - F.sum(F.col("_n") * F.col(f"_m{i}")) ** 2 / F.sum("_n")).alias(f"b{i}"))])
    between, within = F.col("k") - 1, F.col("n") - F.col("k")
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), ((F.col(f"b{i}") / between) / (F.col(f"w{i}") / within)).alias("f"),
                              between.alias("between"), within.alias("within")) for i, c in enumerate(features)])
    return total.select(F.inline(rows))


def normal_cdf(x: Column, mean: float, sd: float) -> Column:
    """Normal distribution function by the complementary error function's rational fit (error below 1.2e-7)."""
    z = (x - mean) / (sd * math.sqrt(2))
    a = F.abs(z)
    u = 1 / (1 + 0.5 * a)
    # fixed coefficients of the fit
    coefficients = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(0.0)
    for c in reversed(coefficients):
        poly = poly * u + c
    erfc = u * F.exp(-a * a + poly)
    return F.when(z >= 0, 1 - erfc / 2).otherwise(erfc / 2)


def ks_statistic(df: DataFrame, column: str, cdf: Column, slices_min_rows: int = HOT_ROWS) -> DataFrame:
    """Largest distance between the sample's steps and a distribution function of the column."""
    levels = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    upto = running(levels, [], [column], sums={"_upto": F.col("_n")}, min_rows=slices_min_rows)
    total = df.agg(F.count(column).alias("_t"))
    gap = upto.join(F.broadcast(total)).select(
        F.greatest(F.col("_upto") / F.col("_t") - cdf, cdf - (F.col("_upto") - F.col("_n")) / F.col("_t")).alias("_g"))
    return gap.agg(F.max("_g").alias("statistic"))


def kernel_density(df: DataFrame, column: str, points: list[float], bandwidth: float) -> DataFrame:
    """Gaussian density at each given point, one pass over the table: (point, density)."""
    norm = 1.0 / (bandwidth * math.sqrt(2 * math.pi))
    c = F.col(column)
    wide = df.agg(*[(F.avg(F.exp(-((c - p) ** 2) / (2 * bandwidth**2))) * norm).alias(f"d{i}") for i, p in enumerate(points)])
    rows = F.array(*[F.struct(F.lit(float(p)).alias("point"), F.col(f"d{i}").alias("density")) for i, p in enumerate(points)])
    return wide.select(F.inline(rows))


def area_under_curve(points: DataFrame, x: str, y: str) -> DataFrame:
    """Trapezoid area under points ordered by x; points with equal x must be merged first."""
    steps = neighbours(points.select(x, y), [], [x], 1, 0, lambda w: [F.lag(x).over(w).alias("_px"), F.lag(y).over(w).alias("_py")])
    return steps.agg(F.coalesce(F.sum((F.col(x) - F.col("_px")) * (F.col(y) + F.col("_py")) / 2), F.lit(0.0)).alias("area"))


def regression_metrics(df: DataFrame, label: str, prediction: str, weight: str | None = None, through_origin: bool = False) -> DataFrame:
    """Mean errors, explained variance and r2 from one aggregate."""
    w = F.col(weight) if weight else F.lit(1.0)
    y, p = F.col(label), F.col(prediction)
    s = df.agg(
        F.sum(w).alias("w"), F.sum(w * y).alias("sy"), F.sum(w * y * y).alias("syy"), F.sum(w * (y - p)).alias("se"),
        F.sum(w * (y - p) ** 2).alias("see"), F.sum(w * F.abs(y - p)).alias("sae"), F.sum(w * p).alias("sp"), F.sum(w * p * p).alias("spp"))
    mean = F.col("sy") / F.col("w")
    ss_tot = F.col("syy") - F.col("w") * mean * mean
    base = F.col("syy") if through_origin else ss_tot
    explained = (F.col("spp") - 2 * mean * F.col("sp") + F.col("w") * mean * mean) / F.col("w")
    mse = F.col("see") / F.col("w")
    return s.select(explained.alias("explained_variance"), (F.col("sae") / F.col("w")).alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
                    (1 - F.col("see") / base).alias("r2"))


def ranking_metrics(predictions: DataFrame, truth: DataFrame, query: str, item: str, rank: str, k: int) -> DataFrame:
    """Mean average precision, MAP@k, precision@k, recall@k and NDCG@k.

    ``predictions`` holds (query, item, rank from 1), ``truth`` holds distinct (query, item); queries without truth score 0.
    """
    sizes = truth.groupBy(query).agg(F.count("*").alias("_truth"))
    listed = predictions.groupBy(query).agg(F.count("*").alias("_listed"))
    hits = predictions.select(query, item, F.col(rank).cast("bigint").alias("_rank")).join(truth.select(query, item), [query, item])
    hits = running(hits, [query], ["_rank"], sums={"_nth": F.lit(1).cast("bigint")})
    top = F.col("_rank") <= k
    per = hits.groupBy(query).agg(
        F.sum(F.col("_nth") / F.col("_rank")).alias("_ap"), F.sum(F.when(top, F.col("_nth") / F.col("_rank"))).alias("_apk"),
        F.sum(F.when(top, 1)).alias("_hits"), F.sum(F.when(top, 1 / F.ln(F.col("_rank") + 1))).alias("_dcg"))
    joined = listed.join(sizes, query, "full").join(per, query, "left").na.fill(0)
    best = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(F.greatest("_truth", "_listed").cast("int"), F.lit(k)), F.lit(1))), F.lit(0.0),
                       lambda s, i: s + F.when(i <= F.col("_truth"), 1 / F.ln(i + 1)).otherwise(0.0))
    t = F.col("_truth")
    return joined.agg(
        F.avg(F.when(t > 0, F.col("_ap") / t).otherwise(0.0)).alias("map"),
        F.avg(F.when(t > 0, F.col("_apk") / F.least(t, F.lit(k))).otherwise(0.0)).alias("map_at_k"),
        F.avg(F.col("_hits") / k).alias("precision_at_k"),
        F.avg(F.when(t > 0, F.col("_hits") / t).otherwise(0.0)).alias("recall_at_k"),
        F.avg(F.when(t > 0, F.col("_dcg") / best).otherwise(0.0)).alias("ndcg_at_k"))


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """Cumulative counts per score threshold, from the highest: (score, tp, fp, positives, negatives)."""
    levels = df.groupBy((-F.col(score)).alias("_neg")).agg(F.sum(label).cast("double").alias("_p"), F.sum(1 - F.col(label)).cast("double").alias("_n"))
    upto = running(levels, [], ["_neg"], sums={"tp": F.col("_p"), "fp": F.col("_n")})
    total = levels.agg(F.sum("_p").alias("positives"), F.sum("_n").alias("negatives"))
    return upto.join(F.broadcast(total)).select((-F.col("_neg")).alias("score"), "tp", "fp", "positives", "negatives")


def binary_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """Areas under the ROC and the precision-recall curve."""
    pts = roc_points(df, score, label)
    step = neighbours(pts.withColumn("_o", -F.col("score")), [], ["_o"], 1, 0, lambda w: [F.lag("tp").over(w).alias("ptp"), F.lag("fp").over(w).alias("pfp")])
    tp, fp = F.col("tp"), F.col("fp")
    ptp, pfp = F.coalesce("ptp", F.lit(0.0)), F.coalesce("pfp", F.lit(0.0))
    precision = tp / (tp + fp)
    before = F.when(F.col("ptp").isNull(), precision).otherwise(ptp / (ptp + pfp))
    return step.agg(
        F.sum((fp - pfp) / F.col("negatives") * (tp + ptp) / F.col("positives") / 2).alias("area_under_roc"),
        F.sum((tp - ptp) / F.col("positives") * (precision + before) / 2).alias("area_under_pr"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def multiclass_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall and F1 of each class, from the confusion counts."""
    cells = confusion(df, label, prediction)
    actual = cells.groupBy(F.col(label).alias("class")).agg(F.sum("n").alias("actual"), F.sum(F.when(F.col(label) == F.col(prediction), F.col("n"))).alias("hit"))
    given = cells.groupBy(F.col(prediction).alias("class")).agg(F.sum("n").alias("given"))
    return actual.join(given, "class", "full").na.fill(0).select("class", *prf("hit", "given", "actual"))


def prf(hit: str, given: str, actual: str) -> list[Column]:
    p = F.when(F.col(given) > 0, F.col(hit) / F.col(given)).otherwise(0.0)
    r = F.when(F.col(actual) > 0, F.col(hit) / F.col(actual)).otherwise(0.0)
    f1 = F.when(F.col(given) + F.col(actual) > 0, 2 * F.col(hit) / (F.col(given) + F.col(actual))).otherwise(0.0)
    return [p.alias("precision"), r.alias("recall"), f1.alias("f1")]


def multilabel_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per-label counts and precision/recall/F1 of two array columns."""
    both = F.array_union(truth, predicted)
    rows = df.select(F.explode(both).alias("label"), truth, predicted)
    t, p = F.array_contains(F.col(truth), F.col("label")), F.array_contains(F.col(predicted), F.col("label"))
    return rows.groupBy("label").agg(F.count_if(t & p).alias("hit"), F.count_if(p).alias("given"), F.count_if(t).alias("actual")).select(
        "label", "hit", "given", "actual", *prf("hit", "given", "actual"))


def ab_test(df: DataFrame, by: list[Column], is_experiment: Column, value: str, method: str = "welch") -> DataFrame:
    """Two-sample t statistic and degrees of freedom per group: experiment against control."""
    e = F.when(is_experiment, F.col(value))
    c = F.when(~is_experiment, F.col(value))
    g = df.groupBy(*by).agg(F.count(e).alias("n1"), F.avg(e).alias("m1"), F.var_samp(e).alias("v1"), F.count(c).alias("n0"), F.avg(c).alias("m0"), F.var_samp(c).alias("v0"))
    n1, n0, v1, v0 = (F.col(x) for x in ("n1", "n0", "v1", "v0"))
    if method == "welch":
        a, b = v1 / n1, v0 / n0
        se, dof = F.sqrt(a + b), (a + b) ** 2 / (a**2 / (n1 - 1) + b**2 / (n0 - 1))
    else:
        dof = n1 + n0 - 2
        se = F.sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / dof * (1 / n1 + 1 / n0))
    ok = (n1 > 1) & (n0 > 1)
    return g.select("*", F.when(ok, (F.col("m1") - F.col("m0")) / se).alias("t"), F.when(ok, dof.cast("double")).alias("degrees"))


def summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, variance, min, max, non-zero count and norms of each column: one row per column."""
    parts = [F.struct(
        F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).cast("double").alias("mean"), F.var_samp(c).alias("variance"),
        F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high"), F.count_if(F.col(c) != 0).alias("non_zero"),
        F.sum(F.abs(c)).cast("double").alias("norm1"), F.sqrt(F.sum(F.col(c) * F.col(c))).alias("norm2")).alias(f"s{i}") for i, c in enumerate(columns)]
    return df.agg(*parts).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))
