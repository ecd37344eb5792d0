"""Mixing sources to target weights by iterative proportional fitting.

The tokens (words) of the documents are summed up by cell: source x language x topic, each value that the targets do not
name counted as ``other``. So the table of cells has at most the product of the targets' sizes, whatever the corpus holds,
and is raked on the driver: every round scales the cells so that one dimension's sums meet its target, until all three do.
A cell's raked weight over its tokens gives the copies that are expected of each of its documents, scaled so that the
expected tokens are the wanted share of the corpus. A document of a cell that is short of its target is given more than
once: as often as the whole part of this number says, and once more where a hash of its id, text length and source falls
below the rest, so a task that is run again decides alike.

With ``once`` no document is given twice: chances end at 1, what that cuts off is spread over the others, and classes above
their natural share by more than 1 / ``keep`` stay short of their targets.

Cells are summed per task before the one small shuffle; the decisions are a pass over the rows with the cells as a
broadcast table of proven size.

Defined results
    * null or unnamed sources, languages and topics are ``other``; a class without tokens gives its target to the rest;
    * a text without words weighs nothing and has its cell's chance; a corpus without words keeps every row;
    * rows that repeat each other get as many copies each; no rows give no rows;
    * the expected tokens meet the marginals that the targets ask for where the cells can; with ``once`` the cells whose
      chances end at 1 are reported by ``capped``, and :func:`shares` gives what is expected beside what is asked for.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import columns

OTHER = "other"
DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Targets:
    """Weights of the named classes and of all others, by dimension; they need not add up to 1."""

    source: dict[str, float]
    lang: dict[str, float]
    topic: dict[str, float]

    def of(self, dimension: str) -> dict[str, float]:
        given = getattr(self, dimension)
        if any(v <= 0 for v in given.values()):
            raise ValueError(f"weights of {dimension} must be above 0")
        return given


#: The mix of the named queries: the hot source brought down, small languages and structured texts lifted.
TARGETS = Targets(
    source={**{f"src{k}": (28.0 if k == 0 else 3.6) for k in range(20)}, OTHER: 3.6},
    lang={"en": 55.0, "de": 16.0, "fr": 16.0, "es": 12.0, OTHER: 1.0},
    topic={"licensed": 3.0, "contact": 4.0, "tabular": 3.0, "long": 73.0, "short": 17.0},
)
#: share of all tokens that the sample is expected to hold
KEEP = 0.8
SEED = "mix-1"


def words(text: Column) -> Column:
    """Number of words, runs of anything but blanks."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))


def topic(text: Column, count: Column) -> Column:
    """A coarse kind of text, the first that fits: licensed, contact (mail addresses), tabular, long, short."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(t, F.lit("icensed under")) | F.contains(t, F.lit("eleased under")), "licensed").when(F.contains(t, F.lit("@")), "contact")
        .when(F.contains(t, F.lit(" | ")), "tabular").when(count >= 300, "long").otherwise("short")
    )


def _class(value: Column, named: dict[str, float]) -> Column:
    return F.when(value.isin(*[n for n in named if n != OTHER]), value).otherwise(OTHER)


def labelled(docs: DataFrame, targets: Targets, text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """``docs`` with ``_words``, ``_source``, ``_lang`` and ``_topic``."""
    out = docs.withColumn("_words", words(F.col(text)))
    kinds = topic(F.col(text), F.col("_words"))
    return out.withColumns({"_source": _class(F.col(source), targets.of("source")), "_lang": _class(F.col(lang), targets.of("lang")), "_topic": _class(kinds, targets.of("topic"))})


def rake(cells: np.ndarray, tokens: np.ndarray, targets: list[np.ndarray], rounds: int = 500, close: float = 1e-9) -> np.ndarray:
    """Weights of the cells (their classes, one column per dimension) whose sums meet ``targets``; they add up to 1.

    Ends when every sum is within ``close`` of its target, or after ``rounds`` where the cells cannot meet all targets.
    """
    weight = tokens / tokens.sum()
    wanted = []
    for d, target in enumerate(targets):
        there = np.bincount(cells[:, d], weight, len(target)) > 0
        wanted.append(np.where(there, target, 0) / np.where(there, target, 0).sum())
    for _ in range(rounds):
        off = 0.0
        for d, target in enumerate(wanted):
            sums = np.bincount(cells[:, d], weight, len(target))
            off = max(off, float(np.abs(sums - target).max()))
            weight = weight * np.divide(target, sums, out=np.zeros_like(target), where=sums > 0)[cells[:, d]]
        if off < close:
            break
    else:
        warnings.warn(f"raking stopped {off:.2g} away from a target after {rounds} rounds", stacklevel=2)
    return weight


def chances(weight: np.ndarray, tokens: np.ndarray, keep: float) -> np.ndarray:
    """Chance of each cell, at most 1, in proportion to weight over tokens, so that ``keep`` of all tokens are expected."""
    ratio = np.divide(weight, tokens, out=np.zeros_like(weight), where=tokens > 0)
    low, high = 0.0, 1.0 / max(ratio[ratio > 0].min(initial=np.inf), 1e-300)
    for _ in range(200):
        mid = (low + high) / 2
        if (np.minimum(1, mid * ratio) * tokens).sum() < keep * tokens.sum():
            low = mid
        else:
            high = mid
    return np.minimum(1, high * ratio)


def cell_table(docs: DataFrame, targets: Targets = TARGETS, keep: float = KEEP, once: bool = False) -> list[tuple]:
    """(source, lang, topic, documents, tokens, raked weight, copies expected, capped) of each cell that has documents."""
    found = labelled(docs, targets).groupBy("_source", "_lang", "_topic").agg(F.count("*").alias("n"), F.sum("_words").alias("tokens")).collect()
    found.sort(key=lambda r: tuple(r)[:3])
    tokens = np.array([r["tokens"] for r in found], np.float64)
    if not tokens.sum():
        return [(*tuple(r)[:3], r["n"], int(r["tokens"]), 0.0, 1.0, False) for r in found]
    names = [sorted({OTHER, *targets.of(d)}) for d in DIMENSIONS]
    cells = np.array([[names[d].index(r[d]) for d in range(3)] for r in found])
    weight = rake(cells, tokens, [np.array([targets.of(d).get(n, 0.0) for n in names[k]]) for k, d in enumerate(DIMENSIONS)])
    if once:
        copies = chances(weight, tokens, keep)
    else:
        copies = np.divide(weight * keep * tokens.sum(), tokens, out=np.zeros_like(weight), where=tokens > 0)
    # cells without a word: they weigh nothing, and are kept
    copies = np.where(tokens > 0, copies, 1.0)
    return [(*tuple(r)[:3], r["n"], int(r["tokens"]), float(w), float(c), once and bool(c == 1)) for r, w, c in zip(found, weight, copies, strict=True)]


def shares(cells: list[tuple], targets: Targets = TARGETS) -> list[tuple[str, str, float, float]]:
    """(dimension, class, share of the expected tokens, target among the classes that have tokens) of a :func:`cell_table`."""
    total, out = sum(c[4] * c[6] for c in cells), []
    for k, dimension in enumerate(DIMENSIONS):
        there = {c[k] for c in cells if c[4]}
        asked = {n: targets.of(dimension).get(n, 0.0) for n in there}
        out += [(dimension, n, sum(c[4] * c[6] for c in cells if c[k] == n) / total, asked[n] / sum(asked.values())) for n in sorted(there)]
    return out


_CELL = "_source string, _lang string, _topic string, _documents long, _tokens long, _weight double, _chance double, _capped boolean"


_HELPERS = ("_words", "_source", "_lang", "_topic", "_documents", "_tokens", "_weight", "_chance", "_capped", "_copies", "_kept", "_copy")


def mixed(docs: DataFrame, targets: Targets = TARGETS, keep: float = KEEP, seed: str = SEED, id_col: str = "doc_id", once: bool = False) -> DataFrame:
    """``docs`` with the cell of each row, ``_chance`` (its expected copies), ``_copies`` and ``_kept``, the decisions on it."""
    if taken := {c.lower() for c in docs.columns} & set(_HELPERS):
        raise ValueError(f"columns {sorted(taken)} exist already")
    spark = docs.sparkSession
    cells = spark.createDataFrame(cell_table(docs, targets, keep, once), _CELL)
    draw = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col("source"), F.lit("")), F.length(F.coalesce(F.col("text"), F.lit(""))).cast("string")))
    uniform = F.conv(F.substring(draw, 1, 13), 16, 10).cast("double") / float(16**13)
    expected = F.coalesce("_chance", F.lit(1.0))
    copies = (F.floor(expected) + (uniform < expected - F.floor(expected)).cast("int")).cast("int")
    out = labelled(docs, targets).join(F.broadcast(cells), ["_source", "_lang", "_topic"], "left").withColumn("_copies", copies)
    return out.withColumn("_kept", F.col("_copies") > 0)


def mix_digest(documents: DataFrame) -> DataFrame:
    rows = mixed(documents.select("doc_id", "text", "source", "lang"))
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_source").alias("source_class"), F.col("_lang").alias("lang_class"), F.col("_topic").alias("topic"),
        F.col("_words").cast("long").alias("n_words"), F.round("_chance", 9).alias("chance"), F.col("_kept").alias("kept"), F.col("_copies").alias("copies"),
    )


def sample(docs: DataFrame, targets: Targets = TARGETS, keep: float = KEEP, seed: str = SEED, once: bool = False) -> DataFrame:
    """The rows that are kept, each as often as its copies say, with the columns they came with."""
    docs, back = columns.apart(docs, _HELPERS)
    own = [F.col(f"`{c}`").alias(back.get(c, c)) for c in docs.columns]
    rows = mixed(docs, targets, keep, seed, once=once).where("_kept")
    return rows.select(*own) if once else rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*own)
