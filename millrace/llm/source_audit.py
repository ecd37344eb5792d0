"""How far the sources of a language differ in their words: smoothed shares compared by a frequent-pattern tree.

A language keeps the terms that stand in ``min_docs`` of its documents. A source gives each kept term the share
``1 + floor(SCALE * (count + smoothing) / (total + smoothing * terms))``, all in whole numbers. For each two sources of a
language the sum of the absolute differences of their shares over all kept terms is wanted.

Most sources lack most terms, so the sum is put together from what all terms would give if no source had any, plus
corrections: one for each term that a source has (from a histogram of its shares), and one for each term that both have.
For the latter a term is a row of its sources' nonzero counts, in the order of the sources. Equal rows are one row with a
multiplicity; the rows, laid out by range so that equal beginnings stand together, are inserted into trees, and each node
is compared with each of its ancestors once, times its multiplicity, however many terms share the path. A tree takes
``TREE_ITEMS`` items, then a new one starts, so memory is bounded; corrections are added up per tree and then by Spark.

Words are counted where the texts are read, ``HELD_TERMS`` at a time; what is shuffled is one row per task, language,
source and term. No list grows beyond the number of sources of a language, which its pairs, the result, are the square of.

Defined results
    * null text, language and source are empty strings; the empty language is a language, the empty source a source;
    * each row is a document, repeated or not; a text without a word counts for nothing, its group still has its pairs;
    * a language without kept terms has pairs of value 0 and no terms; a language of one source has no pairs;
    * ties are ordered by the item's bytes; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import broadcast_join
from millrace.session import checkpointed, task_slots

SCALE = 1_000_000_000
#: distinct (language, source, term) that a task holds before it hands on their counts
HELD_TERMS = 500_000
#: items of the rows that one tree is built from
TREE_ITEMS = 200_000

_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


def term_counts(documents: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, occurrences ``n`` and documents ``d``, over all documents with these columns."""

    def emit(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
        rows = [(lang, source, term, n, docs[term]) for (lang, source), (times, docs) in held.items() for term, n in times.items()]
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "source", "term", "n", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(lambda: (Counter(), Counter())), 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = _TERM.findall(text.lower())  # of bytes, lower() changes A to Z alone
                times, docs = held[lang, source]
                size -= len(times)
                times.update(found)
                docs.update(set(found))
                size += len(times)
                if size > HELD_TERMS:
                    yield emit(held)
                    held.clear()
                    size = 0
        yield emit(held)

    rows = documents.select("lang", "source", F.col("text").cast("binary").alias("text"))
    parts = rows.mapInArrow(run, "lang string, source string, term binary, n long, d long")
    return parts.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def share(count, total, terms, smoothing: int):
    """The share in whole numbers; null where a language has no terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + smoothing).cast("decimal(20,0)")
    below = F.nullif(total + smoothing * terms, F.lit(0).cast("long"))
    return F.lit(1).cast("long") + F.call_function("div", top, below.cast("decimal(20,0)"))


def tree_corrections(offsets: np.ndarray, group: np.ndarray, source: np.ndarray, n: np.ndarray, p: np.ndarray, z: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """For two sources of a language: the sum over all rows that hold both of what their pair adds to the corrections of each alone.

    Row i, of language ``group[i]`` and multiplicity ``times[i]``, has the items ``offsets[i]`` up to ``offsets[i + 1]``, in the
    order of the sources; ``p`` is a source's share of the term, ``z`` its share of a term that it lacks. No row is empty, and
    rows that begin alike follow each other. Returns language, source above, source below and sum.
    """
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    depth = np.arange(len(source)) - offsets[row]
    # insertion: a row shares the nodes of the row before it as far as the two begin alike
    before = offsets[np.maximum(row - 1, 0)] + depth
    alike = (row > 0) & (group[row] == group[row - 1]) & (depth < sizes[row - 1]) & (source[before] == source) & (n[before] == n)
    shared = np.minimum.reduceat(np.where(alike, len(source), depth), offsets[:-1])
    new = depth >= shared[row]
    number = np.cumsum(new) - 1
    order = np.argsort(depth, kind="stable")  # level by level: an item's node is the last new one of its level
    node = np.empty(len(source), np.int64)
    node[order] = number[order][np.maximum.accumulate(np.where(new[order], np.arange(len(order)), 0))]
    weight = np.zeros(number[-1] + 1, np.int64)
    np.add.at(weight, node, times[row])
    at = np.flatnonzero(new)
    parent = np.where(depth[at] > 0, node[at - 1], -1)
    source, p, z, group = source[at], p[at], z[at], group[row[at]]
    here, above, found = np.arange(len(at)), parent, []
    width = int(source.max()) + 1
    while len(here := here[above >= 0]):  # all nodes against their ancestors, one level further up each time
        above = above[above >= 0]
        a, b = p[above], p[here]
        added = weight[here] * (abs(a - b) - abs(a - z[here]) - abs(z[above] - b) + abs(z[above] - z[here]))
        found.append(((group[here] * width + source[above]) * width + source[here], added))
        above = parent[above]
    codes, added = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in range(2))
    order = np.argsort(codes, kind="stable")
    first = np.flatnonzero(np.diff(codes[order], prepend=-1))
    codes, sums = codes[order][first], np.add.reduceat(added[order], first) if len(first) else added
    return codes // width // width, codes // width % width, codes % width, sums


def both_present(items: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b``, ``both``: tree corrections of each two sources that share a term, a before b."""
    row = F.array_sort(F.collect_list(F.struct("source", "n", "p", "z"))).alias("row")
    rows = items.groupBy("lang", "term").agg(row).groupBy("lang", "row").agg(F.count("*").alias("times"))
    # the first items and a hash: small keys for the partitioner's sample, and equal beginnings still spread where they are many
    rows = rows.withColumn("head", F.transform(F.slice("row", 1, 3), lambda x: F.struct(x["source"], x["n"])))
    laid = rows.repartitionByRange(task_slots(items.sparkSession), "lang", "head", F.xxhash64("row")).sortWithinPartitions("lang", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column(1).offsets.to_numpy()
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + TREE_ITEMS, side="right")) - 1)
                part = batch.slice(at, to - at)
                flat = part.column(1).flatten()
                langs, names = part.column(0).dictionary_encode(), flat.field("source").dictionary_encode()
                numbers = [flat.field(c).to_numpy() for c in ("n", "p", "z")]
                lang, a, b, sums = tree_corrections(ends[at : to + 1].astype(np.int64) - ends[at], langs.indices.to_numpy().astype(np.int64), names.indices.to_numpy().astype(np.int64), *numbers, part.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(lang)), names.dictionary.take(pa.array(a)), names.dictionary.take(pa.array(b)), pa.array(sums)], names=["lang", "a", "b", "both"])
                at = to

    return laid.select("lang", "row", "times").mapInArrow(run, "lang string, a string, b string, both long").groupBy("lang", "a", "b").agg(F.sum("both").alias("both"))


def one_present(items: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b``, ``one``: over the terms that ``a`` has, the change if ``b`` lacks them all; for all ordered pairs.

    Sums of ``abs(p - z)`` over the shares p of ``a`` for each z of the other sources: both in one order, with running counts.
    """
    levels = items.groupBy("lang", F.col("source").alias("a"), F.col("p").alias("v")).agg(F.count("*").alias("n"))
    others = groups.select("lang", F.col("source").alias("b"), F.col("z").alias("v"))
    # as many rows as the result has
    asked = groups.select("lang", F.col("source").alias("a"), F.col("z").alias("own")).join(others, "lang").where("a <> b")
    union = levels.select("lang", "a", "v", "n", F.lit(None).cast("string").alias("b"), F.lit(None).cast("long").alias("own")).unionByName(asked.withColumn("n", F.lit(0).cast("long")))
    below = Window.partitionBy("lang", "a").orderBy("v").rangeBetween(Window.unboundedPreceding, 0)  # a histogram's rows, not terms
    whole = Window.partitionBy("lang", "a")
    value = F.col("n") * F.col("v")  # the shares of a source add up to about SCALE, whatever the number of terms
    found = union.select(
        "*", F.sum("n").over(below).alias("n_below"), F.sum(value).over(below).alias("s_below"), F.sum("n").over(whole).alias("n_all"), F.sum(value).over(whole).alias("s_all"))
    one = F.col("s_all") - F.col("n_all") * F.col("v") + 2 * (F.col("n_below") * F.col("v") - F.col("s_below")) - F.col("n_all") * F.abs(F.col("own") - F.col("v"))
    return found.where("b is not null").select("lang", "a", "b", one.alias("one"))


def audit(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30, smoothing: int = 5, top: int = 50) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: the other sources by distance, and the terms that a source overuses most."""
    empty = F.lit("")
    documents = documents.select(F.coalesce(lang, empty).alias("lang"), F.coalesce(source, empty).alias("source"), F.coalesce(text, empty).alias("text"))
    counted = term_counts(documents)
    terms = counted.groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sum("n").alias("everywhere"), F.collect_list(F.struct("source", "n")).alias("held"))
    kept = checkpointed(terms.where(F.col("d") >= min_docs).drop("d"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("everywhere").alias("total"))
    single = kept.select("lang", "term", "everywhere", F.inline("held"))
    sums = single.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = documents.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", F.coalesce("own", zero).alias("own"), F.coalesce("terms", zero).alias("terms"), F.coalesce("total", zero).alias("total"))
    groups = checkpointed(groups.withColumn("z", share(zero, F.col("own"), F.col("terms"), smoothing)))
    # a row per source: sent to every task where they are few, else joined by shuffle, where skewed keys are split
    items = broadcast_join(single, groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("own"), F.col("terms"), smoothing))

    over = items.withColumn("value", F.col("p") - share(F.col("everywhere"), F.col("total"), F.col("terms"), smoothing)).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    words = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    one = checkpointed(one_present(items, groups))
    both = both_present(items)
    twice = both.unionByName(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "both"))
    side = groups.select("lang", F.col("source").alias("a"), "terms", F.col("z").alias("za"))
    other = groups.select("lang", F.col("source").alias("b"), F.col("z").alias("zb"))
    pairs = one.join(one.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), F.col("one").alias("back")), ["lang", "a", "b"])
    pairs = pairs.join(twice, ["lang", "a", "b"], "left").join(side, ["lang", "a"]).join(other, ["lang", "b"])
    value = F.coalesce(F.col("terms") * F.abs(F.col("za") - F.col("zb")) + F.col("one") + F.col("back") + F.coalesce("both", zero), zero)
    near = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value")).withColumn("rank", F.row_number().over(order))
    return near.unionByName(words)
