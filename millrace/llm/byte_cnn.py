"""A byte-level convolutional network in numpy that scores the quality of whole texts.

A text's bytes are covered by chunks of ``CHUNK`` bytes, each starting half a chunk after the one before it. Learned filters
of ``WIDTH`` bytes run over every position (a table for each place in the filter turns bytes into filter responses, which
is a convolution over one-hot bytes); the largest response of each filter in a chunk feeds a small dense layer, whose
largest outputs over all chunks of the text are combined into one probability. Every byte of a text is read.

The network is fitted on the driver with Adam, on at most ``sample`` labelled documents of each class (those with the
smallest hash of their id) and at most ``CHUNKS_FITTED`` evenly spaced chunks of each, that is below 10 MB. As both classes
weigh the same there, the last bias is then moved by the log odds of all labelled rows, so scores are shares.

Scoring is a pass over the rows without a shuffle; the weights (below 1 MB) travel with the function.

Defined results
    * a null or empty text is one chunk without a response and gets the score that the network gives it;
    * without any labelled row every score is 0.5; with labels of one class only, scores are their share with one counter-example added;
    * rows are scored one by one: repeated rows get equal scores, a null id is not held out, no rows give no rows;
    * labels that are null or neither 0 nor 1 are not read; of several labels for an id the smallest counts;
    * other columns are carried along; columns of the added names are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.llm import bytescan

CHUNK, HALF = 512, 256
WIDTH, FILTERS, HIDDEN = 6, 16, 12
CHUNKS_FITTED = 8
SAMPLE = 1500
#: rounds over the sample, and more of them where these make fewer than LEAST_STEPS steps
EPOCHS, LEAST_STEPS, BATCH, RATE = 14, 500, 48, 0.01
THRESHOLD = 0.3
STEP = 1 << 18


@dataclass
class Weights:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    dense: np.ndarray  # FILTERS x HIDDEN
    dense_bias: np.ndarray
    last: np.ndarray  # HIDDEN
    last_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.dense, self.dense_bias, self.last, self.last_bias]


def initial(seed: int) -> Weights:
    r = np.random.default_rng(seed)
    f = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
    return Weights(f(WIDTH, 256, FILTERS, scale=0.25), np.zeros(FILTERS, np.float32), f(FILTERS, HIDDEN, scale=0.35), np.full(HIDDEN, 0.1, np.float32), f(HIDDEN, scale=0.35), np.zeros(1, np.float32))


def responses(data: np.ndarray, w: Weights) -> np.ndarray:
    """Filter responses at each place but the last ``WIDTH - 1`` of ``data``."""
    size = len(data) - WIDTH + 1
    out = np.take(w.tables[0], data[:size], axis=0)
    held = np.empty_like(out)
    for k in range(1, WIDTH):
        out += np.take(w.tables[k], data[k : k + size], axis=0, out=held, mode="clip")
    out += w.bias
    return np.maximum(out, 0, out=out)


def pooled(data: np.ndarray, offsets: np.ndarray, w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Largest responses in each chunk, and the number of the first chunk of each text (every text has one at least)."""
    sizes = np.diff(offsets)
    texts = len(sizes)
    padded = np.zeros(len(data) + texts * (WIDTH - 1) + WIDTH, np.uint8)
    shift = np.repeat(np.arange(texts) * (WIDTH - 1), sizes)
    padded[np.arange(len(data)) + shift] = data
    starts = offsets[:-1] + np.arange(texts) * (WIDTH - 1)
    found = responses(padded, w)
    ends = starts + sizes
    found[(ends[:, None] + np.arange(WIDTH - 1)).ravel()] = 0  # filters that start behind a text see the next one
    blocks = np.maximum(1, -(-sizes // HALF))
    first = np.cumsum(blocks) - blocks
    at = np.repeat(starts, blocks) + (np.arange(blocks.sum()) - np.repeat(first, blocks)) * HALF
    most = np.maximum.reduceat(found, at, axis=0)
    # a chunk is a block and the next one of its text; the last block of a longer text is in the chunk before it
    last = np.zeros(len(most), bool)
    last[first + blocks - 1] = True
    most[:-1] = np.where(last[:-1, None], most[:-1], np.maximum(most[:-1], most[1:]))
    keep = ~last
    keep[first[blocks == 1]] = True
    chunks = np.maximum(1, blocks - 1)
    return most[keep], np.cumsum(chunks) - chunks


def scores(data: np.ndarray, offsets: np.ndarray, w: Weights) -> np.ndarray:
    chunks, first = pooled(data, offsets, w)
    hidden = np.maximum(chunks @ w.dense + w.dense_bias, 0)
    z = np.maximum.reduceat(hidden, first, axis=0).astype(np.float64) @ w.last + w.last_bias[0]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: list[list[bytes]], labels: np.ndarray, odds: float, seed: int = 7) -> Weights:
    """Weights from chunks of texts and labels; ``odds``: of label 1 among all labelled rows."""
    w = initial(seed)
    rng = np.random.default_rng(seed)
    sizes = np.array([len(t) for t in texts])
    at = np.cumsum(sizes) - sizes
    chunks = np.zeros((sizes.sum(), CHUNK + WIDTH - 1), np.uint8)
    length = np.zeros(len(chunks), np.int64)
    for i, chunk in enumerate(c for t in texts for c in t):
        chunks[i, : len(chunk)] = np.frombuffer(chunk, np.uint8)
        length[i] = len(chunk)
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in w.parts()]
    step = 0
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(1, -(-len(labels) // BATCH))))
    for epoch in range(epochs):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(len(labels))
        for b in range(0, len(order), BATCH):
            docs = order[b : b + BATCH]
            rows = np.concatenate([np.arange(at[d], at[d] + sizes[d]) for d in docs])
            first = np.cumsum(sizes[docs]) - sizes[docs]
            x = chunks[rows]
            found = responses(x.ravel(), w)
            found = np.concatenate([found, np.zeros((WIDTH - 1, FILTERS), np.float32)]).reshape(len(rows), CHUNK + WIDTH - 1, FILTERS)
            found[np.arange(CHUNK + WIDTH - 1) >= length[rows][:, None]] = 0
            place = found.argmax(axis=1)
            most = np.take_along_axis(found, place[:, None], axis=1)[:, 0]
            before = most @ w.dense + w.dense_bias
            hidden = np.maximum(before, 0)
            top = np.maximum.reduceat(hidden, first, axis=0)
            p = 1 / (1 + np.exp(-np.clip(top @ w.last + w.last_bias[0], -30, 30)))
            dz = ((p - labels[docs]) * share[docs] / len(docs)).astype(np.float32)
            owner = np.repeat(np.arange(len(docs)), sizes[docs])
            # the first chunk that has the largest output takes the gradient
            is_top = (hidden == top[owner]) & (hidden > 0)
            ranks = np.cumsum(is_top, axis=0)
            is_top &= ranks - (ranks[first] - is_top[first])[owner] == 1
            d_hidden = is_top * (dz[:, None] * w.last)[owner]
            d_most = (d_hidden @ w.dense.T) * (most > 0)
            d_tables = np.zeros_like(w.tables)
            filters = np.broadcast_to(np.arange(FILTERS), place.shape)
            for k in range(WIDTH):
                np.add.at(d_tables[k], (np.take_along_axis(x, place + k, axis=1), filters), d_most)
            grads = [d_tables, d_most.sum(axis=0), most.T @ d_hidden, d_hidden.sum(axis=0), top.T @ dz, dz.sum(keepdims=True)]
            step += 1
            for part, (m, v), g in zip(w.parts(), moment, grads, strict=True):
                g = g + 1e-4 * part
                m += 0.1 * (g - m)
                v += 0.002 * (g * g - v)
                part -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.998**step)) + 1e-6)).astype(np.float32)
    w.last_bias += np.float32(np.log(odds))
    return w


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Weights | float:
    """The network for rows that are not held out, or a constant score where there are not two classes to learn."""
    given = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label).cast("int").alias("_label"))
    given = given.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id"))).groupBy("_id").agg(F.min("_label").alias("_label"))
    given = given.join(documents.select(F.col(id_col).cast("long").alias("_id")).distinct(), "_id", "left_semi")
    counts = {r["_label"]: r["count"] for r in given.groupBy("_label").count().collect()}
    if len(counts) < 2:
        return 0.5 if not counts else (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    order = F.xxhash64("_id")
    chosen = given.where("_label = 0").orderBy(order, "_id").limit(sample).union(given.where("_label = 1").orderBy(order, "_id").limit(sample))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1).to_pylist():
                data = (value or "").encode()
                starts = list(range(0, max(1, len(data) - HALF), HALF))
                if len(starts) > CHUNKS_FITTED:
                    starts = [starts[i] for i in np.linspace(0, len(starts) - 1, CHUNKS_FITTED).astype(int)]
                out.append([data[s : s + CHUNK] for s in starts])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.binary())), batch.column(2)], names=["_id", "chunks", "_label"])

    rows = documents.select(F.col(id_col).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")).join(F.broadcast(chosen), "_id")
    found = rows.mapInArrow(cut, "_id long, chunks array<binary>, _label int").groupBy("_id").agg(F.first("chunks").alias("chunks"), F.first("_label").alias("_label")).collect()
    found.sort(key=lambda r: r["_id"])
    return fit([[bytes(c) for c in r["chunks"]] for r in found], np.array([r["_label"] for r in found]), counts[1] / counts[0])


def with_score(df: DataFrame, weights: Weights | float, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the score of each row's whole text."""
    if name in df.columns:
        raise ValueError(f"column {name} exists already")
    if isinstance(weights, float):
        return df.withColumn(name, F.lit(weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in bytescan.steps(batch, text, STEP):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores(data, offsets, weights))], names=[*part.schema.names, name])

    return df.mapInArrow(score, StructType([*df.schema.fields, StructField(name, DoubleType())]))


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = with_score(rows, fit_on(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``, with the columns they came with."""
    scored = with_score(docs, fit_on(docs, labels), name="_quality_score")
    return scored.where(F.col("_quality_score") >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
