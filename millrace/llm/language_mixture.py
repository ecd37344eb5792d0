"""Language identification that allows for several languages in one text.

Training counts byte trigrams (hashed to ``BINS``) of the lower-cased letters of every text that is not held out, per
language; tasks add up their own counts first, so a language that holds most rows costs no more than any other. A text's
trigrams are then explained by a mixture of the languages' trigram distributions: expectation-maximisation estimates the
shares, and the set of languages is the one whose likelihood, less a penalty for each language, is highest. Sets are the
leading languages of the full estimate, one by one, each estimated anew.

The model has ``BINS`` numbers per language (64 kB); it comes to the driver and travels with the function, so its size
follows the number of languages, not of texts. Prediction is a pass over the rows without a shuffle.

Defined results
    * a text that is null or has no letter is ``und`` with score 0 and no languages;
    * without a row to learn from, every text is ``und``;
    * equal likelihoods: the language first in alphabetical order;
    * rows without id or language are not learned from; a null id is not held out; repeated rows get equal results;
    * other columns are carried along by :func:`with_languages`; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from millrace.llm import bytescan

BINS, BLOCK = 1 << 13, 1 << 10
#: added to every count
SMOOTH = 0.5
ROUNDS = 12
#: what each language after the first must add to the log likelihood: a share of the trigrams, and a multiple of the log of their number
PENALTY_SHARE, PENALTY_LOG = 0.02, 3.0
UNKNOWN = "und"
#: languages whose counts a task holds at once
HELD = 64

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_HAS_LETTER = regex.compile(r"\p{L}")


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the trigrams of all texts, and where those of each text begin and end (one row each)."""
    coded = [b" " + (t or "").lower().encode("utf-8", "replace") + b" " for t in texts]
    sizes = np.array([len(c) for c in coded], np.int64)
    data = np.frombuffer(b"".join(coded), np.uint8)
    starts = np.cumsum(sizes) - sizes
    letter = _LETTER[data]
    data = np.where(letter, data, 32).astype(np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[starts] = True
    kept = data[keep]
    place = np.concatenate([[0], np.cumsum(keep)])
    codes = (kept[:-2] << 16) | (kept[1:-1] << 8) | kept[2:]
    bins = ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    begin = place[starts]
    return bins, np.stack([begin, np.maximum(begin, place[starts + sizes] - 2)], axis=1)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: probability of each bin, by language
    chance: np.ndarray

    def shares(self, count: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, float]:
        """Shares of the languages (rows of ``chance``) by expectation-maximisation, and the log likelihood."""
        total = count.sum()
        share = np.full(len(chance), 1 / len(chance))
        for _ in range(ROUNDS if len(chance) > 1 else 0):
            mixed = share @ chance
            share = share * (chance @ (count / mixed)) / total
        return share, float(count @ np.log(share @ chance))

    def explain(self, bins: np.ndarray) -> tuple[str, float, list[str], list[float]]:
        """The main language, its share among all languages, and the languages of the text with their shares."""
        every = np.bincount(bins, minlength=BINS)
        used = np.flatnonzero(every)
        count, chance = every[used].astype(np.float64), self.chance[:, used]
        single = np.log(chance) @ count
        if len(single) == 1:
            return self.languages[0], 1.0, [self.languages[0]], [1.0]
        share, _ = self.shares(count, chance)
        order = np.lexsort((np.arange(len(share)), -share))
        first = int(np.argmax(single))
        order = [first, *(int(i) for i in order if i != first)]
        penalty = PENALTY_SHARE * count.sum() + PENALTY_LOG * np.log(count.sum() + 1)
        best, chosen, shares = float(single[first]), [first], np.ones(1)
        for size in range(2, len(order) + 1):
            part, likely = self.shares(count, chance[order[:size]])
            if likely - (size - 1) * penalty <= best:
                break
            best, chosen, shares = likely - (size - 1) * penalty, order[:size], part
        main = int(np.argmax(shares))
        return self.languages[chosen[main]], float(min(1.0, share[chosen[main]])), [self.languages[i] for i in chosen], shares.tolist()


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(documents: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Trigram distributions of the languages of all rows that are not held out."""
    rows = documents.where(F.col(id_col).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(id_col)))
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            names = [name for name in held for _ in range(BINS // BLOCK)]
            blocks = [held[name][b : b + BLOCK].astype("<i8").tobytes() for name in held for b in range(0, BINS, BLOCK)]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(list(range(BINS // BLOCK)) * len(held), pa.int32()), pa.array(blocks, pa.binary())], names=["lang", "block", "counts"])

        for batch in batches:
            for part, _, _ in bytescan.steps(batch, "text"):
                bins, ranges = trigrams(part.column(1).to_pylist())
                for name, (begin, end) in zip(part.column(0).to_pylist(), ranges.tolist(), strict=True):
                    if name not in held:
                        if len(held) >= HELD:
                            yield out()
                            held.clear()
                        held[name] = np.zeros(BINS, np.int64)
                    held[name] += np.bincount(bins[begin:end], minlength=BINS)
        if held:
            yield out()

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(c, "<i8") for c in table["counts"].to_pylist()], axis=0)
        return pa.table({"lang": table["lang"][:1], "block": table["block"][:1], "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    schema = "lang string, block int, counts binary"
    found = rows.mapInArrow(count, schema).groupBy("lang", "block").applyInArrow(add, schema).collect()
    languages = tuple(sorted({r["lang"] for r in found}))
    counts = np.zeros((len(languages), BINS), np.float64)
    for r in found:
        counts[languages.index(r["lang"]), r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], "<i8")
    counts += SMOOTH
    return Model(languages, counts / counts.sum(axis=1, keepdims=True))


def with_languages(df: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with lang_pred, score, languages and shares of each row's whole text, all named with ``prefix``."""
    added = [StructField(prefix + "lang_pred", StringType()), StructField(prefix + "score", DoubleType()), StructField(prefix + "languages", ArrayType(StringType())), StructField(prefix + "shares", ArrayType(DoubleType()))]
    if taken := {f.name for f in added} & set(df.columns):
        raise ValueError(f"columns {sorted(taken)} exist already; give another prefix")

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in bytescan.steps(batch, text):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                bins, ranges = trigrams(texts)
                found = [
                    model.explain(bins[b:e]) if e > b and model.languages and _HAS_LETTER.search(t) else (UNKNOWN, 0.0, [], [])
                    for t, (b, e) in zip(texts, ranges.tolist(), strict=True)
                ]
                columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())))]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *(f.name for f in added)])

    return df.mapInArrow(explain, StructType([*df.schema.fields, *added]))


def language_digest(documents: DataFrame) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = with_languages(rows, learn(documents))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.round("score", 9).alias("score"), F.concat_ws(",", F.array_sort("languages")).alias("languages"))
