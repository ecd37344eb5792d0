"""Quality rules: repetition coverage.

Rolling hashes over several n-gram lengths mark every word that lies inside an n-gram found twice or more in its text; the
characters of the marked words, and those of repeated lines, are measured against the characters of all words. A text is
rejected when one of these shares is above its bound, or by the base rules (too few words, too many words in repeated
windows of eight).

All work on a text happens in the task that reads it: there is no shuffle, so no key can be hot.

Defined results
    * null or empty text, or one of blanks only: no words, all counts 0, ``base_failed`` true, ``kept`` false;
    * rows are judged one by one: equal rows get equal results, null ids stay null, an empty table gives no rows;
    * columns beyond the two named ones are carried along untouched by :func:`with_rules` and ignored by the query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from millrace.llm import bytescan

SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
BASE_WINDOW = 8


@dataclass(frozen=True)
class Bounds:
    """The most that a text may have. Shares are of the characters (code points) in words."""

    least_words: int = 20
    base_repeat_percent: int = 30
    #: n-gram length: share of characters inside n-grams found twice or more
    ngram_share: dict[int, float] = field(default_factory=lambda: {3: 0.50, 5: 0.45, 10: 0.35})
    line_share: float = 0.40
    symbol_share: float = 0.10


def _spread(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in one of the windows of ``n`` words at ``starts``."""
    edges = np.zeros(words + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + n, words), -1)
    return np.cumsum(edges[:-1]) > 0


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which values occur twice or more."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def measure(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts for each text; ``in_<n>``: characters of words inside repeated n-grams of ``n`` words."""
    scan = bytescan.Scan(data, offsets)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOLS[data], out=symbols[1:])
    chars = points[scan.ends] - points[scan.starts]
    hashes, owner, words = scan.word_hashes(), scan.text_of_word(), len(scan.starts)
    salt = bytescan.mixed(np.arange(scan.count, dtype=np.uint64) + np.uint64(1))
    per_text = lambda v: np.bincount(owner, v, scan.count).astype(np.int64)
    out = {
        "n_words": np.diff(scan.word_at),
        "word_chars": per_text(chars),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
    }
    for n in sorted({BASE_WINDOW, *lengths}):
        starts, keys = bytescan.windows(hashes, scan.word_at, n)
        marked = _spread(starts[_repeated(keys ^ salt[owner[starts]])], n, words)
        if n == BASE_WINDOW:
            out["n_repeat_words"] = per_text(marked)
        if n in lengths:
            out[f"in_{n}"] = per_text(chars * marked)
    out |= _lines(scan, data, offsets, points, salt)
    return out


def _lines(scan: bytescan.Scan, data: np.ndarray, offsets: np.ndarray, points: np.ndarray, salt: np.ndarray) -> dict[str, np.ndarray]:
    """Lines with a word that equal an earlier line of their text, and the characters of their words."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.union1d(offsets[:-1], breaks + 1)
    starts = starts[starts < len(data)]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.append(starts[1:], len(data))
    ends = np.minimum(ends, offsets[owner + 1])
    ends -= (ends > starts) & (data[np.maximum(ends - 1, 0)] == 0x0A)
    first, behind = np.searchsorted(scan.starts, starts), np.searchsorted(scan.starts, ends)
    full = behind > first
    starts, ends, owner, first, behind = (x[full] for x in (starts, ends, owner, first, behind))
    keys = scan.hashes(starts, ends) ^ salt[owner]
    _, at = np.unique(keys, return_index=True)  # the first of each
    later = np.ones(len(keys), bool)
    later[at] = False
    sums = np.zeros(len(scan.starts) + 1, np.int64)
    np.cumsum(points[scan.ends] - points[scan.starts], out=sums[1:])
    chars = sums[behind] - sums[first]
    count = lambda v: np.bincount(owner, v, scan.count).astype(np.int64)
    return {"n_dup_lines": count(later), "line_chars": count(chars * later)}


def verdicts(found: dict[str, np.ndarray], bounds: Bounds) -> dict[str, np.ndarray]:
    total = np.maximum(found["word_chars"], 1)
    base = (found["n_words"] < bounds.least_words) | (100 * found["n_repeat_words"] > bounds.base_repeat_percent * found["n_words"])
    bad = base | (found["line_chars"] > bounds.line_share * total) | (found["n_symbols"] > bounds.symbol_share * total)
    for n, share in bounds.ngram_share.items():
        bad = bad | (found[f"in_{n}"] > share * total)
    return {"base_failed": base, "kept": ~bad}


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars")


def with_rules(df: DataFrame, text: str = "text", bounds: Bounds | None = None, prefix: str = "") -> DataFrame:
    """``df`` with counts, shares and verdict of each row's text, all named with ``prefix``."""
    bounds = bounds or Bounds()
    lengths = tuple(sorted(bounds.ngram_share))
    shares = [f"share_{n}" for n in lengths]
    added = [StructField(prefix + c, LongType()) for c in COUNTS] + [StructField(prefix + c, DoubleType()) for c in shares]
    added += [StructField(prefix + c, BooleanType()) for c in ("base_failed", "kept")]
    if taken := {f.name for f in added} & set(df.columns):
        raise ValueError(f"columns {sorted(taken)} exist already; give another prefix")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in bytescan.steps(batch, text):
                found = measure(data, offsets, lengths)
                verdict = verdicts(found, bounds)
                total = np.maximum(found["word_chars"], 1)
                new = [pa.array(found[c].astype(np.int64)) for c in COUNTS]
                new += [pa.array(found[f"in_{n}"] / total) for n in lengths] + [pa.array(v) for v in verdict.values()]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *(f.name for f in added)])

    return df.mapInArrow(judge, StructType([*df.schema.fields, *added]))


def rules_digest(documents: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``documents``."""
    return with_rules(documents.select("doc_id", "text")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "share_3", "share_5", "share_10",
    )


def keep_good(docs: DataFrame, text: str = "text", bounds: Bounds | None = None) -> DataFrame:
    """The rows that the rules keep, with the columns they came with."""
    return with_rules(docs, text, bounds, prefix="_rules_").where("_rules_kept").select(*[F.col(f"`{c}`") for c in docs.columns])
