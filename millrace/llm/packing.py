"""Best-fit packing of tokenized documents into sequences of fixed length, by sums of squares.

1. Tasks tokenize whole texts and cut documents that are longer than a sequence into pieces. Each text is taken apart in
   front of the last white space of every run, where no token of a byte-level tokenizer can cross, and each distinct segment
   is tokenized once per worker (``KEPT_SEGMENTS`` are kept). The pieces are written as a table, without texts.
2. The pieces are dealt evenly, by row number, over shards of about ``SHARD_PIECES``. A shard places its pieces, long ones
   first, each into the open sequence for which the sum over all gaps of (open sequences with that gap) squared becomes
   smallest; a new sequence is opened only where the piece fits nowhere. Ties go to the smallest gap. Only the numbers of
   open sequences per gap decide, so the state is two arrays as long as a sequence. A shard wastes about one sequence
   against the total of its tokens; the number of shards grows with the input, the size of one does not.

A document with many pieces has one short piece at most; the others fill a sequence each.

Defined results
    * a null text is an empty one, whose only token is the end mark; a null id stays null;
    * rows are documents: repeated rows are packed one by one; no rows give no rows;
    * special tokens in a text are ordinary text; other columns are not touched, as only id and text are read;
    * a very long text is taken apart in steps of ``STEP_CHARS``.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from millrace.llm import bytescan
from millrace.session import checkpointed

SHARD_PIECES = 16_384
#: segments of each of the two generations that a worker keeps (about 200 bytes a segment)
KEPT_SEGMENTS = 600_000
STEP_CHARS = 1_000_000

_LAST_BLANK = re.compile(r"[ \n](?=\S)")
_ODD = re.compile(r"[ \n](?=\s|\Z)|\0")
_MARKS = ".,;:!?"
#: The letter that stands for each byte in byte-level vocabularies: itself where it is printable, else the next free one.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHOWN = {b: b for b in _PRINTABLE} | {b: 0x100 + k for k, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


def segments(text: str) -> list[str]:
    """The text, cut before each blank or line end that is followed by something else than white space.

    There a byte-level tokenizer cuts too: it leaves the last white space of a run to what follows.
    """
    if not _ODD.search(text):
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    cuts = [0, *(m.start() for m in _LAST_BLANK.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def steps(text: str, size: int = STEP_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut where ``segments`` cuts."""
    at = 0
    while at < len(text):
        found = _LAST_BLANK.search(text, at + size)
        to = found.start() if found else len(text)
        yield text[at:to]
        at = to


class Tokenizer(dict):
    """A tokenizer of the worker, and the segments it has met, each with its ids as little-endian 4-byte integers.

    Most segments are one word, with a blank or line end before it and marks behind it. A byte-level tokenizer cuts behind
    line ends and between letters and marks, so words are kept without these and go to its merges alone. Any other segment
    goes through the whole tokenizer.
    """

    def __init__(self, definition: str, kept: int = KEPT_SEGMENTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        super().__init__()
        self.own, self.kept, self.older = tokenizers.Tokenizer.from_str(definition), kept, {}
        self.own.encode_special_tokens = True
        kind = json.loads(definition)
        #: whether words may be taken apart here: bytes as letters, split by the usual expression, and nothing else
        self.plain = kind["normalizer"] is None and (kind["pre_tokenizer"] or {}).items() >= {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}.items() and kind["model"]["type"] == "BPE"

    def __missing__(self, segment: str) -> bytes:
        if self.plain:
            word = segment.rstrip(_MARKS)
            if len(word) < len(segment) and word[-1:].isalpha():
                return self[word] + self[segment[len(word) :]]
            if segment[0] == "\n" and segment[1:].isalpha():
                return self["\n"] + self[segment[1:]]
        found = self.older.get(segment)
        if found is None and self.plain and (segment[1:] if segment[0] == " " else segment).isalpha():
            # each byte is one letter to the merges; a blank is the first letter of a word
            shown = "\u0120" + segment[1:] if segment[0] == " " and segment.isascii() else segment.encode().decode("latin-1").translate(_SHOWN)
            found = array("I", [t.id for t in self.own.model.tokenize(shown)]).tobytes()
        elif found is None:
            found = array("I", self.own.encode(segment, add_special_tokens=False).ids).tobytes()
        if len(self) >= self.kept:
            self.older = dict(self)
            self.clear()
        self[segment] = found
        return found

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        for text in texts:
            yield b"".join([self[x] for step in steps(text or "") for x in segments(step)])


_tokenizers: dict[tuple[int, int], Tokenizer] = {}


def tokenizer(definition: str) -> Tokenizer:
    """The worker's own tokenizer; it lives on for later tasks."""
    key = (len(definition), zlib.crc32(definition.encode()))
    if key not in _tokenizers:
        _tokenizers[key] = Tokenizer(definition)
    return _tokenizers[key]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and end of the pieces of a document of ``total`` tokens; of several, the first is the short one."""
    first = total % capacity or capacity
    ends = range(first, total + 1, capacity)
    return list(zip([0, *ends], ends))


def pieces(documents: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """One row per piece: the document's id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, as asked, ``token_ids``."""
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    names = ["piece", "start", "length", "ids_crc32"]
    schema = StructType([rows.schema["doc_id"], *(StructField(n, LongType()) for n in names)])
    if ids:
        schema = schema.add("token_ids", ArrayType(LongType(), False))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(definition)
        for batch in batches:
            for part, _, _ in bytescan.steps(batch, "text"):
                row, found, packed = [], [], []
                for i, coded in enumerate(own.encode(part.column(1).to_pylist())):
                    coded += end
                    for k, (a, b) in enumerate(cut(len(coded) // 4, capacity)):
                        row.append(i)
                        found.append((k, a, b - a, zlib.crc32(coded[4 * a : 4 * b])))
                        if ids:
                            packed.append(coded[4 * a : 4 * b])
                table = np.array(found, np.int64)
                columns = [part.column(0).take(pa.array(row)), *(pa.array(table[:, c]) for c in range(4))]
                if ids:
                    flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
                    columns.append(pa.ListArray.from_arrays(np.cumsum([0, *table[:, 2]]).astype(np.int32), flat))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        own.older = {}  # what the next task can do without
        bytescan.rest()

    return rows.mapInArrow(run, schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the sequence and offset in it for pieces in the order in which they are to be placed."""
    gaps = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    standing: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, opened, no = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0, np.int64(1) << 62
    for i, size in enumerate(lengths.tolist()):
        # moving a sequence from gap g to g - size changes the sum of squares by 2 * (gaps[g - size] - gaps[g] + 1); a full one leaves the sum
        change = 2 * (gaps[: capacity - size] - gaps[size:capacity] + 1)
        if len(change):
            change[0] = 1 - 2 * gaps[size]
            change[gaps[size:capacity] == 0] = no
        best = int(change.argmin()) if len(change) else 0
        if len(change) and change[best] < no:
            gap = best + size
            at = standing[gap].pop()
            gaps[gap] -= 1
        else:
            gap, at, opened = capacity, opened, opened + 1
        if gap > size:
            gaps[gap - size] += 1
            standing[gap - size].append(at)
        sequence[i], offset[i] = at, capacity - gap
    return sequence, offset


def pack(found: DataFrame, capacity: int = 2048, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """A written table of pieces with ``row`` and ``length``, each with its ``sequence_id`` and ``offset``."""
    if taken := {"sequence_id", "offset", "_shard"} & set(found.columns):
        raise ValueError(f"columns {sorted(taken)} exist already")
    shards = max(1, -(-found.count() // shard_pieces))
    schema = StructType([*found.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("_shard")[0].as_py()
        table = table.drop_columns(["_shard"]).sort_by([("length", "descending"), ("row", "ascending")])
        sequence, offset = place(table.column("length").to_numpy(), capacity)
        return table.append_column("sequence_id", pa.array(sequence + (shard << 32))).append_column("offset", pa.array(offset))

    return found.withColumn("_shard", F.pmod(F.xxhash64("row"), F.lit(shards))).groupBy("_shard").applyInArrow(run, schema)


def packed(documents: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The pieces with their places, and the sequences: ``sequence_id``, ``token_ids`` and ``n_pieces``."""
    written = checkpointed(pieces(documents, tokenizer_file, capacity, end_id, id_col, text, ids=True).withColumn("row", F.monotonically_increasing_id()))
    placed = checkpointed(pack(written.drop("token_ids"), capacity))
    # a sequence gathers its own tokens, which are ``capacity`` at most
    held = placed.select("row", "sequence_id", "offset").join(written.select("row", "token_ids"), "row")
    sequences = held.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "token_ids"))).alias("held"))
    return placed.drop("row"), sequences.select("sequence_id", F.flatten("held.token_ids").alias("token_ids"), F.size("held").alias("n_pieces"))


def packing_digest(documents: DataFrame, tokenizer_file: str, capacity: int = 2048) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    written = checkpointed(pieces(rows, tokenizer_file, capacity).withColumn("row", F.monotonically_increasing_id()))
    return pack(written, capacity).select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")
