"""Byte-level BPE, encoded and decoded by recursive DuckDB queries inside the tasks.

A task splits its texts by the tokenizer's pattern and sends the distinct words it has not met yet to a DuckDB database in
its own process. There a recursive query starts from one row per word and byte, joins neighbouring tokens with the merge
table, and contracts each word's leftmost pair of least rank until no pair is left; ordered aggregation turns the rows
into id lists and, over the token table, back into bytes. The worker keeps words it has met (``KEPT_WORDS`` at most).

One step may contract all equal pairs of a word at once where that is the same as one by one from the left: always, but for
tokens that begin or end a token of lower rank, which could come first. A word that is a token as a whole is that token.

Words beyond ``LONGEST_WORD`` bytes go through the same recursion in overlapping pieces. A row of tokens is what the merges
make of its bytes exactly when this holds for each two neighbours of it, as the first merge across an end would also take
place between these two alone. So two pieces that have a token in common are put together there. Where they have none, the
later piece begins anew at the end of a token, and grows until they do.

All work on a text happens in the task that reads it, so there is no shuffle and no hot key. The rank file (below 1 MB) is
read on the driver and sent with the function.

Defined results
    * a null or empty text has no tokens, the digest of the empty string, and decodes to no bytes;
    * rows are encoded one by one: repeated rows give repeated results, a null id stays null, no rows give no rows;
    * other columns are carried along untouched; columns of the added names are an error;
    * a very long text is split in steps of ``STEP_WORDS`` words.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from millrace.llm import bytescan

#: words of each of the two generations that a worker keeps (about 350 bytes a word)
KEPT_WORDS = 250_000
LONG_WORD = 64
#: Words of more bytes are contracted in pieces: a step of the recursion reads the whole word, and they need one for each distinct pair.
LONGEST_WORD = 4096
#: bytes of such a piece, and how many of them the next one has too (pieces begin at multiples of 64, as do long tokens of one letter)
PIECE, SHARED = 96, 32
#: rows that the recursion over pieces makes in one query, about
PIECE_ROWS = 2_000_000
#: ids that one query decodes
DECODED_IDS = 500_000
#: words that one DuckDB query encodes; it holds the rows of all its steps, about 2.5 kB a word
QUERY_WORDS = 30_000
STEP_WORDS = 200_000
#: texts of a task that are split at once
STEP_CHARS = 2_000_000

#: Words of at most LONG_WORD bytes: a row knows its token and the next one, and one pair of each word is contracted in a step.
#: The row behind the pair lives on as the merged token, so the rows before it only change what comes next.
_SHORT = """
WITH RECURSIVE state(word, pos, nxt_pos, tok, nxt, live) AS (
  SELECT word, pos, pos + 1::INTEGER, tok, nxt, true FROM short
  UNION ALL
  (WITH cur AS (SELECT * FROM state WHERE live),
   least AS (
     SELECT word, min((merged << 40) | (pos::BIGINT << 20) | (nxt_pos - pos)) AS v FROM cur JOIN merges ON pair = ((tok::BIGINT << 20) | nxt) WHERE nxt >= 0 GROUP BY word),
   best AS (SELECT word, (v >> 40)::INTEGER AS merged, ((v >> 20) & 1048575)::INTEGER AS pos, (((v >> 20) & 1048575) + (v & 1048575))::INTEGER AS nxt_pos FROM least)
   SELECT s.word, s.pos, CASE WHEN s.nxt_pos = b.pos THEN b.nxt_pos ELSE s.nxt_pos END,
     CASE WHEN s.pos = b.nxt_pos THEN b.merged ELSE s.tok END, CASE WHEN s.nxt_pos = b.pos THEN b.merged ELSE s.nxt END, b.word IS NOT NULL
   FROM cur s LEFT JOIN best b ON s.word = b.word WHERE b.word IS NULL OR s.pos <> b.pos))
"""

#: Longer words: all pairs of the least rank at once, where that is the same as one by one from the left.
_LONG = """
WITH RECURSIVE state(word, pos, tok, live) AS (
  SELECT word, pos, tok, true FROM long
  UNION ALL
  (WITH pairs AS (
     SELECT word, pos, tok, lead(tok) OVER w AS nxt, lead(pos) OVER w AS nxt_pos, row_number() OVER w AS i
     FROM state WHERE live WINDOW w AS (PARTITION BY word ORDER BY pos)),
   ranked AS (SELECT p.word, p.pos, p.nxt_pos, p.i, m.merged FROM pairs p JOIN merges m ON m.pair = ((p.tok::BIGINT << 20) | p.nxt)),
   best AS (SELECT word, min(merged) AS merged, arg_min(pos, (merged, pos)) AS pos FROM ranked GROUP BY word),
   hits AS (
     SELECT r.word, r.pos, r.nxt_pos, r.merged, r.pos = b.pos AS leftmost, r.i - row_number() OVER (PARTITION BY r.word ORDER BY r.pos) AS run
     FROM ranked r JOIN best b ON r.word = b.word AND r.merged = b.merged),
   chosen AS (
     SELECT word, pos, nxt_pos, merged FROM (SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY pos) AS in_run FROM hits)
     WHERE leftmost OR (in_run % 2 = 1 AND merged NOT IN (SELECT id FROM late)))
   SELECT p.word, p.pos, coalesce(c.merged, p.tok)::INTEGER, b.word IS NOT NULL
   FROM pairs p LEFT JOIN best b ON p.word = b.word LEFT JOIN chosen c ON p.word = c.word AND p.pos = c.pos
   ANTI JOIN chosen gone ON p.word = gone.word AND p.pos = gone.nxt_pos))
"""

_RESULT = """
SELECT word, list_sort(list((pos::BIGINT << 20) | tok)) AS ids, string_agg(hex, '' ORDER BY pos) AS bytes
FROM {state} JOIN tokens ON id = tok GROUP BY word
"""

_DECODE = "SELECT doc, string_agg(hex, '' ORDER BY pos) AS bytes FROM ids JOIN tokens ON id = tok GROUP BY doc"


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Tokenizer:
    """A rank file in a DuckDB database of this process, and the words met so far."""

    def __init__(self, ranks: bytes, pattern: str, kept_words: int = KEPT_WORDS):
        import duckdb
        import regex

        self.pattern, self.kept_words = regex.compile(pattern), kept_words
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte_ids < 0).any():
            raise ValueError("the rank file lacks single bytes")
        splits = [(l, r, m) for t, m in self.ranks.items() for c in range(1, len(t)) if (l := self.ranks.get(t[:c])) is not None and (r := self.ranks.get(t[c:])) is not None]
        merges = np.array(splits, np.int64).reshape(-1, 3)
        late = {p for t, m in self.ranks.items() for c in range(1, len(t)) for p in (self.ranks.get(t[:c], -1), self.ranks.get(t[c:], -1)) if p > m}
        self.sizes = np.zeros(1 + max(self.ranks.values()), np.int64)
        self.sizes[list(self.ranks.values())] = [len(t) for t in self.ranks]
        self._table("merges", {"pair": (merges[:, 0] << 20) | merges[:, 1], "merged": merges[:, 2]})
        self._table("late", {"id": np.array(sorted(late), np.int64)})
        self._table("tokens", {"id": np.fromiter(self.ranks.values(), np.int32), "hex": [t.hex() for t in self.ranks]})
        #: word -> number of ids, ids in decimal joined by commas, ids as 4-byte integers, decoded bytes
        self.words: dict[str, tuple[int, bytes, bytes, bytes]] = {}
        self.older: dict[str, tuple[int, bytes, bytes, bytes]] = {}

    def _table(self, name: str, columns: dict) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def learn(self, words: set[str]) -> None:
        """Afterwards all of these words are in ``self.words``."""
        missing = words - self.words.keys()
        if len(self.words) + len(missing) > self.kept_words:
            self.words, self.older = {}, self.words
            missing = words
        self.words.update({w: self.older[w] for w in missing & self.older.keys()})
        new = list(missing - self.older.keys())
        for at in range(0, len(new), QUERY_WORDS):
            self._encode(new[at : at + QUERY_WORDS])

    def _encode(self, new: list[str]) -> None:
        coded = [w.encode("utf-8", "surrogatepass") for w in new]
        known = [(i, id_) for i, c in enumerate(coded) if (id_ := self.ranks.get(c)) is not None]
        self._table("known", {"word": pa.array([i for i, _ in known], pa.int32()), "tok": pa.array([t for _, t in known], pa.int32())})
        self._keep(new, _RESULT.format(state="(SELECT word, 0 AS pos, tok FROM known)"))
        for name, sql, wanted in (("short", _SHORT, lambda c: len(c) <= LONG_WORD), ("long", _LONG, lambda c: LONG_WORD < len(c) <= LONGEST_WORD)):
            left = [i for i, c in enumerate(coded) if wanted(c) and c not in self.ranks]
            if left:
                self._lay(name, left, [coded[i] for i in left])
                self._keep(new, sql + _RESULT.format(state="(SELECT * FROM state WHERE NOT live)"))
        for word, c in zip(new, coded):
            if max(LONG_WORD, LONGEST_WORD) < len(c) and c not in self.ranks:
                ids = self._long_word(c)
                cut = range(0, len(ids), DECODED_IDS)
                decoded = b"".join(self.decode(pa.array([ids[at : at + DECODED_IDS]], pa.list_(pa.int32())))[0] for at in cut)
                self.words[word] = (len(ids), ",".join(map(str, ids)).encode(), np.array(ids, "<i4").tobytes(), decoded)

    def _lay(self, name: str, numbers: list[int], coded: list[bytes]) -> None:
        """The table that a recursion begins with: the bytes of these words, by the words' numbers."""
        sizes = np.array([len(c) for c in coded], np.int64)
        tok = self.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
        ends = np.cumsum(sizes)
        nxt = np.append(tok[1:], -1)
        nxt[ends - 1] = -1
        self._table(name, {"word": np.repeat(np.array(numbers, np.int32), sizes), "pos": (np.arange(len(tok)) - np.repeat(ends - sizes, sizes)).astype(np.int32), "tok": tok.astype(np.int32), "nxt": nxt.astype(np.int32)})

    def _contracted(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each of these pieces of words by the recursive queries, also where a piece is a token as a whole."""
        found: list[np.ndarray] = [np.empty(0, np.int64)] * len(pieces)
        for name, sql, short in (("short", _SHORT, True), ("long", _LONG, False)):
            left = [i for i, c in enumerate(pieces) if (len(c) <= PIECE) == short]
            share = np.cumsum([len(pieces[i]) ** 2 // 2 for i in left]) // PIECE_ROWS
            for k in range(share[-1] + 1 if left else 0):
                if some := left[np.searchsorted(share, k) : np.searchsorted(share, k, "right")]:
                    self._lay(name, some, [pieces[i] for i in some])
                    rows = self.con.sql(f"{sql} SELECT word, list_sort(list((pos::BIGINT << 20) | tok)) AS ids FROM state WHERE NOT live GROUP BY word").to_arrow_table()
                    lists = rows["ids"].combine_chunks()
                    ids, ends = lists.flatten().to_numpy() & 1048575, np.cumsum(lists.value_lengths().to_numpy())
                    for i, part in zip(rows["word"].to_pylist(), np.split(ids, ends[:-1]), strict=True):
                        found[i] = part
        return found

    def _long_word(self, word: bytes) -> list[int]:
        """The ids of a very long word, put together from those of its pieces."""
        step = PIECE - SHARED
        ready = dict(zip(range(0, len(word), step), self._contracted([word[at : at + PIECE] for at in range(0, len(word), step)])))
        ids = ready[0].tolist()
        ends = np.cumsum(self.sizes[ready[0]]).tolist()

        def joined(begin: int, part: np.ndarray) -> bool:
            """Go on with this piece from a token that both have; False if they have none."""
            till = (begin + np.cumsum(self.sizes[part])).tolist()
            known = {ends[k - 1]: k for k in range(max(1, bisect_left(ends, begin)), len(ids))}
            for at, (low, high) in enumerate(zip([begin, *till], till)):
                k = known.get(low)
                if k is not None and ends[k] == high:
                    ids[k:], ends[k:] = part[at:].tolist(), till[at:]
                    return True
            return False

        size = PIECE
        while ends[-1] < len(word):
            begin = (ends[-1] - SHARED) // step * step
            if joined(begin, ready[begin]):
                size = PIECE
                continue
            # pieces in a row that agree with none before: longer ones
            size = min(2 * size, max(PIECE, LONGEST_WORD))
            while True:
                at = bisect_right(ends, ends[-1] - size // 2)
                begin = ends[at - 1] if at else 0
                part = self._contracted([word[begin : ends[-1] + size // 2]])[0]
                if begin == 0:
                    ids, ends = part.tolist(), np.cumsum(self.sizes[part]).tolist()
                    break
                if joined(begin, part):
                    break
                size *= 2
        return ids

    def _keep(self, new: list[str], sql: str) -> None:
        found = self.con.sql(sql).to_arrow_table()
        if not len(found):
            return
        lists = found["ids"].combine_chunks()
        flat = (lists.flatten().to_numpy() & 1048575).astype("<i4")
        ends = np.cumsum(lists.value_lengths().to_numpy()).tolist()
        decimal, packed, begin = list(map(str, flat.tolist())), flat.tobytes(), 0
        for word, end, hexed in zip(found["word"].to_pylist(), ends, found["bytes"].to_pylist(), strict=True):
            self.words[new[word]] = (end - begin, ",".join(decimal[begin:end]).encode(), packed[4 * begin : 4 * end], bytes.fromhex(hexed))
            begin = end

    def rest(self) -> None:
        """Give back what the next task can do without; a worker may wait long for it."""
        self.older = {}
        for name in ("known", "short", "long"):
            self.con.execute(f"DROP TABLE IF EXISTS {name}")
        bytescan.rest()

    def split(self, text: str) -> Iterator[list[str]]:
        if len(text) <= STEP_CHARS:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, STEP_WORDS)):
            yield part

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, str, bytes, str]]:
        """For each text: number of ids, digest of the decimal ids, the ids as 4-byte integers, digest of the decoded bytes."""
        short = [self.pattern.findall(t) if t and len(t) <= STEP_CHARS else None for t in texts]
        self.learn(set().union(*(words for words in short if words)))
        for text, words in zip(texts, short, strict=True):
            count, digest, packed, decoded = 0, hashlib.sha256(), [], hashlib.sha256()
            for part in [words] if words is not None else self.split(text or ""):
                if words is None:
                    self.learn(set(part))
                entries = [self.words[w] for w in part]
                if count and entries:
                    digest.update(b",")
                count += sum([e[0] for e in entries])
                digest.update(b",".join([e[1] for e in entries]))
                packed += [e[2] for e in entries]
                decoded.update(b"".join([e[3] for e in entries]))
            yield count, digest.hexdigest(), b"".join(packed), decoded.hexdigest()

    def decode(self, column: pa.ListArray) -> list[bytes | None]:
        """The bytes of each list of ids; null for null."""
        sizes = column.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        flat = column.flatten().to_numpy().astype(np.int32)
        if bad := set(np.unique(flat).tolist()) - set(self.ranks.values()):
            raise ValueError(f"ids {sorted(bad)[:5]} are not in the rank file")
        self._table("ids", {"doc": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), "pos": np.arange(len(flat), dtype=np.int64), "tok": flat})
        found = dict(self.con.execute(_DECODE).fetchall())
        return [None if not v else bytes.fromhex(found.get(i, "")) for i, v in enumerate(column.is_valid().to_pylist())]


_tokenizers: dict[tuple[str, str, int], Tokenizer] = {}


def tokenizer(ranks: bytes, pattern: str, kept_words: int = KEPT_WORDS) -> Tokenizer:
    """The worker's own tokenizer for these ranks; it lives on for later tasks."""
    key = (hashlib.sha256(ranks).hexdigest(), pattern, kept_words)
    if key not in _tokenizers:
        _tokenizers[key] = Tokenizer(ranks, pattern, kept_words)
    return _tokenizers[key]


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: bool = True, digests: bool = False, kept_words: int = KEPT_WORDS) -> DataFrame:
    """``df`` with ``n_tokens`` and, as asked, ``token_ids`` and the two digests ``ids_sha256`` and ``decoded_sha256``.

    ``kept_words`` trades a worker's memory against words that are encoded again; it changes no result.
    """
    ranks = read_ranks(rank_file)
    added = [StructField("n_tokens", LongType())]
    added += [StructField("token_ids", ArrayType(IntegerType(), False))] * ids
    added += [StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())] * digests
    if taken := {f.name for f in added} & set(df.columns):
        raise ValueError(f"columns {sorted(taken)} exist already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(ranks, pattern, kept_words)
        for batch in batches:
            for part, _, _ in bytescan.steps(batch, text, min(STEP_CHARS, 25 * kept_words)):
                found = list(own.encode(part.column(part.schema.get_field_index(text)).to_pylist()))
                columns = [pa.array([f[0] for f in found], pa.int64())]
                if ids:
                    sizes = np.array([0, *(f[0] for f in found)])
                    flat = np.frombuffer(b"".join(f[2] for f in found), "<i4")
                    columns.append(pa.ListArray.from_arrays(np.cumsum(sizes).astype(np.int32), flat))
                if digests:
                    columns += [pa.array([f[1] for f in found]), pa.array([f[3] for f in found])]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *(f.name for f in added)])
        own.rest()

    return df.mapInArrow(run, StructType([*df.schema.fields, *added]))


def decode(df: DataFrame, rank_file: str, pattern: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for; null for null, empty for no ids."""
    ranks = read_ranks(rank_file)
    schema = StructType.fromJson(df.schema.jsonValue()).add(into, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                column = part.column(part.schema.get_field_index(ids))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own.decode(column), pa.binary())], names=[*part.schema.names, into])

    return df.mapInArrow(run, schema)


def token_digests(documents: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return encode(rows, rank_file, pattern, ids=False, digests=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
