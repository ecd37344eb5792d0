"""The cheapest edits that turn a conversation into ``system? (user assistant)+`` or nothing, and the least audit string.

Each row is kept, given another role or deleted, and empty rows may be inserted; the initials of the edits, in order, are the
audit. Of the cheapest audits the one that is least in ASCII is wanted. That is a path through four states (nothing yet,
after system, after user, after assistant), row by row; each state holds its cheapest cost and least audit so far.

Audits share their beginnings, so an audit is a linked node: its letter, its parent, its ancestors at distances 1, 2, 4 and so
on, and a rolling hash of all letters up to it. Two audits of the same cost are compared by a search for their longest common
prefix: both go up by the longest distances whose ancestors differ in hash, until their parents agree. What the hashes say to
be equal is then verified letter by letter, up to the node that both share. (At the same row and cost no audit is the
beginning of another, as each further insertion costs; so keeping the least one per state is enough.)

A conversation of any length is cut into slices of ``SLICE_ROWS`` rows, laid out evenly over the tasks. A slice gives the
cheapest way from each state to each other one; the ways are put together in the order of the slices. Rows travel without
their texts until the audit is known; then the texts of a conversation, sorted behind its audit, are streamed through the
digest, which is sequential by nature: the task holds the audit, which is one cell of the result, and a batch of rows.

Defined results
    * the order within a conversation is turn (nulls first), role, SHA-256 of the text; repeated rows stand next to each other,
      and all but the first are duplicates;
    * a null role or text is one blank, so the text is blank and the role none of the three; an empty role is like it;
    * null conversation ids are one conversation; no rows give no rows; other columns are not read;
    * a role is known by its first character alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.windows import running
from millrace.session import checkpointed

SLICE_ROWS = 20_000
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
_MODULUS, _BASE = (1 << 61) - 1, 0x5DEECE66D1CE4E5

#: a character that is not blank; an end mark, behind which blanks alone follow
_SEEN, _ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


class Node:
    """The last letter of an audit; everything before it is shared with other audits."""

    __slots__ = ("letter", "length", "hash", "up")

    def __init__(self, parent: Node | None, letter: str):
        self.letter = letter
        self.length = parent.length + 1 if parent else 1
        self.hash = ((parent.hash if parent else 0) * _BASE + ord(letter)) % _MODULUS
        up = [parent] if parent else []
        while up and (k := len(up)) and len(up[-1].up) >= k:
            up.append(up[-1].up[k - 1])
        #: ancestors at distances 1, 2, 4, ...
        self.up = up

    def parent(self) -> Node | None:
        return self.up[0] if self.up else None


def at_length(node: Node, length: int) -> Node:
    """The ancestor that ends the first ``length`` letters, at least one."""
    while node.length > length:
        node = node.up[(node.length - length).bit_length() - 1]
    return node


def letters(node: Node | None) -> str:
    found = []
    while node:
        found.append(node.letter)
        node = node.parent()
    return "".join(reversed(found))


def _verified(a: Node | None, b: Node | None) -> tuple[Node, Node] | None:
    """The first place where two audits of one length differ although their hashes agree, or None if there is none."""
    differing = None
    while a is not b:
        if a.letter != b.letter:
            differing = a, b
        a, b = a.parent(), b.parent()
    return differing


def less(a: Node | None, b: Node | None) -> bool:
    """Whether audit a comes before audit b in ASCII."""
    if a is b or b is None:
        return False
    if a is None:
        return True
    short = min(a.length, b.length)
    x, y = at_length(a, short), at_length(b, short)
    if x.hash == y.hash:
        found = _verified(x, y)
        return found[0].letter < found[1].letter if found else a.length < b.length
    for k in range(max(len(x.up), 1) - 1, -1, -1):
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    found = _verified(x.parent(), y.parent())  # the parents' hashes agree
    if found:
        return found[0].letter < found[1].letter
    if x.up:
        x.up[0] = y.up[0]  # the same letters: share them, so that no later search verifies them again
    return x.letter < y.letter


Way = tuple[int, "Node | None"]


def better(ways: list[tuple[Way, int, str]]) -> Way | None:
    """The cheapest of some ways, each with one more edit of a cost; ties by the least audit. An empty letter is no edit."""
    best = None
    for (cost, node), more, letter in ways:
        cost += more
        if best is not None and cost > best[0]:
            continue
        found = Node(node, letter) if letter else node
        if best is None or cost < best[0] or less(found, best[1]):
            best = cost, found
    return best


def inserted(ways: list[Way | None]) -> list[Way | None]:
    """The ways after any insertions, of which more than two in a row never pay."""
    ways = list(ways)
    into_user = [(w, INSERT_COST, INSERT) for s in (NOTHING, SYSTEM, ASSISTANT) if (w := ways[s])]
    ways[USER] = better(into_user + ([(ways[USER], 0, "")] if ways[USER] else []))
    if ways[USER]:
        ways[ASSISTANT] = better([(ways[USER], INSERT_COST, INSERT)] + ([(ways[ASSISTANT], 0, "")] if ways[ASSISTANT] else []))
    return ways


def stepped(ways: list[Way | None], initial: str, fault: str) -> list[Way | None]:
    """The ways behind one more row."""
    ways = inserted(ways)
    more: list[list[tuple[Way, int, str]]] = [[(w, DELETE_COST, DELETE)] if w else [] for w in ways]
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED_COST * (fault == "truncated")
        if initial == "s" and ways[NOTHING]:
            more[SYSTEM].append((ways[NOTHING], extra, KEEP))
        for into, own, before in ((USER, "u", (NOTHING, SYSTEM, ASSISTANT)), (ASSISTANT, "a", (USER,))):
            cost, letter = (extra, KEEP) if initial == own else (extra + REROLE_COST, REROLE)
            more[into] += [(ways[s], cost, letter) for s in before if ways[s]]
    return [better(m) if m else None for m in more]


class Slice:
    """The cheapest ways through some rows of a conversation, from each state they may be entered in."""

    def __init__(self, first: bool):
        self.ways = {entry: [(0, None) if s == entry else None for s in range(4)] for entry in ([NOTHING] if first else range(4))}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, row: dict) -> None:
        turn, initial, fault = row["turn"], row["initial"], row["fault"]
        self.ways = {entry: stepped(ways, initial, fault) for entry, ways in self.ways.items()}
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        self.illegal += self.last is not None and self.last + initial not in ("su", "ua", "au")
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def row(self) -> dict:
        ways = [{"entry": e, "exit": x, "cost": w[0], "audit": letters(w[1])} for e, all_ in self.ways.items() for x, w in enumerate(all_) if w]
        return {k: getattr(self, k) for k in ("blank", "duplicate", "truncated", "illegal", "turns", "first", "last", "low", "high")} | {"ways": ways}


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SLICE = "blank long, duplicate long, truncated long, illegal long, turns long, first string, last string, low long, high long, ways array<struct<entry:int,exit:int,cost:long,audit:string>>"
_CONVERSATION = ", ".join(f"{name} long" for name in FIGURES) + ", audit string"
_WAY = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<struct<entry:int,exit:int,cost:bigint,audit:string>>": _WAY}


class Joined:
    """The slices of a conversation, one after the other; audits are linked parts, one for each slice."""

    def __init__(self):
        self.ways: list[tuple[int, tuple | None] | None] = [(0, None), None, None, None]
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last = self.low = self.high = None

    @staticmethod
    def audit(part: tuple | None, until: tuple | None = None) -> str:
        found = []
        while part is not until:
            part, text = part
            found.append(text)
        return "".join(reversed(found))

    def less(self, a: tuple, b: tuple) -> bool:
        x, y = a, b
        while x is not y:  # both have a part for each slice
            x, y = x[0], y[0]
        return self.audit(a, x) < self.audit(b, x)

    def add(self, s: dict) -> None:
        ways = [None] * 4
        for way in s["ways"]:
            if self.ways[way["entry"]] is None:
                continue
            cost, part = self.ways[way["entry"]]
            found, into = (cost + way["cost"], (part, way["audit"])), way["exit"]
            if ways[into] is None or found[0] < ways[into][0] or found[0] == ways[into][0] and self.less(found[1], ways[into][1]):
                ways[into] = found
        self.ways = ways
        for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, k, getattr(self, k) + s[k])
        if s["first"] is not None:
            self.illegal += self.last is not None and self.last + s["first"] not in ("su", "ua", "au")
            self.last = s["last"]
        if s["low"] is not None:
            self.turns -= s["low"] == self.high
            self.low, self.high = s["low"] if self.low is None else self.low, s["high"]

    def row(self) -> dict:
        ends = Slice(False)
        ends.ways = {}
        for state in (NOTHING, SYSTEM, USER, ASSISTANT):
            ways = inserted([(0, None) if s == state else None for s in range(4)])
            ends.ways[state] = [ways[NOTHING], None, None, ways[ASSISTANT]]  # what may stand at the end
        self.add(ends.row())
        found = [w for w in (self.ways[NOTHING], self.ways[ASSISTANT]) if w]
        cost, part = found[0]
        if len(found) == 2 and (found[1][0] < cost or found[1][0] == cost and self.less(found[1][1], part)):
            cost, part = found[1]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": self.audit(part)}


class Repaired:
    """The rows of a conversation, behind its audit, on their way through the digest."""

    def __init__(self):
        self.found, self.digest, self.at, self.lines, self.next = dict.fromkeys(FIGURES, 0) | {"audit": ""}, hashlib.sha256(), 0, 0, "user"

    def line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def turn(self, own: str | None, text: str) -> None:
        self.line(own or self.next, text)
        self.next = "assistant" if self.next == "user" else "user"

    def insertions(self) -> None:
        audit = self.found["audit"]
        while self.at < len(audit) and audit[self.at] == INSERT:
            self.turn(None, "")
            self.at += 1

    def add(self, row: dict) -> None:
        if row["kind"] == 1:
            self.found = {k: row[k] for k in self.found}
        elif row["kind"] == 2:
            self.insertions()
            edit = self.found["audit"][self.at]
            self.at += 1
            if edit == KEEP and row["role"].startswith("s"):
                self.line(row["role"], row["text"])
            elif edit != DELETE:
                self.turn(row["role"] if edit == KEEP else None, row["text"])

    def row(self) -> dict:
        self.insertions()
        return self.found | {"repaired_sha256": self.digest.hexdigest()}


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with null role and text as one blank, damaged by the checksum of their key: some dropped, emptied, robbed of end marks, repeated, or said by the user."""
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("way"))
    return rows.where("way <> 0").select(
        "conv_id", "turn",
        F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("way") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _streamed(df: DataFrame, by: list[str], order: list[str], make, ddl: str) -> DataFrame:
    """One row of ``make(key)`` per run of rows that agree in ``by``; these lie together and in order within a task."""
    schema = StructType([*(df.schema[c] for c in by), *StructType.fromDDL(ddl).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([(f.name, ARROW[f.dataType.simpleString()]) for f in schema.fields])
        key, state = None, None
        for batch in batches:
            ready = []
            for row in batch.to_pylist():
                own = tuple(row[c] for c in by)
                if state is None or own != key:
                    if state is not None:
                        ready.append(dict(zip(by, key)) | state.row())
                    key, state = own, make(own)
                state.add(row)
            if ready:
                yield pa.RecordBatch.from_pylist(ready, schema=arrow)
        if state is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(by, key)) | state.row()], schema=arrow)

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def repair(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per id of ``ids`` (a distinct ``conv_id`` each): the figures, the audit and the digest of the repaired rows.

    ``rows`` has ``conv_id`` and ``turn`` of integer types, and ``role`` and ``text`` that are not null.
    """
    text = F.col("text")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", F.unhex(F.sha2(text, 256)).alias("digest"))
    light = rows.select(
        "conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"),
        F.when(~text.rlike(_SEEN), "blank").when(~text.rlike(_ENDED), "truncated").otherwise("").alias("fault"), F.monotonically_increasing_id().alias("row"))
    light = checkpointed(light)
    # the number of the row decides between repeated rows, so that a hot one can be cut too
    placed = running(light, ["conv_id"], ["turn", "role", "digest", "row"], position="place")
    seen = running(placed, ["conv_id", "role", "digest"], ["place"], position="nth")
    fault = F.when((F.col("nth") > 1) & (F.col("fault") != "blank"), "duplicate").otherwise(F.col("fault"))
    sliced = seen.select("conv_id", F.expr(f"(place - 1) div {SLICE_ROWS}").alias("slice"), "place", "turn", "initial", fault.alias("fault"))
    slices = _streamed(sliced, ["conv_id", "slice"], ["place"], lambda key: Slice(key[1] == 0), _SLICE)
    found = _streamed(slices, ["conv_id"], ["slice"], lambda key: Joined(), _CONVERSATION)
    # ids, then audits, then rows in order: the audit goes through the task once, not with each row
    marks = ids.select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(0).alias("kind"))
    parts = marks.unionByName(found.withColumn("kind", F.lit(1)), allowMissingColumns=True).unionByName(rows.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    return _streamed(parts, ["conv_id"], ["kind", "turn", "role", "digest"], lambda key: Repaired(), f"{_CONVERSATION}, repaired_sha256 string")


def repair_digest(conversations: DataFrame) -> DataFrame:
    return repair(damaged(conversations), conversations.select("conv_id").distinct())
