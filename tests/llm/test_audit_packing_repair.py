"""Source audit, packing and conversation repair against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import conversation_repair, packing, source_audit
from millrace.llm.conversation_repair import Node, letters
from millrace.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


# --- source audit


def audited(rows, min_docs, smoothing=5, top=50):
    """All of the audit, straight from its definition."""
    rows = [(a or "", b or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))) for a, b, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs, every, own = Counter(), Counter(), {r[1]: Counter() for r in rows if r[0] == lang}
        for r in rows:
            if r[0] == lang:
                docs.update(set(r[2]))
                every.update(r[2])
                own[r[1]].update(r[2])
        kept = [t for t in docs if docs[t] >= min_docs]
        share = lambda counts, total: {t: 1 + 1_000_000_000 * (counts[t] + smoothing) // (total + smoothing * len(kept)) for t in kept}
        p = {s: share(c, sum(c[t] for t in kept)) for s, c in own.items()}
        q = share(every, sum(every[t] for t in kept))
        for s in own:
            found = {"pair": [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s], "term": [(p[s][t] - q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]}
            for part, values in found.items():
                values.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(values) if part == "pair" or k < top]
    return sorted(out)


def corpus(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string").withColumns({c: F.lit(c) for c in ("term", "n", "p", "z", "value", "rank", "Row")})


@pytest.mark.parametrize("tree", [1, 60, 200_000])
def test_audit_brute(spark, monkeypatch, tree):
    monkeypatch.setattr(source_audit, "TREE_ITEMS", tree)
    r = random.Random(4)
    words = [f"w{chr(97 + i % 26)}{'é' * (i // 26)}" for i in range(80)]
    rows = []
    for i in range(400):
        s = r.choice("abcdefg")
        rows.append((r.choice(["en", "de", None, ""]), f"s{s}" if s != "g" else None, " ".join(r.choice(words[: 20 + 10 * (ord(s) - 97)]) for _ in range(r.choice([0, 1, 5, 40])))))
    rows += [("en", "only", None), ("xx", "one", "a b"), ("xx", "two", "ab A-B aB ab"), ("en", "sa", "Wa wA [wa] \x00wa " * 3000), rows[0], rows[0]]
    for min_docs in (1, 12, 1000):
        got = sorted(tuple(x) for x in source_audit.audit(corpus(spark, rows), min_docs=min_docs).collect())
        assert got == audited(rows, min_docs)


def test_audit_empty(spark):
    none = corpus(spark, [("a", "b", "c")]).limit(0)
    assert source_audit.audit(none).collect() == []
    assert source_audit.audit(corpus(spark, [(None, None, None)] * 3)).collect() == []


def test_audit_counts_in_parts(spark, monkeypatch):
    rows = [("en", f"s{i % 3}", f"a b c{chr(97 + i % 7)} a") for i in range(100)]
    docs = corpus(spark, rows).select("lang", "source", "text")
    want = sorted(tuple(r) for r in source_audit.term_counts(docs).collect())
    monkeypatch.setattr(source_audit, "HELD_TERMS", 3)
    assert sorted(tuple(r) for r in source_audit.term_counts(docs).collect()) == want


# --- packing

TEXTS = [None, "", " ", "One.", "a b c", "a b c", "  two  blanks\n\n and lines \n", "tab\t\there there   x", "x \x1c y\x00z", "end ", "\n\nstart", "don't we'll  I'm", "🙂 ß漢字 ١٢٣", "<|endoftext|> x", "word " * 9000, "ab" * 4000,
         "\r\n".join("one two" for _ in range(500)), " " * 5000, "\n" * 3000]


def reference():
    own = Tokenizer.from_file(FILE)
    own.encode_special_tokens = True
    return lambda t: [*own.encode(t or "", add_special_tokens=False).ids, 0]


def check_packed(rows, ids, capacity):
    """Pieces hold their document's ids, in order, and every sequence is filled from 0 without a gap."""
    for i, want in ids.items():
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            part = want[at : at + r["length"]]
            assert (r["piece"], r["start"], r["length"]) == (k, at, len(part)) and r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            assert r["length"] == capacity or k == 0
            at += r["length"]
        assert at == len(want) and (len(own) == 1) == (len(want) <= capacity)
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in held.values():
        found.sort()
        assert [o for o, _ in found] == [sum(n for _, n in found[:k]) for k in range(len(found))] and sum(n for _, n in found) <= capacity
    return len(held)


def test_packing_against_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(packing, "STEP_CHARS", 700)
    encode = reference()
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumns({"piece": F.lit(1), "row": F.lit("r"), "length": F.lit(None)})
    rows = packing.packing_digest(docs, FILE).collect()
    check_packed(rows, {i: encode(t) for i, t in enumerate(TEXTS)}, 2048)
    assert packing.packing_digest(docs.limit(0), FILE).collect() == []


def test_packing_repeats_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b")] * 50 + [(3, "c d e")] * 50, "doc_id long, text string")
    rows = packing.packing_digest(docs, FILE, capacity=9).collect()
    assert Counter(r["doc_id"] for r in rows) == {None: 50, 3: 50}
    assert check_packed(rows, {}, 9) == 25 + 17  # 4 + 4, 3 + 3 + 3


def sum_of_squares(sizes, capacity):
    """Each size where the squared counts become smallest, counted out in full."""
    counts, opened = Counter(), 0
    for s in sizes:
        tried = []
        for g in sorted(counts):
            if g >= s and counts[g]:
                after = counts.copy()
                after[g] -= 1
                if g > s:
                    after[g - s] += 1
                tried.append((sum(v * v for v in after.values()), g, after))
        if tried:
            counts = min(tried, key=lambda x: x[:2])[2]
        else:
            opened += 1
            if s < capacity:
                counts[capacity - s] += 1
    return opened


def test_packing_places(spark):
    r = random.Random(5)
    import numpy as np

    for sizes in ([r.randint(1, 40) for _ in range(300)], [7] * 50, [40, 39, 1, 40], [r.choice([13, 14, 27]) for _ in range(200)]):
        sizes.sort(reverse=True)
        sequence, offset = packing.place(np.array(sizes), 40)
        assert len(set(sequence.tolist())) == sum_of_squares(sizes, 40)
        ends = Counter()
        for s, at, o in zip(sizes, sequence.tolist(), offset.tolist()):
            assert ends[at] == o
            ends[at] += s
        assert max(ends.values()) <= 40


def test_packing_few_sequences(spark):
    rows = QUERIES["op12_sum_of_squares_packing"](spark, "/root/testdata/sf0.01").collect()
    used = check_packed(rows, {}, 2048)
    assert used <= 1.01 * sum(r["length"] for r in rows) / 2048 + 1


def test_packing_shards_and_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 40)
    encode = reference()
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    placed, sequences = packing.packed(spark.read.parquet(f"{SMALL}/documents.parquet"), FILE, capacity=512)
    rows = placed.collect()
    ids = {i: encode(t) for i, t in given.items()}
    check_packed(rows, ids, 512)
    held = {r["sequence_id"]: list(r["token_ids"]) for r in sequences.collect()}
    for r in rows:
        assert held[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
    assert sum(map(len, held.values())) == sum(map(len, ids.values()))


# --- conversation repair


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        way = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if way == 1:
            text = ""
        if way == 2:
            text = re.sub("[.!?]", "", text)
        if way == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    return out


def best_edits(rows):
    """The least (cost, audit, lines) over all edits; rows are (role, text, fault)."""
    found = []

    def tried(i, state, cost, audit, lines, inserted):
        if found and cost > found[0][0]:
            return
        if i == len(rows) and state in "EA":
            found.append((cost, audit, lines))
            found.sort(key=lambda x: x[:2])
            del found[1:]
        into = {"E": "u", "S": "u", "U": "a", "A": "u"}[state]
        name = {"u": "user", "a": "assistant"}[into]
        if inserted < 2:
            tried(i, into.upper(), cost + 2, audit + "I", [*lines, f"{name}:"], inserted + 1)
        if i == len(rows):
            return
        role, text, fault = rows[i]
        tried(i + 1, state, cost + 3, audit + "D", lines, 0)
        if fault in ("blank", "duplicate"):
            return
        extra = fault == "truncated"
        if role[:1] == into or role[:1] == "s" and state == "E":
            tried(i + 1, role[:1].upper(), cost + extra, audit + "K", [*lines, f"{role}:{text}"], 0)
        tried(i + 1, into.upper(), cost + 2 + extra, audit + "R", [*lines, f"{name}:{text}"], 0)

    tried(0, "E", 0, "", [], 0)
    return found[0]


def repaired(given):
    out = {}
    after = damaged(given)
    for conv in {r[0] for r in given}:
        rows = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in rows:
            shown = text.strip(BLANK)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in rows if r[1] is not None]
        cost, audit, lines = best_edits([(r[2], r[3], f) for r, f in zip(rows, faults)])
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(c) for c in ("kind", "audit", "slice", "digest", "way", "copy")})


def random_rows(r, count, longest):
    rows = []
    for c in range(count):
        for t in range(r.randint(1, longest)):
            turn = None if r.random() < 0.05 else t + (r.random() < 0.1)
            rows.append((c, turn, r.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "u2"]), r.choice(["One.", "Two!", "three", "Four? \t\n", "", None, " \x0b", "x ", "é.", "a\nb?\n"])))
    return rows


@pytest.mark.parametrize("slice_rows", [1, 3, 20_000])
def test_repair_brute(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(conversation_repair, "SLICE_ROWS", slice_rows)
    rows = random_rows(random.Random(slice_rows), 150, 6)
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (10**6, None, None, None), rows[0], rows[0], *((2000 + i, i, "user", "Drop?") for i in range(40))]
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.repair_digest(conversations(spark, rows)).collect()}
    assert got == repaired(rows)


def test_repair_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, SMALL).collect()}
    assert got == repaired(rows) and len(got) > 15


def test_repair_empty_and_long(spark, monkeypatch):
    none = conversations(spark, [(1, 1, "user", "x")]).limit(0)
    assert conversation_repair.repair_digest(none).collect() == []
    rows = [(1, t, "user" if t % 2 else "assistant", f"Text {t} " * 2000) for t in range(300)]
    whole = conversation_repair.repair_digest(conversations(spark, rows)).collect()
    monkeypatch.setattr(conversation_repair, "SLICE_ROWS", 37)
    assert conversation_repair.repair_digest(conversations(spark, rows)).collect() == whole and len(whole) == 1


def test_repair_dropped_conversation(spark):
    ids = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = conversation_repair.repair_digest(conversations(spark, [(c, 0, "user", "Hi.") for c in ids])).collect()
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} and len(rows) == len(ids) > 5


@pytest.mark.parametrize("modulus", [1, 3, (1 << 61) - 1])
def test_audit_strings_compared(monkeypatch, modulus):
    """Even where all hashes collide."""
    monkeypatch.setattr(conversation_repair, "_MODULUS", modulus)
    r = random.Random(6)
    for _ in range(300):
        nodes = [None]
        for _ in range(60):
            nodes.append(Node(r.choice(nodes[-8:]), r.choice("DI")))
        texts = [letters(n) for n in nodes]
        for _ in range(60):
            i, j = r.randrange(61), r.randrange(61)
            assert conversation_repair.less(nodes[i], nodes[j]) == (texts[i] < texts[j])
        assert [letters(n) for n in nodes] == texts
