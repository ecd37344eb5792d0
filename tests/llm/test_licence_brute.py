"""The licence scan against a plain reading of its rules, word by word, over whole tables."""

import re

import pytest

from millrace.llm import license_rules as lr
from millrace.llm.queries import QUERIES

NOTICE = re.compile(f"{lr._OPENING}({'|'.join(sorted({n for _, _, names in lr.SHORT for n in names}, key=lambda n: (-len(n), n)))})( license)?")
BREAK, ENDS, GOES_ON = "break", "ends", "goes on"


def marks(gap, last):
    """What the characters between two words are: blanks, ends of sentences, line ends that end a line, and line ends within a sentence."""
    found = []
    gap = re.sub("\n(?=[(\"']|\\Z)" if not last else "\n(?=[(\"'])", "\x02", gap)  # directly followed by a word or an opening mark
    if not last:  # the last line end that only other marks follow
        gap = re.sub("\n[^\n\x02]*\\Z", "\x01", gap)
    gap = re.sub("[.!?;:]+[ \t\r\n\x01\x02]", "\n", gap)
    for c in gap:
        if c in "\n\x01\x02":
            found.append({"\n": BREAK, "\x01": ENDS, "\x02": GOES_ON}[c])
        elif not found or found[-1] != " ":
            found.append(" ")
    return found


def scanned(text):
    text = (text or "").lower().translate(dict.fromkeys(range(1, 5), 5))
    places = [m.span() for m in re.finditer("[a-z0-9]+", text)]
    words = [text[a:b] for a, b in places]
    edges = [0, *(x for p in places for x in p), len(text)]
    gaps = [marks(text[a:b], i == len(words)) for i, (a, b) in enumerate(zip(edges[::2], edges[1::2]))]
    sentence = [0]
    for g in gaps[1 : len(words)]:
        sentence.append(sentence[-1] + (BREAK in g or ENDS in g))
    # before a word and behind one, only a single blank may stand between it and the mark
    begins = lambda i: (g := gaps[i]) is not None and ((i == 0 and g in ([], [" "])) or (g[-1:] != [] and g[-1] != " ") or (len(g) > 1 and g[-2] != " "))
    stops = lambda j: (g := gaps[j]) is not None and ((j == len(words) and g in ([], [" "])) or (g[:1] != [] and g[0] != " ") or (len(g) > 1 and g[1] != " "))
    within = lambda i, j: all(BREAK not in g for g in gaps[i + 1 : j])
    known = sorted(((s.split(" "), name) for name, s in lr._ALL.items()), key=lambda x: (-len(" ".join(x[0])), " ".join(x[0])))
    names = {s: name for name, s in lr._ALL.items()}
    found, i = [], 0
    while i < len(words):
        hit = None
        if begins(i):
            for s, name in known:
                if words[i : i + len(s)] == s and within(i, i + len(s)) and stops(i + len(s)):
                    hit = (names[" ".join(s)], i + len(s))
                    break
            for j in range(min(len(words), i + 30), i, -1) if hit is None else ():
                if within(i, j) and stops(j) and (m := NOTICE.fullmatch(" ".join(words[i:j]))):
                    called = {n: name for name, _, all_ in lr.SHORT for n in all_}
                    hit = (called.get(m[1] + (m[2] or "")) or called[m[1]], j)
                    break
        if hit:
            found.append((sentence[i] + 1, hit[0]))
            i = hit[1]
        else:
            i += 1
    path = "".join(f"<{n}>" for _, n in found)
    licences = set()
    rules = [(licence, "".join(f"<{n}>" for n in names)) for licence, names in lr.RULES + lr.MORE_RULES]
    for licence, own in rules:
        if path.count(own) > sum(path.count(p) for p in {p for _, p in rules if own in p and p != own}):
            licences.add(licence)
    return (sentence[-1] + 1 if words else 0, ",".join(f"{p}:{n}" for p, n in found), ",".join(sorted(licences)))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_licences_brute(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["n_sentences"], r["found"], r["licences"]) for r in QUERIES["op2_license_sentence_rules"](spark, folder).collect()}
    bad = [(i, got[i], scanned(t)) for i, t in texts.items() if got[i] != scanned(t)]
    assert not bad, bad[:3]
    assert sum(x[2] != "" for x in got.values()) >= 3


def test_licences_brute_made_up(spark):
    import random

    r = random.Random(8)
    parts = ["licensed under the mit license", "Released under\nthe MIT License.", "SPDX-License-Identifier: ", "Apache-2.0", "MIT", "GPL-3.0-only\n", "foo", "bar. ", "\n", "\n\n", " * ", "# ", "(", "; ", "This program is free software", "\t",
             " ".join(lr.SENTENCES["bsd-grant"].split()), ":\n", lr.SENTENCES["bsd-source"], ".\n", lr.SENTENCES["bsd-binary"], "the project is distributed under the terms of the ISC license", "\x01", "é", "!", " -- "]
    texts = ["".join(r.choice(parts) + r.choice(["", " ", "\n"]) for _ in range(r.randint(1, 12))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: (x["n_sentences"], x["found"], x["licences"]) for x in lr.licence_digest(docs).collect()}
    bad = [(t, got[i], scanned(t)) for i, t in enumerate(texts) if got[i] != scanned(t)]
    assert not bad, (len(bad), bad[:3])
