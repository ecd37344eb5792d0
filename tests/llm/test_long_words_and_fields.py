"""Very long words against the tokenizer's own library, and fields of records that pages try to break."""

import base64
import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken

from millrace.llm import byte_bpe, warc_derivatives

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_very_long_words(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(12)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(n)) for n in (4000, 4097, 30_000)] + ["a" * 9000, "ab" * 5001, "the" * 4000 + " end", "é" * 2049]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {x["doc_id"]: x for x in byte_bpe.encode(docs, RANKS, PATTERN, digests=True).collect()}
    for i, t in enumerate(texts):
        assert list(rows[i]["token_ids"]) == own.encode_ordinary(t)
        assert rows[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_a_word_of_a_megabyte_ends(spark):
    r = random.Random(13)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    began = time.time()
    row = byte_bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS, PATTERN, digests=True).first()
    assert time.time() - began < 120 and row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    by_id = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(RANKS, "rb"))}
    assert b"".join(by_id[i] for i in row["token_ids"]) == text.encode()


@pytest.mark.parametrize("lang, url", [("x\r\nconversion: forged", "http://a/\r\nWARC-Type: warcinfo"), ("de", "http://a/\x00\tb")])
def test_fields_stay_on_their_lines(spark, lang, url):
    html = f"<html lang=\"{lang}\"><title>a\r\nb\x07c</title><a href=\"/x?a=1&amp;b=2\">1</a><a href=\" /y\r\nconversion: forged\t\">2</a><a href='/&#10;z&lt;'>3</a>"
    pages = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
    for r in warc_derivatives.page_derivatives(pages).collect():
        names = [line.split(": ")[0] for line in r["header"].split("\r\n")[1:]]
        assert len(names) == len(set(names)) == 11 and not any(c < " " for line in r["header"].split("\r\n") for c in line)
        if r["record_type"] == "metadata":
            lines = r["block"].split("\r\n")
            assert [x for x in lines if x.startswith("outlink: ")] == ["outlink: /x?a=1&b=2", "outlink: /yconversion: forged", "outlink: /z<"]
            assert sum(x.startswith("conversion: ") for x in lines) == 1 and lines[0] == "title: a bc"
            assert not any(c < " " for line in lines for c in line)


def test_the_ways_of_contracting_agree(monkeypatch):
    """Words of any length get the same ids, wherever the bounds between the three ways lie."""
    own, r = byte_bpe.Tokenizer(byte_bpe.read_ranks(RANKS), PATTERN), random.Random(14)
    words = {"".join(r.choice(letters) for _ in range(n)) for n in (2, 3, 5, 9, 17, 40, 64, 65, 130, 400) for letters in ("ab", "etaoin shr", "éüñ日本aé", " =-", "0a")}
    found = []
    for short, longest in ((64, 4096), (-1, 0), (1000, 4096), (1, 4096)):
        monkeypatch.setattr(byte_bpe, "LONG_WORD", short)
        monkeypatch.setattr(byte_bpe, "LONGEST_WORD", longest)
        own.words, own.older = {}, {}
        own.learn(words)
        found.append({w: own.words[w] for w in words})
    assert all(f == found[0] for f in found)


def test_very_long_words_are_contracted_and_decoded_by_the_queries():
    """Merges and bytes of a very long word are those of the database's tables, not of a way beside them."""
    word = "".join(random.Random(15).choice("etaoinshr") for _ in range(5000))
    own = byte_bpe.Tokenizer(byte_bpe.read_ranks(RANKS), PATTERN)
    own.con.execute("UPDATE tokens SET hex = '2a'")
    own.learn({word})
    count, _, _, decoded = own.words[word]
    assert decoded == b"*" * count and 0 < count < 5000
    own = byte_bpe.Tokenizer(byte_bpe.read_ranks(RANKS), PATTERN)
    own.con.execute("DELETE FROM merges")
    own.learn({word})
    assert own.words[word][0] == 5000


def test_pieces_of_very_long_words_are_put_together():
    """Runs whose tokens begin elsewhere in each piece, few letters, and words without a cut, against the tokenizer's own library."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    lib, own, r = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), byte_bpe.Tokenizer(byte_bpe.read_ranks(RANKS), PATTERN), random.Random(16)
    words = ["-" * 5003, "é" * 3001, "日" * 2003, "日本語" * 900, "".join(r.choice("etaoin") for _ in range(6000)), "".join(r.choice(["inter", "national", "ation", "und"]) for _ in range(1500))]
    own.learn({*words})
    for word in words:
        count, digest, packed, decoded = own.words[word]
        want = lib._encode_single_piece(word.encode())
        assert [int.from_bytes(packed[at : at + 4], "little") for at in range(0, len(packed), 4)] == want
        assert count == len(want) and digest == ",".join(map(str, want)).encode() and decoded == word.encode()
