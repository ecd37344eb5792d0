"""Texts that follow a rule are told apart, and no column of the caller is touched."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import bytescan, license_rules, minhash_dedup, quality_rules, raking, url_rules

HELPERS = ["_words", "_source", "_lang", "_topic", "_Documents", "_tokens", "_weight", "_chance", "_capped", "_copies", "_kept", "_copy", "_n", "_best", "_gone", "_again",
           "_id", "_set", "_part", "_row", "_node", "_marked", "_path", "_hits", "_site", "_weight_given", "_rules", "row", "node", "key", "kept_", "bands"]


def morse(size, a="a", b="b"):
    """The Thue-Morse word over two letters; swapping these gives its complement."""
    return "".join(b if k.bit_count() % 2 else a for k in range(size))


PAIRS = [(morse(n), morse(n, "b", "a")) for n in (512, 1024, 2048, 4096, 16384)]


def test_complements_are_other_sets(spark):
    """As words, as shingles of such words, and as shingles whose words are the letters."""
    texts = [t for p in PAIRS for t in p]
    for a, b in PAIRS[:3]:
        texts += [" ".join([w] * 5 + [str(k) for k in range(3)]) for w in (a, b)]
        texts += [" ".join(w) for w in (a[:1024], b[:1024])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split(" ") for t in texts)]
    alike = lambda a, b: 100 * len(a & b) >= 75 * len(a | b)
    lowest = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if alike(a, b):
                    lowest[i] = lowest[j] = min(lowest[i], lowest[j])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == {i: (len(s), lowest[i]) for i, s in enumerate(sets)}
    assert [got[i][1] for i in range(10)] == list(range(10))


def test_complements_are_other_lines_and_words(spark):
    texts = ["\n".join([a, b]) for a, b in PAIRS] + ["\n".join([a, b, a]) for a, b in PAIRS]
    texts += [" ".join([w for a, b in PAIRS[:2] for w in [*[a] * k, *[b] * k]] * 1) for k in (1, 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules.rules_digest(docs).collect()}
    assert [got[i][0] for i in range(10)] == [0] * 5 + [1] * 5
    for i, t in enumerate(texts):
        words = t.split()
        grams = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        inside = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(8)}
        assert got[i][1] == len(inside)


def test_families_differ():
    texts = [w.encode() for p in PAIRS for w in p] + [b"a", b"b", b"ab", b"ba", b"aab", b"aba"]
    offsets = np.cumsum([0, *map(len, texts)])
    scan = bytescan.Scan(np.frombuffer(b"".join(texts), np.uint8), offsets)
    one, two = (scan.hashes(offsets[:-1], offsets[1:], f) for f in range(2))
    assert len(set(one.tolist()) | set(two.tolist())) == 2 * len(texts)
    again = scan.hashes(offsets[3:6], offsets[4:7])
    assert again.tolist() == one[3:6].tolist()  # whatever stands around


@pytest.mark.parametrize("name", ["keep_one", "sample", "licences", "urls", "rules"])
def test_no_column_of_the_caller_is_touched(spark, name):
    docs = spark.createDataFrame([(1, "one two three", "en", "src0"), (1, "other words", "de", "src1"), (2, "one two three", "en", None), (3, None, None, "src1")], "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({h: F.concat(F.lit(f"own {h} "), F.col("doc_id").cast("string")) for h in HELPERS}).withColumn("url", F.lit("x://example.com/en/"))
    make = {"keep_one": minhash_dedup.keep_one, "sample": lambda d: raking.sample(d, keep=1.0, once=True), "licences": license_rules.scan_licences, "urls": url_rules.judge_urls, "rules": quality_rules.keep_good}
    out = make[name](docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    for r in out.collect():
        assert all(r[h] == f"own {h} {r['doc_id']}" for h in HELPERS)
    if name == "sample":
        with pytest.raises(ValueError):
            raking.mixed(docs)


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.collect() == []
        docs = out if name != corpus_pipeline.STAGES[-1][0] else docs
