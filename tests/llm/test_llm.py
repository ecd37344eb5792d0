"""The training-data operators against SQL twins, brute force, exact round trips and held-out labels, and on odd rows."""

import base64
import hashlib
import itertools
import random
import zlib

import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import ball_tree, byte_bpe, byte_cnn, language_mixture, license_rules, minhash_dedup, quality_rules, raking, url_rules, warc_derivatives
from millrace.llm.queries import QUERIES, SQL
from tests.oracle import connect, duck_rows, spark_rows

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
LONG = " ".join(f"word{i}" for i in range(30_000))
TEXTS = [None, "", " \n\t ", "One.", "a b c d", "a b c d", "A B c D", "ü" * 300, "x" * 3000, LONG, LONG, "12 !! 🙂 \x00 x", "a\nb c\nb c\n\nb c"]
DOCS = "doc_id long, text string, lang string, source string, n_words int, score string, kept string, word string"


def odd_docs(spark, texts=TEXTS):
    rows = [(i if i != 3 else None, t, None if i == 1 else "en", "src0" if i % 2 else None, 7, "s", "k", "w") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4]], DOCS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, name):
    con = connect(SMALL)
    assert spark_rows(QUERIES[name](spark, SMALL)) == duck_rows(con, SQL[name])


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(SQL) if not n.startswith(("op12", "op13"))))
def test_alone(spark, name):
    t = "pages" if name == "op5_warc_derivatives" else "documents"
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{t}.parquet").count() * (2 if t == "pages" else 1)


def labels(spark, n=40):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(n)] + [(1, None, 0), (None, 1, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")


OVER_DOCS = {
    "op1": minhash_dedup.near_duplicates, "op2": license_rules.licence_digest, "op6": lambda d: byte_cnn.quality_scores(d, labels(d.sparkSession)),
    "op7": lambda d: byte_bpe.token_digests(d, RANKS, PATTERN), "op8": language_mixture.language_digest, "op9": raking.mix_digest, "op10": quality_rules.rules_digest,
}


@pytest.mark.parametrize("name", sorted(OVER_DOCS))
def test_odd_rows(spark, name):
    docs = odd_docs(spark)
    found = [r.asDict() for r in OVER_DOCS[name](docs).collect()]
    assert len(found) == docs.count()
    same = [r for r in found if r["doc_id"] == 4]  # the repeated row
    assert len(same) == 2 and same[0] == same[1]
    assert OVER_DOCS[name](docs.limit(0)).collect() == []


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(texts):
    sets = [shingles(t) for t in texts]
    lowest = list(range(len(texts)))
    for _ in texts:
        for i, j in itertools.combinations(range(len(texts)), 2):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                lowest[i] = lowest[j] = min(lowest[i], lowest[j])
    return {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, lowest))}


def test_near_duplicates_brute(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "PART_SHINGLES", 200)  # buckets of several parts
    r = random.Random(3)
    base = [f"w{r.randrange(500)}" for _ in range(60)]
    texts = [None, "", "a b", "A b", "a b c"]
    for k in range(70):  # a group of copies further and further from the first, and of copies of these
        words = list(base if k < 40 else texts[5 + r.randrange(40)].split(" "))
        for _ in range(r.randrange(5)):
            words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in minhash_dedup.near_duplicates(docs).collect()}
    assert got == components(texts)
    assert sorted(x["doc_id"] for x in minhash_dedup.keep_one(docs).collect()) == sorted(i for i, (_, c) in components(texts).items() if i == c)


def test_keep_one_odd(spark):
    docs = odd_docs(spark)
    kept = [(x["doc_id"], x["text"]) for x in minhash_dedup.keep_one(docs).collect()]
    assert docs.columns == minhash_dedup.keep_one(docs).columns
    assert sorted(i for i, _ in kept if i is not None) == [0, 1, 2, 4, 7, 8, 9, 11, 12] and (None, "One.") in kept


def test_estimate_corrects_chance(spark):
    row = spark.range(1).select(minhash_dedup.estimate(F.lit(32)).alias("a"), minhash_dedup.estimate(F.lit(128)).alias("b")).first()
    assert row == (0.0, 1.0)


def test_top_k_brute(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(700)] + [(i, [0.5, 0.5, 0.0, 1.0]) for i in range(700, 1000)]
    rows += [(1000, None), (1001, [None, 1.0, 1.0, 1.0]), (1002, [float("nan")] * 4), (1003, [float("inf")] * 4), (None, [1.0] * 4), (1100, [1.0, 2.0]), (1200, []), (5, rows[5][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = [tuple(x) for x in ball_tree.top_k(table, F.col("vec_id") % 100 == 0, shard_rows=150, block_queries=3).collect()]
    import math

    fine = {i: [math.floor(1024 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in fine if i % 100 == 0):
        best = sorted((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q and len(v) == len(fine[q]))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(want)
    assert ball_tree.embedding_neighbours(table.limit(0).drop("score")).collect() == []


def test_urls(spark):
    urls = [None, "", "no-scheme.com/x", "http://WWW.Example.COM/en/a?b#c", "x://example.com/en/", "x://a.example.com/EN/", "x://a.net/es/1", "x://net/fr/", "x://badnet/fr/", "x://b.com", "x://b.com/",
            "x://adult-x.example.org/a", "x://a.org/login", "x://a.org/?q=login", "x://a.org/\n#://b.com/"]
    pages = spark.createDataFrame([*enumerate(urls), (3, urls[3])], "page_id long, url string").withColumns({"host": F.lit("h"), "rule": F.lit(1)})
    got = {r["page_id"]: tuple(r)[1:] for r in url_rules.url_verdicts(pages).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("www.example.com", "/en/a", "www.example.com/en/", "allow"), ("example.com", "/en/", "example.com/en/", "block"),
        ("a.example.com", "/EN/", "com/", "allow"), ("a.net", "/es/1", "net/es/", "block"), ("net", "/fr/", "net/fr/", "block"), ("badnet", "/fr/", None, "allow"), ("b.com", "", None, "allow"), ("b.com", "/", "com/", "allow"),
        ("adult-x.example.org", "/a", None, "block"), ("a.org", "/login", None, "block"), ("a.org", "/", None, "allow"), ("a.org", "/\n", None, "allow")]
    assert url_rules.url_verdicts(pages.limit(0)).collect() == []


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software."
    bsd = [license_rules.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")]
    texts = [mit, ". ".join(bsd), ". ".join(bsd[:3]), ". ".join(reversed(bsd)), "SPDX-License-Identifier: MIT", "mit", "x. Released under the MIT License. y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["licences"] for r in license_rules.licence_digest(docs).collect()} == {0: "MIT", 1: "BSD-3-Clause", 2: "BSD-2-Clause", 3: "", 4: "MIT", 5: "", 6: "MIT"}


def test_warc(spark, tmp_path):
    html = "<html lang='x'><title>T &amp; t</title><p>a &lt;b&gt; &#233;</p><script>no</script><a href=\"/l\">l</a><!-- c"
    pages = spark.createDataFrame([(1, "http://a/", html), (None, None, None), (2, "u", ""), (1, "http://a/", html)], "page_id long, url string, html string").withColumn("block", F.lit(1))
    rows = warc_derivatives.page_derivatives(pages).collect()
    assert len(rows) == 8
    text = next(r for r in rows if r["page_id"] == 1 and r["record_type"] == "conversion")
    meta = next(r for r in rows if r["page_id"] == 1 and r["record_type"] == "metadata")
    assert text["block"] == "a <b> é\nl" and text["refers_to"] == meta["refers_to"] and text["record_id"] in meta["block"]
    assert text["payload_digest"] == "sha256:" + hashlib.sha256(html.encode()).hexdigest() and text["block_digest"] == "sha256:" + hashlib.sha256(text["block"].encode()).hexdigest()
    assert "title: T & t\r\n" in meta["block"] and "outlink: /l\r\n" in meta["block"] and "source-header: Content-Type: text/html; charset=utf-8\r\n" in meta["block"]
    warc_derivatives.write_warc(warc_derivatives.page_derivatives(pages), f"{tmp_path}/w")
    import gzip

    stored = b"".join(gzip.open(p).read() for p in sorted((tmp_path / "w").glob("*.gz")))
    found = 0
    while stored:  # by Content-Length alone
        head, _, rest = stored.partition(b"\r\n\r\n")
        size = int(head.rpartition(b"Content-Length: ")[2])
        assert rest[size : size + 4] == b"\r\n\r\n"
        stored, found = rest[size + 4 :], found + 1
    assert found == 8
    assert warc_derivatives.page_derivatives(pages.limit(0)).collect() == []


def test_bpe_against_tiktoken(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(2)
    texts = [*TEXTS, "a" * 20_000, "".join(r.choice("abcdeé") for _ in range(3000)), "<|endoftext|>", *(" ".join("".join(r.choice("thaeéß.,1 ") for _ in range(9)) for _ in range(200)) for _ in range(5))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = byte_bpe.encode(docs, RANKS, PATTERN, digests=True, kept_words=100)
    rows = {x["doc_id"]: x for x in byte_bpe.decode(coded, RANKS, PATTERN).collect()}
    for i, t in enumerate(texts):
        want = own.encode_ordinary(t or "")
        assert list(rows[i]["token_ids"]) == want and rows[i]["n_tokens"] == len(want)
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert bytes(rows[i]["decoded"]) == (t or "").encode() and rows[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    with pytest.raises(ValueError):
        byte_bpe.encode(coded, RANKS, PATTERN)


def test_classifier_held_out(spark):
    given = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op6_byte_cnn_quality"](spark, FOLDER).collect() if r["doc_id"] in given]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    out = [r for r in rows if r["held_out"]]
    good = [r["predicted"] for r in out if given[r["doc_id"]] == 1]
    assert sum(r["predicted"] == given[r["doc_id"]] for r in out) >= 0.93 * len(out) and sum(good) >= 0.97 * len(good)


def test_classifier_without_classes(spark):
    docs = odd_docs(spark)
    none = labels(spark).limit(0)
    assert {r["score"] for r in byte_cnn.quality_scores(docs, none).collect()} == {0.5}
    one = labels(spark).where("quality = 1")
    assert 0.5 < byte_cnn.quality_scores(docs, one).first()["score"] < 1


def test_language_held_out(spark):
    given = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op8_language_mixture"](spark, FOLDER).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    out = [r["lang_pred"] == given[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(out) >= 0.97 * len(out)


def test_language_mixture_shares(spark):
    docs = spark.createDataFrame([(i, *x) for i, x in enumerate([("the cat and the other dog that was there " * 20, "en"), ("der hund und die katze nicht ein schöner " * 20, "de")] * 6)], "doc_id long, text string, lang string")
    model = language_mixture.learn(docs)
    two = spark.createDataFrame([("the cat and the other dog that was there " * 6 + "der hund und die katze nicht ein schöner " * 3,), ("12 34",), (None,)], "text string")
    a, b, c = language_mixture.with_languages(two, model).collect()
    assert a["lang_pred"] == "en" and sorted(a["languages"]) == ["de", "en"] and 0.55 < max(a["shares"]) < 0.8
    assert (b["lang_pred"], b["score"], c["lang_pred"]) == ("und", 0.0, "und")


def test_raked_marginals(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    cells = raking.cell_table(docs)
    for k, dimension in enumerate(raking.DIMENSIONS):
        target = raking.TARGETS.of(dimension)
        there = {c[k] for c in cells if c[4]}
        whole = sum(target[v] for v in there)
        for v in there:
            assert abs(sum(c[5] for c in cells if c[k] == v) - target[v] / whole) < 1e-3
    assert abs(sum(c[4] * c[6] for c in cells) / sum(c[4] for c in cells) - raking.KEEP) < 1e-3
    again = raking.sample(docs.repartition(5)).select("doc_id").collect()
    assert sorted(again) == sorted(raking.sample(docs).select("doc_id").collect()) and 0.5 * docs.count() < len(again) < docs.count()


def test_pipeline_stages(spark):
    """Each stage's decisions against brute force over what it was given."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("_n", F.lit(1))
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, given, SMALL)
        rows, before = out.collect(), {r["doc_id"]: r["text"] for r in given.collect()}
        kept = {r["doc_id"] for r in rows}
        assert len(kept) == len(rows) and kept <= set(before) and all(before[r["doc_id"]] == r["text"] for r in rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        if name == "quality rules":
            sql = {r[1]: r[4] for r in connect(SMALL).execute(f"SELECT 0, doc_id, 0, 0, kept FROM ({SQL['op10_quality_rules']})").fetchall()}
            assert kept == {i for i, k in sql.items() if k}
        if name == "minhash near-dedup":
            ids = sorted(before)
            lowest = components([before[i] for i in ids])
            assert kept == {ids[i] for i, (_, c) in lowest.items() if c == i}
        if name == "byte-level bpe":
            assert all(r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest() for r in rows) and kept == set(before)
        given = spark.createDataFrame(rows, out.schema)
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()) == sorted(kept)


def test_licences_on_lines(spark):
    grant, notice = (license_rules.SENTENCES[k] for k in ("mit-grant", "mit-notice"))
    words = grant.split(" ")
    wrapped = [" ".join(words[i : i + 9]) for i in range(0, len(words), 9)]
    texts = [
        "SPDX-License-Identifier: MIT\nimport x", "Released under the MIT License\nFoo", "Foo bar\nReleased under the MIT License\nfoo", "# Licence\nLicensed under CC BY-NC 4.0.", "a | b |\nLicensed under the Apache License, Version 2.0.",
        "foo\nThis work is licensed under the\nGNU General Public License\nversion 3\nBar", "/*\n * " + "\n * ".join(wrapped) + ":\n *\n * " + notice + ".\n */\nint x;", "; " + "\n; ".join(wrapped) + ":\n;\n; " + notice,
        "Released under\n\nthe MIT License", "it was released under the MIT License", "Released under the MIT License today\nfoo", "One.\nA\x01b\nx Released under\x02 the MIT License\r\nReleased under the MIT License\r\nB", "Released under the MIT License\n" * 3000,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in license_rules.licence_digest(docs).collect()}
    assert [rows[i]["licences"] for i in range(len(texts))] == ["MIT", "MIT", "MIT", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0", "MIT", "MIT", "", "", "", "MIT", "MIT"]
    assert rows[0]["found"] == "1:spdx,2:spdx-mit" and rows[11]["found"] == "2:mit-short" and rows[12]["found"] == ",".join(["1:mit-short"] * 3000)


def test_raked_expected_tokens(spark):
    """Sources of equal size, one of which the targets want eight times as often: copies make up what it lacks."""
    texts = ["a b c d", "mail a@b.c now " * 3, "x | y | z", "word " * 310]
    rows = [(i, texts[i // 80 % 4], ("en", "de", "fr", "es", "it")[i % 5], f"src{i % 16}") for i in range(3200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    cells = raking.cell_table(docs)
    assert max(c[6] for c in cells) > 1 and all(abs(got - wanted) < 1e-6 for _, _, got, wanted in raking.shares(cells))
    assert abs(sum(c[4] * c[6] for c in cells) / sum(c[4] for c in cells) - raking.KEEP) < 1e-9
    expected = {c[:3]: c[6] for c in cells}
    digest = raking.mix_digest(docs).collect()
    for r in digest:
        chance = expected[r["source_class"], r["lang_class"], r["topic"]]
        assert int(chance) <= r["copies"] <= int(chance) + 1 and r["kept"] == (r["copies"] > 0)
    got = sum(r["n_words"] * r["copies"] for r in digest if r["source_class"] == "src0") / sum(r["n_words"] * r["copies"] for r in digest)
    assert abs(got - next(s[3] for s in raking.shares(cells) if s[1] == "src0")) < 0.03
    given = {r["doc_id"]: r["copies"] for r in digest if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in raking.sample(docs).groupBy("doc_id").count().collect()} == given
    assert raking.sample(docs, once=True).groupBy("doc_id").count().where("count > 1").count() == 0


def test_licences_by_wording(spark):
    free = "{} is free software; you can redistribute it and/or modify\n{}it under the terms of the GNU {}General Public License as published by\n{}the Free Software Foundation; either version {} of the License, or\n{}(at your option) any later version.\n"
    header = lambda what, kind, version, lead: lead + free.format(what, lead, kind, lead, version, lead).replace("Foundation; either", "Foundation, either")
    mit = " * ".join(["", *(f"{line}\n" for line in (
        "Permission is hereby granted, free of charge, to any person obtaining a copy", "of this software and associated documentation files (the \"Software\"), to deal", "in the Software without restriction, including without limitation the rights",
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell", "copies of the Software, and to permit persons to whom the Software is", "furnished to do so, subject to the following conditions:", "",
        "The above copyright notice and this permission notice shall be included in all", "copies or substantial portions of the Software."))])
    texts = {
        "This project is licensed under the MIT License.": "MIT", "Licensed under the MIT License": "MIT", "# This software is released under the terms of the\n# Apache License, Version 2.0\nimport x": "Apache-2.0", "/*\n" + mit + " */\nint x;": "MIT",
        header("This program", "", "2", "# "): "GPL-2.0", header("This program", "", "3", " * "): "GPL-3.0", header("This library", "Lesser ", "2.1", "// "): "LGPL-2.1", header("This program", "Affero ", "3", "    "): "AGPL-3.0",
        "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy": "MPL-2.0", "This is free and unencumbered software released into the public domain.": "Unlicense",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0", "Licensed under CC BY 4.0": "CC-BY-4.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "The code is distributed under the GNU GPL v3.": "GPL-3.0",
        "SPDX-License-Identifier: LGPL-3.0-or-later": "LGPL-3.0", "This file is licensed under the GNU General Public License version 2.": "GPL-2.0", "Licensed under the Foo License": "", "We asked if it is licensed under the MIT License.": "",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["licences"] for r in license_rules.licence_digest(docs).collect()}
    assert [(t, rows[i]) for i, t in enumerate(texts)] == list(texts.items())


def test_keep_one_ids_with_other_texts(spark):
    a, b, c, near = "one two three four five six", "red green blue black white grey", "uno dos tres cuatro cinco seis", " ".join(f"w{i}" for i in range(80))
    rows = [(3, a, 0), (9, a, 0), (9, b, 0), (9, b, 1), (9, "", 0), (11, c, 0), (11, near, 0), (11, f"{near} w80", 0), (12, near, 0), (12, " ", 5)]
    for parts in (1, 4):
        kept = minhash_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(parts))
        assert sorted(tuple(r) for r in kept.collect()) == sorted([(3, a, 0), (9, b, 0), (9, "", 0), (11, c, 0), (11, near, 0), (12, " ", 5)])


def test_warc_attribute_quotes(spark):
    links = "<a href='/one'>1</a><a class=x href=/two>2</a><A title=\"t\" HREF = \"/three\">3</A><a\nhref= '/it\"s'>4</a><a href=\"/o'clock'\">5</a><a data-href=/no>6</a><a href=''>7</a><abbr href=/no>8</abbr><a href='/one'>9</a>"
    pages = spark.createDataFrame([(i, "u", f"<html class='c' {lang}>{links}") for i, lang in enumerate(("lang='x'", "lang=x", "lang = \"x\"", "LANG= 'x'", "xml:lang='y'"))], "page_id long, url string, html string")
    blocks = {r["page_id"]: r["block"].split("\r\n") for r in warc_derivatives.page_derivatives(pages).where("record_type = 'metadata'").collect()}
    for i, block in blocks.items():
        assert [x for x in block if x.startswith("outlink: ")] == [f"outlink: {u}" for u in ("/one", "/two", "/three", "/it\"s", "/o'clock'", "")]
        assert [x for x in block if x.startswith("language: ")] == [f"language: {'x' if i < 4 else 'y'}"]
