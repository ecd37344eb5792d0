"""SQL twins (DuckDB) of the queries in this folder that SQL can state."""

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
sh AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM sh JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.seen = u.a),
m AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY ALL)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def _covered(n: int) -> str:
    """Words and their characters inside n-grams found twice or more."""
    return f"""
g{n} AS (SELECT rid, i, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n})),
t{n} AS (SELECT DISTINCT rid, unnest(range(i, i + {n})) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM g{n}) WHERE c > 1),
c{n} AS (SELECT rid, count(*) AS words, sum(length(w[p])) AS chars FROM t{n} JOIN d USING (rid) GROUP BY rid)"""


OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
{",".join(_covered(n) for n in (3, 5, 8, 10))},
l AS (SELECT rid, line, count(*) AS c, sum(length(line) - length(regexp_replace(line, '[^\\x20\\x09-\\x0D]', '', 'g'))) / count(*) AS chars
      FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid, line),
dl AS (SELECT rid, sum(c - 1) AS dups, sum((c - 1) * chars) AS chars FROM l GROUP BY rid),
x AS (SELECT d.rid, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(c8.words, 0) AS n_repeat_words,
        coalesce(dl.chars, 0) AS lc, coalesce(c3.chars, 0)::BIGINT AS k3, coalesce(c5.chars, 0)::BIGINT AS k5, coalesce(c10.chars, 0)::BIGINT AS k10
      FROM d LEFT JOIN dl USING (rid) LEFT JOIN c3 USING (rid) LEFT JOIN c5 USING (rid) LEFT JOIN c8 USING (rid) LEFT JOIN c10 USING (rid)),
y AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, greatest(word_chars, 1) AS total FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR lc > 0.40::DOUBLE * total OR n_symbols > 0.10::DOUBLE * total OR k3 > 0.50::DOUBLE * total OR k5 > 0.45::DOUBLE * total OR k10 > 0.35::DOUBLE * total) AS kept,
  k3::DOUBLE / total AS share_3, k5::DOUBLE / total AS share_5, k10::DOUBLE / total AS share_10
FROM y
"""

OP3 = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
p AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.v, v.v)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.v) = len(v.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM p QUALIFY rank <= 10
"""

_HOST_WORDS = ("adult", "casino", "porn", "xxx", "escort", "viagra", "torrent", "malware", "phishing")
_PATH_WORDS = ("login", "logout", "signup", "cart", "checkout", "calendar")
OP4 = f"""
WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
m AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
  len(list_intersect(regexp_extract_all(host, '[a-z0-9]+'), {list(_HOST_WORDS)})) > 0
    OR regexp_matches(path, '/({"|".join(_PATH_WORDS)})([/.]|$)') AS bad FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL OR bad THEN 'block' ELSE 'allow' END AS verdict
FROM m
"""

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS everywhere FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(everywhere) AS total FROM k GROUP BY ALL),
o AS (SELECT lang, source, sum(n) AS own FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(own, 0) + 5 * v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (everywhere + 5)) // (total + 5 * v)::HUGEINT AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN o ON o.lang = g.lang AND o.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f, 0)::BIGINT AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM a QUALIFY part = 'pair' OR rank <= 50
"""


SQL = {"op1_minhash_near_dedup": OP1, "op3_ball_tree_top_k": OP3, "op4_url_pattern_rules": OP4, "op10_quality_rules": OP10, "op11_source_audit": OP11}
