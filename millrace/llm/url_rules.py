"""URL filters by pattern rules, found through their rarest literal token.

Every rule is a regular expression over ``host + path`` with the literal tokens that each of its matches must hold. A rule
is filed under the one of its tokens that the fewest URLs hold (counted over the whole column); a URL's tokens fetch the
rules filed under them, and only those run their expression. So the cost for a URL follows the rules that could fit it,
not the number of rules.

Two kinds of rules: *site* rules (host and path prefix), of which the longest that fits decides, and *pattern* rules, which
decide where no site rule fits: ``block`` if one matches, else ``allow``.

DataFrame functions only. No shuffle but the count of the rules' own tokens, whose result has a row per token. The rule
index travels in the plan as one literal map, so keep it to some thousand rules.

Defined results
    * host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or
      the end; a null URL, or one without ``://``, has empty host and path and fits no site rule;
    * every row is judged by itself: repeated rows and ids give repeated results, a null id stays null;
    * rules of equal length: the later one in sort order decides; other columns are not read; no rows give no rows.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import columns

TOKEN = "[A-Za-z0-9]+"
_INDEX_TYPE = "map<string,array<struct<name:string,size:int,pattern:string,verdict:string,site:boolean>>>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` over host + path; every match must hold all of ``tokens`` as whole runs of ASCII letters and digits."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    site: bool = False


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path`` (which starts with ``/``)."""
    whole = re.findall(TOKEN, host) + [m for m in re.findall(f"{TOKEN}(?=[^A-Za-z0-9])", path)]
    return Rule(host + path, f"^(?:[^/]*\\.)?{_literal(host)}{_literal(path)}", tuple(whole), verdict, site=True)


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


#: The rules that the query states.
SITE_RULES = (
    site_rule("com", "/", "allow"), site_rule("example.com", "/en/", "block"), site_rule("www.example.com", "/en/", "allow"),
    site_rule("net", "/es/", "block"), site_rule("net", "/fr/", "block"),
)
_HOST_WORDS = ("adult", "casino", "porn", "xxx", "escort", "viagra", "torrent", "malware", "phishing")
_PATH_WORDS = ("login", "logout", "signup", "cart", "checkout", "calendar")
#: The method's own rules, for URLs that no site rule fits.
PATTERN_RULES = (
    *(Rule(f"host word {w}", f"^(?:[^/]*[^a-z0-9/])?{w}(?:[^a-z0-9/][^/]*)?(?:/|$)", (w,), "block") for w in _HOST_WORDS),
    *(Rule(f"path word {w}", f"/{w}(?:[/.]|$)", (w,), "block") for w in _PATH_WORDS),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(target, F.lit(TOKEN), F.lit(0)))


def token_counts(urls: DataFrame, url: str, rules: tuple[Rule, ...]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens; one row per token comes to the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    held = F.filter(_tokens(F.concat(*host_and_path(F.col(url)))), lambda t: t.isin(wanted))
    rows = urls.select(F.explode(held).alias("token")).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def index(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; ``""`` for rules without one."""
    filed: dict[str, list[Rule]] = {}
    for rule in rules:
        key = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        filed.setdefault(key, []).append(rule)
    return filed


def judge_urls(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = SITE_RULES + PATTERN_RULES, default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the site rule that decides, else null), ``matched`` (all rules that match) and ``verdict``.

    Columns of these names that ``pages`` already has are replaced.
    """
    pages, back = columns.apart(pages, ("_hits", "_site"))
    url = {old: new for new, old in back.items()}.get(url, url)
    filed = index(rules, token_counts(pages, url, rules))
    as_rows = {k: [{"name": r.name, "size": len(r.name), "pattern": r.pattern, "verdict": r.verdict, "site": r.site} for r in v] for k, v in filed.items()}
    lookup = F.from_json(F.lit(json.dumps(as_rows)), _INDEX_TYPE)  # folded to one literal
    host, path = host_and_path(F.col(url))
    given = pages.withColumns({"host": host, "path": path})
    target = F.concat("host", "path")
    keys = F.concat(F.array(F.lit("")), _tokens(target))
    candidates = F.flatten(F.filter(F.transform(keys, lambda t: F.try_element_at(lookup, t)), lambda c: c.isNotNull()))
    hits = F.filter(candidates, lambda r: F.regexp_like(target, r["pattern"]))
    sites = F.array_max(F.transform(F.filter("_hits", lambda r: r["site"]), lambda r: F.struct(r["size"].alias("size"), r["name"].alias("name"), r["verdict"].alias("verdict"))))
    blocked = F.exists("_hits", lambda r: ~r["site"] & (r["verdict"] == "block"))
    judged = given.withColumn("_hits", hits).withColumn("_site", sites)
    return judged.withColumns({
        "rule": F.col("_site.name"),
        "matched": F.array_sort(F.transform("_hits", lambda r: r["name"])),
        "verdict": F.coalesce("_site.verdict", F.when(blocked, "block").otherwise(default)),
    }).drop("_hits", "_site").withColumnsRenamed(back)


def url_verdicts(pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url")).select(F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule", "verdict")
