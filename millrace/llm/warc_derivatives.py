"""WARC derivatives: metadata and plain-text conversion records built from response records.

Every response gives two records that name it in ``WARC-Refers-To``: a *metadata* record (title, language, outgoing links,
the source's HTTP headers and digests, and the id of the conversion) and a *conversion* record with the text of the page.
Record ids are name-based, so a task that is run again writes the same records. Digests are SHA-256 in hexadecimal.

Built-in functions only, row by row: no shuffle, so no hot keys.

Defined results
    * a null or empty page gives both records, with an empty text and no title; a null URL gives an empty target;
    * a null id is named by its URL and content alone; rows that repeat each other give records with the same ids;
    * an unclosed comment, script or style runs to the end of the page; an unclosed tag is text;
    * other columns are not read; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
#: The named entities that are decoded.
ENTITIES = {
    "nbsp": "\u00a0", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "copy": "©", "reg": "®", "middot": "·", "bull": "•",
    "ndash": "–", "mdash": "—", "hellip": "…", "laquo": "«", "raquo": "»", "euro": "€",
}
_HIDDEN = r"(?is)<(?:(script|style|noscript|template|title)\b[^<>]*+>.*?(?:</\1\s*>|\z)|!--.*?(?:-->|\z))"
_BREAKS = r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|nav|header|footer|aside|main|form|pre|blockquote|body|html|head)\b[^<>]*+>"


def _attribute(tag: str, name: str) -> str:
    """An attribute of a tag; its group is the value as it stands: in double quotes, in single quotes or bare."""
    return rf"""(?i)<{tag}\s(?:[^<>]*?[\s"'/:])??{name}\s*+=\s*+("[^"<>]*"|'[^'<>]*'|[^\s"'<>]++)"""


def _unquoted(value: Column) -> Column:
    return F.when(value.startswith('"') | value.startswith("'"), F.substring(value, 2, F.length(value) - 2)).otherwise(value)


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def _sha(value: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(value, "UTF-8"), 256))


def _record_id(*parts: Column) -> Column:
    """A name-based id in the form of a version 8 UUID."""
    h = F.md5(F.concat_ws("\n", *(_text(p) for p in parts)))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8"), F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _entities(text: Column) -> Column:
    """Named and numeric entities as characters, each decoded once; what names no character stays.

    Only what follows an ``&`` is looked at.
    """
    names = F.create_map(*(F.lit(x) for pair in ENTITIES.items() for x in pair))

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]{2,8});", 1)
        code = F.when(name.rlike("^#[0-9]"), F.substring(name, 2, 8).cast("long")).when(F.startswith(name, F.lit("#")), F.conv(F.substring(name, 3, 8), 16, 10).cast("long"))
        real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.try_element_at(names, name))
        return F.coalesce(F.concat(char, F.substring(part, F.length(name) + 2, F.length(part))), F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), decoded)
    return F.concat(parts[0], F.concat_ws("", rest))


def _line(value: Column) -> Column:
    """The value as it may stand in a field of one line: line ends and tabs percent-encoded, other control characters left out."""
    clean = value
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        clean = F.replace(clean, F.lit(char), F.lit(code))
    return F.when(value.rlike("[\\x00-\\x1F\\x7F]"), F.regexp_replace(clean, "[\\x00-\\x1F\\x7F]", "")).otherwise(value)


def _link(value: Column) -> Column:
    """An attribute's link: entities decoded, blanks at the ends and line ends and tabs anywhere taken out, as browsers do."""
    url = F.when(F.contains(value, F.lit("&")), _entities(value)).otherwise(value)
    return _line(F.btrim(F.when(url.rlike("[\\r\\n\\t]"), F.regexp_replace(url, "[\\r\\n\\t]+", "")).otherwise(url)))


def _visible(html: Column) -> Column:
    """The page without tags and hidden parts, block elements on lines of their own."""
    t = F.regexp_replace(_text(html), _HIDDEN, " ")
    t = F.regexp_replace(t, _BREAKS, "\n")
    return F.regexp_replace(t, "<[a-zA-Z/!?][^<>]*+>", "")


def _tidy(text: Column) -> Column:
    """Runs of blanks as one, no blanks around line ends, no empty lines, nothing at the ends. Single blanks match nothing."""
    t = F.regexp_replace(F.translate(text, "\t\r\f\u00a0", "    "), " {2,}+", " ")
    return F.btrim(F.regexp_replace(t, "\\n[ \\n]++| \\n[ \\n]*+", "\n"), F.lit(" \n"))


def plain_text(html: Column) -> Column:
    """The visible text with its entities decoded."""
    return _tidy(_entities(_visible(html)))


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as response records: record_id, target_uri, warc_date, http_headers and payload."""
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(_text(F.col(html))).cast("string"))
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), _record_id(F.lit("response"), F.col(id_col), F.col(url), F.md5(_text(F.col(html)))).alias("record_id"),
        _text(F.col(url)).alias("target_uri"), F.lit(date).alias("warc_date"), head.alias("http_headers"), _text(F.col(html)).alias("payload"),
    )


def derivatives(found: DataFrame) -> DataFrame:
    """Two rows for each response: its metadata record and its conversion record.

    ``found`` has page_id, record_id, target_uri, warc_date, http_headers and payload, as :func:`responses` gives them.
    """
    body = F.concat("http_headers", F.lit(CRLF * 2), "payload")
    title = _tidy(_entities(F.regexp_extract("payload", r"(?is)<title\b[^<>]*+>(.*?)</title\s*>", 1)))
    links = F.array_distinct(F.transform(F.regexp_extract_all("payload", F.lit(_attribute("a", "href")), F.lit(1)), lambda v: _link(_unquoted(v))))
    # step by step, so that no step is worked out once for every mention of it
    seen = found.withColumn("text", _visible(F.col("payload"))).withColumn("text", _entities(F.col("text"))).withColumns({
        "payload_digest": _sha(F.col("payload")), "source_digest": _sha(body), "text": _tidy(F.col("text")), "title": title,
        "language": _unquoted(F.regexp_extract("payload", _attribute("html", "lang"), 1)), "links": links,
        "metadata_id": _record_id(F.lit("metadata"), F.col("record_id")), "conversion_id": _record_id(F.lit("conversion"), F.col("record_id")),
    })
    fields = F.concat_ws(
        CRLF, F.concat(F.lit("title: "), _line(F.regexp_replace("title", "\\s+", " "))), F.concat(F.lit("language: "), _line(F.col("language"))),
        F.concat(F.lit("conversion: "), F.col("conversion_id")), F.concat(F.lit("source-payload-digest: "), F.col("payload_digest")), F.concat(F.lit("source-block-digest: "), F.col("source_digest")),
        F.transform(F.split("http_headers", CRLF), lambda h: F.concat(F.lit("source-header: "), h)), F.transform("links", lambda u: F.concat(F.lit("outlink: "), u)), F.lit(""),
    )
    record = lambda kind, id_, content, block: F.struct(F.lit(kind).alias("record_type"), F.col(id_).alias("derived_id"), F.lit(content).alias("content_type"), block.alias("block"))
    two = F.array(record("metadata", "metadata_id", "application/warc-fields", fields), record("conversion", "conversion_id", "text/plain; charset=utf-8", F.col("text")))
    rows = seen.select("page_id", "record_id", "target_uri", "warc_date", "payload_digest", F.inline(two))
    rows = rows.withColumns({"block_digest": _sha(F.col("block")), "content_length": F.octet_length("block").cast("long")})
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), *(
        F.concat(F.lit(f"{name}: "), value) for name, value in (
            ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", F.col("derived_id")), ("WARC-Refers-To", F.col("record_id")), ("WARC-Refers-To-Target-URI", _line(F.col("target_uri"))),
            ("WARC-Refers-To-Date", F.col("warc_date")), ("WARC-Target-URI", _line(F.col("target_uri"))), ("WARC-Date", F.col("warc_date")), ("WARC-Source-Payload-Digest", F.col("payload_digest")),
            ("WARC-Block-Digest", F.col("block_digest")), ("Content-Type", F.col("content_type")), ("Content-Length", F.col("content_length").cast("string")))
    ))
    return rows.select("page_id", "record_type", F.col("derived_id").alias("record_id"), F.col("record_id").alias("refers_to"), "target_uri", "warc_date", "content_type", "content_length",
                       "block_digest", "payload_digest", head.alias("header"), "block")


def write_warc(records: DataFrame, path: str) -> None:
    """The records as WARC files (one per task, gzip) at a new path: header, empty line, block, two line ends each."""
    lines = records.select(F.concat("header", F.lit(CRLF * 2), "block").alias("value"))
    lines.write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def page_derivatives(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    return derivatives(responses(pages, date))
