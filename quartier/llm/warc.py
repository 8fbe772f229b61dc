"""Derivatives of web-archive responses: metadata and plain-text conversions.

Input: one row per response record (``RESPONSE`` columns). Output: for each a
``metadata`` record (application/warc-fields) and a ``conversion`` record
(text/plain), both pointing at the response by WARC-Refers-To and carrying its
target, date, payload digest and headers. All of it is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESPONSE = ("page_id", "record_id", "target_uri", "warc_date", "http_headers", "payload")
# Named character references decoded in plain text, & last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
# Elements that end a line of text.
_BLOCK = ("p|div|br|hr|li|ul|ol|dl|dt|dd|h1|h2|h3|h4|h5|h6|tr|td|th|table|article|section|"
          "aside|nav|main|footer|header|title|head|body|html|blockquote|pre|form")
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
BLOCKS = rf"(?i)</?(?:{_BLOCK})(?:[\s/][^>]*)?>"
TAGS = r"<[A-Za-z/!?][^>]*>"
# Opening and closing marks of hidden elements.
_HIDDEN_MARKS = ((r"script\b", r"</script\s*>"), (r"style\b", r"</style\s*>"), ("!--", "-->"))
#: Beyond so many openings, those that nothing closes are set aside first.
OPENINGS = 100
# What must match lies in one stretch without ">", so the first opening of a stretch decides
# it; the atomic groups keep later ones from being tried, each over the rest of the page.
TITLE = r"(?is)^(?>.*?<title)[^>]*+>(.*?)</title"
LANG = r'(?i)(?:^|>)(?>[^>]*?<html\b)[^>]*?\blang="([^"]*)"'
OUTLINK = r"(?i)(?:^|>)(?>[^>]*?<a\s)[^>]*href"


def urn(kind: str, *parts: Column) -> Column:
    """A stable urn:uuid from the digest of the parts."""
    h = F.sha2(F.concat_ws("|", F.lit(kind), *parts), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses(pages: DataFrame, warc_date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of a (page_id, url, html) table, with the headers that
    a server would have sent. Null html is an empty payload, a null url an
    empty target; other columns are ignored. The record's id comes of page_id,
    url and payload, so only repeated rows share one."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        urn("response", page, url, F.sha2(html, 256)).alias("record_id"), url.alias("target_uri"),
        F.lit(warc_date).alias("warc_date"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                       "Content-Length: "), F.octet_length(html).cast("string"),
                 F.lit("\r\n")).alias("http_headers"),
        html.alias("payload"))


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(text: Column, tail: Column) -> Column:
    return F.left(text, F.length(text) - F.length(tail))


def _mark(opening: str, closing: str):
    """Marks the openings of one kind behind its last closing."""
    def run(text: Column) -> Column:
        return _let(F.regexp_replace(text, f"(?is)^.*{closing}", ""), lambda tail: F.concat(
            _before(text, tail),
            F.regexp_replace(tail, f"(?i)<(?={opening})", "<\x01" + "1")))
    return run


def _set_aside(html: Column) -> Column:
    """Openings of hidden elements that nothing closes get a mark after their
    ``<``, so that the search does not run to the end of the page for each."""
    t = F.replace(html, F.lit("\x01"), F.lit("\x01" + "0"))
    for opening, closing in _HIDDEN_MARKS:
        t = _let(t, _mark(opening, closing))
    return t


def _unhide(html: Column) -> Column:
    """A page without its hidden elements, in time linear in its length."""
    openings = F.lit("(?i)<(?:" + "|".join(o for o, _ in _HIDDEN_MARKS) + ")")
    marked = F.regexp_replace(_set_aside(html), HIDDEN, "")
    marked = F.replace(F.replace(marked, F.lit("\x01" + "1"), F.lit("")),
                       F.lit("\x01" + "0"), F.lit("\x01"))
    return (F.when(F.regexp_count(html, openings) > OPENINGS, marked)
            .otherwise(F.regexp_replace(html, HIDDEN, "")))


def _replace_tags(text: Column, pattern: str, by: str) -> Column:
    """Replaces what ends in ``>``; what follows the last one is not searched."""
    return _let(text, lambda t: _let(F.substring_index(t, ">", -1), lambda tail: F.concat(
        F.regexp_replace(_before(t, tail), pattern, by), tail)))


def plain_text(html: Column) -> Column:
    """Text of a page: hidden elements out, block elements as line ends, other
    tags out, character references decoded, runs of blanks and empty lines
    closed up. Takes time linear in the page, however broken it is."""
    t = _replace_tags(_unhide(html), BLOCKS, "\n")
    t = _replace_tags(t, TAGS, "")
    for name, char in ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    t = F.regexp_replace(t, r"[ \t\x0B\f\r]+", " ")
    t = F.regexp_replace(t, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(t, r"^[ \n]+|[ \n]+$", "")


def derivatives(resp: DataFrame) -> DataFrame:
    """Two records per response: ``metadata`` and ``conversion``.

    Null columns count as empty; an empty payload gives an empty conversion;
    repeated rows give repeated records with equal ids; an empty table gives an
    empty result.
    """
    r = resp.select("page_id", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in RESPONSE[1:]])
    html = F.col("payload")
    # In the DOTALL mode Java's $ would also match before a last line end; the
    # patterns below have none.
    title = F.regexp_extract(html, TITLE, 1)
    lang = F.regexp_extract(html, LANG, 1)
    status = F.regexp_extract("http_headers", r"^HTTP/[0-9.]+ ([0-9]{3})", 1)
    r = r.select(
        *RESPONSE[:-1], plain_text(html).alias("plain"), digest(html).alias("payload_digest"),
        status.alias("http_status"), F.concat(
            F.lit("http-status: "), status,
            F.lit("\r\ntitle: "), F.regexp_replace(title, r"[\r\n]+", " "),
            F.lit("\r\nlanguage: "), lang,
            F.lit("\r\noutlinks: "),
            F.regexp_count(html, F.lit(OUTLINK)).cast("string"),
            F.lit("\r\npayload-length: "), F.octet_length(html).cast("string"),
            F.lit("\r\n")).alias("fields"))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"),
                 F.lit("application/warc-fields").alias("content_type"),
                 F.col("fields").alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("plain").alias("block")))
    d = r.select("page_id", "record_id", "target_uri", "warc_date", "http_headers",
                 "http_status", "payload_digest", F.inline(kinds))
    return d.select(
        "page_id", "warc_type",
        _derived_urn().alias("record_id"), F.col("record_id").alias("refers_to"),
        "target_uri", "warc_date", "content_type",
        F.octet_length("block").cast("long").alias("content_length"),
        digest(F.col("block")).alias("block_digest"), "payload_digest", "http_status",
        F.col("http_headers").alias("source_headers"), "block")


def _derived_urn() -> Column:
    h = F.sha2(F.concat_ws("|", F.col("warc_type"), F.col("record_id")), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records as WARC/1.0 files; the line separator is the end of a record.

    Header values hold no line end, so line ends of the source headers are
    folded into one X-Source-Headers field as ``\\r\\n\\t`` continuation lines.
    """
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.col("warc_type"),
        F.lit("\r\nWARC-Record-ID: "), F.col("record_id"),
        F.lit("\r\nWARC-Refers-To: "), F.col("refers_to"),
        F.lit("\r\nWARC-Target-URI: "), F.col("target_uri"),
        F.lit("\r\nWARC-Date: "), F.col("warc_date"),
        F.lit("\r\nWARC-Block-Digest: "), F.col("block_digest"),
        F.lit("\r\nWARC-Payload-Digest: "), F.col("payload_digest"),
        F.lit("\r\nX-Source-Headers: "),
        F.replace(F.regexp_replace("source_headers", r"\r\n$", ""), F.lit("\r\n"),
                  F.lit("\r\n\t")),
        F.lit("\r\nContent-Type: "), F.col("content_type"),
        F.lit("\r\nContent-Length: "), F.col("content_length").cast("string"),
        F.lit("\r\n\r\n"))
    (records.select(F.concat(head, F.col("block")).alias("value"))
     .write.mode("overwrite").option("lineSep", "\r\n\r\n").option("compression", compression)
     .text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers map, block) of every record in WARC files, plain or gzip."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip
        for b in batches:
            for data in b["content"]:
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                at, out = 0, []
                while data.startswith(b"WARC/", at):
                    end = data.index(b"\r\n\r\n", at)
                    lines = data[at:end].replace(b"\r\n\t", b"\n").decode().split("\r\n")[1:]
                    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "")
                                   for x in lines)
                    n = int(headers["Content-Length"])
                    out.append((headers, data[end + 4:end + 4 + n]))
                    at = end + 4 + n + 4
                yield pd.DataFrame(out, columns=["headers", "block"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(parse, "headers map<string,string>, block binary")
