import random
import re
import time

from quartier.llm import warc
from quartier.session import scratch_path

HTML = ('<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><script>var t="</p>";</script>'
        '<style>p{}</style></head><body><!-- x --><p>One <b>two</b>&nbsp;three<br>four</p><a href="/x">l</a>'
        "<ul><li>i</li></ul> 1 < 2 &lt;b&gt;</body></html>")


def test_records_link_back_and_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://x/é", HTML, "b"), (2, None, None, None), (None, "u", "plain", ""),
                                   (3, "http://x", "", ""), (1, "http://x/é", HTML, "b")],
                                  "page_id long, url string, html string, block string")
    resp = warc.responses(pages)
    rec = warc.derivatives(resp)
    rows = rec.collect()
    assert len(rows) == 10
    refs = {r["record_id"] for r in resp.collect()}
    assert {r["refers_to"] for r in rows} == refs
    text = next(r["block"] for r in rows if r["page_id"] == 1 and r["warc_type"] == "conversion")
    assert text == "A & B\nOne two three\nfour\nl\ni\n1 < 2 <b>"
    meta = next(r["block"] for r in rows if r["page_id"] == 1 and r["warc_type"] == "metadata")
    assert "language: fr\r\n" in meta and "outlinks: 1\r\n" in meta and "http-status: 200" in meta
    path = scratch_path(spark, "warc")
    warc.write_warc(rec, path)
    back = warc.read_warc(spark, path).collect()
    assert len(back) == 10
    want = {r["record_id"]: r for r in rows}
    for b in back:
        h, r = b["headers"], want[b["headers"]["WARC-Record-ID"]]
        assert bytes(b["block"]) == r["block"].encode()
        assert h["WARC-Refers-To"] == r["refers_to"] and h["WARC-Payload-Digest"] == r["payload_digest"]
        assert h["WARC-Block-Digest"] == r["block_digest"] and h["WARC-Type"] == r["warc_type"]
        assert h["X-Source-Headers"].replace("\n", "\r\n") + "\r\n" == r["source_headers"]


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derivatives(warc.responses(pages)).count() == 0


def test_ids_tell_payloads_apart(spark):
    pages = spark.createDataFrame([(None, "u", "a"), (None, "u", "b"), (None, "u", None)],
                                  "page_id long, url string, html string")
    rec = warc.derivatives(warc.responses(pages)).collect()
    assert len({r["record_id"] for r in rec}) == 6


def _plain(html):
    """The definition, by the patterns as they stand."""
    t = re.sub(warc.HIDDEN, "", html)
    t = re.sub(warc.BLOCKS, "\n", t)
    t = re.sub(warc.TAGS, "", t)
    for name, char in warc.ENTITIES:
        t = t.replace(name, char)
    t = re.sub(r"[ \t\x0B\f\r]+", " ", t)
    return re.sub(r" ?\n[ \n]*", "\n", t).strip(" \n")


def _fields(html):
    title = re.search(r"(?is)<title[^>]*>(.*?)</title", html)
    lang = re.search(r'(?i)<html\b[^>]*?\blang="([^"]*)"', html)
    return (re.sub(r"[\r\n]+", " ", title[1]) if title else "", lang[1] if lang else "",
            len(re.findall(r"(?i)<a\s[^>]*href", html)))


def test_broken_pages_match_the_plain_patterns(spark, monkeypatch):
    """Random pages of marks that do not close, with openings set aside from the first on."""
    monkeypatch.setattr(warc, "OPENINGS", 0)
    parts = ["<script", "<SCRIPT>", "</script>", "</script ", "<style>", "</style>", "<!--", "-->", "<p>", "<p ",
             "<a ", "href", ">", "<html", ' lang="', '"', "<title", "<Title>", "</title>", "x", " ", "\n", "\x01", "1",
             "0", "-", "<", "!", "&lt;", "é"]
    rnd = random.Random(7)
    html = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 40))) for _ in range(3000)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)],
                                  "page_id long, url string, html string")
    rec = warc.derivatives(warc.responses(pages)).select("page_id", "warc_type", "block").collect()
    for r in rec:
        h = html[r["page_id"]]
        if r["warc_type"] == "conversion":
            assert r["block"] == _plain(h), repr(h)
        else:
            title, lang, links = _fields(h)
            assert f"title: {title}\r\nlanguage: {lang}\r\noutlinks: {links}\r\n" in r["block"], repr(h)


def test_a_megabyte_of_openings_takes_seconds(spark):
    marks = ["<!--", "<script ", "<style ", "<title>", "<title", "<a ", "<html ", "<p ", "<x"]
    pages = spark.createDataFrame([(i, "u", m * (1_000_000 // len(m)) + end)
                                   for i, m in enumerate(marks) for end in ("", "<p>", "-->")],
                                  "page_id long, url string, html string")
    began = time.monotonic()
    assert warc.derivatives(warc.responses(pages)).agg({"content_length": "sum"}).first()[0] > 0
    assert time.monotonic() - began < 60
