"""One registered query per operator, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (decontaminate, dialogue, jaccard, maxent, merkle, packing, pii,
               quality, rules, substrings, tokencount, urlfilter, warc)
from .common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


URL_RULES = [
    urlfilter.UrlRule("allow", "org", "/"),
    urlfilter.UrlRule("block", "example.org", "/es/"),
    urlfilter.UrlRule("block", "example.org", "/en/1"),
    urlfilter.UrlRule("allow", "com", "/fr/"),
    urlfilter.UrlRule("block", "com", "/de/"),
]
#: Hosts with such a word between dots or dashes are listed.
LISTED_HOST = r"(^|[.-])(adult|spam|pills|ads|casino|bets|porn|malware)([.-]|$)"


@_query("op2_url_filters", f"""
WITH p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
k AS (SELECT DISTINCT host, path FROM p),
f AS (
  SELECT host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
    max_by(verdict, length(rhost || rpath)) AS verdict
  FROM k JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(verdict,
    CASE WHEN regexp_matches(p.host, '{LISTED_HOST}') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN f ON p.host = f.host AND p.path = f.path""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES,
                           F.col("host").rlike(LISTED_HOST))


@_query("op3_decontamination", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
    SELECT item_id, w, least(10, len(w)) AS n,
      unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i
    FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
    SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
    FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, dw.n, i FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
hw AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
hi AS (
  SELECT doc_id, count(*) AS n_items,
    string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))


@_query("op4_quality_rules", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (
      SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3))),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '^[^a-z]*[A-Z]{2}[^a-z]*$'))) AS n_capital_words
  FROM d LEFT JOIN r USING (doc_id)),
f AS (
  SELECT *, CAST(n_words < 50 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS BIGINT)
    + 4 * CAST(10 * n_symbols > 3 * n_words AS BIGINT)
    + 8 * CAST(10 * n_dup_lines > 3 * n_lines AS BIGINT)
    + 16 * CAST(2 * n_capital_words > n_words AS BIGINT)
    + 32 * CAST(word_chars > 20 * n_words AS BIGINT)
    + 64 * CAST(word_chars < 2 * n_words AS BIGINT) AS fail_bits
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
  fail_bits = 0 AS kept, CAST(fail_bits AS BIGINT) AS fail_bits
FROM f""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = rules.ledger(table(spark, sf_dir, "documents"))
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes("base")).alias("base_failed"),
        (rules.passes("base") & rules.passes("v1")).alias("kept"), "fail_bits")


@_query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencount.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        scratch_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def _warc_sql() -> str:
    plain = f"regexp_replace(html, '{warc.HIDDEN}', '', 'g')"
    plain = f"regexp_replace({plain}, '{warc.BLOCKS}', chr(10), 'g')"
    plain = f"regexp_replace({plain}, '{warc.TAGS}', '', 'g')"
    for name, char in warc.ENTITIES:
        quoted = [x.replace("'", "''") for x in (name, char)]
        plain = f"replace({plain}, '{quoted[0]}', '{quoted[1]}')"
    plain = rf"regexp_replace({plain}, '[ \t\x0B\f\r]+', ' ', 'g')"
    plain = rf"regexp_replace({plain}, ' ?\n[ \n]*', chr(10), 'g')"
    plain = rf"regexp_replace({plain}, '^[ \n]+|[ \n]+$', '', 'g')"
    urn = ("'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || "
           "substr({h}, 13, 4) || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12) || '>'")
    crlf = "chr(13) || chr(10)"
    return rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
    sha256('response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '') ||
      '|' || sha256(coalesce(html, ''))) AS h
  FROM pages),
r AS (
  SELECT page_id, url AS target_uri, {urn.format(h="h")} AS refers_to, {plain} AS plain,
    'sha256:' || sha256(html) AS payload_digest, '200' AS http_status,
    'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf} ||
      'Content-Length: ' || CAST(strlen(html) AS VARCHAR) || {crlf} AS source_headers,
    'http-status: 200' || {crlf} || 'title: ' || regexp_replace(regexp_extract(html,
      '(?is)<title[^>]*>(.*?)</title', 1), '[\r\n]+', ' ', 'g') || {crlf} || 'language: ' ||
      regexp_extract(html, '(?i)<html\b[^>]*?\blang="([^"]*)"', 1) || {crlf} || 'outlinks: ' ||
      CAST(len(regexp_extract_all(html, '(?i)<a\s[^>]*href')) AS VARCHAR) || {crlf} ||
      'payload-length: ' || CAST(strlen(html) AS VARCHAR) || {crlf} AS fields
  FROM p),
d AS (
  SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
    fields AS block FROM r
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', plain FROM r),
e AS (SELECT *, sha256(warc_type || '|' || refers_to) AS h FROM d)
SELECT page_id, warc_type, {urn.format(h="h")} AS record_id, refers_to, target_uri,
  '2024-01-01T00:00:00Z' AS warc_date, content_type,
  CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest,
  payload_digest, http_status, source_headers, block
FROM e"""


@_query("op8_warc_derivatives", _warc_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


@_query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))


@_query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op1_lm_scoring")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"), fold(7) != 2)


@_query("op5_ngram_jaccard", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (
    SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i
    FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (
  SELECT doc_id AS x, doc_id AS y FROM w
  UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.y) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN r ON r.x = w.doc_id GROUP BY ALL""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@_query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

#: Unsigned crc32 of ASCII text ``x``, bit by bit (null: null).
_CRC32 = """xor(list_reduce(flatten(list_transform(string_split({x}, ''),
    lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, 3988292384 * (c & 1)) END,
    CAST(4294967295 AS BIGINT)), 4294967295)"""


def _merkle_sql(levels: int = 7, crown: int = 5) -> str:
    """Trees of up to 16^levels leaves and 16^crown sources; a group that has
    come down to one node is carried upwards unchanged."""
    def framed(c: str) -> str:
        v = f"CAST({c} AS VARCHAR)"
        return f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')"

    def leaf(text: str) -> str:
        return ("sha256(" + " || ".join(framed(c) for c in (*merkle.FIELDS[:-1], text)) + ")")

    low = ("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    out = [f"""leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {leaf('text')} AS h,
    coalesce(crc32 % 5 = 0, false) AS struck, {leaf(low)} AS low
  FROM (SELECT *, {_CRC32.format(x="CAST(doc_id AS VARCHAR)")} AS crc32 FROM documents)),
n0 AS (
  SELECT g, h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
    count(*) OVER (PARTITION BY g) AS n, doc_id,
    CASE WHEN struck THEN low ELSE h END AS f FROM leaves),
p0 AS (SELECT doc_id, h AS leaf, f, g, i, n, '' AS path FROM n0)"""]

    def climb(nodes: str, rows: str, k: int) -> str:
        """One level: runs, their parents, and the rows' folded digests."""
        return f"""
{nodes}r{k} AS (SELECT g, i // 16 AS run, any_value(n) AS n, list(h ORDER BY i) AS hs
  FROM {nodes}{k} GROUP BY g, i // 16),
{nodes}{k + 1} AS (SELECT g, run AS i, CASE WHEN n > 1 THEN (n + 15) // 16 ELSE 1 END AS n,
  CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {nodes}r{k}),
{rows}{k + 1} AS (
  SELECT * EXCLUDE (i, n, f, path, before, after, run, rn), run AS i,
    CASE WHEN rn > 1 THEN (rn + 15) // 16 ELSE 1 END AS n,
    CASE WHEN rn > 1 THEN sha256(before || f || after) ELSE f END AS f,
    path || before || after AS path
  FROM (SELECT p.*, run, r.n AS rn, array_to_string(hs[1:i % 16], '') AS before,
          array_to_string(hs[i % 16 + 2:], '') AS after
        FROM {rows}{k} p JOIN {nodes}r{k} r ON p.g = r.g AND p.i // 16 = r.run))"""

    out += [climb("n", "p", k) for k in range(levels)]
    out.append(f"""
s0 AS (SELECT '' AS g, g AS member, h, row_number() OVER (ORDER BY g) - 1 AS i,
  count(*) OVER () AS n FROM n{levels}),
q0 AS (
  SELECT doc_id, leaf, f, path, s0.h AS subroot, s0.g, s0.i, s0.n
  FROM p{levels} p JOIN s0 ON p.g = s0.member)""")
    out += [climb("s", "q", k) for k in range(crown)]
    return "WITH " + ",".join(out) + f"""
SELECT doc_id, leaf, subroot, s.h AS root, sha256(path) AS proof_sha256, f AS folded_root,
  f = s.h AS verified
FROM q{crown} JOIN s{crown} s ON q{crown}.g = s.g"""


@_query("op13_merkle_manifest", _merkle_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.manifest(table(spark, sf_dir, "documents"))
    folded = merkle.fold(F.coalesce("forged", "leaf"), F.col("path"))
    return (rows.select("doc_id", "leaf", "subroot", "root",
                        merkle.proof(F.col("path")).alias("proof_sha256"),
                        folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


@_query("op12_pii")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), "spans")


def _dialogue_sql() -> str:
    """The edit lattice column by column: per state the cheapest (cost, audit,
    text) so far, first by the edits that use a row, then by inserts."""
    far = "{'c': 1000000, 'a': '', 't': ''}"

    def step(state: str, cost: str, op: str, text: str = "''") -> str:
        return (f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{op}', "
                f"'t': {state}.t || {text}}}")

    def least(*xs: str) -> str:
        return f"list_sort([{', '.join(xs)}])[1]"

    def message(role: str, text: str = "''") -> str:
        return f"chr(10) || {role} || ':' || {text}"

    user, assistant = message("'user'"), message("'assistant'")

    def closed(v: str) -> str:
        """Inserts after the row's own edits, ``v`` = list of the four states."""
        to_u = least(f"{v}[3]", *[step(f"{v}[{i}]", "2", "I", user) for i in (1, 2, 4)])
        return (f"list_transform([{to_u}], lambda u: [{v}[1], {v}[2], u, "
                f"{least(f'{v}[4]', step('u', '2', 'I', assistant))}])[1]")

    def used(s: str) -> str:
        keep = message("x.role", "x.text")
        delete = [step(f"{s}[{i}]", "3", "D") for i in (1, 2, 3, 4)]

        def kept(i: int, initial: str) -> str:
            return (f"CASE WHEN x.ini = '{initial}' AND x.f < 2 THEN "
                    f"{step(f'{s}[{i}]', 'x.f', 'K', keep)} ELSE {far} END")

        def named(i: int, role: str) -> str:
            return (f"CASE WHEN x.f < 2 THEN "
                    f"{step(f'{s}[{i}]', '2 + x.f', 'R', message(repr(role), 'x.text'))} "
                    f"ELSE {far} END")
        return "[" + ", ".join([
            delete[0], least(delete[1], kept(1, "s")),
            least(delete[2], *[kept(i, "u") for i in (1, 2, 4)],
                  *[named(i, "user") for i in (1, 2, 4)]),
            least(delete[3], kept(3, "a"), named(3, "assistant"))]) + "]"

    start = closed(f"[{{'c': 0, 'a': '', 't': ''}}, {far}, {far}, {far}]")
    body = f"list_transform([{used('s.st')}], lambda v: {closed('v')})[1]"
    crc = _CRC32.format(x="coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || "
                          "coalesce(CAST(turn AS VARCHAR), ' ')")
    return rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc} % 20 AS k FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
      ELSE text END AS text,
    unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM c WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text), copy) AS i FROM d),
q AS (
  SELECT *, substr(role, 1, 1) AS ini,
    CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 2
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 3
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 1 ELSE 0 END AS f,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev
  FROM o),
r AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (f = 2) AS blank, count(*) FILTER (f = 3) AS duplicate,
    count(*) FILTER (f = 1) AS truncated,
    count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'st': [{far}], 'ini': ini, 'f': f, 'role': role, 'text': text}} ORDER BY i) AS rows
  FROM q GROUP BY conv_id),
z AS (
  SELECT * EXCLUDE (rows), list_reduce(rows, lambda s, x: {{'st': {body}, 'ini': '', 'f': 0,
      'role': '', 'text': ''}}, {{'st': {start}, 'ini': '', 'f': 0, 'role': '', 'text': ''}}).st
    AS st FROM r),
b AS (SELECT *, list_sort([st[1], st[4]])[1] AS w FROM z)
SELECT x.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps,
  CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(w.c, 0) AS BIGINT) AS cost,
  coalesce(w.a, '') AS audit, sha256(coalesce(substr(w.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x
LEFT JOIN b ON x.conv_id IS NOT DISTINCT FROM b.conv_id"""


@_query("op11_conversation_repair", _dialogue_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return dialogue.repair(dialogue.damage(rows), rows.select("conv_id"))
