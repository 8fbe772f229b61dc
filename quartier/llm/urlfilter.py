"""Exact URL membership through a cascade of Bloom filters.

The universe (every key of the corpus) is known, so the false positives of a
filter are known too. Level 0 encodes the listed keys; level 1 encodes those
unlisted keys that level 0 lets through; level 2 the listed keys that level 1
lets through; and so on until none is left. A key of the universe is listed if
the first level that rejects it is an odd one. Keys are split into shards by
hash; a shard's cascade is built in one task and probing needs no join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks

#: Distinct keys per shard, about; a shard is built in the memory of one task.
SHARD_KEYS = 250_000
#: Bytes of cascades broadcast at once; more are probed in further passes.
BROADCAST_BYTES = 64 << 20
_CASCADE = "shard long, n_bytes long, bits binary"
_MAX_LEVELS = 200


@dataclass(frozen=True)
class UrlRule:
    """Allow or block the urls of a host and its subdomains below a path."""
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ? or #; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest fitting rule, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.path))):
        fits = (((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path))
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def _key_hashes(key: Column) -> list[Column]:
    key = F.coalesce(key, F.lit(""))
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit("second")).alias("h2")]


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser over uint64."""
    x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hits(bits: np.ndarray, m: int, k: int, level: int, h1: np.ndarray, h2: np.ndarray
          ) -> np.ndarray:
    a, b = _mix(h1, 2 * level + 1), _mix(h2, 2 * level + 2) | np.uint64(1)
    out = np.ones(len(h1), bool)
    for i in range(k):
        at = (a + np.uint64(i) * b) % np.uint64(m)
        out &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def _level(n_in: int, n_out: int, level: int, h1: np.ndarray, h2: np.ndarray
           ) -> tuple[np.ndarray, int, int]:
    """A filter over n_in keys; level 0 lets through about as many others as
    it holds, later ones about half of them."""
    fpr = 0.5 if level else min(0.5, 0.7 * n_in / max(n_out, 1))
    k = max(1, round(-np.log2(fpr)))
    m = max(64, int(np.ceil(n_in * k / np.log(2))))
    bits = np.zeros(m // 8 + 1, np.uint8)
    a, b = _mix(h1, 2 * level + 1), _mix(h2, 2 * level + 2) | np.uint64(1)
    for i in range(k):
        at = (a + np.uint64(i) * b) % np.uint64(m)
        np.bitwise_or.at(bits, at >> np.uint64(3),
                         (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))
    return bits, m, k


def _build(listed: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> bytes:
    """Serialised cascade: per level m, k, byte length, bits."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    out, level = [], 0
    while len(inside):
        if level >= _MAX_LEVELS:
            raise ValueError("a listed and an unlisted key share a 128-bit hash")
        bits, m, k = _level(len(inside), len(outside), level, h1[inside], h2[inside])
        out.append(np.array([m, k, len(bits)], "<u8").tobytes() + bits.tobytes())
        through = outside[_hits(bits, m, k, level, h1[outside], h2[outside])]
        inside, outside, level = through, inside, level + 1
    return b"".join(out)


def _levels(blob: bytes) -> list[tuple[np.ndarray, int, int]]:
    out, at = [], 0
    while at < len(blob):
        m, k, n = (int(x) for x in np.frombuffer(blob, "<u8", 3, at))
        out.append((np.frombuffer(blob, np.uint8, n, at + 24), m, k))
        at += 24 + n
    return out


def _member(levels: list, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the parity of the level that rejects it."""
    left = np.arange(len(h1))
    out = np.zeros(len(h1), bool)
    for level, (bits, m, k) in enumerate(levels):
        hit = _hits(bits, m, k, level, h1[left], h2[left])
        out[left[~hit]] = level % 2 == 1
        left = left[hit]
    out[left] = len(levels) % 2 == 1
    return out


def build_cascade(universe: DataFrame, key: str, listed: Column) -> tuple[DataFrame, int]:
    """Cascades over every distinct key of ``universe``: (table, n_shards).

    A key is listed if any of its rows is. Equal keys are merged map-side, so
    a key holding a third of the rows costs one row per task. A null key is the
    empty key; an empty universe or listing gives no level, i.e. no member.
    """
    h1, h2 = _key_hashes(F.col(key))
    keys = (universe.select(h1, h2, F.coalesce(listed, F.lit(False)).alias("listed"))
            .groupBy("h1", "h2").agg(F.max("listed").alias("listed")))
    n_shards = max(1, -(-universe.select(key).count() // SHARD_KEYS))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        blob = _build(pdf["listed"].to_numpy(bool), a, b)
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "n_bytes": [len(blob)],
                             "bits": [blob]})

    table = (keys.withColumn("shard", F.pmod("h1", F.lit(n_shards)))
             .groupBy("shard").applyInPandas(build, _CASCADE))
    return table, n_shards


def probe(df: DataFrame, key: str, cascade: DataFrame, n_shards: int) -> DataFrame:
    """``df`` with a boolean ``is_listed``: exact for keys of the universe.

    Cascades are broadcast in blocks of at most BROADCAST_BYTES; each block is
    one pass over the rows of its shards.
    """
    spark = df.sparkSession
    h1, h2 = _key_hashes(F.col(key))
    rows = df.withColumns({"_h1": h1, "_h2": h2})
    rows = rows.withColumn("_shard", F.pmod("_h1", F.lit(n_shards)))
    out, seen = None, []
    for block in blocks(cascade, "n_bytes", BROADCAST_BYTES):
        held = spark.sparkContext.broadcast({r["shard"]: bytes(r["bits"]) for r in block})
        shards = sorted(held.value)

        @F.pandas_udf("boolean")
        def is_listed(it: Iterator[tuple[pd.Series, pd.Series, pd.Series]]
                      ) -> Iterator[pd.Series]:
            levels = {s: _levels(b) for s, b in held.value.items()}
            for shard, a, b in it:
                shard = shard.to_numpy()
                a, b = (x.to_numpy(np.int64).view(np.uint64) for x in (a, b))
                member = np.zeros(len(shard), bool)
                for s in np.unique(shard):
                    at = np.flatnonzero(shard == s)
                    member[at] = _member(levels.get(int(s), []), a[at], b[at])
                yield pd.Series(member)

        part = rows if len(shards) == n_shards else rows.filter(F.col("_shard").isin(shards))
        part = part.withColumn("is_listed", is_listed("_shard", "_h1", "_h2"))
        out = part if out is None else out.unionByName(part)
        seen += shards
    if out is None or len(seen) < n_shards:  # shards without a key
        part = rows if out is None else rows.filter(~F.col("_shard").isin(seen))
        part = part.withColumn("is_listed", F.lit(False))
        out = part if out is None else out.unionByName(part)
    return out.drop("_h1", "_h2", "_shard")


def judge(pages: DataFrame, rules: Sequence[UrlRule], listed_host: Column) -> DataFrame:
    """page_id, host, path, rule, verdict of every page row.

    ``listed_host`` (over ``host``) lists the keys to block; a key is host plus
    path. The longest fitting rule decides, else the cascade. A null url, or
    one without ://, has an empty host and path; a null page_id stays null;
    repeated rows repeat; an empty table gives an empty result; columns other
    than page_id and url are ignored.
    """
    url = F.col("url").cast("string")
    d = pages.select(F.col("page_id").cast("long").alias("page_id"),
                     url_host(url).alias("host"), url_path(url).alias("path"))
    d = d.withColumn("key", F.concat("host", "path"))
    cascade, n_shards = build_cascade(d, "key", listed_host)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("is_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return probe(d, "key", cascade, n_shards).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, method).alias("verdict"))
