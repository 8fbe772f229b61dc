"""Benchmark decontamination by a prefix-filtered set join.

An item is the set of its windows (``WINDOW`` consecutive words; a shorter item
is one window), a window the sequence of its shingles (``SHINGLE`` words). The
join looks for windows that a document contains whole, so one shingle is a
sufficient prefix: the rarest of the window in the corpus. A place where that
shingle occurs gives one possible start; it must leave room for the window
(position and length bounds) and is then verified word by word.

Windows are broadcast in blocks of bounded size, one pass over the documents
per block, so a benchmark of any size is joined without moving a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, texts

WINDOW = 10
SHINGLE = 5
#: Bytes of window text broadcast at once.
BLOCK_BYTES = 24 << 20

# Word bytes are 0-9, a-z and everything from 0x80; A-Z is lower-cased.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else
              c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
              for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def windows(items: DataFrame) -> DataFrame:
    """Distinct windows of all items: window (words joined by a space), n_words,
    items (their ids as text after a "=", without an id: empty), weight in bytes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for item, text in zip(b["item"], b["text"]):
                w = words(text)
                n = min(WINDOW, len(w))
                out += [(item, b" ".join(w[i:i + n]), n)
                        for i in range(len(w) - n + 1) if n]
            yield pd.DataFrame(out, columns=["item", "window", "n_words"])

    item = F.coalesce(F.concat(F.lit("="), F.col("item_id").cast("string")), F.lit(""))
    return (items.select(item.alias("item"),
                         F.col("text").cast("string").alias("text"))
            .mapInPandas(run, "item string, window binary, n_words int")
            .groupBy("window", "n_words").agg(F.sort_array(F.collect_set("item")).alias("items"))
            .withColumn("weight", F.octet_length("window") + 40 + F.size("items") * 16))


class Block:
    """Windows of one block, indexed for the search; words are numbered from 1."""

    def __init__(self, rows: list):
        self.vocab: dict[bytes, int] = {}
        self.items = [tuple(r["items"]) for r in rows]
        self.length = np.array([r["n_words"] for r in rows], np.int64)
        self.ids = np.zeros((len(rows), WINDOW), np.int32)
        for i, r in enumerate(rows):
            for j, w in enumerate(bytes(r["window"]).split(b" ")):
                self.ids[i, j] = self.vocab.setdefault(w, len(self.vocab) + 1)
        #: shingle sizes in use: the whole of a window shorter than SHINGLE
        self.size = np.minimum(self.length, SHINGLE)
        self.sizes = sorted(set(self.size.tolist()))
        self.shingles = {s: np.unique(np.concatenate([
            rolling(row[:n], s)[0] for row, n, m in zip(self.ids, self.length, self.size)
            if m == s])) for s in self.sizes}
        self.prefix: dict[int, tuple] = {}

    def choose(self, counts: dict[int, dict[int, int]]) -> None:
        """Per window the rarest shingle (ties: the first) and its offset."""
        for s in self.sizes:
            own = np.flatnonzero(self.size == s)
            key = np.zeros(len(own), np.uint64)
            offset = np.zeros(len(own), np.int64)
            for i, at in enumerate(own):
                h = rolling(self.ids[at, :self.length[at]], s)[0]
                offset[i] = min(range(len(h)), key=lambda j: counts[s].get(int(h[j]), 0))
                key[i] = h[offset[i]]
            order = np.argsort(key, kind="stable")
            uniq, start = np.unique(key[order], return_index=True)
            self.prefix[s] = (uniq, np.append(start, len(order)), own[order], offset[order])

    def number(self, text: str) -> np.ndarray:
        w = words(text)
        return np.fromiter(map(self.vocab.get, w, repeat(0)), np.int32, len(w))


def rolling(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of each run of ``size`` known words."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    known = np.concatenate([[0], np.cumsum(ids > 0)])
    at = np.flatnonzero(known[size:] - known[:n] == size)
    h = np.zeros(len(at), np.uint64)
    for j in range(size):
        h = h * _BASE + ids[at + j].astype(np.uint64)
    return h, at


def _lookup(sorted_keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of h occur, their index in sorted_keys)."""
    i = np.minimum(np.searchsorted(sorted_keys, h), len(sorted_keys) - 1)
    hit = np.flatnonzero(sorted_keys[i] == h)
    return hit, i[hit]


def _search(block: Block, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
    """Runs of words inside occurring windows, and the items of those windows."""
    runs, items = [], set()
    for s in block.sizes:
        keys, starts, owners, offsets = block.prefix[s]
        h, at = rolling(ids, s)
        if not len(h):
            continue
        hit, k = _lookup(keys, h)
        if not len(hit):
            continue
        n_each = starts[k + 1] - starts[k]
        first = np.repeat(starts[k] - np.cumsum(n_each) + n_each, n_each)
        entry = first + np.arange(len(first))
        win = owners[entry]
        begin = np.repeat(at[hit], n_each) - offsets[entry]
        fits = (begin >= 0) & (begin + block.length[win] <= len(ids))
        win, begin = win[fits], begin[fits]
        span = np.arange(WINDOW)
        inside = span < block.length[win][:, None]
        there = ids[np.minimum(begin[:, None] + span, len(ids) - 1)]
        same = ((there == block.ids[win]) | ~inside).all(axis=1)
        win, begin = win[same], begin[same]
        runs += zip(begin.tolist(), (begin + block.length[win]).tolist())
        for w in np.unique(win).tolist():
            items.update(block.items[w])
    return runs, items


def _union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _count_shingles(docs: DataFrame, held) -> dict[int, dict[int, int]]:
    """Occurrences of the block's shingles in the whole corpus."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = held.value
        total = {s: np.zeros(len(k), np.int64) for s, k in block.shingles.items()}
        for b in batches:
            for text in b["text"]:
                ids = block.number(text)
                for s, keys in block.shingles.items():
                    h, _ = rolling(ids, s)
                    if len(h):
                        total[s] += np.bincount(_lookup(keys, h)[1], minlength=len(keys))
        for s, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"size": np.int32(s), "at": at, "n": n[at]})

    rows = (docs.select("text").mapInPandas(run, "size int, at long, n long")
            .groupBy("size", "at").agg(F.sum("n").alias("n")).collect())
    out: dict[int, dict[int, int]] = {s: {} for s in held.value.sizes}
    for r in rows:
        out[r["size"]][int(held.value.shingles[r["size"]][r["at"]])] = r["n"]
    return out


_SPANS = "array<struct<a:int,b:int>>"


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text, n_words, spans of hit words, items: one row per input row.

    Null or empty texts have no words; items without a word have no window; an
    empty benchmark hits nothing; a null doc_id stays null; repeated rows
    repeat; items that share an id are one item, those without one too (null in
    ``items``); other columns are ignored.
    """
    spark = docs.sparkSession
    d = texts(docs).select("doc_id", "text",
                           F.array().cast(_SPANS).alias("spans"),
                           F.array().cast("array<string>").alias("items"),
                           F.lit(-1).cast("long").alias("n_words"))
    schema = f"doc_id long, text string, spans {_SPANS}, items array<string>, n_words long"

    def step(held):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            block = held.value if held else None
            for b in batches:
                spans, found, n_words = [], [], []
                for text, old, had in zip(b["text"], b["spans"], b["items"]):
                    if block is None:
                        n_words.append(len(words(text)))
                        runs, items = [], set()
                    else:
                        ids = block.number(text)
                        n_words.append(len(ids))
                        runs, items = _search(block, ids)
                    runs = _union(runs + [(x["a"], x["b"]) for x in old])
                    spans.append([{"a": x, "b": y} for x, y in runs])
                    found.append(sorted(items.union(had)))
                yield pd.DataFrame({"doc_id": b["doc_id"], "text": b["text"], "spans": spans,
                                    "items": found, "n_words": n_words})
        return run

    n = 0
    for rows in blocks(windows(items), "weight", BLOCK_BYTES):
        block = Block(rows)
        block.choose(_count_shingles(d, spark.sparkContext.broadcast(block)))
        if n:  # one pass at a time: a chain would hold several blocks at once
            d = d.checkpoint()
        d = d.mapInPandas(step(spark.sparkContext.broadcast(block)), schema)
        n += 1
    d = d if n else d.mapInPandas(step(None), schema)
    return d.withColumn("items", F.transform(
        "items", lambda x: F.when(x != "", F.substring(x, 2, 2**31 - 1))))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row (see find).

    Items without an id count as one, of which items_sha256 has nothing."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"),
                        lambda n, x: n + (x["b"] - x["a"]).cast("long"))
    return find(docs, items).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
