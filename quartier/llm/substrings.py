"""Removal of repeated substrings across documents by suffix arrays.

Every byte covered by a WINDOW-byte string that also starts in a document with
a smaller id is removed. Whole copies are told by digest. For the others:

1. every window owns a content-defined anchor (``anchors``); anchors whose key
   occurs in one document only cannot lie in a repeated string and go no
   further. Keys travel as sorted arrays, one per piece of text and shard.
2. Around each remaining anchor the bytes of the windows that own it form a
   context. Contexts are dealt to shards by key, equal ones of a group of
   documents once, so a passage in a third of all rows costs a shard one
   context per group.
3. A shard sorts the suffixes of its distinct contexts by two-stage sorting;
   runs of adjacent common prefixes of WINDOW bytes give each window the
   smallest document it starts in.
4. Each group of documents applies the answers to its own texts.

Texts are shuffled once, into groups of about GROUP_BYTES; steps 1, 2 and 4
read the same exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .anchors import WINDOW, anchors
from .common import NO_ID, lean, lean_pair, release, texts, without_ids, written
from .suffixes import PAD, common_prefix_reaches, suffix_array

#: Text per group of documents, and per shard of anchors.
GROUP_BYTES = 4 << 20
SHARD_BYTES = 2 << 20
#: Text whose anchors are found at once.
_PIECE = 1 << 20
_LONGEST = 2 * WINDOW  # a context is shorter
_WIDTH = _LONGEST + PAD
_BLOB = "g long, shard long, kind int, a binary, b binary, c binary, d binary"


def _pieces(data: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at, held, size = 0, [], 0
    for t in data:
        held.append(t)
        size += len(t)
        if size >= _PIECE:
            yield at, held
            at, held, size = at + len(held), [], 0
    if held:
        yield at, held


def _all_anchors(data: list[bytes]) -> tuple[np.ndarray, ...]:
    parts = []
    for at, piece in _pieces(data):
        doc, key, lo, hi = anchors(piece)
        parts.append((doc + at, key, lo, hi))
    if not parts:
        parts = [anchors([])]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _split(key: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, 32 bits of the key that are independent of it)."""
    return ((key >> np.uint64(32)) % np.uint64(n_shards)).astype(np.int64), key.astype(np.uint32)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["g", "shard", "kind", "a", "b", "c", "d"])


def _keys(n_shards: int):
    """Step 1, per piece: (shard, keys, which of them occur in two documents)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for g, part in b.groupby("g"):
                data = [t.encode("utf-8", "surrogatepass") for t in part["text"]]
                doc, key, _, _ = _all_anchors(data)
                shard, low = _split(key, n_shards)
                order = np.lexsort((doc, low, shard))
                shard, low, doc = shard[order], low[order], doc[order]
                new = np.append(True, (low[1:] != low[:-1]) | (shard[1:] != shard[:-1]))
                first = np.flatnonzero(new[:len(low)])
                if not len(first):
                    continue
                last = np.append(first[1:], len(low)) - 1
                many = doc[first] != doc[last]
                s, low = shard[first], low[first]
                cut = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
                yield _frame([(int(g), int(s[i]), 0, low[i:j].tobytes(),
                               np.packbits(many[i:j]).tobytes(), None, None)
                              for i, j in zip(cut, np.append(cut[1:], len(s)))])
            release()
    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """Step 1, per shard: each group's keys that two documents hold."""
    # by group, whatever order the shuffle delivers
    keys = [np.frombuffer(x, np.uint32) for x in pdf["a"]]
    many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k))
                           for x, k in zip(pdf["b"], keys)])
    group = np.repeat(pdf["g"].to_numpy(), [len(k) for k in keys])
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    key, many, group = key[order], many[order], group[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(first, len(key)))
    keep = np.repeat((size > 1) | (np.maximum.reduceat(many, first) > 0), size)
    key, group = key[keep], group[keep]
    shard, rows = int(pdf["shard"].iloc[0]), []
    order = np.lexsort((key, group))
    key, group = key[order], group[order]
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else []
    for i, j in zip(cut, np.append(cut[1:], len(group)) if len(group) else []):
        rows.append((int(group[i]), shard, 1, np.unique(key[i:j]).tobytes(), None, None, None))
    return _frame(rows)


class _Group:
    """A group's documents, and the contexts of its shared anchors.

    Equal contexts are numbered once, in the order of their bytes within each
    shard, so steps 2 and 4 agree on the numbers.
    """

    def __init__(self, docs: pd.DataFrame, blobs: pd.DataFrame, n_shards: int):
        docs = docs.sort_values(["doc_id", "text"], kind="stable", ignore_index=True)
        self.ids = docs["doc_id"].to_numpy(np.int64)
        self.data = [t.encode("utf-8", "surrogatepass") for t in docs["text"]]
        known = {int(s): np.frombuffer(a, np.uint32) for s, k, a in
                 zip(blobs["shard"], blobs["kind"], blobs["a"]) if k == 1}
        shared = np.sort(np.concatenate(
            [(np.uint64(s) << np.uint64(32)) | k.astype(np.uint64) for s, k in known.items()]
            or [np.zeros(0, np.uint64)]))
        size = np.array([len(t) for t in self.data], np.int64)
        begin = np.cumsum(size) - size
        doc, key, lo, hi = _all_anchors(self.data)
        shard, low = _split(key, n_shards)
        full = (shard.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)
        if len(shared):
            i = np.minimum(np.searchsorted(shared, full), len(shared) - 1)
            keep = shared[i] == full
        else:
            keep = np.zeros(len(full), bool)
        self.doc, self.lo, shard = doc[keep], lo[keep], shard[keep]
        length = hi[keep] - self.lo + WINDOW
        buf = np.frombuffer(b"".join(self.data) + bytes(_LONGEST), np.uint8)
        col = np.arange(_LONGEST)
        at = begin[self.doc] + self.lo
        rows = np.zeros((len(at), _LONGEST + 5), np.uint8)
        # shard and length lead and follow the bytes, so one sort does all
        rows[:, :4] = shard.astype(">u4").view(np.uint8).reshape(-1, 4)
        rows[:, -1] = length
        for i in range(0, len(at), 100_000):
            j = slice(i, i + 100_000)
            rows[j, 4:-1] = np.where(col < length[j, None], buf[at[j, None] + col], 0)
        void = rows.view(f"V{rows.shape[1]}").ravel()
        order = np.argsort(void, kind="stable")
        new = np.append(True, void[order[1:]] != void[order[:-1]])[:len(order)]
        self.number = np.zeros(len(at), np.int64)
        self.number[order] = np.cumsum(new) - 1
        first = order[new]
        self.rows, self.shard = rows[first], shard[first]
        n = len(first)
        self.low_id = np.full(n, NO_ID)
        np.minimum.at(self.low_id, self.number, self.ids[self.doc])
        self.high_id = np.full(n, -(2 ** 63))
        np.maximum.at(self.high_id, self.number, self.ids[self.doc])
        #: first context of each shard
        self.cut = np.flatnonzero(np.append(True, self.shard[1:] != self.shard[:-1])[:n])


def _contexts(n_shards: int):
    """Step 2, per group: its distinct contexts, by shard."""
    def run(docs: pd.DataFrame, blobs: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return _frame([])
        group = _Group(docs, blobs, n_shards)
        g, rows = int(docs["g"].iloc[0]), []
        for i, j in zip(group.cut, np.append(group.cut[1:], len(group.shard))):
            length = group.rows[i:j, -1]
            inside = np.arange(_LONGEST) < length[:, None]
            rows.append((g, int(group.shard[i]), 2, group.rows[i:j, 4:-1][inside].tobytes(),
                         length.tobytes(), group.low_id[i:j].tobytes(),
                         group.high_id[i:j].tobytes()))
        return _frame(rows)
    return run


def first_documents(rows: np.ndarray, length: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Per row and window start, the smallest ``low`` of all rows that hold the
    window; NO_ID where no window starts. Bytes are raised by one: UTF-8 has no
    byte above 0xF4, and 0 ends a string."""
    n = len(length)
    out = np.full((n, _LONGEST - WINDOW + 1), NO_ID)
    sa = suffix_array(rows, length)
    reach = common_prefix_reaches(rows, length, sa, WINDOW)
    width = rows.shape[1]
    row, col = sa // width, sa % width
    run = np.cumsum(~reach) - 1
    least = np.full(int(run[-1]) + 1, NO_ID) if n else np.zeros(0, np.int64)
    np.minimum.at(least, run, low[row])
    ok = length[row] - col >= WINDOW
    out[row[ok], col[ok]] = least[run[ok]]
    return out


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    """Steps 3, per shard: for each context of each group, runs of windows with
    the smallest document they start in, where that may matter."""
    pdf = pdf.sort_values("g", ignore_index=True)
    lengths = [np.frombuffer(x, np.uint8).astype(np.int64) for x in pdf["b"]]
    length = np.concatenate(lengths)
    low = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["c"]])
    rows = np.zeros((len(length), _WIDTH), np.uint8)
    rows[np.arange(_WIDTH) < length[:, None]] = np.frombuffer(b"".join(pdf["a"]), np.uint8) + 1
    void = rows.view(f"V{_WIDTH}").ravel()
    order = np.argsort(void, kind="stable")
    new = np.append(True, void[order[1:]] != void[order[:-1]])
    number = np.zeros(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    first = order[new]
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, number, low)
    answer = first_documents(rows[first], length[first], least)
    shard, out, at = int(pdf["shard"].iloc[0]), [], 0
    for g, own, high in zip(pdf["g"], lengths, pdf["d"]):
        m = answer[number[at:at + len(own)]]
        at += len(own)
        # a run: equal smallest documents that are smaller than some holder
        useful = m < np.frombuffer(high, np.int64)[:, None]
        change = np.ones(m.shape, bool)
        change[:, 1:] = (m[:, 1:] != m[:, :-1]) | (useful[:, 1:] != useful[:, :-1])
        c, j = np.nonzero(change)
        end = np.where(np.append(c[1:] == c[:-1], False), np.append(j[1:], 0), m.shape[1])
        use = useful[c, j]
        c, j, end = c[use], j[use], end[use]
        if len(c):
            out.append((int(g), shard, 3, c.astype("<i4").tobytes(), j.astype(np.uint8).tobytes(),
                        end.astype(np.uint8).tobytes(), m[c, j].tobytes()))
    return _frame(out)


def _apply(n_shards: int):
    """Step 4, per group: the removed bytes of its documents."""
    def run(docs: pd.DataFrame, blobs: pd.DataFrame) -> pd.DataFrame:
        cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        if not len(docs):
            return pd.DataFrame([], columns=cols)
        group = _Group(docs, blobs, n_shards)
        size = np.array([len(t) for t in group.data], np.int64)
        begin = np.cumsum(size + 1) - size - 1  # one byte between documents
        cover = np.zeros(int(size.sum()) + len(size) + 1, np.int32)
        start = {int(group.shard[i]): i for i in group.cut}
        found = blobs[blobs["kind"] == 3]
        runs = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (
            [np.frombuffer(a, "<i4").astype(np.int64) + start[int(s)]
             for s, a in zip(found["shard"], found["a"])],
            [np.frombuffer(x, np.uint8).astype(np.int64) for x in found["b"]],
            [np.frombuffer(x, np.uint8).astype(np.int64) for x in found["c"]],
            [np.frombuffer(x, np.int64) for x in found["d"]])]
        order = np.argsort(runs[0], kind="stable")
        ctx, lo, hi, least = (x[order] for x in runs)
        count = np.bincount(ctx, minlength=len(group.shard))
        first = np.cumsum(count) - count
        # every place of a context meets the context's runs
        times = count[group.number]
        place = np.repeat(np.arange(len(times)), times)
        run_ = np.repeat(first[group.number] - np.cumsum(times) + times, times) + np.arange(
            times.sum())
        doc = group.doc[place]
        hit = least[run_] < group.ids[doc]
        place, run_, doc = place[hit], run_[hit], doc[hit]
        at = begin[doc] + group.lo[place]
        np.add.at(cover, at + lo[run_], 1)
        np.add.at(cover, at + hi[run_] - 1 + WINDOW, -1)
        gone = np.cumsum(cover) > 0
        out = []
        for d, t, a, n in zip(group.ids.tolist(), group.data, begin.tolist(), size.tolist()):
            own = gone[a:a + n]
            n_gone = int(own.sum())
            if n_gone:
                spans = int(own[0]) + int(np.count_nonzero(own[1:] & ~own[:-1]))
                t = np.frombuffer(t, np.uint8)[~own].tobytes()
            out.append((d, n, n_gone, spans if n_gone else 0, t))
        return pd.DataFrame(out, columns=cols)
    return run


def group_of(n_groups: int) -> Column:
    """A row's group: by id and text, so rows of one id or of none spread."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_groups))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) of every row.

    Null and empty texts, and texts shorter than WINDOW bytes, lose nothing. A
    null doc_id counts as larger than any other. Rows that share an id take
    nothing from each other. Very long texts are read whole. An empty table
    gives an empty result; columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    d = texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    size = F.octet_length("text").cast("long")
    rows = written(d.select("doc_id", size.alias("n_bytes"),
                            F.unhex(F.sha2("text", 256)).alias("digest")),
                   scratch_path(spark, "texts"))
    # Whole copies of a smaller id's text lose everything.
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"))
    by_id = (rows.join(least, "digest").groupBy("doc_id").agg(
        F.min((F.col("least") < F.col("doc_id")) & (F.col("n_bytes") >= WINDOW)).alias("copy")))
    copies = written(by_id.filter("copy").select("doc_id"), scratch_path(spark, "copies"))
    n_bytes = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    n_groups, n_shards = -(-n_bytes // GROUP_BYTES) or 1, -(-n_bytes // SHARD_BYTES) or 1

    x = (without_ids(d, copies)
         .select(group_of(n_groups).alias("g"), "doc_id", "text")
         .repartition(n_groups, "g"))
    shared = (x.mapInPandas(_keys(n_shards), _BLOB)
              .groupBy("shard").applyInPandas(lean(_shared), _BLOB))
    contexts = (x.groupBy("g").cogroup(shared.groupBy("g"))
                .applyInPandas(lean_pair(_contexts(n_shards)), _BLOB))
    answers = contexts.groupBy("shard").applyInPandas(lean(_search), _BLOB)
    out = (x.groupBy("g").cogroup(shared.unionByName(answers).groupBy("g"))
           .applyInPandas(lean_pair(_apply(n_shards)),
                          "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))
    whole = rows.join(copies, "doc_id", "left_semi").select(
        "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept"))
    none = F.lit(None).cast("long")
    return out.unionByName(whole).withColumn(
        "doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).otherwise(none))
