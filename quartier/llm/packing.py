"""Lexical retrieval packing: fill training windows with related documents.

Documents become token ids in one pass. Whole windows inside a long document
are sequences of their own; the rest of each document, its tail, is packed with
others. Tails are dealt to shards of bounded size by content: a document's BM25
weights, with the document frequencies of the whole corpus, are projected to a
short vector, and vectors go to the nearest of the corpus's centroids, found in
two levels; only what is still too large (copies) is split by row. Each shard builds a BM25 inverted index over its documents'
token ids. A seed document asks the index for unused neighbours, which fill its
window greedily; the last one is cut where the window ends and its remainder
seeds the next.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import release, texts, written

WINDOW = 2048
#: Documents per shard, about.
SHARD_DOCS = 1000
#: Terms of a seed that are asked for: those of the largest BM25 weight.
QUERY_TERMS = 32
#: Documents encoded at once, and bytes of their texts, about; the more, the fewer
#: times a word is looked up and the more a worker holds.
BATCH, BATCH_BYTES = 1000, 4 << 20
#: Bytes of texts whose ids are counted in 32 bits.
_SMALL = 1 << 26
#: Neighbours looked at for one that fits before one is cut.
LOOK = 16
K1, B = 1.2, 0.75
#: Terms whose document frequencies travel in one row.
_TERMS = 4096
#: Length of the vectors that documents are dealt by, and places of a direction.
DIM, SPARSE = 64, 8
#: Centroids of the first level, at most; the second level grows with the corpus.
CELLS = 512
#: Vectors that the centroids are found on, per centroid.
SAMPLE = 64
#: Remembered pieces per worker; beyond it the memory starts afresh.
MEMORY = 200_000

# White space as the tokenizer's pattern sees it.
_SPACE = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORD = re.compile(f"[^{_SPACE}]+")
#: Characters that Unicode takes for white space and the tokenizer does not.
_ODD = "[\x1c-\x1f]"
# ASCII punctuation, which the pre-tokenizer cuts off a word as one piece.
_TAIL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Stands for the end of a word in merges; plain words do not hold it.
_STOP = "\x00"

_DOC = ("doc_id long, doc_tokens long, full binary, tail binary, terms binary, tf binary")
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, `offset` long")


def _plain(word: str) -> bool:
    """Latin letters that need no normalising beyond lower case, one for one."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and "\u0130" not in word))


def _byte_of_char() -> dict[str, int]:
    """Byte-level tokenizers write bytes as printable characters: those that are
    printable in Latin-1 as themselves, the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Ids of many plain words at once, by the vocabulary's own merges.

    Each word is written with a stop byte for the end-of-word mark. The marked
    single bytes come before all merges in the vocabulary, so the stop joins the
    last byte first, as the mark requires; a token that holds it ends a word.
    """

    def __init__(self, tok, dtype: np.dtype):
        import tiktoken
        byte, added = _byte_of_char(), set(tok.get_added_tokens_decoder())
        ranks = {}
        for token, i in tok.get_vocab(with_added_tokens=False).items():
            if i not in added:
                body = token.removesuffix("</w>")
                ranks[bytes(byte[c] for c in body) + _STOP.encode() * (body != token)] = i
        self.dtype = dtype
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[i for t, i in ranks.items() if t.endswith(b"\0") and len(t) > 1]] = True
        self.bpe = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks,
                                     special_tokens={})

    def ids(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        ids = self.bpe.encode_to_numpy(_STOP.join(words) + _STOP)
        cut = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
        raw = ids.astype(self.dtype).tobytes()
        cut = cut.tolist()
        if len(cut) != len(words):
            raise ValueError("a word does not end where its tokens do")
        return [raw[a:b] for a, b in zip([0, *cut], cut)]


class Encoder:
    """Token ids of texts by way of their distinct words: plain words are merged
    in bulk, the ids of other pieces come from the library and are remembered.

    Used for tokenizers that drop white space and treat words one by one; a
    text holding the string of an added token goes to the library whole.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 65536 else "<u4")
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {"": b""}
        vocab = self.tok.get_vocab(with_added_tokens=False)
        marked = all(c + "</w>" in vocab and vocab[c + "</w>"] < 512 and vocab[c] < 512
                     for c in _byte_of_char())
        self.merges = Merges(self.tok, self.dtype) if marked else None
        self.end = np.array([end], self.dtype)

    def _ids(self, items: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tok.encode_batch_fast(items, add_special_tokens=False)]

    def _known(self, items: list[str]) -> list[bytes]:
        """Ids by the library, remembered."""
        if len(self.known) > MEMORY:
            self.known = {"": b""}
        ask = list(set(items).difference(self.known))
        self.known.update(zip(ask, self._ids(ask)))
        return list(map(self.known.__getitem__, items))

    def _pieces(self, words: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of pieces, and the two pieces of each word: its letters, merged in
        bulk, and a tail of punctuation; or nothing and the whole word, if it is
        for the library. Piece 0 is empty."""
        body = pc.utf8_rtrim(words, _TAIL).dictionary_encode()
        core = [c.lower() if c.isalpha() and (c.isascii() or _plain(c)) else ""
                for c in _strings(body.dictionary)]
        if not self.merges:
            core = [""] * len(core)
        cores = sorted(set(core) - {""})
        number = dict(zip(cores, range(1, len(cores) + 1)))
        number[""] = 0
        first = np.fromiter(map(number.__getitem__, core), np.int32, len(core))[
            body.indices.to_numpy()]
        length = np.fromiter(map(len, core), np.int32, len(core))[body.indices.to_numpy()]
        tailed = np.flatnonzero((first == 0) | (length < pc.utf8_length(words).to_numpy()))
        tails = [w[n:] for w, n in zip(_strings(words.take(pa.array(tailed))),
                                       length[tailed].tolist())]
        rest = list(set(tails) - {""})
        number = dict(zip(rest, range(len(cores) + 1, len(cores) + 1 + len(rest))))
        number[""] = 0
        second = np.zeros(len(words), np.int32)
        second[tailed] = [number[t] for t in tails]
        merged = self.merges.ids(cores) if cores else []
        return [b"", *merged, *self._known(rest)], np.stack([first, second], axis=1)

    def arrays(self, batch: pa.Array) -> list[np.ndarray]:
        """Ids of each text, and the end id. Words are cut and told apart by
        Arrow: Python sees the distinct ones only."""
        apart = pc.match_substring_regex(batch, _ODD)
        for t in self.added:
            apart = pc.or_(apart, pc.match_substring(batch, t))
        words = pc.utf8_split_whitespace(pc.if_else(apart, "", batch))
        coded = words.flatten().dictionary_encode()
        found, pair = self._pieces(coded.dictionary)
        # places fit 32 bits unless the texts are huge (normalising lengthens some)
        place = np.int32 if batch.nbytes < _SMALL else np.int64
        size = np.fromiter(map(len, found), np.int32, len(found)) // self.dtype.itemsize
        pool = np.frombuffer(b"".join(found), self.dtype)
        piece = pair[coded.indices.to_numpy()].ravel()
        cut = words.offsets.to_numpy()
        cut = 2 * (cut - cut[0])
        del found, pair, coded, words
        length = size[piece]
        ends = np.zeros(len(piece) + 1, place)
        np.cumsum(length, dtype=place, out=ends[1:])
        first = (np.cumsum(size, dtype=place) - size).astype(place)[piece]
        first -= ends[:-1]
        del piece
        at = np.repeat(first, length)
        at += np.arange(len(at), dtype=place)
        ids = pool[at]
        cut = ends[cut]
        del at, first, length, ends
        out = [np.append(ids[a:b], self.end) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for i in np.flatnonzero(apart.to_numpy(zero_copy_only=False)).tolist():
            text = batch[i].as_py()
            parts = [text] if any(t in text for t in self.added) else _WORD.findall(text)
            ids = b"".join(self._ids(parts))
            out[i] = np.append(np.frombuffer(ids, self.dtype), self.end)
        return out

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        return self.arrays(pa.array(batch, pa.string()))


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode(docs: DataFrame, path: str, end: int, window: int = WINDOW) -> DataFrame:
    """Per document: number of ids, crc of each whole window, the tail's ids,
    the distinct ids with their frequencies (at most 255), and a row number.
    Rows of negative doc_tokens hold a task's document frequencies, by block of
    ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path, end)
        release()    # what reading the vocabulary took
        df = np.zeros(-(-max(enc.tok.get_vocab_size(), end + 1) // _TERMS) * _TERMS, np.int64)
        for b in batches:
            for part in _parts(b):
                total, cols = [], ([], [], [], [])
                for ids in enc.arrays(part.column("text")):
                    n = len(ids)
                    cut = n - n % window
                    terms, tf = np.unique(ids, return_counts=True)
                    df[terms] += 1
                    total.append(n)
                    for col, x in zip(cols, (
                            np.array([crc(ids[i:i + window]) for i in range(0, cut, window)], "<u4"),
                            ids[cut:], terms, np.minimum(tf, 255).astype(np.uint8))):
                        col.append(x.tobytes())
                yield _batch(part.column("doc_id"), total, cols)
        if df.any():
            blocks = [x.tobytes() for x in df.reshape(-1, _TERMS)]
            none = [b""] * len(blocks)
            yield _batch(pa.nulls(len(blocks), pa.int64()), [-1 - i for i in range(len(blocks))],
                         (none, none, blocks, none))

        del enc, df
        release()

    return (texts(docs).mapInArrow(run, _DOC)
            .withColumn("row", F.monotonically_increasing_id()))


def _parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most BATCH documents, and of about BATCH_BYTES."""
    size = np.cumsum(pc.binary_length(b.column("text")).to_numpy(), dtype=np.int64)
    at = 0
    while at < b.num_rows:
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + BATCH_BYTES, "right")))
        end = min(end, at + BATCH)
        yield b.slice(at, end - at)
        at = end


def _batch(doc_id: pa.Array, total: list[int], cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(total, pa.int64()), *[pa.array(c, pa.binary()) for c in cols]],
        names=["doc_id", "doc_tokens", "full", "tail", "terms", "tf"])


@dataclass
class Corpus:
    """Documents, their mean length in ids, and each id's document frequency."""
    n: int
    mean: float
    df: np.ndarray

    def weight(self, term: np.ndarray, tf: np.ndarray, length) -> np.ndarray:
        """BM25 weights of terms in documents of the given lengths."""
        df, tf = self.df[term], tf.astype(np.float64)
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(self.mean, 1e-9)))


def corpus(encoded: DataFrame) -> Corpus:
    """Counts over the whole of ``encoded``."""
    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        df = sum(np.frombuffer(x, np.int64) for x in pdf["terms"])
        return pd.DataFrame({"block": [-1 - int(pdf["doc_tokens"].iloc[0])], "df": [df.tobytes()]})

    parts = sorted(encoded.filter("doc_tokens < 0").select("doc_tokens", "terms")
                   .groupBy("doc_tokens").applyInPandas(total, "block long, df binary").collect())
    n, length = encoded.filter("doc_tokens > 0").agg(
        F.count("*"), F.coalesce(F.avg("doc_tokens"), F.lit(0.0))).first()
    return Corpus(n, length, np.concatenate([np.frombuffer(r["df"], np.int64) for r in parts])
                  if parts else np.zeros(0, np.int64))


@cache
def _projection(size: int) -> tuple[np.ndarray, np.ndarray]:
    """One sparse random direction per id: SPARSE places and their signs (a
    fixed seed)."""
    r = np.random.default_rng(20240611)
    place = np.argpartition(r.random((size, DIM), np.float32), SPARSE, axis=1)[:, :SPARSE]
    return place.astype(np.int32), r.choice(np.array([-1, 1], np.float32), (size, SPARSE))


def vectors(whole: Corpus, terms: list[np.ndarray], tf: list[np.ndarray],
            length: np.ndarray) -> np.ndarray:
    """Projected BM25 weights of documents, of length one."""
    out = np.zeros((len(terms), DIM), np.float32)
    size = np.cumsum([len(t) for t in terms])
    place, sign = _projection(len(whole.df))
    at = 0
    while at < len(terms):  # about 50 000 terms at once
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + 50_000)))
        n = np.array([len(t) for t in terms[at:end]])
        term = np.concatenate(terms[at:end])
        weight = whole.weight(term, np.concatenate(tf[at:end]), np.repeat(length[at:end], n))
        cell = place[term] + np.repeat(np.arange(end - at, dtype=np.int32) * DIM, n)[:, None]
        out[at:end] = np.bincount(cell.ravel(), (sign[term] * weight[:, None]).ravel(),
                                  (end - at) * DIM).reshape(-1, DIM)
        at = end
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def nearest(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    step = max(1, 4_000_000 // len(centroids))
    return np.concatenate([np.argmax(v[i:i + step] @ centroids.T, axis=1)
                           for i in range(0, len(v), step)] or [np.zeros(0, np.int64)])


def centroids_of(v: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` centroids of vectors of length one; they start evenly spaced."""
    c = v[np.linspace(0, len(v) - 1, k).astype(np.int64)].copy()
    for _ in range(rounds):
        cell = nearest(v, c)
        order = np.argsort(cell, kind="stable")
        met, first = np.unique(cell[order], return_index=True)
        c[met] = np.add.reduceat(v[order], first)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def _read(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float16).reshape(-1, DIM).astype(np.float32)


@dataclass
class Shards:
    """Places of documents: first-level centroids, those below a large cell,
    and the shards and row-wise splits of the places."""
    top: np.ndarray
    below: dict[int, np.ndarray]
    shard: np.ndarray | None = None
    parts: np.ndarray | None = None

    def place(self, v: np.ndarray) -> np.ndarray:
        size = np.ones(len(self.top), np.int64)
        for cell, c in self.below.items():
            size[cell] = len(c)
        cell = nearest(v, self.top)
        out = (np.cumsum(size) - size)[cell]
        for i in np.unique(cell).tolist():
            if i in self.below:
                own = cell == i
                out[own] += nearest(v[own], self.below[i])
        return out

    def number(self, counts: dict[int, int]) -> None:
        """Neighbouring small places share a shard; large ones get several."""
        top = max(counts) + 1
        self.shard, self.parts = np.zeros(top, np.int64), np.ones(top, np.int64)
        at, held = 0, 0
        for place in sorted(counts):
            n = counts[place]
            if held and held + n > SHARD_DOCS:
                at, held = at + 1, 0
            self.shard[place] = at
            held += n
            if n > SHARD_DOCS * 3 // 2:
                self.parts[place] = -(-n // SHARD_DOCS)
                at, held = at + int(self.parts[place]), 0

    def of(self, v: np.ndarray, row: np.ndarray) -> np.ndarray:
        place = self.place(v)
        return self.shard[place] + row % self.parts[place]


def deal(encoded: DataFrame, whole: Corpus, dtype: np.dtype) -> DataFrame:
    """``encoded`` documents with their shard."""
    rows = encoded.filter("doc_tokens > 0")
    if not whole.n:
        return rows.drop("row").withColumn("shard", F.lit(0).cast("long"))
    spark = encoded.sparkSession
    known = spark.sparkContext.broadcast(whole)

    def vectors_of(b: pa.RecordBatch) -> np.ndarray:
        return vectors(known.value,
                       [np.frombuffer(x, dtype) for x in b.column("terms").to_pylist()],
                       [np.frombuffer(x, np.uint8) for x in b.column("tf").to_pylist()],
                       b.column("doc_tokens").to_numpy()).astype(np.float16)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), pa.array([x.tobytes() for x in vectors_of(b)], pa.binary())],
                    names=["row", "v"])

    # the vectors alone: the documents themselves are read again when they are dealt
    short = written(rows.select("row", "doc_tokens", "terms", "tf")
                    .mapInArrow(project, "row long, v binary"), scratch_path(spark, "vectors"))
    n_shards = -(-whole.n // SHARD_DOCS)
    k = min(CELLS, n_shards)
    every = max(1, whole.n // (k * SAMPLE))
    chosen = short.filter(F.pmod(F.xxhash64("row"), F.lit(every)) == 0)
    found = [bytes(r["v"]) for r in sorted(chosen.collect())] if n_shards > 1 else []
    shards = Shards(centroids_of(_read(found), k) if found else np.zeros((1, DIM), np.float32), {})
    held = spark.sparkContext.broadcast(shards)

    def places(use):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"place": use.value.place(_read(b["v"])), "row": b["row"],
                                    "v": b["v"]})
        return short.mapInPandas(run, "place long, row long, v binary")

    large = {r["place"]: -(-r["count"] // SHARD_DOCS)
             for r in places(held).groupBy("place").count().collect()
             if r["count"] > SHARD_DOCS * 3 // 2}
    if large:
        def divide(pdf: pd.DataFrame) -> pd.DataFrame:
            cell = int(pdf["place"].iloc[0])
            c = centroids_of(_read(pdf.sort_values("row")["v"]), large[cell])
            return pd.DataFrame({"place": [cell], "c": [c.astype(np.float32).tobytes()]})

        every = max(1, SHARD_DOCS // SAMPLE)
        part = places(held).filter(F.col("place").isin(list(large))
                                   & (F.pmod(F.xxhash64("row", F.lit(1)), F.lit(every)) == 0))
        shards.below = {r["place"]: np.frombuffer(r["c"], np.float32).reshape(-1, DIM)
                        for r in part.groupBy("place").applyInPandas(
                            divide, "place long, c binary").collect()}
        held = spark.sparkContext.broadcast(shards)
    shards.number({r["place"]: r["count"]
                   for r in places(held).groupBy("place").count().collect()})
    final = spark.sparkContext.broadcast(shards)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = vectors_of(b).astype(np.float32)
                shard = final.value.of(v, b.column("row").to_numpy())
                yield b.drop_columns(["row"]).append_column("shard", pa.array(shard, pa.int64()))

    return rows.mapInArrow(assign, f"{_DOC}, shard long")


class Index:
    """BM25 inverted index over the documents of a shard, weighted by the
    frequencies of the whole corpus."""

    def __init__(self, whole: Corpus, terms: list[np.ndarray], tf: list[np.ndarray],
                 length: np.ndarray):
        n = len(terms)
        size = np.array([len(t) for t in terms])
        doc = np.repeat(np.arange(n), size)
        term = np.concatenate(terms).astype(np.int64)
        weight = whole.weight(term, np.concatenate(tf), length[doc])
        self.vocab, term = np.unique(term, return_inverse=True)
        df = np.bincount(term, minlength=len(self.vocab))
        self.query = []  # each document's strongest terms
        ends = np.cumsum(size)
        for a, b in zip(ends - size, ends):
            own = term[a:b]
            if b - a > QUERY_TERMS:
                own = own[np.argpartition(-weight[a:b], QUERY_TERMS)[:QUERY_TERMS]]
            self.query.append(own[df[own] > 1])
        order = np.argsort(term, kind="stable")
        self.docs, self.weight = doc[order], weight[order]
        self.start = np.concatenate([[0], np.cumsum(df)])
        self.n = n

    def scores(self, doc: int) -> np.ndarray:
        q = self.query[doc]
        first, size = self.start[q], self.start[q + 1] - self.start[q]
        at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(self.docs[at], self.weight[at], self.n)


def _fill(left: np.ndarray, index: Index | None, window: int) -> Iterator[list[tuple[int, int]]]:
    """Windows as lists of (document, ids taken). ``left``: ids of each tail."""
    left = left.copy()
    order = np.argsort(-left, kind="stable")  # long tails seed first
    at, seed = 0, -1
    while True:
        if seed < 0 or left[seed] == 0:
            while at < len(order) and left[order[at]] == 0:
                at += 1
            if at == len(order):
                return
            seed = int(order[at])
        take = int(min(left[seed], window))
        left[seed] -= take
        filled, room, after = [(seed, take)], window - take, -1
        if room:
            score = index.scores(seed)
            score[left == 0] = -1
            ranked = np.argsort(-score, kind="stable")
            ranked = ranked[:np.count_nonzero(score >= 0)].tolist()
            pos = 0
            while room and pos < len(ranked):
                ahead = ranked[pos:pos + LOOK]
                fit = next((d for d in ahead if 0 < left[d] <= room), None)
                if fit is None:
                    rest = [d for d in ahead if left[d] > 0]
                    if rest:  # none fits: cut the nearest
                        filled.append((rest[0], room))
                        left[rest[0]] -= room
                        room, after = 0, rest[0]
                    pos += LOOK
                    continue
                filled.append((fit, int(left[fit])))
                room -= int(left[fit])
                left[fit] = 0
                while pos < len(ranked) and left[ranked[pos]] == 0:
                    pos += 1
        yield filled
        seed = after


def pack(docs: DataFrame, path: str, end: int = 1, window: int = WINDOW) -> DataFrame:
    """PIECE rows: every id of every document in exactly one piece.

    A document is its ids plus ``end``; null and empty texts have that one id.
    Sequences have at most ``window`` ids; all but the last of a shard are full.
    A null doc_id stays null; repeated rows are packed as documents of their
    own; an empty table gives an empty result; columns other than doc_id and
    text are ignored.
    """
    spark = docs.sparkSession
    dtype = Encoder(path, end).dtype
    encoded = written(encode(docs, path, end, window), scratch_path(spark, "encoded"))
    whole = corpus(encoded)
    known = spark.sparkContext.broadcast(whole)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        # a fixed order, whatever order the shuffle delivers
        pdf = pdf.sort_values(["doc_id", "tail"], kind="stable", ignore_index=True)
        ids = pdf["doc_id"].to_numpy("int64", na_value=-1)
        absent = pdf["doc_id"].isna().to_numpy()
        total = pdf["doc_tokens"].to_numpy()
        rows, seq = [], shard << 32
        for i, full in enumerate(pdf["full"]):
            for j, c in enumerate(np.frombuffer(full, "<u4").tolist()):
                rows.append((i, j * window, window, c, seq, 0))
                seq += 1
        tails = [np.frombuffer(x, dtype) for x in pdf["tail"]]
        left = np.array([len(t) for t in tails])
        index = Index(known.value, [np.frombuffer(x, dtype) for x in pdf["terms"]],
                      [np.frombuffer(x, np.uint8) for x in pdf["tf"]], total)
        done = np.zeros(len(tails), np.int64)
        for filled in _fill(left, index, window):
            offset = 0
            for i, n in filled:
                a = int(done[i])
                rows.append((i, int(total[i] - left[i]) + a, n, crc(tails[i][a:a + n]), seq,
                             offset))
                done[i] += n
                offset += n
            seq += 1
        i, start, length, c, s, o = (np.array(x, np.int64) for x in zip(*rows))
        doc = pd.array(ids[i], "Int64")
        doc[absent[i]] = pd.NA
        return pd.DataFrame({"doc_id": doc, "start": start, "length": length, "ids_crc32": c,
                             "doc_tokens": total[i], "sequence_id": s, "offset": o})

    return deal(encoded, whole, dtype).groupBy("shard").applyInPandas(run, PIECE)
