"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer network with temperature-calibrated probabilities.

1. Words are counted over the whole corpus. Those met ``LEAST`` times have a row
   of their own in the word table, at most ``DICTIONARY`` of them (the most
   frequent); rarer and unseen words fall back on one of ``ENDINGS`` rows that
   words of one case and ending share. So the table has a known largest size.
2. Random indexing over the whole corpus: a word's vector sums the sparse random
   index vectors of its neighbours. Every task adds up the rows it meets, and the
   sums are added block by block as they stream in.
3. A document is the mean of its words' vectors plus a few text statistics.
4. A two-layer numpy network is trained on a bounded sample of labelled rows
   (``MAX_TRAIN``, the smallest id hashes); a part held out of it sets the
   temperature of the probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import fold, most_frequent, release, texts, with_ids, written

DIM = 48
#: Rows of words without one of their own.
ENDINGS = 1 << 14
#: Words with rows of their own, at most, and how often they are met at least.
DICTIONARY = 1 << 17
LEAST = 5
#: Non-zero entries of an index vector.
SPARSE = 4
#: Neighbours on each side.
REACH = 2
#: Labelled documents that the network is fitted on, at most.
MAX_TRAIN = 20_000
HIDDEN = 32
STATS = 7
_ROWS = 1024
_MEMORY = 100_000
_FLUSH = 200_000
_CHUNK = 125_000
_PAIRS = 1 << 15

_WORD = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+|\n")


def _form(word: bytes) -> bytes:
    """The key of a word without a row of its own: short words are themselves,
    longer ones their case and ending, as similar words tend to share them."""
    if len(word) <= 3 or not (word[:1].isalpha() or word[0] > 127):
        return word[:4]
    if word.islower():
        return b"l:" + word[-3:]
    return (b"u:" if word == word.upper() else b"t:") + word[-3:].lower()


def words_of(text: str) -> list[bytes]:
    """Runs of letters, of digits and of other signs, and line ends."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass"))


def vocabulary(docs: DataFrame) -> dict[bytes, int]:
    """The words with rows of their own, numbered from ENDINGS on by falling count."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[bytes] = Counter()
        for b in batches:
            for text in b["text"]:
                held.update(words_of(text))
                if len(held) > _FLUSH:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held.clear()
        yield pd.DataFrame({"word": list(held), "n": list(held.values())})
        del held
        release()

    counts = written(texts(docs).select("text").mapInPandas(run, "word binary, n long")
                     .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST),
                     scratch_path(docs.sparkSession, "words"))
    # as a table: a row object of every word would take many times its bytes
    rows = (most_frequent(counts, "word", "n", DICTIONARY).toArrow()
            .sort_by([("n", "descending"), ("word", "ascending")]))
    index = {w: ENDINGS + i for i, w in enumerate(rows.column("word").to_pylist())}
    del rows
    release()
    return index


class Words(dict):
    """Numbers the words of texts by table row, remembering the shared rows' keys
    (most words that share one are met once; their endings are met often)."""

    def __init__(self, index: dict[bytes, int]):
        super().__init__(index)
        self.shared: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        form = _form(word)
        row = self.shared.get(form)
        if row is None:
            if len(self.shared) > _MEMORY:
                self.shared.clear()
            row = self.shared[form] = crc32(form) % ENDINGS
        return row

    def rows(self, text: str) -> tuple[np.ndarray, list[bytes]]:
        found = words_of(text)
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found)), found


def _index_vectors(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the sparse index vectors of ``n`` rows (a fixed seed)."""
    rng = np.random.default_rng(20240607)
    return (rng.integers(0, DIM, (n, SPARSE), dtype=np.uint8),
            rng.integers(0, 2, (n, SPARSE), dtype=np.int8) * np.int8(2) - np.int8(1))


def _add_neighbours(table: np.ndarray, w: np.ndarray, place: np.ndarray, sign: np.ndarray) -> None:
    """Add the index vectors of the words up to REACH away; -1 parts texts."""
    met = np.zeros(len(table) + 1, bool)     # the last one is of -1
    met[w] = True
    ids = np.flatnonzero(met[:-1])
    k = len(ids)
    number = np.full(len(table) + 1, -1)
    number[ids] = np.arange(k)
    local = number[w]
    keys = []
    for gap in range(1, REACH + 1):
        a, b = local[:-gap], local[gap:]
        ok = (a >= 0) & (b >= 0)
        a, b = a[ok], b[ok]
        keys += [a * k + b, b * k + a]
    # pairs are counted first: most of them repeat
    pair, n = np.unique(np.concatenate(keys), return_counts=True)
    del keys
    # then taken in order of their first word, so that few sums are open at a time
    for at in range(0, len(pair), _PAIRS):
        x, y = np.divmod(pair[at:at + _PAIRS], k)
        y, low = ids[y], int(x[0])
        cell = ((x - low) * DIM)[:, None] + place[y]
        sums = np.bincount(cell.ravel(), (n[at:at + _PAIRS, None] * sign[y]).ravel(),
                           (int(x[-1]) - low + 1) * DIM)
        table[ids[low:int(x[-1]) + 1]] += sums.reshape(-1, DIM).astype(np.float32)


def train_vectors(docs: DataFrame, index: dict[bytes, int]) -> np.ndarray:
    """The word table (a row per shared row, then per word of ``index``; float32)
    of a corpus."""
    size = ENDINGS + len(index)
    known = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, sign = _index_vectors(size)
        words, table = Words(known.value), np.zeros((size, DIM), np.float32)
        apart = np.full(REACH, -1)
        parts, held = [], 0
        for batch in batches:
            for text in batch["text"]:
                parts += [words.rows(text)[0], apart]
                held += len(parts[-2])
                if held > _CHUNK:
                    _add_neighbours(table, np.concatenate(parts), place, sign)
                    parts, held = [], 0
        if parts:
            _add_neighbours(table, np.concatenate(parts), place, sign)
        for at in range(0, size, _ROWS):
            block = table[at:at + _ROWS]
            met = np.flatnonzero(block.any(axis=1)).astype(np.uint16)
            if len(met):
                yield pd.DataFrame({"block": [at], "met": [met.tobytes()],
                                    "sums": [block[met].tobytes()]})
        del words, table, parts
        release()

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for at, met, sums in zip(b["block"], b["met"], b["sums"]):
                s = held.setdefault(int(at), np.zeros((_ROWS, DIM)))
                # whole numbers: the order of the sum does not matter
                s[np.frombuffer(met, np.uint16)] += np.frombuffer(sums, np.float32).reshape(-1, DIM)
        for at, s in held.items():
            yield pd.DataFrame({"block": [at], "sums": [s.astype(np.float32).tobytes()]})

    parts = (texts(docs).select("text").mapInPandas(run, "block int, met binary, sums binary")
             .repartition("block").mapInPandas(total, "block int, sums binary").toArrow())
    table = np.zeros((size, DIM), np.float32)
    for at, sums in zip(parts.column("block").to_pylist(), parts.column("sums")):
        block = table[at:at + _ROWS]
        block[:] = np.frombuffer(sums.as_buffer(), np.float32).reshape(-1, DIM)[:len(block)]
        block /= np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-6)
    parts = sums = None
    place, sign = _index_vectors(size)
    for j in range(SPARSE):  # a word also points at itself
        table[np.arange(size), place[:, j]] += np.float32(0.5) * sign[:, j]
    return table


@dataclass
class Vectors:
    """The words with rows of their own, and the table (half floats)."""
    index: dict[bytes, int]
    table: np.ndarray


def pool(words: Words, table: np.ndarray, text: str) -> np.ndarray:
    """Mean word vector and statistics of a text; zeros for one without words."""
    out = np.zeros(DIM + STATS, np.float32)
    found = words_of(text)
    n = len(found)
    if not n:
        return out
    own = dict.fromkeys(found)
    distinct = len(own)
    rows = np.fromiter(map(words.__getitem__, own), np.int64, distinct)
    own.update(zip(own, range(distinct)))
    at = np.fromiter(map(own.__getitem__, found), np.int64, n)
    met = np.bincount(at)
    order = np.argsort(rows, kind="stable")
    row, first = np.unique(rows[order], return_index=True)
    count = np.add.reduceat(met[order], first)
    out[:DIM] = count.astype(np.float32) @ table[row].astype(np.float32) / n
    pairs = np.sort(at[:-1] * distinct + at[1:])
    lines = text.split("\n")
    letters = len(b"".join(found))
    out[DIM:] = (np.log1p(n), distinct / n, np.log(distinct + 1) / np.log(n + 1.5), letters / n / 10,
                 len(set(lines)) / len(lines), count.max() / n,
                 (np.count_nonzero(np.diff(pairs)) + (n > 1)) / n)
    return out


@dataclass
class Network:
    """Standardisation, two layers and a temperature; ``w1`` None: a constant."""
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray | None
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        if self.w1 is None:
            return np.full(len(x), self.b2)
        h = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(x) / self.temperature, -30, 30)
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 40, seed: int = 7) -> Network:
    """Adam on the logistic loss, then the temperature on a held-out fifth.

    Without rows, or with one class only, the network is the class frequency.
    """
    k = x.shape[1]
    if len(np.unique(y)) < 2:
        p = (y.sum() + 0.5) / (len(y) + 1)
        return Network(np.zeros(k), np.ones(k), None, np.zeros(1), np.zeros(1),
                       float(np.log(p / (1 - p))) if len(y) else 0.0, 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, own = order[:len(y) // 5], order[len(y) // 5:]
    if len(np.unique(y[own])) < 2:
        own = order
    mean, scale = x[own].mean(0), x[own].std(0) + 1e-3
    z = (x - mean) / scale
    par = [rng.normal(0, np.sqrt(2 / k), (k, HIDDEN)), np.zeros(HIDDEN),
           rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(())]
    m, v, t = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par], 0
    for _ in range(epochs):
        own = rng.permutation(own)
        for at in range(0, len(own), 128):
            i = own[at:at + 128]
            a = z[i] @ par[0] + par[1]
            h = np.maximum(a, 0)
            g = (1 / (1 + np.exp(-np.clip(h @ par[2] + par[3], -30, 30))) - y[i]) / len(i)
            back = np.outer(g, par[2]) * (a > 0)
            grads = [z[i].T @ back + 1e-4 * par[0], back.sum(0), h.T @ g + 1e-4 * par[2], g.sum()]
            t += 1
            for j, d in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * d
                v[j] = 0.999 * v[j] + 0.001 * d * d
                par[j] = par[j] - 0.005 * (m[j] / (1 - 0.9 ** t)) / (
                    np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8)
    net = Network(mean, scale, par[0], par[1], par[2], float(par[3]), 1.0)
    if len(held):
        s, target = net.logits(x[held]), y[held]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.mean(np.logaddexp(0, s / t) - target * s / t) for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def sample_ids(labels: DataFrame, train: Column) -> DataFrame:
    """(doc_id, quality) of at most MAX_TRAIN labelled training rows: those of
    the smallest id hashes. Rows without an id or a label are left out; of an
    id labelled twice the larger label counts."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("quality").cast("int").alias("quality"))
            .filter(train & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
            .groupBy("doc_id").agg(F.max("quality").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN))


def train(docs: DataFrame, labels: DataFrame, is_train: Column) -> tuple[Vectors, Network]:
    """(word vectors, network): vectors of the whole corpus, labels of the sample."""
    spark = docs.sparkSession
    index = vocabulary(docs)
    vectors = Vectors(index, train_vectors(docs, index).astype(np.float16))
    held = spark.sparkContext.broadcast(vectors)
    chosen = {r["doc_id"]: r["quality"] for r in sample_ids(labels, is_train).collect()}
    ids = spark.createDataFrame([(i,) for i in chosen], "doc_id long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, table = Words(held.value.index), held.value.table
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "x": [
                pool(words, table, t).tobytes() for t in b["text"]]})
        del words, table
        release()

    rows = with_ids(texts(docs), ids).mapInPandas(run, "doc_id long, x binary")
    # of rows that repeat an id one is used, so the result stays bounded
    rows = sorted(rows.groupBy("doc_id").agg(F.max("x").alias("x")).collect())
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows],
                 np.float64).reshape(-1, DIM + STATS)
    y = np.array([chosen[r["doc_id"]] for r in rows], np.float64)
    net = fit(x, y)
    del rows, x, y
    release()
    return vectors, net


def score(docs: DataFrame, vectors: Vectors, net: Network) -> DataFrame:
    """doc_id, score: the calibrated probability of label 1, one row per input row.

    Null and empty texts are scored as texts without words; a null doc_id stays
    null; repeated rows get equal scores; columns other than doc_id and text are
    ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, network = model.value
        words = Words(own.index)
        for b in batches:
            x = np.array([pool(words, own.table, t) for t in b["text"]],
                         np.float64).reshape(-1, DIM + STATS)
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": network.probability(x)})
        del words
        release()

    return texts(docs).mapInPandas(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 3, left_out: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Labels are learnt from
    rows whose crc32 of the id modulo ``modulus`` is not ``left_out``.

    Null and empty texts are texts without words; a null doc_id is of no label and
    stays null; repeated rows are counted, learnt as one label, and scored each;
    without labels of both kinds the score is their frequency (none: 0.5); an
    empty table gives an empty result; other columns are ignored.
    """
    vectors, net = train(docs, labels, fold(modulus) != left_out)
    return score(docs, vectors, net).select(
        "doc_id", (fold(modulus) == left_out).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
