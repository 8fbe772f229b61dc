"""Hashed maximum-entropy language model with a class-factored softmax.

p(token | history) = p(class | history) * p(token | class, history). The
``HEAD`` most frequent tokens are dealt to ``CLASSES`` classes of like mass; one
more class stands for all other tokens, whose share inside it is their add-one
unigram estimate (with one unseen type), so the model sums to one over every
known token and an unknown one. The scores of both layers are sums of hashed
feature rows: bigram and trigram histories and a skip feature.

Counts cover all training rows. The weights are trained by distributed gradient
updates: in each round every task runs minibatches over its part of the round's
documents from the shared weights and returns its change; changes are averaged
per feature row, weighted by how often a task met the row. Texts are looked up in
the dictionary once and written as token numbers, which every round and the scoring
read. They are scored in numpy batches that gather the few active rows; tokens
outside the broadcast dictionary (of bounded size) get their counts by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import most_frequent, texts, written

CLASSES = 32
WIDTH = 32
#: Tokens with weights of their own.
HEAD = CLASSES * WIDTH
#: Most frequent tokens whose counts are broadcast; the others are joined.
DICTIONARY = 300_000
#: History keys of tokens outside the head, by their ending.
ENDINGS = 4096
CLASS_ROWS = 1 << 13
WORD_ROWS = 1 << 15
ROUNDS = 3
RATE = 0.3
_FLUSH = 1_000_000
_CHUNK = 60_000
_SCORED = 8192
_PART = 4096
_BLOCK = 1024

#: The end of a text: no word is empty.
END = b""


def tokens(text: str) -> list[bytes]:
    """Words (A-Z lower-cased, split at 0x20 and 0x09-0x0D), then the end."""
    out = text.encode("utf-8", "surrogatepass").lower().split()
    out.append(END)
    return out


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, c) over all rows; a task adds up before it emits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from collections import Counter
        held: Counter[bytes] = Counter()
        for b in batches:
            for text in b["text"]:
                held.update(tokens(text))
            if len(held) > _FLUSH:
                yield pd.DataFrame({"token": list(held), "n": list(held.values())})
                held.clear()
        yield pd.DataFrame({"token": list(held), "n": list(held.values())})

    return (docs.select("text").mapInPandas(run, "token binary, n long")
            .groupBy("token").agg(F.sum("n").alias("c")))


@dataclass
class Vocabulary:
    """The dictionary: token -> index by falling count; arrays by index."""
    index: dict[bytes, int]
    logc: np.ndarray      # log10(c + 1)
    cls: np.ndarray       # class, CLASSES for the rest class
    slot: np.ndarray      # place inside the class
    key: np.ndarray       # history key
    size: np.ndarray      # tokens per class
    n: int                # training tokens
    v: int                # distinct training tokens
    rest: int             # add-one mass of the rest class: its tokens, types and one unseen
    start: np.ndarray = field(default=None)  # initial class scores
    inner: np.ndarray = field(default=None)  # initial scores inside the classes


def _ending(token: bytes) -> int:
    return HEAD + crc32(token[-3:]) % ENDINGS


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Classes, history keys and first scores from the training counts."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    rows = most_frequent(counts, "token", "c", DICTIONARY).collect()
    rows.sort(key=lambda r: (-r["c"], bytes(r["token"])))
    tok = [bytes(r["token"]) for r in rows]
    c = np.array([r["c"] for r in rows], np.int64)
    head = min(HEAD, len(tok))
    cls = np.full(len(tok), CLASSES, np.int64)
    slot = np.zeros(len(tok), np.int64)
    # by falling count, each to the next class in turn, back and forth
    turn, lap = np.arange(head) % CLASSES, np.arange(head) // CLASSES
    cls[:head] = np.where(lap % 2 == 0, turn, CLASSES - 1 - turn)
    slot[:head] = lap
    size = np.bincount(cls[:head], minlength=CLASSES)
    key = np.array([i if i < head else _ending(t) for i, t in enumerate(tok)], np.int64)
    in_head = int(c[:head].sum())
    rest = int(total["n"]) - in_head + int(total["v"]) - head + 1
    mass = np.append(np.bincount(cls[:head], c[:head] + 1.0, CLASSES) + 1e-9, rest)
    inner = np.full((CLASSES, WIDTH), -np.inf)
    inner[cls[:head], slot[:head]] = np.log(c[:head] + 1.0)
    return Vocabulary({t: i for i, t in enumerate(tok)}, np.log10(c + 1.0), cls, slot, key, size,
                      int(total["n"]), int(total["v"]), rest, np.log(mass), inner)


class Weights:
    """Rows of both layers; the first scores are kept apart and fixed."""

    def __init__(self, w1: np.ndarray | None = None, w2: np.ndarray | None = None):
        self.w1 = np.zeros((CLASS_ROWS, CLASSES + 1), np.float32) if w1 is None else w1
        self.w2 = np.zeros((WORD_ROWS, WIDTH), np.float32) if w2 is None else w2


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint32)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def encode(vocab: Vocabulary, text: str) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of a text's tokens (int32), and its tokens outside the dictionary:
    they are numbered -1 minus their ending."""
    found = tokens(text)
    codes = np.fromiter(map(vocab.index.get, found, repeat(-1)), np.int32, len(found))
    unknown = np.flatnonzero(codes < 0)
    missing = [found[i] for i in unknown.tolist()]
    codes[unknown] = [-1 - crc32(t[-3:]) % ENDINGS for t in missing]
    return codes, missing


class Batch:
    """Tokens of some texts, flat; the texts may be given by their numbers."""

    def __init__(self, vocab: Vocabulary, batch: list[str], codes: list[np.ndarray] | None = None):
        if codes is None:
            codes = [encode(vocab, t)[0] for t in batch]
        self.sizes = np.array([len(c) for c in codes], np.int64)
        flat = np.concatenate(codes).astype(np.int64)
        known = flat >= 0
        self.ids = ids = np.where(known, flat, -1)
        key = np.where(known, vocab.key[ids] if len(vocab.key) else 0, HEAD - 1 - flat)
        ends = np.cumsum(self.sizes)
        self.doc = np.repeat(np.arange(len(codes)), self.sizes)
        self.cls = np.where(known, vocab.cls[ids] if len(vocab.cls) else CLASSES, CLASSES)
        self.slot = np.where(self.cls < CLASSES, vocab.slot[ids] if len(vocab.slot) else 0, 0)
        # history keys: 1 + key, 0 before the text
        place = np.arange(len(ids)) - np.repeat(ends - self.sizes, self.sizes)
        past = [np.where(place >= g, np.roll(key, g) + 1, 0) for g in (1, 2)]
        a, b = (p.astype(np.uint32) for p in past)
        self.features = [
            _mix(a * np.uint32(4) + np.uint32(1)),                    # last token
            _mix(a * np.uint32(0x9E3779B1) + b * np.uint32(8) + np.uint32(2)),  # last two
            _mix(b * np.uint32(4) + np.uint32(3)),                    # skip one
        ]

    def class_rows(self, part: slice) -> list[np.ndarray]:
        return [(f[part] % np.uint32(CLASS_ROWS)).astype(np.int64) for f in self.features]

    def word_rows(self, at: np.ndarray) -> list[np.ndarray]:
        cls = self.cls[at].astype(np.uint32) * np.uint32(0x85EBCA6B)
        return [(_mix(f[at] ^ cls) % np.uint32(WORD_ROWS)).astype(np.int64)
                for f in self.features]


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def _log_chosen(scores: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """log10 of the softmax at one column per row."""
    scores -= scores.max(axis=1, keepdims=True)
    own = scores[np.arange(len(chosen)), chosen]
    total = np.exp(scores, out=scores).sum(axis=1)
    return (own.astype(np.float64) - np.log(total)) / np.log(10)


def _gather(first: np.ndarray, w: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    s = w[rows[0]]
    for r in rows[1:]:
        s += w[r]
    s += first
    return s


def _probabilities(w: np.ndarray, rows: list[np.ndarray], first) -> np.ndarray:
    """Softmax per token; ``first(part)`` gives the first scores of a part, and
    parts are small, so that they stay in the processor's cache."""
    n = len(rows[0])
    out = np.empty((n, w.shape[1]), np.float32)
    for lo in range(0, n, _PART):
        k = slice(lo, lo + _PART)
        out[k] = _softmax(_gather(first(k), w, [r[k] for r in rows]))
    return out


def log_probability(vocab: Vocabulary, weights: Weights, batch: Batch) -> np.ndarray:
    """log10 p(token | history) per token; a token of the rest class gets the
    class's part and 1 / rest, i.e. lacks log10(c + 1)."""
    n = len(batch.ids)
    out = np.empty(n)
    first, inner = vocab.start.astype(np.float32), vocab.inner.astype(np.float32)
    for lo in range(0, n, _SCORED):
        part = slice(lo, min(lo + _SCORED, n))
        cls = batch.cls[part]
        q = _log_chosen(_gather(first, weights.w1, batch.class_rows(part)), cls)
        at = np.flatnonzero(cls < CLASSES)
        if len(at):
            g = at + lo
            q[at] += _log_chosen(_gather(inner[cls[at]], weights.w2, batch.word_rows(g)),
                                 batch.slot[g])
        q[cls == CLASSES] -= np.log10(vocab.rest)
        out[part] = q
    return out


class Learner:
    """Minibatch updates of a local copy, with one step size per row."""

    def __init__(self, weights: Weights):
        self.layers = [weights.w1.copy(), weights.w2.copy()]
        self.before = [weights.w1, weights.w2]
        self.power = [np.zeros(len(w), np.float32) for w in self.layers]
        self.met = [np.zeros(len(w), np.float32) for w in self.layers]

    def _update(self, layer: int, rows: list[np.ndarray], grad: np.ndarray) -> None:
        w = self.layers[layer]
        width = grad.shape[1]
        # column by column: what is being added up stays in the processor's cache
        columns = np.ascontiguousarray(grad.T, np.float64)
        for r in rows:
            order = np.argsort(r.astype(np.uint16), kind="stable")  # a radix sort
            sorted_rows = r[order]
            new = np.append(True, sorted_rows[1:] != sorted_rows[:-1])
            number = np.empty(len(r), np.int64)
            number[order] = np.cumsum(new) - 1
            row = sorted_rows[new]
            g = np.empty((len(row), width), np.float32)
            for c in range(width):
                g[:, c] = np.bincount(number, columns[c], len(row))
            self.met[layer][row] += np.bincount(number, minlength=len(row))
            self.power[layer][row] += (g * g).sum(axis=1)
            w[row] -= RATE * g / np.sqrt(self.power[layer][row] + 1.0)[:, None]

    def learn(self, vocab: Vocabulary, batch: Batch) -> None:
        n = len(batch.ids)
        first, inner = vocab.start.astype(np.float32), vocab.inner.astype(np.float32)
        for lo in range(0, n, _CHUNK // 4):
            part = slice(lo, min(lo + _CHUNK // 4, n))
            cls = batch.cls[part]
            rows = batch.class_rows(part)
            p = _probabilities(self.layers[0], rows, lambda k: first)
            p[np.arange(len(cls)), cls] -= 1
            self._update(0, rows, p)
            at = np.flatnonzero(cls < CLASSES)
            if len(at):
                g = at + lo
                rows = batch.word_rows(g)
                own = cls[at]
                p = _probabilities(self.layers[1], rows, lambda k: inner[own[k]])
                p[np.arange(len(at)), batch.slot[g]] -= 1
                self._update(1, rows, p)

    def changes(self) -> Iterator[pd.DataFrame]:
        """Per block of rows: changes times weights, and weights (half floats
        scaled by the block's largest)."""
        for layer, (w, old, met) in enumerate(zip(self.layers, self.before, self.met)):
            for at in range(0, len(w), _BLOCK):
                d = (w[at:at + _BLOCK] - old[at:at + _BLOCK]).astype(np.float16)
                yield pd.DataFrame({"layer": [layer], "at": [at], "change": [d.tobytes()],
                                    "met": [met[at:at + _BLOCK].tobytes()]})


def _pieces(b: pd.DataFrame, limit: int = 400_000) -> Iterator[pd.DataFrame]:
    """Parts of a batch with about ``limit`` characters each."""
    size = b["n_chars"].to_numpy().cumsum()
    cut = np.searchsorted(size, np.arange(limit, size[-1], limit)) + 1 if len(b) else []
    at = 0
    for end in [*np.unique(cut).tolist(), len(b)]:
        if end > at:
            yield b.iloc[at:end]
        at = end


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``docs`` with token numbers instead of the text: n_chars, codes (int32),
    and words, the tokens outside the dictionary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    keep = [f for f in docs.schema if f.name != "text"]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in keep]
                       + ["n_chars long", "codes binary", "words array<binary>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [encode(shared.value, t) for t in b["text"]]
            yield b.drop(columns="text").assign(
                n_chars=[len(t) for t in b["text"]], codes=[c.tobytes() for c, _ in found],
                words=[m for _, m in found])

    return docs.mapInPandas(run, schema)


def _batch(vocab: Vocabulary, part: pd.DataFrame) -> Batch:
    return Batch(vocab, [], [np.frombuffer(c, np.int32) for c in part["codes"]])


def train(docs: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """Every document (texts, or ``encoded`` ones) is learnt from once, in the
    round its id's hash names."""
    spark = docs.sparkSession
    if "codes" not in docs.columns:
        docs = encoded(docs.select("doc_id", "text"), vocab)
    weights = Weights()
    shared = spark.sparkContext.broadcast(replace(vocab, index={}))
    schema = "layer int, at int, change binary, met binary"

    def average(pdf: pd.DataFrame) -> pd.DataFrame:
        layer, at = int(pdf["layer"].iloc[0]), int(pdf["at"].iloc[0])
        total = mass = None
        for change, met in sorted(zip(pdf["change"], pdf["met"])):  # a fixed order
            m = np.frombuffer(met, np.float32).astype(np.float64)
            c = np.frombuffer(change, np.float16).reshape(len(m), -1) * m[:, None]
            total, mass = (c, m) if total is None else (total + c, mass + m)
        mean = (total / np.maximum(mass, 1)[:, None]).astype(np.float32)
        return pd.DataFrame({"layer": [layer], "at": [at], "change": [mean.tobytes()],
                             "met": [mass.astype(np.float32).tobytes()]})

    turn = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1))), F.lit(rounds))
    for r in range(rounds):
        held = spark.sparkContext.broadcast((weights.w1, weights.w2))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            learner, met = Learner(Weights(*held.value)), False
            for b in batches:
                for part in _pieces(b):
                    learner.learn(shared.value, _batch(shared.value, part))
                    met = True
            if met:
                yield from learner.changes()

        rows = (docs.filter(turn == r).select("n_chars", "codes").mapInPandas(run, schema)
                .groupBy("layer", "at").applyInPandas(average, schema).collect())
        w1, w2 = weights.w1.copy(), weights.w2.copy()
        for row in rows:
            w = (w1, w2)[row["layer"]]
            w[row["at"]:row["at"] + _BLOCK] += np.frombuffer(row["change"], np.float32).reshape(
                -1, w.shape[1])
        weights = Weights(w1, w2)
    return weights


def score(docs: DataFrame, is_train: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row; ``is_train`` marks the rows to learn from.

    Null and empty texts are the end token alone; a null doc_id stays null;
    repeated rows are learnt from and scored each; without a training row every
    token is unknown; an empty table gives an empty result; columns other than
    doc_id and text are ignored.
    """
    spark = docs.sparkSession
    d = texts(docs).withColumn("is_train", is_train)
    own = d.filter("is_train")
    counts = written(count_tokens(own), scratch_path(spark, "lm-counts"))
    vocab = vocabulary(counts)
    d = written(encoded(d.withColumn("row", F.monotonically_increasing_id()), vocab),
                scratch_path(spark, "lm-codes"))
    weights = train(d.filter("is_train"), vocab)
    model = spark.sparkContext.broadcast((replace(vocab, index={}), weights.w1, weights.w2))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab, w1, w2 = model.value
        w = Weights(w1, w2)
        logc = np.append(vocab.logc, 0.0)  # -1: to be joined
        for b in batches:
            for part in _pieces(b):
                batch = _batch(vocab, part)
                k = len(part)
                lp = log_probability(vocab, w, batch)
                lc = logc[batch.ids]
                lp[batch.cls == CLASSES] += lc[batch.cls == CLASSES]
                yield pd.DataFrame({
                    "row": part["row"].to_numpy(), "doc_id": part["doc_id"].to_numpy(),
                    "is_train": part["is_train"].to_numpy(), "n_tokens": batch.sizes,
                    "n_known": np.bincount(batch.doc, batch.ids >= 0, k).astype(np.int64),
                    "base": np.bincount(batch.doc, lc, k),
                    "lp": np.bincount(batch.doc, lp, k)}).astype({"doc_id": "Int64"})

    schema = ("row long, doc_id long, is_train boolean, n_tokens long, n_known long, "
              "base double, lp double")
    rows = written(d.select("row", "doc_id", "is_train", "n_chars", "codes")
                   .mapInPandas(run, schema), scratch_path(spark, "lm-rows"))
    # Tokens outside the dictionary are rare ones: no hot key in this join.
    rare = d.select("row", F.explode("words").alias("token")).join(
        counts, "token").groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count("*").alias("known"))
    norm = float(np.log10(vocab.n + vocab.v + 1))
    more = F.coalesce("more", F.lit(0.0))
    return (rows.join(rare, "row", "left").select(
        "doc_id", (~F.col("is_train")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("lp") + more).alias("score")))
